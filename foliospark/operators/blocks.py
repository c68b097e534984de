"""Blocks of documents: splitting, headings, links, page contexts, replacement of pages.

Order is kept within a document (columns doc_id, pos), so windows are by document and
no global sort is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.lexicon import CHUNK_LIMITS, DEFAULT, Lexicon


_strip = T.strip


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(_strip(text), r"\n{2,}"), _strip), lambda p: p != "")


def chunks(text: Column, limit: int) -> Column:
    """Array of chunks of at most `limit` characters: paragraphs packed greedily, long ones cut."""
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))
    flushed = lambda a: F.when(a["cur"] != "", F.array_append(a["out"], _strip(a["cur"]))).otherwise(a["out"])
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.length(p) - 1) / limit).cast("int")), lambda i: _strip(F.substr(p, i * limit + 1, F.lit(limit))))

    def pack(a: Column, p: Column) -> Column:
        long = F.struct(F.concat(flushed(a), cut(p)).alias("out"), F.lit("").alias("cur"))
        full = F.struct(flushed(a).alias("out"), p.alias("cur"))
        more = F.struct(a["out"].alias("out"), F.when(a["cur"] != "", F.concat(a["cur"], F.lit("\n\n"), p)).otherwise(p).alias("cur"))
        return F.when(F.length(p) > limit, long).when((a["cur"] != "") & (F.length(a["cur"]) + F.length(p) + 2 > limit), full).otherwise(more)

    packed = lambda whole: F.aggregate(paragraphs(whole), empty, pack, flushed)
    return T.let(_strip(text), lambda whole: F.when(whole == "", F.array().cast("array<string>")).when(F.length(whole) <= limit, F.array(whole)).otherwise(packed(whole)))


def chunks_by_type(text: Column, kind: Column) -> Column:
    out = chunks(text, CHUNK_LIMITS["other"])
    for k in ("text", "procedure"):
        out = F.when(kind == k, chunks(text, CHUNK_LIMITS[k])).otherwise(out)
    return out


def code_segments(canon: Column, lex: Lexicon = DEFAULT) -> Column:
    """From each code to the next; text before the first is left out."""
    parts = F.split(canon, r"(?=" + lex.compact_code.replace("(?i)", "(?i:") + "))")
    return F.filter(F.transform(parts, _strip), lambda p: p.rlike("^" + lex.compact_code.replace(r"\b(", "(", 1)))


def merged_short(parts: Column, short: int = 80, limit: int = 300) -> Column:
    """Neighbours are merged while the current one is short and both fit."""
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(a: Column, p: Column) -> Column:
        joined = F.concat(a["cur"], F.lit("\n"), p)
        return (
            F.when(a["cur"] == "", F.struct(a["out"].alias("out"), p.alias("cur")))
            .when((F.length(a["cur"]) < short) & (F.length(joined) <= limit), F.struct(a["out"].alias("out"), joined.alias("cur")))
            .otherwise(F.struct(F.array_append(a["out"], a["cur"]).alias("out"), p.alias("cur")))
        )

    return F.aggregate(parts, empty, step, lambda a: F.when(a["cur"] != "", F.array_append(a["out"], a["cur"])).otherwise(a["out"]))


def steps(text: Column, lex: Lexicon = DEFAULT) -> Column:
    """Lines gathered into steps; a step begins at a step mark."""
    lines = F.filter(F.transform(F.split(text, "\n"), _strip), lambda x: x != "")
    empty = F.array().cast("array<string>")

    def add(a: Column, x: Column) -> Column:
        last = F.concat(F.element_at(a, -1), F.lit("\n"), x)
        return F.when((F.size(a) == 0) | x.rlike(lex.step_start), F.array_append(a, x)).otherwise(F.array_append(F.slice(a, F.lit(1), F.size(a) - 1), last))

    return F.aggregate(lines, empty, add)


def rows_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), _strip), lambda x: x != "")


def exploded(df: DataFrame, parts: Column, name: str = "text") -> DataFrame:
    return df.select("*", F.posexplode(parts).alias("part_no", "part_")).drop(name).withColumnRenamed("part_", name)


def with_hierarchy(df: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """chapter, section, section_path: the last heading above, a chapter ending the section before it."""
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = F.trim("text")
    head = T.is_heading(F.col("text"))
    chapter = F.when(head & T.is_chapter(t), F.struct("pos", t.alias("t")))
    section = F.when(head & ~T.is_chapter(t) & T.is_section(t), F.struct("pos", t.alias("t")))
    df = df.withColumn("c_", F.last(chapter, ignorenulls=True).over(w)).withColumn("s_", F.last(section, ignorenulls=True).over(w))
    valid = F.col("s_").isNotNull() & (F.col("c_").isNull() | (F.col("s_.pos") > F.col("c_.pos")))
    df = df.withColumn("chapter", F.coalesce("c_.t", F.lit(""))).withColumn("section", F.when(valid, F.col("s_.t")).otherwise(""))
    return df.withColumn("section_path", T.section_path(F.col("chapter"), F.col("section"))).drop("c_", "s_")


def relink(df: DataFrame, before: int = 2, after: int = 2) -> DataFrame:
    """prev/next ids, and the ids around by position that aren't page contexts (not filled up)."""
    w = Window.partitionBy("doc_id").orderBy("pos")

    def near(a: int, b: int) -> Column:
        found = F.collect_list(F.struct("block_id", "block_type")).over(w.rowsBetween(a, b))
        return F.transform(F.filter(found, lambda x: x["block_type"] != "page_context"), lambda x: x["block_id"])

    return df.select("*", F.lag("block_id").over(w).alias("prev_block_id"), F.lead("block_id").over(w).alias("next_block_id"), near(-before, -1).alias("context_prev"), near(1, after).alias("context_next"))


def dense_pages(df: DataFrame, threshold: int = 3) -> DataFrame:
    """`code_dense` of candidates and plain text: their page's blocks have so many codes in all."""
    dense = F.sum(F.size("codes")).over(Window.partitionBy("doc_id", "page_no")) >= threshold
    return df.withColumn("code_dense", dense & F.col("block_type").isin("alarm_candidate", "table_candidate", "text"))


def refine_reasons() -> Column:
    return F.array_compact(
        F.array(
            F.when(F.col("block_type") == "alarm_candidate", "alarm_candidate"),
            F.when(F.col("block_type") == "table_candidate", "table_candidate"),
            F.when(F.size("codes") >= 3, "alarm_dense"),
            F.when(F.col("block_type") == "image", "image"),
        )
    )


def replace_pages(old: DataFrame, new: DataFrame, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """old without the blocks (of some types, or all) of pages that new has, and new."""
    pages = new.select("doc_id", "page_no").distinct()
    gone = old.where(F.col("block_type").isin(*kinds)) if kinds else old
    kept = gone.join(pages, ["doc_id", "page_no"], "left_anti")
    if kinds:
        kept = kept.unionByName(old.where(~F.col("block_type").isin(*kinds)))
    return kept.unionByName(new, allowMissingColumns=True)
