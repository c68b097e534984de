"""Blocks out of layout items, and pages built anew from better text.

Everything is ordered within a document, so windows are by document and no global sort is
needed. The time stamps of the data model are left to the caller: they'd make results differ from run to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.lexicon import BLOCK_SOURCES, DEFAULT, Lexicon
from foliospark.operators import blocks as B
from foliospark.runtime import shuffle_partitions

PICTURES = "picture|image|figure"
DENSE = 3


def page_image(doc: Column, page: Column) -> Column:
    return F.when(page > 0, F.array(F.concat(F.lit("data/images/"), doc.cast("string"), F.lit("/page_"), T.padded(page, 4), F.lit(".png")))).otherwise(F.array().cast("array<string>"))


def context_id(doc: Column, page: Column) -> Column:
    return F.when(page > 0, F.concat(doc.cast("string"), F.lit("_page_"), T.padded(page, 4), F.lit("_context")))


def level(kind: Column) -> Column:
    return F.when(kind.isin("alarm", "alarm_candidate"), 2).when(kind == "page_context", 1).otherwise(3)


def described(df: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """What follows from doc_id, page_no, block_type, text, chapter and section: canonical text, codes, title, search text, ids."""
    df = df.withColumn("canonical_text", T.canonical(F.col("text"), lex, unicode)).withColumn("codes", T.codes(F.col("canonical_text"), lex))
    heading = F.coalesce(F.when(F.col("section") != "", F.col("section")), F.col("chapter"))
    df = df.withColumn("title", F.when(F.size("codes") > 0, F.get("codes", F.lit(0))).otherwise(heading))
    df = df.withColumn("section_path", T.section_path(F.col("chapter"), F.col("section")))
    return df.withColumns({
        "searchable_text": T.searchable(F.col("title"), F.col("codes"), F.col("section_path"), F.col("canonical_text")),
        "block_level": level(F.col("block_type")),
        "source_priority": T.priority(F.col("block_type"), lex),
        "page_context_id": context_id(F.col("doc_id"), F.col("page_no")),
    })


def candidate_type(text: Column, label: Column, lex: Lexicon = DEFAULT) -> Column:
    return F.when(F.size(T.codes(text, lex)) > 0, "alarm_candidate").otherwise(T.block_type(text, label, lex))


def build_blocks(items: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True, contexts: bool = True) -> DataFrame:
    """items: doc_id, page_no (null: unknown), layout_ref, layout_type, text, ocr_confidence. Blocks in the order of
    pages and references (as strings), with headings carried forward; page contexts come after all of a
    document's blocks; without `contexts` there are none, and all else but the id after a document's last block is the same. `pos` is the place in the document.

    The subsection of a hierarchy stays empty: what is taken for a heading is always a chapter or a section."""
    picture = F.lower("layout_type").rlike(PICTURES)
    bare = T.strip(F.coalesce("text", F.lit("")))
    # The number is given, since Spark would gather the small items into few tasks, and all the work on texts is done in these.
    items = items.repartition(shuffle_partitions(items.sparkSession), "doc_id")
    rows = items.withColumn("text", bare).where((F.col("text") != "") | picture)
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.coalesce("page_no", F.lit(0)), "layout_ref")))
    rows = B.with_hierarchy(rows, lex).withColumn("page_no", F.coalesce("page_no", F.lit(-1)))
    rows = rows.withColumn("block_type", F.when(F.col("text") == "", "image").otherwise(candidate_type(F.col("text"), F.col("layout_type"), lex)))
    segments = B.code_segments(T.canonical(F.col("text"), lex, unicode), lex)
    parts = F.when(F.col("block_type") == "image", F.array(F.lit(""))).when(F.col("block_type") == "alarm_candidate", T.let(segments, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array("text"))))
    rows = B.exploded(rows, parts.otherwise(B.chunks_by_type(F.col("text"), F.col("block_type"))))
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "part_no"))).drop("part_no")
    rows = described(rows, lex, unicode).withColumns({
        "block_id": F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("_b"), T.padded(F.col("pos"), 6)),
        "layout_refs": F.array("layout_ref"),
        "image_paths": page_image(F.col("doc_id"), F.col("page_no")),
        "source": F.lit(BLOCK_SOURCES["light"]),
        "parse_level": F.lit("light"),
    })
    rows = marked(rows).drop("layout_ref", "layout_type")
    return B.relink(with_contexts(rows, lex, unicode) if contexts else rows.withColumn("pos", F.col("pos").cast("long")))


def marked(df: DataFrame) -> DataFrame:
    """refine_reason and needs_refine, by the block itself and by the codes of its page."""
    page = F.sum(F.size("codes")).over(Window.partitionBy("doc_id", "page_no"))
    dense = (page >= DENSE) & F.col("block_type").isin("alarm_candidate", "table_candidate", "text")
    df = df.withColumn("refine_reason", F.array_distinct(F.concat(B.refine_reasons(), F.when(dense, F.array(F.lit("alarm_dense"))).otherwise(F.array().cast("array<string>")))))
    return df.withColumn("needs_refine", F.size("refine_reason") > 0)


def with_contexts(df: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """df with a page context for each page with text, after the blocks: texts in order, all references, the images and
    headings of the first block that has any, the parse level if it is one.

    A page's blocks are gathered once and given back with its context, so df isn't worked out twice and stays dealt out by document."""
    keep = [c for c in df.columns if c not in LINKS]
    rows = df.select(*keep).withColumn("pos", F.col("pos").cast("long"))
    own = ["pos", *(c for c in keep if c not in ("doc_id", "page_no", "pos"))]
    pages = rows.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct(*own))).alias("rows_"))
    live = F.filter("rows_", lambda r: (r["block_type"] != "page_context") & (F.col("page_no") > 0))
    each = lambda c, on=None: F.transform("live_" if on is None else F.filter("live_", on), lambda r: r[c])
    first = lambda c, on: F.get(each(c, on), F.lit(0))
    none = F.array().cast("array<string>")
    pages = pages.withColumn("live_", live).select(
        "doc_id",
        "page_no",
        "rows_",
        F.array_join(each("text", lambda r: F.trim(r["text"]) != ""), "\n").alias("text"),
        F.array_sort(F.array_distinct(F.flatten(F.array_compact(each("layout_refs"))))).alias("layout_refs"),
        F.coalesce(first("image_paths", lambda r: F.size(r["image_paths"]) > 0), none).alias("image_paths"),
        F.coalesce(first("chapter", lambda r: r["section_path"] != ""), F.lit("")).alias("chapter"),
        F.coalesce(first("section", lambda r: r["section_path"] != ""), F.lit("")).alias("section"),
        F.array_sort(F.array_distinct(F.array_compact(each("parse_level")))).alias("levels"),
    )
    pages = described(pages.withColumn("block_type", F.lit("page_context")), lex, unicode)
    pages = pages.withColumns({
        "block_id": F.col("page_context_id"),
        "title": F.format_string("page_%04d_context", "page_no"),
        "source": F.lit(BLOCK_SOURCES["merged"]),
        "parse_level": F.when(F.size("levels") == 1, F.get("levels", F.lit(0))).otherwise("merged"),
        "ocr_confidence": F.lit(None).cast("double"),
        "refine_reason": none,
        "needs_refine": F.lit(False),
        "pos": (F.lit(1 << 40) + F.col("page_no")),
    })
    pages = pages.withColumn("searchable_text", T.searchable(F.col("title"), F.col("codes"), F.col("section_path"), F.col("canonical_text")))
    kind = {c: rows.schema[c].dataType for c in own}
    context = F.struct(*((F.col(c) if c in pages.columns else F.lit(None)).cast(kind[c]).alias(c) for c in own))
    both = F.when(F.trim("text") != "", F.array_append("rows_", context)).otherwise(F.col("rows_"))
    return pages.select("doc_id", "page_no", F.inline(both)).select(*keep)


LINKS = ("prev_block_id", "next_block_id", "context_prev", "context_next")


def lean(df: DataFrame) -> DataFrame:
    """Blocks as they are written: without what `whole` derives again at little cost."""
    other = ~F.col("canonical_text").eqNullSafe(F.upper("text"))
    return df.withColumn("canonical_text", F.when(other, F.col("canonical_text"))).drop("searchable_text")


def whole(df: DataFrame) -> DataFrame:
    """The blocks that were made lean, all columns as before."""
    df = df.withColumn("canonical_text", F.coalesce("canonical_text", F.upper("text")))
    return df.withColumn("searchable_text", T.searchable(F.col("title"), F.col("codes"), F.col("section_path"), F.col("canonical_text")))


def final_type(kind: Column) -> Column:
    return F.when(kind == "alarm_candidate", "alarm").when(kind == "table_candidate", "table").otherwise(kind)


def refined(blocks: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """Blocks of a page parsed again, as final ones: numbered within the page, no marks, references of the page's own."""
    page = F.col("page_no")
    n = F.row_number().over(Window.partitionBy("doc_id", "page_no").orderBy("pos"))
    out = blocks.where("block_type <> 'page_context' and page_no > 0").withColumn("n_", n).withColumn("block_type", final_type(F.col("block_type")))
    return out.withColumns({
        "block_id": F.format_string("%s_r%04d_%04d", F.col("doc_id").cast("string"), page, F.col("n_")),
        "block_level": level(F.col("block_type")),
        "source_priority": T.priority(F.col("block_type"), lex),
        "image_paths": page_image(F.col("doc_id"), page),
        "layout_refs": F.transform("layout_refs", lambda r: F.concat(F.format_string("refined_page_%04d:", page), r)),
        "source": F.lit(BLOCK_SOURCES["refined"]),
        "parse_level": F.lit("refined"),
        "refine_reason": F.array().cast("array<string>"),
        "needs_refine": F.lit(False),
        "refined_from_page": page,
    }).drop("n_")


def sorted_blocks(df: DataFrame) -> DataFrame:
    """`pos` anew: by page, page contexts after the others, then by id."""
    w = Window.partitionBy("doc_id").orderBy(F.coalesce("page_no", F.lit(0)), (F.col("block_type") == "page_context").cast("int"), "block_id")
    return df.withColumn("pos", F.row_number().over(w).cast("long"))


def merge_refined(draft: DataFrame, fresh: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """draft without the candidates of pages that were parsed again, and these; contexts and links anew."""
    old = draft.where("block_type <> 'page_context'").drop(*LINKS)
    merged = B.replace_pages(old, fresh.drop(*LINKS), ("alarm_candidate", "table_candidate"))
    return relinked(merged, lex, unicode)


def relinked(df: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """Sorted blocks, page contexts last, and links."""
    return B.relink(with_contexts(sorted_blocks(df), lex, unicode))


def ocr_blocks(pages: DataFrame, seeds: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """Blocks of pages read anew (doc_id, page_no, ocr_text): paragraphs, codes cut apart; headings go on from the page's
    first block before (seeds: doc_id, page_no, chapter, section)."""
    rows = pages.where((F.col("page_no") > 0) & (F.trim("ocr_text") != "")).join(seeds.select("doc_id", "page_no", F.col("chapter").alias("c0_"), F.col("section").alias("s0_")), ["doc_id", "page_no"], "left")
    rows = rows.select("doc_id", "page_no", "c0_", "s0_", F.posexplode(B.paragraphs(F.col("ocr_text"))).alias("para", "text"))
    # Headings within a page: the hierarchy's document is the page.
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("page_no").cast("string"))
    rows = B.with_hierarchy(rows.withColumn("own_", F.col("doc_id")).withColumn("doc_id", key).withColumnRenamed("para", "pos"), lex).withColumn("doc_id", F.col("own_")).drop("own_")
    chapter = F.when(F.col("chapter") != "", F.col("chapter")).otherwise(F.coalesce("c0_", F.lit("")))
    section = F.when((F.col("section") != "") | (F.col("chapter") != ""), F.col("section")).otherwise(F.coalesce("s0_", F.lit("")))
    rows = rows.withColumn("section", section).withColumn("chapter", chapter).drop("c0_", "s0_")
    rows = rows.withColumn("block_type", candidate_type(F.col("text"), F.lit("text"), lex)).withColumnRenamed("pos", "para")
    parts = F.when(F.col("block_type") == "alarm_candidate", B.code_segments(T.canonical(F.col("text"), lex, unicode), lex)).otherwise(F.array("text"))
    rows = B.exploded(rows, parts).withColumn("block_type", final_type(F.col("block_type")))
    n = F.row_number().over(Window.partitionBy("doc_id", "page_no").orderBy("para", "part_no"))
    rows = described(rows, lex, unicode).withColumn("n_", n)
    return rows.withColumns({
        "block_id": F.format_string("%s_ocr%04d_%04d", F.col("doc_id").cast("string"), "page_no", "n_"),
        "layout_refs": F.array(F.format_string("ocr_page_%04d:%d:%d", F.col("page_no"), F.col("para") + 1, F.col("part_no") + 1)),
        "image_paths": page_image(F.col("doc_id"), F.col("page_no")),
        "ocr_confidence": F.lit(1.0),
        "source": F.lit(BLOCK_SOURCES["ocr_fixed"]),
        "parse_level": F.lit("ocr_fixed"),
        "refine_reason": F.array().cast("array<string>"),
        "needs_refine": F.lit(False),
        "pos": F.col("n_"),
    }).drop("n_", "para", "part_no")


def fix_pages(blocks: DataFrame, pages: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """blocks, all of a page that was read anew replaced; the first replaced block's headings are the page's to begin with."""
    old = blocks.where("block_type <> 'page_context'").drop(*LINKS)
    live = pages.where((F.col("page_no") > 0) & (F.trim("ocr_text") != ""))
    seeds = old.groupBy("doc_id", "page_no").agg(F.min_by(F.struct("chapter", "section"), "pos").alias("s")).select("doc_id", "page_no", "s.*")
    return relinked(B.replace_pages(old, ocr_blocks(live, seeds, lex, unicode)), lex, unicode)
