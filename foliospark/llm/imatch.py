"""I-Match document fingerprints, with DataFrame functions only.

The lexicon: terms whose share of documents (all rows of the table are counted) lies
in [min_share, max_share], that is a band of inverse document frequency. It has at
most (mean distinct terms of a document) / min_share terms, whatever the table's
size, and is held as a bit array of `2^bits` slots by the terms' hash, so what the
tasks get is of a fixed size (128 KB at 20 bits); a term that shares a lexicon
term's slot counts as one of it.

A text's distinct terms of the lexicon are sorted. Each of several randomised lexicon
subsets keeps a term by its hash with the subset's salt, at one of several rates, so
short and long texts both have subsets with few terms; the sorted terms that a subset
keeps are hashed into one part (8 hex digits) of the fingerprint. A part without a
term is 00000000. A text without any term of the lexicon takes all its terms
instead. Likeness of two fingerprints: equal parts that have terms, over parts that
have terms in either; 1 if neither has any.

Terms: runs of letters and digits, lower-cased.

Cases: null counts as empty; an empty text's fingerprint is all zeros and equal to
others like it only; ties of doc_id are ordered by text; an empty table gives an
empty result; the document after the last is the first (with one row, itself).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.columns import id_text
from foliospark.runtime import materialize, shuffle_partitions

#: (rate, subsets, lowest bit): of each rate there are so many subsets, each with every rate-th term
#: of the lexicon. Which one a term is in (if any) is told by the bits of its hash from that bit on.
RATES = ((16, 16, 0), (32, 16, 8), (128, 16, 16), (512, 16, 24))
PARTS = sum(n for _, n, _ in RATES)
#: The hash of an array without elements is its seed.
NOTHING = 42


def terms(text: Column) -> Column:
    """Distinct terms as 64-bit hashes."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def slot(term: Column, bits: int) -> Column:
    return F.shiftrightunsigned(term, 64 - bits)


def lexicon_bits(docs: DataFrame, min_share: float, max_share: float, bits: int) -> DataFrame:
    """One row: an array of 2^bits / 64 longs, a bit for each slot of the lexicon."""
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    df = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = df.join(F.broadcast(n)).where((F.col("df") >= F.greatest(F.lit(2.0), F.col("n") * min_share)) & (F.col("df") <= F.col("n") * max_share))
    s = slot(F.col("term"), bits)
    some = kept.select(F.shiftrightunsigned(s, 6).cast("int").alias("w"), F.expr("1L").alias("one"), F.pmod(s, F.lit(64)).cast("int").alias("at"))
    some = some.select("w", F.expr("shiftleft(one, at)").alias("b"))
    empty = docs.sparkSession.range((1 << bits) // 64).select(F.col("id").cast("int").alias("w"), F.expr("0L").alias("b"))
    words = some.union(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bits"))


def fingerprinted(df: DataFrame, text_col: str, out: str, lexicon: DataFrame, bits: int) -> DataFrame:
    """df with the fingerprint of a text column; each step is a projection of its own, computed once."""
    found = df.withColumn("lex_", lexicon.scalar()).withColumn("found_", terms(F.col(text_col)))
    at = lambda t: slot(t, bits)
    inside = F.filter("found_", lambda t: F.getbit(F.element_at(F.col("lex_"), (F.shiftrightunsigned(at(t), 6) + 1).cast("int")), F.pmod(at(t), F.lit(64)).cast("int")) == 1)
    kept = found.withColumn("inside_", inside).withColumn("inside_", F.array_sort(F.when(F.size("inside_") > 0, F.col("inside_")).otherwise(F.col("found_"))))
    # A column for each rate with the terms that are in any of its subsets, so that the passes over them are short.
    some = kept.select("*", *(F.filter("inside_", below(rate, low, n)).alias(f"some{low}_") for rate, n, low in RATES))
    hashes = [F.xxhash64(F.filter(f"some{low}_", in_subset(rate, low, k))) for rate, n, low in RATES for k in range(n)]
    part = lambda h: F.when(h == NOTHING, F.lit("0" * 8)).otherwise(F.lpad(F.lower(F.hex(F.pmod(h, F.lit((1 << 32) - 1)) + 1)), 8, "0"))
    named = some.withColumn("hashes_", F.array(*hashes)).withColumn(out, F.array_join(F.transform("hashes_", part), ""))
    return named.drop("lex_", "found_", "inside_", "hashes_", *(f"some{low}_" for _, _, low in RATES))


def place(term: Column, rate: int, low: int) -> Column:
    return F.shiftrightunsigned(term, low).bitwiseAND(F.lit(rate - 1).cast("long"))


def below(rate: int, low: int, n: int) -> Callable[[Column], Column]:
    return lambda t: place(t, rate, low) < n


def in_subset(rate: int, low: int, k: int) -> Callable[[Column], Column]:
    return lambda t: place(t, rate, low) == k


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two fingerprints."""
    none = F.lit("0" * 8)
    pairs = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.struct(F.substr(a, i * 8 + 1, F.lit(8)).alias("x"), F.substr(b, i * 8 + 1, F.lit(8)).alias("y")))
    some = F.size(F.filter(pairs, lambda p: (p["x"] != none) | (p["y"] != none)))
    same = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != none)))
    return F.when(some == 0, F.lit(1.0)).otherwise(same.cast("double") / some)


def imatch(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = 0.0005, max_share: float = 0.2, bits: int = 20) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text ('' for null), fingerprint of every row; the lexicon, for more texts)."""
    docs = id_text(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    lexicon = materialize(lexicon_bits(docs, min_share, max_share, bits), "lexicon")
    return fingerprinted(docs, "text", "fingerprint", lexicon, bits), lexicon


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with `next_<column>`: the values of the next row by descending doc_id (ties: by text); after the last, the first.

    Rows are dealt out in ranges of doc_id whose bounds are fixed first (a bounded
    number of values); each range also gets the first row of the one after it, so a
    window within a range is enough and no task sees the whole table.
    """
    spark = df.sparkSession
    n = max(1, min(1000, 2 * shuffle_partitions(spark)))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    got = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(got or []))
    part = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: key <= c)) if cuts else F.lit(0)
    placed = df.withColumn("part", part)
    tops = {r["part"]: r["top"] for r in df.select(key.alias("k"), part.alias("part")).groupBy("part").agg(F.max("k").alias("top")).collect()}
    order = sorted(tops)
    into = {p: order[i - 1] for i, p in enumerate(order)}  # the range before; before the first comes the last
    if not order:
        return placed.drop("part").select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    pairs = [x for p in order for x in (F.lit(p), F.struct(F.lit(tops[p]).cast("long").alias("top"), F.lit(into[p]).alias("to")))]
    where = F.create_map(*pairs)[F.col("part")]
    places = F.when(key == where["top"], F.array(F.struct(F.col("part").alias("p"), F.lit(0).alias("extra")), F.struct(where["to"].alias("p"), F.lit(1).alias("extra")))).otherwise(F.array(F.struct(F.col("part").alias("p"), F.lit(0).alias("extra"))))
    dealt = placed.withColumn("place", F.explode(places))
    w = Window.partitionBy("place.p").orderBy(F.col("place.extra"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    out = dealt.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns))
    return out.where("place.extra = 0").drop("part", "place")


def edited(df: DataFrame) -> DataFrame:
    """Adds n_chars and edited_text: the last half of the text replaced by as much of the next one's beginning."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    return df.withColumn("n_chars", n.cast("long")).withColumn("edited_text", F.concat(F.left("text", n - half), F.left("next_text", half)))
