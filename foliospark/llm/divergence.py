"""How the sources of a language differ in their terms, counted exactly behind a count-min sketch.

1. A sketch of document frequencies is merged from all tasks. A term whose estimate is under MIN_DOCS is in fewer documents
   of its language for certain and is dropped in the map task, before anything is shuffled; most terms of a corpus are.
2. The terms that are left are counted exactly by (language, source, term), added up in the map tasks first. Those in MIN_DOCS documents are kept.
3. Sources are compared by a join of the occurring (source, term) counts on the term. Terms that
   one or both of two sources lack are not expanded: they enter through each source's histogram of counts and one product.

Shares are p = 1 + floor(SCALE (count + 1) / (N + V)), divergences f = floor((p - q)^2 / q), all in whole numbers.
Cases: null text, lang or source is the empty string; a group without terms has equal shares of everything and no `term` rows;
a language without kept terms has pairs of value 0; a language of one source has no pairs; repeated rows are documents of their own; ties go
by the item's UTF-8 bytes; an empty table gives no rows. Other columns are not read. Counts may reach 10^18.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm import count_min
from foliospark.runtime import bounded, materialize

SCALE = 1_000_000_000
MIN_DOCS = count_min.CAP
TERMS = 200
FLUSH = 400_000
#: Letters of ASCII and all bytes of other characters, in text whose A-Z are lower-cased.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_SMALL = 100_000


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes, list[bytes]]]:
    for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
        yield bytes(lang), bytes(source), _TERM.findall(text.lower())


def _key(lang: bytes, term: bytes) -> bytes:
    # No term has a byte under 0x61, so the first zero byte from the right parts them.
    return lang + b"\0" + term


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    have: dict[bytes, Counter] = {}

    def out() -> tuple[list[bytes], np.ndarray]:
        keys = [_key(lang, t) for lang, terms in have.items() for t in terms]
        counts = np.fromiter((n for terms in have.values() for n in terms.values()), np.int64, len(keys))
        have.clear()
        return keys, counts

    for batch in batches:
        for lang, _, terms in _documents(batch):
            have.setdefault(lang, Counter()).update(set(terms))
            if sum(map(len, have.values())) > FLUSH:
                yield out()
    yield out()


def candidate_counts(docs: DataFrame, seen: count_min.Sketch) -> DataFrame:
    """lang, source, term, n (occurrences), docs: of the terms that the sketch doesn't rule out, added up in each task."""
    kind = "lang binary, source binary, term binary, n long, docs long"
    schema = pa.schema([("lang", pa.binary()), ("source", pa.binary()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = shared.value.may_reach
        have: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs_of) in have.items():
                terms = list(n)
                on = np.flatnonzero(may([_key(lang, t) for t in terms])) if terms else np.zeros(0, int)
                for a in range(0, len(on), 50_000):
                    some = [terms[i] for i in on[a : a + 50_000].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.binary()), pa.array([source] * len(some), pa.binary()), pa.array(some, pa.binary()), pa.array([n[t] for t in some], pa.int64()), pa.array([docs_of[t] for t in some], pa.int64())], schema=schema)
            have.clear()

        for batch in batches:
            for lang, source, terms in _documents(batch):
                n, docs_of = have.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                docs_of.update(set(terms))
                if sum(len(x[0]) for x in have.values()) > FLUSH:
                    yield from out()
        yield from out()

    found = docs.mapInArrow(run, kind)
    return found.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")), "n", "docs")


def _share(n: str, total: str) -> str:
    return f"1L + (({SCALE}BD * cast({n} + 1 as decimal(19,0))) div cast({total} + v as decimal(19,0)))"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _beside(df: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join with a table that has a row a language or source; broadcast if it is small, which is checked."""
    return df.join(F.broadcast(small) if bounded(small, _SMALL) else small, on, how)


def source_divergence(documents: DataFrame, top: int = TERMS, width: int | None = None) -> DataFrame:
    """lang, source, part, item, value, rank. width: cells of a row of the sketch, a power of two (by default from the size of the texts)."""
    blank = F.lit("")
    docs = documents.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), blank).alias(c) for c in ("lang", "source", "text")))
    raw = docs.select(*(F.col(c).cast("binary").alias(c) for c in docs.columns))
    if width is None:
        width = count_min.width_for((docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // 64)
    counts = candidate_counts(raw, count_min.sketch(raw, _frequencies, width))
    counts = materialize(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= MIN_DOCS).select("lang", "term", "all_n")
    counts = materialize(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept")

    # A row for each group: its total N, how many kept terms it has, V and N of its language, its share of a term that it lacks.
    of_lang = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    v = counts.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("one").alias("v"))
    groups = docs.groupBy("lang", "source").agg(F.lit(1).alias("one")).join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("n").alias("own")), ["lang", "source"], "left")
    groups = groups.join(of_lang, "lang", "left").join(v, "lang", "left").na.fill(0, ["total", "own", "lang_total", "v"])
    groups = materialize(groups.select("lang", "source", "total", "own", "lang_total", "v", F.when(F.col("v") > 0, F.expr(_share("0L", "total"))).alias("zero")), "groups")

    full = _beside(counts, groups, ["lang", "source"]).select("lang", "source", "term", "n", "zero", F.expr(_share("n", "total")).alias("p"), F.expr(_share("all_n", "lang_total")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    term = full.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    # Both sources have the term: the exact term, less what the histograms below count for it.
    left = full.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    right = full.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    met = left.join(right, ["lang", "term"]).where("a <> b")
    met = met.groupBy("lang", "a", "b").agg(F.sum(F.expr(f"{_f('pa', 'pb')} - {_f('pa', 'zb')} - {_f('za', 'pb')} + {_f('za', 'zb')}")).alias("value"))
    # One source has it: each distinct count of a source against what the others give a term they lack.
    bars = full.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("terms")).select("lang", F.col("source").alias("a"), F.col("p").alias("pa"), "terms")
    others = groups.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"))
    apart = _beside(bars, others, ["lang"]).where("a <> b")
    apart = apart.groupBy("lang", "a", "b").agg(F.sum(F.expr(f"terms * {_f('pa', 'zb')}")).alias("has"), F.sum(F.expr(f"terms * {_f('zb', 'pa')}")).alias("lacks"))
    apart = apart.select("lang", "a", "b", F.col("has").alias("value")).unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("lacks").alias("value")))
    # Neither has it; this also gives each pair of sources its row.
    mine = groups.select("lang", "v", F.col("source").alias("a"), F.col("own").alias("own_a"), F.col("zero").alias("za"))
    yours = groups.select("lang", F.col("source").alias("b"), F.col("own").alias("own_b"), F.col("zero").alias("zb"))
    rest = _beside(mine, yours, ["lang"]).where("a <> b").select("lang", "a", "b", F.expr(f"coalesce((v - own_a - own_b) * ({_f('za', 'zb')}), 0L)").alias("value"))
    pair = met.unionByName(apart).unionByName(rest).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pair = pair.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value").withColumn("rank", F.row_number().over(ranked))
    return pair.unionByName(term)
