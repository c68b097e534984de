"""Each stage of the pipeline against brute force on nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliospark.llm import language_id

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone_ long, decoded string, place int, same string, node long, component_id long, key string"
ITEM = "which of these nine rivers flows north past the old glass mill before it meets the sea"


def words(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(n)]


def rows() -> list[tuple]:
    texts: dict[int, str | None] = {i: " ".join(words(i, 40)) for i in range(20)}
    texts |= {20: None, 21: "", 22: "", 23: "  \n ", 24: "12 34 !!"}
    base = words(100, 60)
    texts |= {31: " ".join(base), 30: " ".join(base), 32: " ".join([*base[:-1], "changed"]), 33: " ".join([*base[:20], "x", *base[20:40], "y", *base[40:], "z"])}
    long = words(200, 60_000)
    texts |= {40: " ".join(long), 41: " ".join([*long[:30_000], "inserted", *long[30_000:]]), 42: " ".join(reversed(long))}
    texts |= {50 + i: f"Footer LINE {'' if i % 2 else ' '}\n{' '.join(words(300 + i, 15))}" for i in range(10)}
    texts |= {60 + i: f"nine times only\n{' '.join(words(400 + i, 15))}" for i in range(9)}
    texts |= {70: " ".join([*words(500, 20), ITEM, *words(501, 20)]), 71: " ".join([*words(502, 9), *ITEM.replace("nine", "ten").split(), "end"]), 72: "one word of it: mill " + " ".join(words(503, 30))}
    out = [(i, t, "en", "s", len(t or ""), 1, "d", 2, "same", 3, 4, "k") for i, t in texts.items()]
    out += [out[0], (0, texts[0], "en", "other", 5, 0, "c", 1, "a", 1, 1, "j"), (None, texts[1], "en", "s", 1, 1, "d", 2, "same", 3, 4, "k"), (None, texts[1], None, None, 1, 1, "d", 2, "same", 3, 4, "k"), (None, None, None, None, None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, "mill"), (3, None), (4, "")], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def got(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def test_language(spark, docs, folder):
    import corpus_pipeline

    learned = language_id.sample(docs.where(language_id.fold_of(F.col("doc_id")) != 1), 100, 80_000)["en"]

    def known(text):
        """By greedy longest phrases, found by substring search; the very long texts are of learned letters, so three symbols are nearly always a phrase."""
        t = language_id.folded(text)
        if not t or len(t) < 60 or len(t) > 100_000:
            return bool(t)
        at = n = 0
        while at < len(t):
            to = at + 1
            while to < len(t) and t[at : to + 1] in learned:
                to += 1
            at, n = to, n + 1
        return n <= 0.4 * len(t)

    want = Counter(r for r in rows() if known(r[1]))
    assert not known(None) and not known("12 34 !!") and known(rows()[0][1]) and len(want) > 50
    out = corpus_pipeline.language(spark, docs, folder)
    assert out.columns == docs.columns and got(out) == want


def test_lines(spark, docs, folder):
    import corpus_pipeline

    key = lambda line: line.strip(" \t\n\r\x0b\x0c").lower()
    count = Counter(k for r in rows() for k in {key(x) for x in (r[1] or "").split("\n")})
    def left(r):
        text = None if r[1] is None else "\n".join(x for x in r[1].split("\n") if not key(x) or count[key(x)] < 10)
        return (r[0], text, *r[2:4], len(text or ""), *r[5:])

    want = Counter(map(left, rows()))
    assert sum(1 for r in want if r[1] and "ooter" in r[1]) == 0 and sum(1 for r in want if r[1] and "nine times" in r[1]) == 9
    out = corpus_pipeline.lines(spark, docs, folder)
    assert out.columns == docs.columns and got(out) == want


def test_near_duplicates(spark, docs, folder):
    import corpus_pipeline

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r[0]: shingles(r[1]) for r in rows() if r[0] is not None}
    head = {i: i for i in sets}
    for a in sorted(sets):  # links between any two; labels are settled by repetition
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((head[a], head[b]))
                head = {i: low if h == high else h for i, h in head.items()}
    assert {head[i] for i in (30, 31, 32)} == {30} and head[41] == 40 and head[42] == 42
    once = {}
    for r in rows():
        if r[0] is not None and head[r[0]] == r[0]:
            once.setdefault(r[0], []).append(r)
    out = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert out.columns == docs.columns
    found = got(out)
    assert Counter(r for r in found.elements() if r[0] is None) == Counter(r for r in rows() if r[0] is None)
    assert sorted(r[0] for r in found.elements() if r[0] is not None) == sorted(once)
    assert all(r in once[r[0]] for r in found if r[0] is not None)
    # Of rows equal in id and text that with the least other columns, whatever the order of the input.
    assert [r[3] for r in found.elements() if r[0] == 0] == ["other"]
    assert [r["source"] for r in corpus_pipeline.near_duplicates(spark, docs.repartition(5), folder).where("doc_id = 0").collect()] == ["other"]


def test_decontamination(spark, docs, folder):
    import corpus_pipeline

    def distance(a, b):
        """Of the words a to the nearest stretch of the words b."""
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return min(row)

    item = ITEM.split()
    gone = {i for i, r in enumerate(rows()) if r[0] not in (40, 41, 42) and distance(item, (r[1] or "").lower().split()) <= len(item) // 5}
    assert {rows()[i][0] for i in gone} == {70, 71}
    out = corpus_pipeline.decontaminated(spark, docs, folder)
    assert out.columns == docs.columns and got(out) == Counter(r for i, r in enumerate(rows()) if i not in gone)


def test_pieces(spark, docs, folder):
    import corpus_pipeline

    out = corpus_pipeline.pieces(spark, docs, folder).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(r[:2] for r in rows())
    assert all(r["lossless"] for r in out) and all((r["pieces"] is None) == (r["text"] is None) for r in out)


def test_run_and_empty_tables(spark, docs, folder, tmp_path):
    import corpus_pipeline

    chained = docs
    for _, stage in corpus_pipeline.STAGES:
        chained = stage(spark, chained, folder)
        assert stage(spark, docs.limit(0), folder).count() == 0
    kept = Counter((r["doc_id"], r["text"]) for r in chained.collect())
    assert Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, folder).collect()) == kept
    ids = {i for i, _ in kept}
    assert {30, 33, 40, 42, 72, None} <= ids and not {20, 21, 22, 24, 31, 32, 41, 70, 71} & ids
    empty = str(tmp_path)
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
