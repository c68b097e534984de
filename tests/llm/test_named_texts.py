"""Only the texts that near-duplicate pairs name are moved to compare them."""

from __future__ import annotations

from foliospark.llm import simhash


def test_named(spark):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(2000)] + [(-5, "below zero"), (7, "text 7")], "node long, text string")
    pairs = spark.createDataFrame([(9, 7), (1999, -5), (7, 3)], "a long, b long")
    got = simhash.named(texts, pairs).collect()
    assert {(3, "text 3"), (9, "text 9"), (1999, "text 1999"), (-5, "below zero")} <= set(map(tuple, got))
    assert sum(x["node"] == 7 for x in got) == 2 and len(got) < 20


def test_alike_gets_no_other_texts(spark, monkeypatch):
    sizes, own = [], simhash.alike
    monkeypatch.setattr(simhash, "alike", lambda pairs, texts, *args: (sizes.append(texts.count()), own(pairs, texts, *args))[1])
    many = [(i, " ".join(f"w{i}x{j}" for j in range(30)), "", "", 0) for i in range(400)]
    many += [(400 + i, many[i][1] + " end", "", "", 0) for i in range(3)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x["doc_id"] for x in simhash.keep_one(df).collect()) == list(range(400))
    assert sizes and max(sizes) <= 10


def test_near_copies_by_simhash_alone(spark, monkeypatch):
    keys = simhash.prefix_keys
    monkeypatch.setattr(simhash, "prefix_keys", lambda *args: keys(*args).limit(0))
    base = [[f"w{i}x{j}" for j in range(400)] for i in range(20)]
    many = [(i, " ".join(b), "", "") for i, b in enumerate(base)] + [(100 + i, " ".join([*b, "end"]), "", "") for i, b in enumerate(base)]
    got = dict(map(tuple, simhash.near_copies(spark.createDataFrame(many, "doc_id long, text string, lang string, source string")).collect()))
    fp = {i: simhash.simhash(simhash.shingle_set(t, 5)) for i, t, *_ in many}
    close = [i for i in range(20) if (fp[i] ^ fp[100 + i]).bit_count() <= simhash.RADIUS]
    assert len(close) > 10 and all(got[100 + i] == i for i in close) and all(got[i] == i for i in range(20))
