"""Where there are more shingles than a table has slots, keys that no other text has are still left out, with the same groups."""

import random

from pyspark.sql import functions as F

from foliospark.llm import simhash

WORDS = 1200


def corpus():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    texts = [[word() for _ in range(WORDS)] for _ in range(150)]
    for i in range(20):  # near copies, and copies of copies
        texts.append([*texts[i][: WORDS - 40], *(word() for _ in range(40))])
    texts += [list(t) for t in texts[150:160]]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def labels(df):
    return sorted(map(tuple, simhash.near_copies(df).collect()))


def test_few_keys_are_left_of_full_tables(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    want = labels(docs)
    assert len({c for _, c in want}) == 150
    monkeypatch.setattr(simhash, "MOST_SLOTS", 1 << 16)
    assert labels(docs) == want
    left = simhash.prefix_keys(docs, WORDS * len(corpus()), 5, 0.8)
    # A fifth of the shingles of each text would be a key; those of texts with a copy are met twice.
    assert left.count() < 0.2 * WORDS * 50


def test_keys_of_one_row_go_and_others_stay(spark, monkeypatch):
    keys = spark.range(200_000).select(F.when(F.col("id") < 150_000, F.xxhash64("id")).otherwise(F.col("id") % 5000).alias("key"), F.col("id").alias("row"))
    monkeypatch.setattr(simhash, "MOST_SLOTS", 1 << 16)
    got = {r["row"] for r in simhash.met_twice(simhash.materialize(keys, "keys")).collect()}
    assert set(range(150_000, 200_000)) <= got and len(got) < 80_000
    assert simhash.met_twice(simhash.materialize(keys.limit(0), "keys")).count() == 0


def test_the_share_that_a_table_is_for():
    hashes = simhash._salted(simhash.np.arange(100_000, dtype=simhash.np.uint64), range(1))[:, 0]
    assert abs(simhash.looked_up(hashes, 0.25).mean() - 0.25) < 0.01
