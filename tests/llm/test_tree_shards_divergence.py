"""Point-in-time features, resharding and source divergence against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foliospark.llm import count_min, divergence, ordered_scan, point_in_time, sharding

DAY = 86_400_000_000
START = dt.datetime(2024, 1, 1)
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, kind string"
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
LINES = "sale_id long, item_id long, amount double, shipped_at timestamp_ntz, client_id string"


def at(us: int | None) -> dt.datetime | None:
    return None if us is None else START + dt.timedelta(microseconds=us)


def us(t: dt.datetime | None) -> int | None:
    return None if t is None else round((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))


def cents(x: float | None) -> int:
    return 0 if x is None else math.floor(100 * x + 0.5)


def wanted(sales, clicks, lines):
    out = []
    for s in sales:
        if s[1] is None or s[4] is None:
            continue
        t = us(s[4]) + (zlib.crc32(str(s[0]).encode()) % 259200 * 1_000_000 if s[0] is not None else 0)
        label = any(x[1] == s[1] and x[4] is not None and t < us(x[4]) <= t + 7 * DAY for x in sales)
        for d in (2, 14):
            def seen(when, arrived, t=t, d=d):
                return when is not None and arrived is not None and t - d * DAY < us(when) <= t and us(arrived) + 14_400_000_000 <= t

            ks = [c for c in set(clicks) if c[3] == s[1] and seen(c[1], c[2])]
            bought = [x for x in sales if x[1] == s[1] and seen(x[4], x[5])]
            ls = [x for b in bought for x in lines if x[0] is not None and x[0] == b[0] and x[3] is not None and us(x[3]) <= t]
            last = max(((us(c[1]), c[0]) for c in ks if c[0] is not None), default=(0, None))[1]
            out.append((s[0], d, t, label, len(ks), sum(c[4] == "purchase" for c in ks), sum(cents(c[5]) for c in ks), len(bought), sum(cents(b[3]) for b in bought), len(ls), len({x[1] for x in ls} - {None}), sum(cents(x[2]) for x in ls), last))
    return sorted(out, key=str)


def features(spark, sales, clicks, lines):
    rows = point_in_time.point_in_time(spark.createDataFrame(sales, SALES), spark.createDataFrame(clicks, CLICKS), spark.createDataFrame(lines, LINES))
    cols = ["sale_id", "d", "t_us", "label", "n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents", "last_click_id"]
    return sorted((tuple(r) for r in rows.select(cols).collect()), key=str)


@pytest.mark.parametrize(("seed", "top"), [(1, 12), (2, 1)])
def test_point_in_time_is_what_each_sale_saw(spark, monkeypatch, seed, top):
    monkeypatch.setattr(point_in_time, "TOP", top)
    rnd = random.Random(seed)
    times = [0, 5, DAY, 3 * DAY, *(rnd.randrange(30 * DAY) for _ in range(12))]  # few, so that many are tied
    late = lambda t: None if rnd.random() < 0.05 else at(t + rnd.choice([0, 60_000_000, 5 * DAY]))
    who = lambda: rnd.choice([1, 1, 1, 2, 3, None])
    money = lambda: rnd.choice([None, 0.0, 1.25, 19.99])
    sales = [(rnd.choice([None, i, i, i, i, i]), who(), "x", money(), at(t) if rnd.random() > 0.05 else None, late(t), "k") for i in range(50) for t in [rnd.choice(times)]]
    sales += [sales[0], sales[7]]
    clicks = [(rnd.choice([None, i, i % 5, i]), at(t) if rnd.random() > 0.05 else None, late(t), who(), rnd.choice(["purchase", "view", None]), money(), "{}") for i in range(60) for t in [rnd.choice(times)]]
    clicks += clicks[:9]
    lines = [(rnd.choice([None, *range(12)]), rnd.choice([None, 1, 1, 2, 3]), money(), at(rnd.choice(times)) if rnd.random() > 0.05 else None, "x") for _ in range(120)]
    lines += lines[:9]
    assert features(spark, sales, clicks, lines) == wanted(sales, clicks, lines)


def test_point_in_time_of_nothing(spark):
    assert features(spark, [], [], []) == []
    one = [(5, 1, "x", 2.0, at(0), at(0), "k")]
    assert features(spark, one, [], []) == wanted(one, [], [])


def test_canonical_nodes_cover_a_range_once(spark):
    rnd = random.Random(3)
    ranges = [(i, *sorted(rnd.sample(range(5000), 2))) for i in range(60)] + [(60, 4, 8), (61, 0, 1), (62, 7, 9)]
    got = defaultdict(list)
    for r in point_in_time.nodes_of(spark.createDataFrame(ranges, "i int, lo long, hi long")).collect():
        got[r["i"]].append((r["level"], r["node"]))
    for i, lo, hi in ranges:
        assert sorted(x for level, node in got[i] for x in range(node << level, (node + 1) << level)) == list(range(lo, hi))
        assert all(n <= 2 for n in Counter(level for level, _ in got[i]).values())


def test_scans_over_more_partitions_than_keys(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 1, 2]), rnd.randrange(40), rnd.randrange(50), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, o long, v long, i long").withColumn("keep", F.col("i") % 3 == 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sums = {r["i"]: r["before"] for r in ordered_scan.prefix_sums(df, ["k", "o", "i"], {"before": "v"}, "keep", "t").collect()}
        tops = {r["i"]: r["to"] for r in ordered_scan.running_max(df.drop("keep"), ["k"], "o", "v", "to", "t").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(rows, key=lambda r: (r[0], r[1], r[3]))
    assert sums == {r[3]: sum(x[2] for x in order[:n]) for n, r in enumerate(order) if r[3] % 3 == 0}
    by = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    for n, r in enumerate(by):
        before = max((x[2] for x in by[:n] if x[0] == r[0]), default=None)
        tied = [x[2] for x in rows if (x[0], x[1], x[2]) == r[:3]]
        assert tops[r[3]] == before or len(tied) > 1 and tops[r[3]] in (before, r[2], max((x[2] for x in by if x[0] == r[0] and x[1] < r[1]), default=None))


def test_flow_moves_the_fewest_units():
    assert sharding.flow([10, 0], [5, 5]) == [[5, 5], [0, 0]]
    # The cheapest way for the last source is taken by the first, which has another.
    assert sharding.flow([5, 5], [5, 5], [[0, 1], [0, 9]]) == [[0, 5], [5, 0]]
    rnd = random.Random(5)
    for _ in range(30):
        supply = [rnd.randrange(50) for _ in range(5)]
        goal = sharding.equal_capacities(sum(supply), 7)
        sent = sharding.flow([*supply, 0, 0], goal)
        assert [sum(r) for r in sent] == [*supply, 0, 0] and [sum(c) for c in zip(*sent, strict=True)] == goal
        assert sum(sent[i][j] for i in range(7) for j in range(7) if i != j) == sum(max(0, s - g) for s, g in zip(supply, goal, strict=False))
    with pytest.raises(ValueError):
        sharding.flow([3], [2])


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, size string, shard int")


def test_shards_are_equal_and_slots_have_no_gaps(spark):
    rnd = random.Random(6)
    texts = [None, "", "é" * 3, *(("w" * rnd.randrange(1, 400)) + str(i % 150) for i in range(900)), *["a copy of a text"] * 400]
    rows = sharding.shard_documents(documents(spark, texts)).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(texts)))
    by = defaultdict(list)
    for r in rows:
        text = (texts[r["id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        by[r["shard"]].append(r)
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert sorted(by) == list(range(8)) and max(sizes) - min(sizes) <= 500  # about a block
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    homes = defaultdict(set)
    for r in rows:
        homes[texts[r["id"]] or ""].add(r["shard"])
    assert sum(len(h) > 1 for t, h in homes.items() if t != "a copy of a text") <= 8  # texts on a cut by their size only


def test_few_or_no_documents_are_sharded(spark):
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    rows = sharding.shard_documents(documents(spark, [None, "x" * 100_000, "x" * 100_000])).collect()
    assert len(rows) == 3 and all(0 <= r["shard"] < 8 for r in rows)


def test_a_table_is_resharded_in_place(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    rnd = random.Random(7)
    rows = [(i, "x" * rnd.randrange(50) + str(i), 0 if i < 500 else 1 if i < 620 else 2, "kept") for i in range(700)]
    rows.append(rows[0])
    spark.createDataFrame(rows, "doc_id long, text string, shard int, more string").repartition(1).write.partitionBy("shard").parquet(path)
    before = {s: {f for f in os.listdir(f"{path}/shard={s}") if f.endswith(".parquet")} for s in range(3)}
    moves = sharding.reshard_table(spark, path, 4)
    assert 0 in moves["lost"] and 3 in moves["gained"]
    after = spark.read.parquet(path).collect()
    assert sorted((r["doc_id"], r["text"], r["more"]) for r in after) == sorted((r[0], r[1], r[3]) for r in rows)
    sizes = Counter()
    for r in after:
        sizes[r["shard"]] += len(r["text"]) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 60
    assert all(before[s] <= set(os.listdir(f"{path}/shard={s}")) for s in (1, 2) if s not in moves["lost"])  # what only gains keeps its files
    assert sharding.reshard_table(spark, path, 2)["gained"] == [0, 1]
    assert {r["shard"] for r in spark.read.parquet(path).collect()} == {0, 1}


def audit(docs, top=200):
    words = [(lang or "", source or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in docs]
    out = []
    for lang in {w[0] for w in words}:
        mine = [w for w in words if w[0] == lang]
        df = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts = defaultdict(Counter)
        for _, source, ts in mine:
            counts[source].update(t for t in ts if df[t] >= 3)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))  # noqa: E731, B023
        f = lambda p, q: (p - q) * (p - q) // q
        for g, c in counts.items():
            pairs = [(sum(f(share(c, t), share(o, t)) for t in kept), h) for h, o in counts.items() if h != g]
            terms = [(f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, rows in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.append((lang, g, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("width", [None, 1 << 16])
def test_divergence_is_exact(spark, width):
    rnd = random.Random(8)
    vocabulary = [f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(70)] + ["Éclair", "éclair", "straße", "中文", "AbC"]
    docs = [(rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "ü", None]), rnd.choice([" ", "1", "_"]).join(rnd.choices(vocabulary, k=rnd.randrange(12))).swapcase()) for _ in range(90)]
    docs += [("en", "silent", None), ("en", "none", "12 34"), ("lone", "a", "x x x"), ("lone", "b", ""), ("single", "a", "q")] + [docs[0]] * 4
    df = spark.createDataFrame([(i, *d, 1) for i, d in enumerate(docs)], "doc_id long, lang string, source string, text string, term int")
    assert sorted(tuple(r) for r in divergence.source_divergence(df, width=width).collect()) == audit(docs)


def test_divergence_ranks_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 5)
    docs = [("en", s, "same words here and there " * n) for s in "abc" for n in (1, 2, 3)] + [("en", "a", "there there")]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence.source_divergence(df, top=2).collect()) == audit(docs, 2)
    assert divergence.source_divergence(df.limit(0)).collect() == []


def test_a_sketch_never_underestimates():
    rnd = random.Random(9)
    keys = [f"k{i}".encode() for i in range(3000)]
    counts = {k: rnd.choice([1, 1, 1, 2, 3, 9]) for k in keys}
    width, table = 1 << 16, {}
    for b in count_min._blocks(keys, __import__("numpy").array([counts[k] for k in keys]), width):
        table[b["block"][0].as_py()] = b["cells"][0].as_py()
    import zlib as z

    import numpy as np

    cells = np.zeros(2 * width, np.uint8)
    for b, raw in table.items():
        cells[b * count_min.BLOCK : (b + 1) * count_min.BLOCK] = np.frombuffer(z.decompress(raw), np.uint8)
    four = cells.reshape(-1, 4)
    packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    may = count_min.Sketch(width, z.compress(packed.astype(np.uint8).tobytes())).may_reach(keys)
    assert all(m for m, k in zip(may, keys, strict=True) if counts[k] >= count_min.CAP)
    assert sum(may) < 1.2 * sum(c >= count_min.CAP for c in counts.values())
