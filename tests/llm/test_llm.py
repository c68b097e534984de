"""Corpus operators against brute force, and their edge cases: nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliospark.llm import components, decontamination, imatch, language_id, line_dedup, lm_score, sentencepiece_codec, simhash, suffix_dedup, token_counts, url_filter
from foliospark.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, n_tokens string, node string"
RANDOM = random.Random(5)
WORDS = ["".join(RANDOM.choice("abcdefg") for _ in range(RANDOM.randint(2, 6))) for _ in range(60)]


def prose(n, r=RANDOM):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = prose(80)
    out = [(1, base), (2, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, "   \n \t"), (7, "x"), (8, "a" * 3000), (None, prose(30)), (9, prose(4000)), (10, "Ünïcode ▁ mark\0 — 日本語 don't"), (11, prose(90) + " " + base), (12, "ab" * 400)]
    return [(i, t, "clash", "clash") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts(docs, rows, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        content = f.read()
    got = sorted(map(tuple, token_counts.token_counts(docs, content).collect()), key=str)
    assert got == sorted(((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for i, x, *_ in rows), key=str)
    assert token_counts.token_counts(empty, content).count() == 0
    merges, specials = token_counts.bpe_parts(content)
    counter = token_counts.BpeCounter(merges)
    r = random.Random(1)
    texts = ["".join(r.choice("  \n\t'strevlmd SXé1२,.!$ 　a'ß日b<|endoftext|>") for _ in range(r.randint(0, 50))) for _ in range(1500)] + ["<|endoftext|>", "a<|endoftext|> b  ", "we'll'd ''s"]
    assert token_counts.count_batch(texts, counter, specials).tolist() == [len(t.encode(x, add_special_tokens=False)) for x in texts]


def test_splitter_is_the_same_in_any_chunks():
    r = random.Random(2)
    classes = token_counts.class_table()[np.frombuffer("".join(r.choice("' srevl\n1x.") for _ in range(3000)).encode("utf-32-le"), np.uint32)]
    assert all((token_counts.states(classes, c) == token_counts.states(classes, 10_000)).all() for c in (16, 33, 500))


def test_language_id(spark, docs, rows, empty):
    labelled = spark.createDataFrame([("aa", prose(50).replace("a", "ä")), ("bb", prose(50)), (None, "zzz"), ("bb", None)], "lang string, text string")
    got = {r["doc_id"]: r for r in language_id.language_id(docs, labelled).collect()}
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[6]["lang_pred"] == "und" and got[1]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.language_id(empty, labelled).count() == 0
    assert {r["lang_pred"] for r in language_id.language_id(docs, empty.select(F.lit("x").alias("lang"), "text")).collect()} == {"und"}
    kept = language_id.known_language(docs, labelled)
    known = {i for i, r in got.items() if r["lang_pred"] != "und" and (r["n_symbols"] < 60 or r["phrases"] <= 0.4 * r["n_symbols"])}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == known and {1, 2, 3, 9} <= known
    other = spark.createDataFrame([(1, "слово " * 40), (2, "слово"), (3, prose(40))], "doc_id long, text string")
    assert {r["doc_id"] for r in language_id.known_language(other, labelled).collect()} == {2, 3}
    # Whole texts are drawn, as many as fit; a text that is longer than the bound isn't.
    few = spark.createDataFrame([("x", "a" * 50), ("x", "b" * 50), ("x", "c" * 200), ("y", "d")], "lang string, text string")
    drawn = language_id.sample(few, 10, 120)
    assert sorted(drawn["x"].split()) == ["a" * 50, "b" * 50] and drawn["y"] == "d"
    assert language_id.sample(few, 10, 60)["x"] in ("a" * 50, "b" * 50)
    # Brute force: greedy longest phrases by substring search.
    sample = {"aa": "abcabd xyz", "bb": "hello world"}

    def phrases(text, known):
        i = n = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i : j + 1] in known:
                j += 1
            i, n = j, n + 1
        return n

    # Of whole texts, whatever the blocks in which they are parsed, repeats of one letter among them.
    r = random.Random(4)
    sample |= {"cc": "a" * 37, "dd": "".join(r.choice("ab ") for _ in range(300))}
    p = language_id.CrossParser(sample)
    texts = ["abcab hello", "zzzz", "world abd xyz hell", "a", "a" * 1000, *("".join(r.choice(x) for _ in range(400)) for x in ("ab ", "abcdelo ", "aq"))]
    for block in (1, 7, 64, 5000):
        assert p.phrases(texts, block).tolist() == [[phrases(t, sample[x]) for x in p.langs] for t in texts]


def test_url_filter(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    urls = [None, "no scheme", "http://EXAMPLE.org/es/1", "https://a.example.org/en?x=1#y", "http://xorg/", "http://b.com/de/9", "http://b.net/de/9", "http://org", "http://q.org/es/", "http://b.net/de/9"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.url_filter(df, rules).collect()}
    assert [got[i]["rule"] for i in range(len(urls))] == [None, None, "example.org/es/", "org/", None, "com/de/", None, None, "org/", None]
    assert (got[2]["host"], got[2]["path"], got[0]["host"], got[3]["path"]) == ("example.org", "/es/1", "", "/en")
    assert {got[i]["verdict"] for i in (2, 5)} == {"block"} and got[6]["verdict"] == got[9]["verdict"]
    assert url_filter.url_filter(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.url_filter(df, []).collect()} == {"allow"}


def test_boosted_trees_by_hand(spark):
    """The first tree's first split and the values of a stump, computed from sums over all rows."""
    r = random.Random(13)
    rows = [(int(r.random() < (0.8 if d > 3 else 0.2)), float(d), float(r.randint(0, 3))) for d in (r.randint(0, 7) for _ in range(600))]
    names = [f for f in url_filter.FEATURES if f not in ("depth", "hyphens")]
    df = spark.createDataFrame(rows, "y int, depth double, hyphens double").select("*", *(F.lit(1.0).alias(f) for f in names))
    model = url_filter.fit(df, trees=1, depth=1)
    prior = np.log(sum(x[0] for x in rows) / (len(rows) - sum(x[0] for x in rows)))
    p = 1 / (1 + np.exp(-prior))
    best = None
    for k, f in ((1, "depth"), (2, "hyphens")):
        for cut in sorted({x[k] for x in rows})[:-1]:
            g, h = ([sum(v for x, v in zip(rows, vs, strict=True) if (x[k] <= cut) == side) for side in (True, False)] for vs in ([x[0] - p for x in rows], [p * (1 - p)] * len(rows)))
            gain = sum(a * a / (b + 1) for a, b in zip(g, h, strict=True)) - sum(g) ** 2 / (sum(h) + 1)
            if best is None or gain > best[0] + 1e-9:
                best = gain, f, cut, [0.4 * a / (b + 1) for a, b in zip(g, h, strict=True)]
    (splits, values), = model.trees
    feature, bin_ = splits[1]
    assert url_filter.FEATURES[feature] == best[1] and [c for c in model.cuts[feature] if c <= best[2]][bin_ - 1 if bin_ else 0] <= best[2]
    assert np.allclose([values[2], values[3]], best[3])


def test_suffix_rates_leave_out_the_own_fold(spark):
    rows = [(f"h{i}.aa", f"/{i}", "aa", "", int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "host string, path string, tld string, extension string, y int").withColumn("fold", url_filter.fold_of())
    got = {x["fold"]: x["tld_rate"] for x in url_filter.suffix_rates(df, "tld").collect()}
    each = [(x["fold"], x["y"]) for x in df.collect()]
    assert set(got) == set(range(-1, url_filter.FOLDS))
    for fold, rate in got.items():
        ys = [y for f, y in each if f != fold]
        assert np.isclose(rate, (sum(ys) + 10) / (len(ys) + 20))


def test_trees_learn_a_split(spark):
    f = url_filter.FEATURES
    rows = spark.range(400).select((F.col("id") % 4 == 0).cast("int").alias("y"), *((F.when(F.col("id") % 4 == 0, 5.0) if n == "depth" else F.lit(1.0) * (F.col("id") % 3)).alias(n) for n in f)).fillna(1.0)
    scored = url_filter.fit(rows).score(rows)
    assert scored.where("(p > 0.5) <> (y = 1)").count() == 0


def test_sentencepiece(docs, rows, empty):
    import sentencepiece

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain, varied = sentencepiece_codec.PieceCodec(model, 0.0), sentencepiece_codec.PieceCodec(model, 0.2, 3, 2)
    for _, t, *_ in rows:
        if t:
            if "▁" not in t:
                assert plain.encode(t).tolist() == sp.encode(t)
            assert varied.decode(varied.encode(t)) == t
    words = ["▁" + w for w in WORDS] + ["▁" * 9, "日本", "x"]
    assert all(varied.scan(w, 1) == varied.agenda(w, 1) for w in words)
    text = " ".join(["international"] * 60)
    assert len({tuple(varied.word("▁international", v)) for v in range(2)} | {varied.encode(text).tobytes()}) >= 2 and (varied.encode(text) == varied.encode(text)).all()
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
    assert out.where("not (text <=> decoded)").count() == 0 and out.count() == len(rows)
    assert sentencepiece_codec.encode(docs, model, decoded=True).where("not (text <=> decoded)").count() == 0
    assert sentencepiece_codec.encode(empty, model).count() == 0


def test_merge_dropout_of_each_occurrence(spark):
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    df = spark.createDataFrame([(i, " ".join(["international"] * 100)) for i in range(4)] + [(9, "other " + " ".join(["international"] * 100))], "doc_id long, text string")
    c = sentencepiece_codec.PieceCodec(model, 0.1)
    plain, ways = sentencepiece_codec.PieceCodec(model, 0.0).encode("international").tolist(), set()
    for row in sentencepiece_codec.encode(df, model).collect():
        word, words = b"", []
        for piece in row["pieces"]:
            if c.bytes[piece].startswith(b" ") and word:
                words.append(word)
                word = b""
            word += b"|" + c.bytes[piece]
        ways |= {*words, word}
    assert len(ways) > 5 and len(plain) >= 1
    # The list gives what the heap gives, for short words and such as meet more skips than are drawn at once.
    r = random.Random(12)
    high = sentencepiece_codec.PieceCodec(model, 0.4, 7)
    for w in ["▁" + w for w in WORDS[:20]] + ["▁internationalisation", "▁" + "abcdefgh" * 5]:
        for key in (r.getrandbits(64) for _ in range(60)):
            assert high.scan(w, key) == high.agenda(w, key)
    # Texts together give what each gives alone, and words what the agenda gives for their keys.
    texts = [" ".join(r.choice(WORDS + ["x", "", "internationalisation", "ab" * 40]) for _ in range(r.randint(0, 80))) for _ in range(60)] + [None, "", "▁ a", "日本 " * 20]
    texts += ["".join(r.choice("aeinorst  ▁éжд中🙂\n\t|09") for _ in range(r.randint(1, 120))) for _ in range(300)]
    texts += [" ", "▁", "▁▁", " ▁ ▁a", "a▁", " " * 200, "x" * 300, "▁" * 60 + "b" * 70, "b" * 47, "b" * 48]
    for codec in (high, c, sentencepiece_codec.PieceCodec(model, 0.2, 5, 3), sentencepiece_codec.PieceCodec(model, 0.0), sentencepiece_codec.PieceCodec(model, 1.0)):
        together = codec.encode_many(texts)
        assert [None if x is None else x.tolist() for x in together] == [None if t is None else codec.encode(t).tolist() for t in texts]
        assert all(t is None or codec.decode(x) == t for t, x in zip(texts, together, strict=True) if t)


def edit_distance(a, text):
    """Least distance of a to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination(spark, docs, empty):
    r = random.Random(4)
    item = [r.choice(WORDS) for _ in range(25)]
    near = item[:3] + ["other"] + item[4:10] + item[11:]
    far = [w if i % 3 else "no" for i, w in enumerate(item)]
    rows = [(1, f"{prose(40, r)} {' '.join(item).upper()}, {prose(20, r)}"), (2, prose(30, r) + " " + "; ".join(near)), (3, " ".join(far)), (4, None), (5, ""), (6, prose(300, r))]
    df = spark.createDataFrame([(i, t, "c", "c") for i, t in rows], SCHEMA)
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "nowhere met"), (10, "!")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["distance"] for x in decontamination.matches(df, bench).collect()}
    assert got == {(i, 7): d for i, t in rows if (d := edit_distance(item, decontamination.words_of(t))) <= 5}
    assert {1, 2} <= {k[0] for k in got}
    kept = decontamination.decontaminate(df, bench, block_bytes=50)
    assert kept.columns == df.columns and {x["doc_id"] for x in kept.collect()} == {3, 4, 5, 6}
    assert decontamination.matches(df, empty, item_id_col="doc_id").count() == 0 and decontamination.matches(empty, bench).count() == 0
    for _ in range(200):
        p, t = [r.randint(0, 3) for _ in range(r.randint(1, 70))], [r.randint(0, 3) for _ in range(r.randint(1, 90))]
        assert min(decontamination.myers(p, t)) == min(edit_distance(p, t), len(p))


def test_decontamination_of_short_items(spark):
    """Items of under five words, and such in scripts without spaces, are found as they are; repeated rows and items repeat."""
    bench = spark.createDataFrame([(1, "alpha beta"), (1, "alpha beta"), (2, "你好世界"), (3, "solo")], "item_id long, text string")
    rows = [(1, "x Alpha, BETA y"), (1, "x Alpha, BETA y"), (2, "alpha gamma beta"), (3, "他说你好世界了"), (4, "你好大世界"), (5, "solos")]
    got = sorted((x["doc_id"], x["item_id"], x["distance"]) for x in decontamination.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect())
    assert got == [(1, 1, 0)] * 4 + [(3, 2, 0)]


def test_golay_keys_meet_within_four_bits():
    r = np.random.default_rng(0)
    # How four errors or fewer may fall on the three segments, each way many times.
    splits = [x for x in itertools.product(range(5), repeat=3) if sum(x) <= 4]
    fp = r.integers(0, 2**64, 40 * len(splits), dtype=np.uint64)
    other = fp.copy()
    for i in range(len(fp)):
        for n, (low, width) in zip(splits[i % len(splits)], simhash.SEGMENTS, strict=True):
            for b in r.choice(width, n, replace=False):
                other[i] ^= np.uint64(1 << low + int(b))
    a, b = (set(zip(*(x.tolist() for x in simhash.keys_of(z)), strict=True)) for z in (fp, other))
    assert len({i for i, _ in a & b}) == len(fp)


def test_golay_links_of_large_groups(spark):
    """Chains, stars and chance neighbours, in one task and in shards, against all pairs."""
    r = np.random.default_rng(1)
    words = {0, (1 << 64) - 1}
    for _ in range(12):
        x = int(r.integers(0, 2**64, dtype=np.uint64))
        for _ in range(40):
            words.add(x)
            x ^= sum(1 << int(b) for b in r.choice(64, r.integers(1, 7), replace=False))
    words = np.array(sorted(words), np.uint64)
    want = groups(len(words), [(i, j) for i in range(len(words)) for j in range(i) if int(words[i] ^ words[j]).bit_count() <= 4])
    df = spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "fp long")
    for most, chunk in ((1 << 20, 1 << 17), (3, 50)):
        at = {int(x): i for i, x in enumerate(words.view(np.int64))}
        got = groups(len(words), [(at[x["a"]], at[x["b"]]) for x in simhash.golay_links(df, most=most, chunk=chunk).collect()])
        assert got == want


def groups(n, links):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    want = groups(300, links)
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert [got.get(i, i) for i in range(300)] == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_join_what_links_join(spark):
    rng = np.random.default_rng(5)
    links = [(int(max(x)), int(min(x))) for x in rng.integers(-60, 60, (90, 2)) if x[0] != x[1]]

    def tops(pairs):
        groups = components.Groups(120)
        for a, b in pairs:
            groups.link(np.array([a + 60]), np.array([b + 60]))
        return groups.top.tolist()

    for chunk in (1, 7, 1 << 20):
        got = [tuple(r) for r in components.stars(spark.createDataFrame(links, "hi long, lo long").coalesce(1), chunk).collect()]
        assert tops(got) == tops(links) and len(got) <= len(links) and all(a > b for a, b in got)
    assert components.stars(spark.createDataFrame([], "hi long, lo long")).count() == 0


def test_simhash(spark, docs, rows, empty):
    def fingerprint(text):
        words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        hashes = [xxhash.xxh64_intdigest(" ".join(words[j : j + 4]).encode(), 42) for j in range(max(1, len(words) - 3))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    r = random.Random(8)
    many = list(rows)
    base = [r.choice(WORDS) + str(i) for i in range(400)]
    for i in range(40):
        new = list(base)
        for _ in range(r.randint(0, 4)):
            new[r.randrange(400)] = "edit" + str(r.random())
        many.append((100 + i, " ".join(new), "", ""))
    many = [x for x in many if x[0] is not None]
    prints = [fingerprint(x[1]) for x in many]
    top = groups(len(many), [(a, b) for a in range(len(many)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    least = {}
    for i, t in enumerate(top):
        least[t] = min(least.get(t, 1 << 60), many[i][0])
    want = sorted((x[0], p - (1 << 64) * (p >> 63), least[t]) for x, p, t in zip(many, prints, top, strict=True))
    df = spark.createDataFrame(many, SCHEMA)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want
    assert simhash.near_duplicates(empty).count() == 0 and simhash.near_duplicates(docs).count() == len(rows)
    kept = simhash.keep_one(df)
    ids = [x["doc_id"] for x in kept.collect()]
    assert kept.columns == df.columns and len(ids) == len(set(ids))
    assert {1, 7, 8, 9, 10} <= set(ids) and not {2, 3} & set(ids) and len([i for i in ids if i >= 100]) <= 4
    assert simhash.keep_one(empty).count() == 0


def test_near_copies(spark, rows):
    def shingles(text):
        words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        return {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))} if words else set()

    r = random.Random(9)
    many = [x for x in rows if x[0] is not None]
    for i in range(60):
        base = [r.choice(WORDS) + str(r.randrange(99)) for _ in range(r.choice([40, 150, 400]))]
        share = r.choice([0.005, 0.02, 0.03, 0.08])
        many += [(100 + 2 * i, " ".join(base), "", ""), (101 + 2 * i, " ".join("edit" + str(r.random()) if r.random() < share else w for w in base), "", "")]
    sets = [shingles(x[1]) for x in many]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    top = groups(len(many), [(a, b) for a in range(len(many)) for b in range(a) if alike(sets[a], sets[b])])
    least = {}
    for i, t in enumerate(top):
        least[t] = min(least.get(t, 1 << 60), many[i][0])
    want = sorted((x[0], least[t]) for x, t in zip(many, top, strict=True))
    got = simhash.near_copies(spark.createDataFrame([*many, (None, many[0][1], "", ""), (None, "alone", "", "")], SCHEMA)).collect()
    assert sorted(map(tuple, (x for x in got if x[0] is not None))) == want
    assert sorted((x[1] for x in got if x[0] is None), key=str) == [1, None]


def near_pairs(many):
    """doc_id, least doc_id that links reach, by comparing all pairs."""
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))}

    sets = [shingles(x[1]) for x in many]
    top = groups(len(many), [(a, b) for a in range(len(many)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9])
    return [(x[0], many[t][0]) for x, t in zip(many, top, strict=True)]


def test_near_copies_by_any_edit(spark):
    r = random.Random(10)
    many = []
    for i in range(240):
        few = [f"k{i}x{j}" for j in range(60)]
        base = [r.choice(few if i % 2 else WORDS) for _ in range(500)]
        n = r.randint(40, 119)
        new = [f"new{i}y{j}" for j in range(n)]
        other = base + new if i % 3 == 0 else base[n:] if i % 3 == 1 else base[:200] + new + base[200:]
        many += [(2 * i, " ".join(base), "", ""), (2 * i + 1, " ".join(other), "", "")]
    want = near_pairs(many)
    assert sum(a != b for a, b in want) > 150
    assert sorted(map(tuple, simhash.near_copies(spark.createDataFrame(many, SCHEMA)).collect())) == want


def test_near_copies_of_short_texts(spark):
    r = random.Random(11)
    many = []
    for i in range(300):
        base = [f"w{i}x{j}" for j in range(8 if i % 2 else r.randint(5, 24))]
        many += [(2 * i, " ".join(base), "", ""), (2 * i + 1, " ".join([*base, f"one{i}"]), "", "")]
    want = near_pairs(many)
    assert sum(a != b for a, b in want) > 200
    assert sorted(map(tuple, simhash.near_copies(spark.createDataFrame(many, SCHEMA)).collect())) == want


def test_imatch(docs, rows, empty):
    own, lexicon = imatch.imatch(docs, min_share=0.0, max_share=1.0)
    moved = imatch.edited(imatch.with_next(own, ["text", "fingerprint"]))
    out = imatch.fingerprinted(moved, "edited_text", "edited", lexicon, 20).withColumn("near", imatch.likeness(F.col("fingerprint"), F.col("edited"))).collect()
    assert len(out) == len(rows) and all(0 <= r["near"] <= 1 for r in out)
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    texts = [x[1] or "" for x in order]
    want = []
    for i, (x, t) in enumerate(zip(order, texts, strict=True)):
        n, h = texts[(i + 1) % len(texts)], len(t) // 2
        want.append((x[0], t[: len(t) - h] + n[:h]))
    assert sorted(((r["doc_id"], r["edited_text"]) for r in out), key=str) == sorted(want, key=str)
    prints = {}
    for r in out:
        prints.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert imatch.with_next(imatch.imatch(empty)[0], ["text"]).count() == 0


def xxh64_long(value, seed):
    return xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)


def test_imatch_by_hand(spark, rows):
    """Lexicon, fingerprints and likeness against sets and hashes in Python."""
    r = random.Random(14)
    many = [(i, " ".join(r.choice(WORDS) + str(r.randrange(3)) for _ in range(r.choice([0, 1, 5, 60, 300])))) for i in range(60)] + [(90, None), (91, "Ünï dö"), (91, "Ünï dö")]
    df = spark.createDataFrame(many, "doc_id long, text string")
    own, lexicon = imatch.imatch(df, min_share=0.05, max_share=0.4)
    terms = [{xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[^\w]+|_", (t or "").lower()) if w} for _, t in many]
    n = {}
    for ts in terms:
        for t in ts:
            n[t] = n.get(t, 0) + 1
    slots = {t >> 44 for t, k in n.items() if max(2, 0.05 * len(many)) <= k <= 0.4 * len(many)}
    signed = lambda t: t - (1 << 64) * (t >> 63)
    want = []
    for (i, _), ts in zip(many, terms, strict=True):
        inside = sorted(map(signed, {t for t in ts if t >> 44 in slots} or ts))
        parts = []
        for rate, subsets, low in imatch.RATES:
            for k in range(subsets):
                h = 42
                for t in inside:
                    if ((t & (1 << 64) - 1) >> low) & (rate - 1) == k:
                        h = xxh64_long(t, h)
                parts.append("00000000" if h == 42 else f"{signed(h) % ((1 << 32) - 1) + 1:08x}")
        want.append((i, "".join(parts)))
    got = sorted((x["doc_id"], x["fingerprint"]) for x in own.collect())
    assert got == sorted(want)
    a, b = want[3][1], want[4][1]
    cut = lambda f: [f[j : j + 8] for j in range(0, len(f), 8)]
    pairs = [(x, y) for x, y in zip(cut(a), cut(b), strict=True) if x != "00000000" or y != "00000000"]
    one = spark.range(1).select(imatch.likeness(F.lit(a), F.lit(b)).alias("x"), imatch.likeness(F.lit(a), F.lit(a)).alias("y")).first()
    assert np.isclose(one["x"], sum(x == y for x, y in pairs) / len(pairs) if pairs else 1) and one["y"] == 1


def brute_suffix(rows, length):
    seen, out = {}, {}
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if seen.setdefault(w, (i, p)) != (i, p):
                gone[p : p + length] = True
        out[i] = (int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), bytes(np.frombuffer(data, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup(spark, docs, rows, empty, hot):
    r = random.Random(6)
    shared = [prose(40, r) for _ in range(4)]
    many = [(i, t) for i, t, *_ in rows if i is not None and i != 2]
    for i in range(60):
        parts = [prose(r.randint(1, 30), r), r.choice(shared)[r.randint(0, 60) : r.randint(120, 240)], prose(r.randint(1, 30), r)]
        many.append((200 + i, " ".join(parts)))
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in suffix_dedup.suffix_dedup(spark.createDataFrame([(i, t, "", "") for i, t in many], SCHEMA), hot=hot).collect()}
    assert got == brute_suffix(sorted(many), 100)
    assert suffix_dedup.suffix_dedup(empty).count() == 0 and suffix_dedup.suffix_dedup(docs).count() == len(rows)


def test_line_dedup_beside_any_columns(spark):
    rows = [(i, "common\nown" + str(i), "1", "2", "3", "4") for i in range(12)]
    for names in ("h_ string, id_ string, of_ string, gone_ string", "H_ string, key string, id string, line string"):
        df = spark.createDataFrame(rows, f"doc_id long, text string, {names}")
        out = line_dedup.drop_repeated_lines(df, broadcast_bytes=0)
        assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [(i, "own" + str(i), "1", "2", "3", "4") for i in range(12)]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup(spark, docs, rows, empty, keep):
    r = random.Random(7)
    many = [(i, "\n".join(r.choice([" Common ", "common", "rare" + str(i), "", "Two\t", prose(3, r), "É"]) for _ in range(r.randint(1, 8)))) for i in range(40)] + [(90, None), (91, ""), (92, "\n")]
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\r\x0b\x0c"))
    where = {}
    for i, t in many:
        for n, line in enumerate((t or "").split("\n")):
            where.setdefault(key(line), []).append((i, n))
    often = {k: min(v) for k, v in where.items() if k and len({i for i, _ in v}) >= 10}
    want = []
    for i, t in many:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if key(x) not in often or (keep == "first" and often[key(x)] == (i, n))]
        want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    df = spark.createDataFrame([(i, t, "", "") for i, t in many], SCHEMA)
    for limit in (1 << 20, 0):
        assert sorted(map(tuple, line_dedup.line_dedup(df, keep=keep, broadcast_bytes=limit).collect())) == sorted(want)
        through = line_dedup.drop_repeated_lines(df, keep=keep, broadcast_bytes=limit)
        assert through.columns == df.columns and sorted((x["doc_id"], x["text"] or "") for x in through.collect()) == sorted(w[:2] for w in want)
    assert line_dedup.line_dedup(empty).count() == 0 and line_dedup.line_dedup(docs).count() == len(rows)


def test_lm_score(spark, docs, rows, empty):
    good = spark.createDataFrame([(1,), (3,), (None,)], "doc_id long")
    got = {x["doc_id"]: x for x in lm_score.lm_score(docs, good).collect()}
    assert got[1]["score"] < 0 < got[8]["score"] and got[4]["score"] == got[5]["n_tokens"] == 0
    assert {x["score"] for x in lm_score.lm_score(docs, good.limit(0)).collect()} == {0.0}
    assert lm_score.lm_score(empty, good).count() == 0
    n = np.random.default_rng(0).integers(0, 5, lm_score.SIZE**2)
    p = 2 ** -lm_score.losses(n, 2).reshape(lm_score.SIZE, -1)
    assert np.allclose(p.sum(axis=1), 1)


def test_lm_score_of_actual_characters(spark, docs, rows, empty):
    many = [(1, "Éa éa èa ñb"), (2, "èa éa Ña"), (3, "слово дело"), (4, "дело слова"), (5, "日本語の文"), (6, None), (7, ""), (7, "XY\0x")]
    df, good = spark.createDataFrame(many, "doc_id long, text string"), spark.createDataFrame([(1,), (3,)], "doc_id long")
    chars = sorted({c for _, t in many for c in t or ""})
    table = np.zeros((2, (len(chars) + 1) ** 3), np.int64)
    symbol = {c: i for i, c in enumerate(["\n", *chars])}

    def cells(text):
        s = [symbol[c] for c in "\n\n" + text]
        return [(a * len(symbol) + b) * len(symbol) + c for a, b, c in zip(s, s[1:], s[2:])]  # noqa: B905

    for i, t in many:
        for c in cells(t or ""):
            table[:, c] += [i in (1, 3), 1]
    # No token is a line end, so the symbol that only pads has no share of the uniform estimate.
    size = len(symbol)
    p = np.full((2, size), 1 / len(chars))
    for k in range(1, 4):
        c = table.reshape(2, -1, size**k).sum(axis=1).reshape(2, -1, size)
        total, kinds = c.sum(axis=2, keepdims=True), (c > 0).sum(axis=2, keepdims=True)
        lower = np.tile(p.reshape(2, -1, size), (1, size if k > 1 else 1, 1))
        p = np.where(total > 0, (c + kinds * lower) / np.maximum(total + kinds, 1), lower).reshape(2, -1)
    want = [(i, len(t or ""), *(-np.log2(p[:, cells(t)]).mean(axis=1) if t else (0, 0))) for i, t in many]
    for most in (1 << 20, 0):
        got = sorted(lm_score.lm_score(df, good, 3, broadcast_rows=most).collect(), key=lambda x: x[:2])
        assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2:4] for x in got], [x[2:] for x in want])
        assert lm_score.lm_score(docs, good, broadcast_rows=most).count() == len(rows) and lm_score.lm_score(empty, good, broadcast_rows=most).count() == 0
    # Texts that differ only in letters beyond a..z, or in capitals.
    pairs = spark.createDataFrame([(1, "éa"), (2, "èa"), (3, "Ab"), (4, "Bb"), (5, "да"), (6, "но"), (7, "но")], "doc_id long, text string")
    assert len({x["score"] for x in lm_score.lm_score(pairs, good.where("doc_id = 1")).where("doc_id < 3").collect()}) == 2
    assert len({x["background_loss"] for x in lm_score.lm_score(pairs, good).where("doc_id in (5, 6)").collect()}) == 2


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "pieces"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() <= docs.count() and out.where("not lossless").count() == 0
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    assert out.where(F.contains("text", F.lit(item))).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_language_held_out(spark):
    from foliospark.llm.queries import op2_language_id

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = op2_language_id(spark, SF).join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()
    assert row[0] > 0.95 and hashlib.sha256(b"").hexdigest()
