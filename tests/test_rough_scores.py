"""Pairs of rows and queries are scored roughly; only those that may be among the best are worked out in full, with the results of all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.operators import best, bm25, vectors


def ranked(score, ids, k, least=-np.inf):
    """qn, id, score of the k best rows of each query (rows x queries), ties to the least id."""
    score = best.rounded(score)
    return [(q, ids[i], score[i, q]) for q in range(score.shape[1]) for i in sorted(range(len(ids)), key=lambda i: (-score[i, q], ids[i]))[:k] if score[i, q] >= least]


def got(found):
    return [(q, i, float(best.rounded(np.float64(s)))) for b in found for q, i, s in zip(*b.to_pydict().values())]


@pytest.mark.parametrize("common, lowest", [(64, 0.1), (2, 0.1), (0, 0.1), (64, -0.5)])
def test_few_pairs_are_scored_in_full(monkeypatch, common, lowest):
    monkeypatch.setattr(bm25, "COMMON", common)
    monkeypatch.setattr(best, "CELLS", 4000)
    monkeypatch.setattr(best, "PENDING", 50)
    monkeypatch.setattr(bm25, "PAIRS", 500)
    rnd = np.random.default_rng(11)
    n, n_queries, k, vocabulary = 6000, 20, 4, 90
    tf = (rnd.random((n, vocabulary)) < 0.9 / np.arange(1, vocabulary + 1)) * rnd.integers(1, 4, (n, vocabulary))
    tf[:50] = tf[50:100]  # ties
    idf = np.where(rnd.random((n_queries, vocabulary)) < 0.3, np.round(rnd.uniform(lowest, 4, (n_queries, vocabulary)), 3), 0.0)
    dl = tf.sum(axis=1).astype(float)
    weight = tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl[:, None] / 7.5))
    ids = [f"r{i:x}" for i in rnd.permutation(n)]
    rows = pa.table({"id": ids, "dl": dl, "terms": [[f"w{t}" for t in np.flatnonzero(r)] for r in tf], "tfs": [r[r > 0].astype(np.int32) for r in tf]})
    asked = bm25.Asked.of([(q, f"w{t}", idf[q, t]) for q in range(n_queries) for t in np.flatnonzero(idf[q])], n_queries)
    worked = []
    whole = bm25.Asked.full
    monkeypatch.setattr(bm25.Asked, "full", lambda self, *a: worked.append(len(a[-1])) or whole(self, *a))
    found = got(bm25.scored(iter(rows.to_batches(1000)), asked, 7.5, n_queries, k))
    assert found == ranked(weight @ idf.T, ids, k, 1e-6)
    assert sum(worked) < n * n_queries / 10


def test_queries_of_the_same_terms_are_scored_once(spark, monkeypatch):
    asked = []
    of = bm25.Asked.of
    monkeypatch.setattr(bm25.Asked, "of", lambda terms, n: asked.append(n) or of(terms, n))
    index = bm25.build(spark.createDataFrame([(i, ["a"] * (i % 3) + ["b", f"c{i % 5}"]) for i in range(40)], "id long, tokens array<string>"))
    queries = spark.createDataFrame([(q, ["a", "c1", "a"] if q % 2 else ["c1", "a", "a"]) for q in range(6)] + [(9, ["a", "c1"])], "query_id long, tokens array<string>")
    found = bm25.search(index, queries, 3)
    assert asked == [2]
    rows = lambda df: sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in df.collect())
    want = rows(bm25.top_k(bm25.scores(index, queries), 3))
    assert rows(found) == want and len(want) == 21
    # Also where queries are dealt into blocks: those of the same terms come into one.
    asked.clear()
    assert rows(bm25.one_pass(index, bm25.priced(index, queries), 3, block=1)) == want and sum(asked) == 2


@pytest.mark.parametrize("scale", ["cosine", "shifted", "inverse_distance"])
def test_few_vectors_are_compared_in_full(monkeypatch, scale):
    monkeypatch.setattr(best, "CELLS", 4000)
    monkeypatch.setattr(best, "PENDING", 50)
    rnd = np.random.default_rng(4)
    x, q, ids = rnd.integers(-3, 4, (6000, 6)).astype(float), rnd.integers(-3, 4, (20, 6)).astype(float), [f"r{i:x}" for i in rnd.permutation(6000)]
    x[:3] = 0
    seen = []
    put = best.Best.put
    monkeypatch.setattr(best.Best, "put", lambda self, i, at, *a: seen.append(len(at)) or put(self, i, at, *a))
    rows = pa.table({"id": ids, "embedding": list(x)})
    found = got(vectors.scored(iter(rows.to_batches(1000)), q, 5, scale))
    length = lambda a: np.sqrt((a * a).sum(axis=1)) + 1e-9
    c = (x / length(x)[:, None]) @ (q / length(q)[:, None]).T
    assert found == ranked(np.round(vectors.SCALES[scale][0](c), 6), ids, 5)
    assert sum(seen) < x.shape[0] * len(q) / 10
