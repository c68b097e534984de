"""A BM25 index kept as one table and maintained in place.

The table is partitioned by bucket and kind of row: a row with its postings (kind "row": id, dl, terms, tfs) and the
bucket's share of the statistics ("stat": term, its rows, greatest tf, least dl). Statistics of all rows are sums over buckets, so an upsert writes the
buckets that it touches and no others; it is one job with one commit, and doing it again gives the same index. A bucket is what is updated together
(pages of a document, say); the caller gives it as a column, or ids are spread over `BUCKETS`.

ids are unique in what an index is built of; of repeated ones in an upsert the least (bucket, tokens) stays. A row without tokens counts as a row, null tokens as none, rows with a
null id are left out. A row may move to another bucket. Upserts must not run side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import bm25
from foliospark.runtime import delete_folder, materialize

BUCKETS = 64
PARTS = ("bucket", "kind")
ROW = ("id", "dl", "terms", "tfs", "bucket")


@dataclass
class Kept:
    spark: SparkSession
    path: str
    kind: str  # type of the ids

    def table(self) -> DataFrame:
        schema = f"id {self.kind}, dl double, terms array<string>, tfs array<int>, term string, tf double, n long, bucket int, kind string"
        return self.spark.read.schema(schema).parquet(self.path)

    def rows(self) -> DataFrame:
        return self.full().select("id", "dl", "bucket")

    def full(self) -> DataFrame:
        return self.table().where("kind = 'row'").select(*ROW)


def spread(c: Column | str = "id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def counted(tokens: DataFrame) -> DataFrame:
    """Rows of the kind "row" for tokens (id, tokens, bucket)."""
    return materialize(bm25.counted(tokens.select("id", "bucket", "tokens")).select(*ROW), "index-rows")


def laid_out(rows: DataFrame) -> DataFrame:
    """All rows of the table for those of the kind "row": these and the buckets' statistics."""
    each = bm25.postings(rows, "bucket")
    stats = each.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("tf"), F.min("dl").alias("dl")).withColumn("kind", F.lit("stat"))
    out = rows.withColumn("kind", F.lit("row")).unionByName(stats, allowMissingColumns=True)
    return out.select("id", "dl", "terms", "tfs", "term", "tf", "n", "bucket", "kind")


def written(rows: DataFrame, path: str) -> None:
    """Buckets and kinds that rows have replace those of the table; large ones are written by several tasks (rebalance splits them)."""
    rows.hint("rebalance", *PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*PARTS).parquet(path)


def ready(tokens: DataFrame) -> DataFrame:
    rows = tokens if "bucket" in tokens.columns else tokens.withColumn("bucket", spread())
    return rows.where("id is not null").select("id", "tokens", F.col("bucket").cast("int").alias("bucket"))


def build(tokens: DataFrame, path: str) -> Kept:
    """tokens: id, tokens and, if the caller has one, bucket. The folder must be new."""
    written(laid_out(counted(ready(tokens))), path)
    return Kept(tokens.sparkSession, path, tokens.schema["id"].dataType.simpleString())


def upsert(kept: Kept, tokens: DataFrame, removed: DataFrame | None = None) -> list[int]:
    """Puts tokens (as for build) in, in place of rows of the same id, and takes out the ids of `removed` (column id); an id in both stays in.

    Returns the buckets that were written again. Rows of these buckets that stay are taken from their postings, so no text is read again."""
    once = ready(tokens).groupBy("id").agg(F.min(F.struct("bucket", "tokens")).alias("r")).select("id", "r.tokens", "r.bucket")
    new = materialize(once, "upsert")
    changed = new.select("id")
    if removed is not None:
        changed = changed.unionByName(removed.select("id")).distinct()
    changed = materialize(changed, "upsert-ids")
    left_behind = kept.rows().join(changed, "id", "left_semi").select("bucket")
    touched = sorted(r["bucket"] for r in new.select("bucket").union(left_behind).distinct().collect())  # at most as many as there are buckets
    if not touched:
        return []
    inside = kept.table().where(F.col("bucket").isin(touched))
    had = {(r["bucket"], r["kind"]) for r in inside.select(*PARTS).distinct().collect()}  # at most two a bucket
    stay = inside.where("kind = 'row'").select(*ROW).join(changed, "id", "left_anti")
    live = materialize(stay.unionByName(counted(new)), "upsert-rows")
    written(laid_out(live), kept.path)
    full = F.max(F.size("terms") > 0).alias("full")
    has = {(r["bucket"], kind) for r in live.groupBy("bucket").agg(full).collect() for kind in ("row", "stat") if kind == "row" or r["full"]}
    for bucket, kind in sorted(had - has):  # what has no row any more is not overwritten
        delete_folder(kept.spark, f"{kept.path}/bucket={bucket}/kind={kind}")
    return touched


def opened(kept: Kept) -> bm25.Index:
    """The index for bm25.search. A term's `top` is the weight of its greatest tf in its shortest row: no less than any posting's, so bounds hold."""
    table = kept.table()
    totals = kept.rows().agg(F.count("id").alias("n"), F.avg("dl").alias("avgdl"))
    avgdl = totals.select("avgdl")
    each = table.where("kind = 'stat'").groupBy("term").agg(F.sum("n").alias("df"), F.max("tf").alias("tf"), F.min("dl").alias("dl"))
    df = each.crossJoin(F.broadcast(avgdl)).select("term", "df", bm25.saturated().alias("top"))
    return bm25.Index(kept.full().drop("bucket"), bm25.with_idf(df, totals.select("n")), avgdl)
