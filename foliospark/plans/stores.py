"""Queries of sources, sinks and services, and the whole offline build, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.plans.manual import KB, built, canon, items
from foliospark.plans.online import ARMS, arms, hybrid_blocks, hybrid_sql, only
from foliospark.plans.registry import documents, joined, query
from foliospark.runtime import materialize, shared_dir
from foliospark.sources import collections, files, services
from foliospark.sources import stores as S


def place(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/foliospark/{tag}-{uuid.uuid4().hex}"


@query("SELECT doc_id, md5(coalesce(text, '-')) AS text_md5, lang, n_chars FROM documents")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = place(spark, "jsonl")
    files.write_jsonl(documents(spark, d), path)
    back = files.read_jsonl(spark, path, documents(spark, d).schema)
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit("-"))).alias("text_md5"), "lang", "n_chars")


@query("SELECT doc_id, md5(coalesce(text, '-')) AS text_md5, lang, source FROM documents")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path, docs = place(spark, "json"), documents(spark, d)
    S.write_json(docs.select(F.struct(*docs.columns).alias("value")), path)
    return S.read_json(spark, path, docs.schema).select("doc_id", F.md5(F.coalesce("text", F.lit("-"))).alias("text_md5"), "lang", "source")


@query(f"""WITH {ARMS} SELECT b.id AS node_id, md5(concat_ws(chr(10), nullif(title, ''), nullif(array_to_string(b.codes, ' '), ''), nullif(section_path, ''), nullif(s, ''), nullif(body, ''))) AS text_md5, b.page_no
FROM (SELECT *, concat_ws(chr(10), nullif(title, ''), nullif(array_to_string(codes, ' '), ''), nullif(section_path, ''), nullif(c, '')) AS s FROM (SELECT block_id AS id, title, codes, section_path, body, page_no, {canon('body')} AS c FROM blocks WHERE ctx = 0)) b""")
def text_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = S.text_nodes(built(spark, d), ["block_type", "page_no", "codes"])
    return nodes.select("node_id", F.md5("text").alias("text_md5"), F.get_json_object("metadata", "$.page_no").cast("int").alias("page_no"))


@query("SELECT doc_id, md5('data:image/' || CASE doc_id % 3 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' ELSE 'webp' END || ';base64,' || to_base64(encode(coalesce(text, '')))) AS url_md5, CASE WHEN doc_id % 2 = 0 THEN 'A_b_' || doc_id ELSE 'document' END AS slug FROM documents")
def data_urls(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    suffix = F.when(i % 3 == 0, "jpg").when(i % 3 == 1, "").otherwise("webp")
    name = F.when(i % 2 == 0, F.concat(F.lit("A-b  "), i.cast("string"))).otherwise("--")
    return documents(spark, d).select("doc_id", F.md5(files.data_url(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), suffix)).alias("url_md5"), files.slug(name).alias("slug"))


class Upper:
    """A page reader that gives back its url in capitals."""

    def read(self, image_url: str) -> str:
        return f" {image_url.upper()} "


@query("""SELECT doc_id, page_no, CASE WHEN page_no = 1 THEN 'kept' ELSE 'IMG' || doc_id || '/' || page_no END AS ocr_text FROM (SELECT doc_id, unnest(range(1, doc_id % 3 + 2))::INT AS page_no FROM documents)""")
def read_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", F.explode(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int"))).alias("page_no"))
    rows = rows.withColumn("image_url", F.concat(F.lit("img"), F.col("doc_id").cast("string"), F.lit("/"), F.col("page_no").cast("string")))
    known = rows.where("page_no = 1").select("doc_id", "page_no", F.lit("kept").alias("ocr_text"))
    return services.read_pages(rows, known, Upper)


class Lengths:
    """An embedder that fails on large batches: the text's length and number of spaces."""

    def many(self, texts: list[str]) -> list[list[float]]:
        if len(texts) > 4:
            raise ValueError("too many")
        return [self.one(t) for t in texts]

    def one(self, text: str) -> list[float]:
        return [float(len(text)), float(text.count(" "))]


@query("SELECT doc_id AS id, len(coalesce(text, ''))::DOUBLE AS a, (len(coalesce(text, '')) - len(replace(coalesce(text, ''), ' ', '')))::DOUBLE AS b FROM documents")
def embeddings_of(spark: SparkSession, d: str) -> DataFrame:
    out = services.embed(documents(spark, d), Lengths, "doc_id")
    return out.select("id", F.get("embedding", F.lit(0)).alias("a"), F.get("embedding", F.lit(1)).alias("b"))


@query("SELECT doc_id, len(coalesce(text, '')) AS n, false AS made_again, true AS made_after_change FROM documents")
def kept_collection(spark: SparkSession, d: str) -> DataFrame:
    """A table that is made once, read the second time, and made again when its input differs."""
    path, docs = place(spark, "kept"), documents(spark, d)
    make = lambda df: df.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    collections.synced(docs, path, make, ["doc_id", "text"], "lengths")
    out, again = collections.synced(docs, path, make, ["doc_id", "text"], "lengths")
    rows = materialize(out, "kept-copy")
    _, changed = collections.synced(docs.where("doc_id >= 0").withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit("!"))), path, make, ["doc_id", "text"], "lengths")
    return rows.select("doc_id", "n", F.lit(again).alias("made_again"), F.lit(changed).alias("made_after_change"))


@query("SELECT count(*) AS n, count(DISTINCT source) AS sources FROM documents")
def found_input(spark: SparkSession, d: str) -> DataFrame:
    rows = S.first_found(spark, f"{d}/final_documents.parquet", f"{d}/documents.parquet")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source").alias("sources"))


class Shares:
    """A scorer: the share of the query's words that a text has. Given back worst first, as a service may."""

    def rerank(self, query: str, documents: list[str], top_n: int) -> list[dict]:
        q = set(query.split())
        rows = [{"index": i, "relevance_score": round(len(q & set(t.split())) / max(1, len(q)), 6)} for i, t in enumerate(documents)]
        return sorted(rows, key=lambda r: r["relevance_score"])[-top_n:]


@query(f"WITH {ARMS}, {hybrid_sql(20, 5, 0.15, 0.05)} SELECT h.query_id, h.id, round(len(list_intersect(list_distinct(q.ts), list_distinct(b.t))) / greatest(1, len(list_distinct(q.ts))), 6) AS relevance FROM hyb h JOIN asks q USING (query_id) JOIN btoks b ON b.id = h.id")
def rerank_service(spark: SparkSession, d: str) -> DataFrame:
    rows, index, embeddings, asked = arms(spark, d)
    found = materialize(hybrid_blocks(rows, index, embeddings, asked, 5), "found")
    both = found.join(asked.select("query_id", joined("tokens").alias("raw_query")), "query_id").join(only(rows, found).select(F.col("block_id").alias("id"), joined("tokens").alias("text")), "id")
    return S.rerank_scores(both, Shares)


@query(f"""WITH {KB}, pg AS (SELECT doc_id, page_no, string_agg(body, chr(10) ORDER BY pos_no) AS t FROM own WHERE page_no > 0 GROUP BY ALL)
SELECT (SELECT count(*) FROM rows) AS n_blocks, (SELECT count(*) FROM own WHERE typ IN ('alarm_candidate', 'table_candidate')) AS n_candidates, (SELECT count(*) FROM pg WHERE len(t) BETWEEN 1 AND 24) AS n_short_pages, (SELECT count(*) FROM kb) AS n_rows, (SELECT count(DISTINCT e) FROM (SELECT unnest(entities) AS e FROM kb)) AS n_entities""")
def offline_build(spark: SparkSession, d: str) -> DataFrame:
    """The whole build, from layout items to the graph: its report."""
    from foliospark.plans.offline import build_all

    report = build_all(spark, items(spark, d), place(spark, "build"), least_garble=1.0, unicode=False)
    return spark.createDataFrame([(report["blocks"], report["candidates"], report["short_pages"], report["kb_rows"], report["entities"])], "n_blocks long, n_candidates long, n_short_pages long, n_rows long, n_entities long")
