"""The queries of the corpus operators over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import decontamination, divergence, imatch, language_id, line_dedup, lm_score, point_in_time, sentencepiece_codec, sharding, simhash, suffix_dedup, token_counts, url_filter
from foliospark.runtime import table

TOKEN_LIMIT = 1024
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    with open(path or tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        out = token_counts.token_counts(table(spark, sf_dir, "documents"), f.read())
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(language_id.fold_of(F.col("doc_id")) != 1)
    out = language_id.language_id(docs, learn)
    return out.select("doc_id", F.coalesce(language_id.fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "phrases", "n_symbols")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), RULES)


def op4_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    with open(path or tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    out = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), model, decoded=True)
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.coalesce("pieces", F.array().cast("array<int>")), " "), 256).alias("pieces_sha256"),
        F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, lexicon = imatch.imatch(table(spark, sf_dir, "documents"))
    rows = imatch.edited(imatch.with_next(own, ["text", "fingerprint"])).withColumn("edited_sha256", F.sha2("edited_text", 256))
    both = imatch.fingerprinted(rows.select("doc_id", "n_chars", "edited_text", "edited_sha256", "fingerprint", "next_fingerprint"), "edited_text", "edited_fingerprint", lexicon, 20)
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return lm_score.lm_score(table(spark, sf_dir, "documents"), good)


def op11_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_in_time.point_in_time(*(table(spark, sf_dir, n) for n in ("sales", "clicks", "sale_lines")))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_counts, op2_language_id, op3_url_filter, op4_sentencepiece, op5_decontamination, op6_simhash, op7_imatch, op8_suffix_dedup, op9_line_dedup, op10_lm_score, op11_point_in_time, op12_sharding, op13_source_divergence, pipeline)
}

ORACLES: dict[str, str] = {
    "op9_line_dedup": r"""
        WITH lines AS (
            SELECT d.doc_id, i.n, string_split(coalesce(d.text, ''), chr(10))[i.n] AS line
            FROM documents d, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) AS n) i
        ), keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), often AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op13_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
        ), groups AS (SELECT DISTINCT lang, source FROM docs),
        words AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        own AS (SELECT w.lang, source, term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
        totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN own USING (lang, source) GROUP BY ALL),
        shares AS (
            SELECT t.lang, t.source, k.term, coalesce(o.n, 0) AS n,
                   (1 + (1000000000::hugeint * (coalesce(o.n, 0) + 1)) // (t.total + l.v))::hugeint AS p,
                   (1 + (1000000000::hugeint * (k.n + 1)) // (l.total + l.v))::hugeint AS q
            FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN own o ON (o.lang, o.source, o.term) = (t.lang, t.source, k.term)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::bigint AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON (p.lang, p.source, p.item) = (a.lang, a.source, b.source)
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint FROM shares WHERE n > 0 AND p > q
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE C)::int AS rank FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
