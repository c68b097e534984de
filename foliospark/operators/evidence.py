"""Query understanding, candidates of several sources, their fusion and re-ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.lexicon import DEFAULT, PLC_PATTERN, QUERY_PARAMETER_PATTERN, Lexicon
from foliospark.operators import bm25
from foliospark.operators import kb as K
from foliospark.operators.kb import among
from foliospark.operators.vectors import vector_search
from foliospark.runtime import materialize


def pool_size(k: int) -> int:
    """How many merged candidates are ranked again."""
    return min(max(2 * k, 12), 18)


def merge_size(k: int) -> int:
    return min(max(4 * k, 16), 28)


def intent(raw: Column, lex: Lexicon = DEFAULT) -> Column:
    """The first rule with a word in the query."""
    out = F.lit("troubleshooting")
    for name, words in reversed(lex.intents):
        out = F.when(T.contains_any(raw, words), name).otherwise(out)
    return out


def query_type() -> Column:
    codes = F.size("alarm_codes") > 0
    return (
        F.when(codes & (F.col("intent") == "explain"), "alarm_explain")
        .when(codes & (F.col("intent") == "troubleshooting"), "alarm_diagnosis")
        .when(F.size("param_codes") > 0, "parameter_lookup")
        .when(F.size("plc_addresses") > 0, "plc_lookup")
        .when(F.col("intent") == "procedure", "procedure_lookup")
        .when(F.col("intent") == "safety", "safety_lookup")
        .otherwise("general_lookup")
    )


def parse(queries: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """queries: query_id, raw_query. Adds what later steps ask of a query, and its limits."""
    found = lambda p: F.array_distinct(F.transform(F.regexp_extract_all("normalized_query", F.lit(p), F.lit(1)), F.upper))
    q = queries.withColumn("normalized_query", T.canonical(F.col("raw_query"), lex, unicode))
    q = q.withColumn("alarm_codes", found(lex.compact_code)).withColumn("param_codes", found(QUERY_PARAMETER_PATTERN)).withColumn("plc_addresses", found(PLC_PATTERN))
    q = q.withColumn("entities", T.components(F.col("normalized_query"), lex.query_components)).withColumn("intent", intent(F.col("raw_query"), lex)).withColumn("query_type", query_type())
    q = q.withColumn("keywords", F.array_distinct(T.keywords(F.col("normalized_query"), F.array_union("alarm_codes", "entities"))))
    q = q.withColumn("need_safety", (F.col("intent") == "safety") | T.contains_any(F.col("raw_query"), lex.safety_words))
    first = lambda c, n: F.array_join(F.slice(c, 1, n), " ")
    has_e, has_k = F.size("entities") > 0, F.size("keywords") > 0
    per_code = F.flatten(F.transform("alarm_codes", lambda c: F.array_compact(F.array(c, F.when(has_e, F.concat(c, F.lit(" "), first("entities", 2))), F.when(has_k, F.concat(c, F.lit(" "), first("keywords", 4)))))))
    rest = F.array_compact(F.array(F.when(has_e & has_k, F.concat(first("entities", 2), F.lit(" "), first("keywords", 4))), F.when(has_e, first("entities", 3))))
    q = q.withColumn("expanded_queries", F.array_distinct(F.filter(F.concat(F.array(F.trim("raw_query"), F.trim("normalized_query")), per_code, rest), lambda x: x != "")))
    terms = F.array_join(F.array_distinct(F.concat(F.slice("entities", 1, 2), F.slice("keywords", 1, 3))), " ")
    other = F.when(terms != "", terms).when(F.trim("normalized_query") != F.trim("raw_query"), F.trim("normalized_query"))
    coded = F.when((F.size("alarm_codes") > 0) & (terms != ""), F.concat(F.col("alarm_codes")[0], F.lit(" "), terms))
    q = q.withColumn("vector_queries", F.slice(F.array_distinct(F.filter(F.array_compact(F.array(F.trim("raw_query"), other, coded)), lambda x: x != "")), 1, 2))
    exact = F.size(F.concat("alarm_codes", "param_codes", "plc_addresses")) > 0
    careful = F.col("query_type").isin("procedure_lookup", "safety_lookup")
    return (
        q.withColumn("entity_limit", F.when(exact, 20).otherwise(12))
        .withColumn("bm25_limit", F.when(exact, 24).otherwise(20))
        .withColumn("vector_limit", F.greatest(F.when(exact, 10).otherwise(16), F.when(careful, 14).otherwise(0)))
        .withColumn("graph_limit", F.greatest(F.when(exact, 16).otherwise(20), F.when(careful, 18).otherwise(0)))
    )


#: Of each kind of key in a query: its mark, score and reason.
ENTITY_ARMS = (
    ("alarm_codes", "a", 1.0, "alarm_code_exact_match"),
    ("param_codes", "p", 0.95, "param_code_exact_match"),
    ("plc_addresses", "l", 0.95, "plc_address_exact_match"),
    ("entities", "e", 0.75, "entity_exact_match"),
)
MOST_ENTITY_HITS = 20
SOURCES = ("entity", "bm25", "vector", "graph")


def _marked(c: Column | str, mark: str) -> Column:
    return F.transform(c, lambda x: F.concat(F.lit(mark + ":"), x))


def entity_keys(codes: Column | str, entities: Column | str) -> Column:
    """The keys by which a knowledge row is found."""
    digits = F.transform(F.filter(entities, lambda e: e.rlike("[0-9]")), F.upper)
    plc = F.filter(F.transform(entities, F.upper), lambda e: e.rlike("^[A-Z]?[0-9]{1,4}[.][0-9]$"))
    return F.array_distinct(F.concat(_marked(F.transform(codes, T.normalize_code), "a"), _marked(digits, "p"), _marked(plc, "l"), _marked(entities, "e")))


def entity_match(parsed: DataFrame, kb: DataFrame) -> DataFrame:
    """query_id, id, score, reasons, rank: knowledge rows (id, codes, entities) with a key of the query.

    A row's score hangs on the kind of the key alone, so of each key's rows only the first by id can be among a
    query's best: those are kept before the join, whatever the number of rows that have the key.
    """
    arm = lambda c, v: F.transform(c, lambda key: F.struct(key.alias("key"), F.lit(v).alias("score")))
    asked = F.array_distinct(F.flatten(F.array(*(arm(_marked(c, m), v) for c, m, v, _ in ENTITY_ARMS))))
    wants = parsed.select("query_id", "entity_limit", F.explode(asked).alias("x")).select("query_id", "entity_limit", "x.*")
    keyed = kb.select("id", entity_keys("codes", "entities").alias("keys"))
    first = keyed.select("id", F.explode("keys").alias("key")).withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("r") <= MOST_ENTITY_HITS)
    hits = first.join(wants, "key").groupBy("query_id", "entity_limit", "id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    best = hits.withColumn("rank", F.row_number().over(w)).where("rank <= entity_limit").drop("entity_limit")
    best = materialize(best, "entity-best")
    both = best.join(parsed.select("query_id", F.transform(asked, lambda x: x["key"]).alias("asked_")), "query_id").join(among(keyed, best), "id")
    met = F.array_intersect("asked_", "keys")
    name = lambda k: F.element_at(F.create_map(*(F.lit(x) for _, m, _, r in ENTITY_ARMS for x in (m, r))), F.substring(k, 1, 1))
    return both.select("query_id", "id", "score", "rank", F.array_distinct(F.transform(met, name)).alias("reasons"), F.array_distinct(F.transform(met, lambda k: F.substr(k, F.lit(3)))).alias("matched_entities"))


def of_blocks(found: DataFrame, kb: DataFrame, limit: Column, most: int = 3) -> DataFrame:
    """query_id, id, score, rank: the first rows of each block found (query_id, id, score and `limit`'s columns), the best score of any."""
    found = materialize(found, "found")
    rows = among(kb.where(F.col("part_no") < most).select(F.col("block_id").alias("block_"), F.col("kb_id")), found, "block_")
    best = found.join(rows, found["id"] == rows["block_"]).groupBy("query_id", F.col("kb_id").alias("id")).agg(F.max("score").alias("score"), F.max(limit).alias("limit_"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(w)).where("rank <= limit_").drop("limit_")


def _limited(found: DataFrame, parsed: DataFrame, limit: str) -> DataFrame:
    """Hits of variants (query_id a struct) within the query's limit."""
    rows = found.select(F.col("query_id.query_id").alias("query_id"), "id", "score", "rank").join(parsed.select("query_id", F.col(limit).alias("lim")), "query_id")
    return rows.where("rank <= lim")


def bm25_hits(parsed: DataFrame, index: bm25.Index, kb: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """Each expanded query finds its best blocks; their first three knowledge rows count with the best score of any."""
    variants = parsed.select("query_id", F.posexplode("expanded_queries").alias("variant", "q")).select(F.struct("query_id", "variant").alias("query_id"), tokens(F.col("q")).alias("tokens"))
    return of_blocks(_limited(bm25.search(index, variants, 24), parsed, "bm25_limit"), kb, F.col("lim"))


def vector_hits(parsed: DataFrame, vectors: DataFrame, kb: DataFrame, embedded: Callable[[Column], Column]) -> DataFrame:
    """The same for vector queries; vectors: id (of a block), embedding."""
    variants = parsed.select("query_id", F.posexplode("vector_queries").alias("variant", "q")).select(F.struct("query_id", "variant").alias("query_id"), embedded(F.col("q")).alias("embedding"))
    return of_blocks(_limited(vector_search(vectors, variants, 16, "inverse_distance"), parsed, "vector_limit"), kb, F.col("lim"))


def skips_vector(parsed: DataFrame, *hits: DataFrame) -> DataFrame:
    """query_id of the queries with an exact key of which something was found already."""
    some = hits[0].select("query_id")
    for h in hits[1:]:
        some = some.union(h.select("query_id"))
    return parsed.where(F.size(F.concat("alarm_codes", "param_codes", "plc_addresses")) > 0).select("query_id").join(some.distinct(), "query_id", "left_semi")


def graph_seeds(parsed: DataFrame, arms: list[DataFrame], most: int = 20) -> DataFrame:
    """query_id, id, score, hops, max_expand: the first `most` hits, arm after arm; of a row's scores the last arm's counts."""
    rows = None
    for i, a in enumerate(arms):
        part = a.select("query_id", "id", "score", F.lit(i).alias("arm"), "rank")
        rows = part if rows is None else rows.union(part)
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("arm", "rank"))).where(F.col("n") <= most)
    last = rows.groupBy("query_id", "id").agg(F.max_by("score", "n").alias("score"))
    limits = parsed.select("query_id", F.when(F.size("alarm_codes") > 0, 2).otherwise(1).alias("hops"), F.col("graph_limit").alias("max_expand"))
    return last.join(limits, "query_id")


def retrieve(queries: DataFrame, index: bm25.Index, vectors: DataFrame, kb: DataFrame, links: K.Links | Callable[[DataFrame], K.Links], tokens: Callable[[Column], Column], embedded: Callable[[Column], Column], k: int = 5, lex: Lexicon = DEFAULT, unicode: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parsed queries, merged candidates, the best k after ranking again) of queries (query_id, raw_query).

    index and vectors are over blocks; kb: kb_id, block_id, part_no, kb_type, section_path, codes, entities, text,
    search_text. links: those of the graph, or what gives them for the seeds (id) that it is gone through from.
    The scorer is the share of the query's tokens in a row's search text.
    """
    parsed = materialize(parse(queries, lex, unicode), "parsed")
    rows = kb.withColumn("id", F.col("kb_id"))
    entity = materialize(entity_match(parsed, rows), "entity-hits")
    lexical = materialize(bm25_hits(parsed, index, kb, tokens), "bm25-hits")
    asked = parsed.join(skips_vector(parsed, entity, lexical), "query_id", "left_anti")
    vector = materialize(vector_hits(asked, vectors, kb, embedded), "vector-hits")
    seeds = materialize(graph_seeds(parsed, [entity, lexical, vector]), "seeds")
    near = K.expand(links(seeds) if callable(links) else links, seeds, F.col("hops"), F.col("max_expand")).join(parsed.select("query_id", "graph_limit"), "query_id").where("rank <= graph_limit")
    none, nil = F.array().cast("array<string>"), F.lit(None)
    arm = lambda df, s, why, d=nil.cast("int"), met=none, seed=nil.cast("string"): df.select("query_id", "id", F.lit(s).alias("source"), "score", d.alias("distance"), why.alias("reasons"), met.alias("matched_entities"), seed.alias("seed"))
    found = arm(entity, "entity", F.col("reasons"), met=F.col("matched_entities")).union(arm(lexical, "bm25", F.array(F.lit("keyword_match")))).union(arm(vector, "vector", F.array(F.lit("semantic_match"))))
    found = found.union(arm(near, "graph", F.array(F.lit("graph_neighbor"), F.coalesce("relation", F.lit("graph_neighbor"))), F.col("distance"), seed=F.col("parent")))
    found = materialize(found, "candidates")
    facts = among(rows, found).select("id", "kb_type", "section_path", F.col("codes").alias("alarm_codes"), "entities", "text", "search_text", "block_id", "page_no")
    merged = materialize(merge(found, facts, parsed, k, lex), "merged")
    pool = merged.where(F.col("rank") <= pool_size(k)).join(parsed.select("query_id", "raw_query"), "query_id")
    pool = pool.withColumn("relevance", F.round(lexical_relevance(tokens(F.col("raw_query")), tokens(F.col("search_text"))), 6)).drop("raw_query")
    return parsed, merged, rerank(pool, parsed, k, lex, unicode)


def merge(candidates: DataFrame, kb: DataFrame, parsed: DataFrame, k: int = 5, lex: Lexicon = DEFAULT) -> DataFrame:
    """candidates: query_id, id, source (entity, bm25, vector, graph), score, distance (null but for
    graph); kb: id, kb_type, section_path, alarm_codes. Weighted sum of each source's best, with boosts.

    If candidates also say why (reasons, matched_entities, seed), a merged row has all reasons in the order of the sources, each once."""
    said = "reasons" in candidates.columns
    of = lambda c: F.array_distinct(F.flatten(F.array(*(F.coalesce(F.max(F.when(F.col("source") == s, F.col(c))), F.array().cast("array<string>")) for s in SOURCES))))
    why = [of("reasons").alias("reasons"), of("matched_entities").alias("matched_entities"), F.max("seed").alias("seed_kb_id")] if said else []
    best = candidates.groupBy("query_id", "id").agg(
        *(F.max(F.when(F.col("source") == s, F.col("score"))).alias(f"{s}_score") for s in SOURCES),
        *why,
        F.min("distance").alias("graph_distance"),
        F.collect_set("source").alias("had_"),
    )
    # Sources in the order in which they are asked.
    best = best.withColumn("sources", F.array_intersect(F.array(*map(F.lit, SOURCES)), "had_")).drop("had_")
    rows = best.join(kb, "id").join(parsed.select("query_id", F.col("alarm_codes").alias("query_codes"), "need_safety"), "query_id")
    yes = lambda on, v: F.when(on, v).otherwise(0.0)
    boost = (
        yes(F.arrays_overlap("alarm_codes", "query_codes"), 0.30)
        + yes(F.col("kb_type").isin("alarm", "procedure"), 0.20)
        + yes(T.contains_any(F.coalesce("section_path", F.lit("")), lex.fault_words), 0.15)
        + yes(F.coalesce(F.col("graph_distance") == 1, F.lit(False)), 0.10)
        + yes(F.col("need_safety") & (F.col("kb_type") == "warning"), 0.15)
    )
    z = lambda s: F.coalesce(f"{s}_score", F.lit(0.0))
    out = rows.withColumn("boost", boost).withColumn("score", F.round(1.20 * z("entity") + 1.00 * z("bm25") + 0.90 * z("vector") + 0.70 * z("graph") + F.col("boost"), 9))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= merge_size(k))


def evidence_text(text: Column | str, section: Column | str, codes: Column | str, entities: Column | str, lex: Lexicon = DEFAULT, unicode: bool = True) -> Column:
    """Text, section, codes and entities of a row, canonical."""
    whole = F.concat_ws("\n", F.coalesce(text, F.lit("")), F.coalesce(section, F.lit("")), F.array_join(codes, " "), F.array_join(entities, " "))
    return T.canonical(whole, lex, unicode)


def rerank(merged: DataFrame, parsed: DataFrame, k: int = 5, lex: Lexicon = DEFAULT, unicode: bool = True) -> DataFrame:
    """merged also has text, section_path, entities and relevance (a scorer's). Adds the boosts that the query's type asks for and ranks again."""
    rows = merged.drop("rank", "need_safety", "query_codes").join(parsed.select("query_id", "normalized_query", "query_type", "need_safety", F.col("alarm_codes").alias("query_codes")), "query_id")
    rows = rows.withColumn("evidence_text", evidence_text("text", "section_path", "alarm_codes", "entities", lex, unicode))
    yes = lambda on, v: F.when(on, v).otherwise(0.0)
    match = F.arrays_overlap("alarm_codes", "query_codes") & F.col("query_type").isin("alarm_diagnosis", "alarm_explain")
    boost = (
        yes((F.col("normalized_query") != "") & F.contains("evidence_text", F.col("normalized_query")), 0.25)
        + yes((F.col("query_type") == "procedure_lookup") & (F.col("kb_type") == "procedure"), 0.20)
        + yes((F.col("query_type") == "safety_lookup") & (F.col("kb_type") == "warning"), 0.18)
        + yes(match, 0.20)
        + yes(match & (F.col("kb_type") == "alarm"), 0.10)
    )
    out = rows.withColumn("post_boost", F.round(boost, 9)).withColumn("adjusted", F.round(F.col("relevance") + F.col("post_boost"), 9))
    w = Window.partitionBy("query_id").orderBy(F.col("adjusted").desc(), "id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def lexical_relevance(query_tokens: Column, text_tokens: Column) -> Column:
    """The offline scorer: the share of the query's distinct tokens that the text has."""
    q = F.array_distinct(query_tokens)
    return F.when(F.size(q) == 0, 0.0).otherwise(F.size(F.array_intersect(q, text_tokens)) / F.size(q))


def expand_context(blocks: DataFrame, before: int = 2, after: int = 3) -> DataFrame:
    """context_before, context_after: ids around a block, page contexts skipped."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    live = blocks.where("block_type <> 'page_context'")
    return live.select("*", F.collect_list("block_id").over(w.rowsBetween(-before, -1)).alias("context_before"), F.collect_list("block_id").over(w.rowsBetween(1, after)).alias("context_after"))


def metadata_filter(literals: dict[str, str], array_columns: tuple[str, ...] = ()) -> Column:
    """AND of key = value; digits and true/false are typed; an array column must hold the value."""
    out = F.lit(True)
    for key, raw in sorted(literals.items()):
        value: object = int(raw) if raw.isdigit() else {"true": True, "false": False}.get(raw.lower(), raw)
        out = out & (F.array_contains(key, raw) if key in array_columns else F.col(key) == F.lit(value))
    return out


def displayed(hits: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each hit (query_id, id, ...) with its page's context and the first image of the block, else of the context, else "".

    blocks: block_id, doc_id, page_no, block_type, text, image_paths. Contexts are found by document and page; a hit without a page has none.
    Of several contexts of a page that with the last id is taken; hits whose block is missing are left out."""
    own = blocks.where("block_type <> 'page_context'").select(F.col("block_id").alias("id"), "doc_id", "page_no", F.get("image_paths", F.lit(0)).alias("own_image"))
    context = blocks.where("block_type = 'page_context' and page_no > 0").groupBy("doc_id", "page_no").agg(F.max_by(F.struct("block_id", "text", "image_paths"), "block_id").alias("c"))
    rows = hits.join(own, "id").join(context, ["doc_id", "page_no"], "left")
    image = F.coalesce(F.col("own_image"), F.get(F.col("c.image_paths"), F.lit(0)), F.lit(""))
    return rows.select(*hits.columns, "doc_id", "page_no", F.col("c.block_id").alias("page_context_id"), F.col("c.text").alias("page_context"), image.alias("page_image"))
