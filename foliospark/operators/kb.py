"""Knowledge rows, their links, and the graph over them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.lexicon import DEFAULT, EDGE_WEIGHTS, Lexicon
from foliospark.operators import blocks as B
from foliospark.runtime import bounded, materialize, shared_dir, shuffle_partitions

KEPT = ("block_type", "block_level", "section_path", "image_paths", "page_context_id", "source", "parse_level", "context_prev", "context_next", "title")


def split_blocks(df: DataFrame, lex: Lexicon = DEFAULT, unicode: bool = False) -> DataFrame:
    """Knowledge rows of blocks (doc_id, block_id, pos, page_no, block_type, text, codes, and of KEPT what there is): one
    for each code, else steps, table rows or merged paragraphs; none of page contexts and blank text."""
    kind = F.col("block_type")
    as_one = lambda texts, k, family: F.transform(texts, lambda x: F.struct(k.alias("kb_type"), F.lit(family).alias("family"), x.alias("text")))
    parts = (
        F.when(F.size("codes") > 0, as_one(F.transform("codes", lambda c: F.col("text")), F.lit("alarm"), "alarm"))
        .when(kind == "procedure", as_one(B.steps(F.col("text"), lex), F.lit("procedure"), "step"))
        .when(F.startswith(kind, F.lit("table")), as_one(B.rows_of(F.col("text")), F.lit("table"), "row"))
        .otherwise(as_one(B.merged_short(B.paragraphs(F.col("text"))), F.when(kind == "warning", "warning").otherwise("text"), "para"))
    )
    live = df.where((kind != "page_context") & (F.trim("text") != ""))
    kept = ["doc_id", "block_id", "pos", "page_no", "codes", *(c for c in KEPT if c in df.columns)]
    out = live.select(*kept, F.posexplode(parts).alias("part_no", "x")).select(*kept, "part_no", "x.kb_type", "x.family", "x.text")
    out = out.withColumn("kb_id", F.concat("block_id", F.lit("__"), "family", F.lit("_"), T.padded(F.col("part_no") + 1, 2)))
    # Each in a projection of its own, so that it is computed once a row.
    out = out.withColumn("canonical_text", T.canonical(F.col("text"), lex, unicode))
    found = F.array_union(F.array_union("codes", T.parameters(F.col("canonical_text"), lex)), T.components(F.col("text"), lex.components))
    out = out.withColumn("entities", F.array_sort(found))
    if "title" not in out.columns:
        return out
    out = out.withColumn("action", actions(F.col("title"), F.col("codes"), F.col("text"), F.col("kb_type")))
    return searched(out)


def searched(df: DataFrame) -> DataFrame:
    """What is searched, from the other columns of knowledge rows."""
    df = df.withColumn("searchable_text", T.join_filled(F.col("title"), F.array_join("entities", " "), F.col("section_path"), F.col("canonical_text")))
    return df.withColumn("search_text", T.kb_search_text(F.col("entities"), F.col("action"), F.col("section_path"), F.col("searchable_text"), F.col("canonical_text"), F.col("text")))


def lean(kb: DataFrame) -> DataFrame:
    """Knowledge rows as they are written: without what `whole` derives again at little cost."""
    other = ~F.col("canonical_text").eqNullSafe(F.upper("text"))
    return kb.withColumn("canonical_text", F.when(other, F.col("canonical_text"))).drop("searchable_text", "search_text")


def whole(kb: DataFrame) -> DataFrame:
    """The rows that were made lean, all columns as before."""
    return searched(kb.withColumn("canonical_text", F.coalesce("canonical_text", F.upper("text"))))


def actions(title: Column, codes: Column, text: Column, kind: Column) -> Column:
    """The title if it is no code, the first line if it is another; else a default of the type. Sorted, distinct."""
    name = F.trim(F.coalesce(title, F.lit("")))
    first = F.split_part(T.strip(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(1))
    line = T.let(first, lambda x: F.when((x != "") & (x != name), F.substring(x, 1, 120)))
    found = F.array_compact(F.array(F.when((name != "") & ~F.array_contains(codes, name), name), line))
    default = F.when(kind == "procedure", F.array(F.lit("procedure_step"))).when(kind == "table", F.array(F.lit("table_row"))).when(kind == "alarm", F.array(F.lit("alarm_event")))
    return F.array_sort(F.array_distinct(T.let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(F.coalesce(default, x)))))


def _first_two(kb: DataFrame) -> DataFrame:
    """block_id, ids: the first two rows of each block, in order."""
    first = kb.where("part_no < 2").groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("part_no", "kb_id"))).alias("x"))
    return first.select("block_id", F.transform("x", lambda r: r["kb_id"]).alias("ids"))


def context_rows(kb: DataFrame) -> DataFrame:
    """block_id, around_prev, around_next: the first two rows of each of a block's context blocks, in order."""
    one = kb.where("part_no = 0")
    refs = one.select("block_id", F.explode(F.concat(F.transform("context_prev", lambda b, i: F.struct(F.lit(0).alias("side"), i.alias("i"), b.alias("ref"))), F.transform("context_next", lambda b, i: F.struct(F.lit(1).alias("side"), i.alias("i"), b.alias("ref"))))).alias("r")).select("block_id", "r.*")
    got = refs.join(_first_two(kb).withColumnRenamed("block_id", "ref"), "ref").groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("side", "i", "ids"))).alias("x"))
    side = lambda k: F.flatten(F.transform(F.filter("x", lambda r: r["side"] == k), lambda r: r["ids"]))
    return got.select("block_id", side(0).alias("around_prev"), side(1).alias("around_next"))


def relink(kb: DataFrame) -> DataFrame:
    """prev/next ids, the two ids before and after, and with context blocks (context_prev, context_next) the first two rows of each, if new."""
    w = Window.partitionBy("doc_id").orderBy("pos", "part_no")
    near = lambda a, b: F.collect_list("kb_id").over(w.rowsBetween(a, b))
    out = kb.select("*", F.lag("kb_id").over(w).alias("prev_kb_id"), F.lead("kb_id").over(w).alias("next_kb_id"), near(-2, -1).alias("context_prev_kb"), near(1, 2).alias("context_next_kb"))
    if "context_prev" not in kb.columns:
        return out
    none = F.array().cast("array<string>")
    out = out.join(context_rows(kb), "block_id", "left")
    more = lambda c: F.concat(f"context_{c}_kb", F.array_distinct(F.array_except(F.coalesce(f"around_{c}", none), f"context_{c}_kb")))
    return out.withColumn("context_prev_kb", more("prev")).withColumn("context_next_kb", more("next")).drop("around_prev", "around_next")


def edges(kb: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """source, target, relation, direction, page_no, distinct: entity links, neighbours in order and on a page, and the first
    two rows of the context blocks. All links of a row come of one array, so kb is gone through once; kb_id names one row, so equal links
    can only come of the same row, and none are shuffled to be told apart."""
    w = Window.partitionBy("doc_id").orderBy("pos", "part_no")
    page = Window.partitionBy("doc_id", "page_no").orderBy("pos", "part_no")
    rows = kb.select("*", F.lead("kb_id").over(w).alias("n_"), F.lead("kb_id").over(page).alias("p_"))
    none = F.array().cast("array<string>")
    if "context_prev" in kb.columns:
        rows = rows.join(context_rows(kb), "block_id", "left")
    else:
        rows = rows.withColumns({"around_prev": none, "around_next": none})
    nil, here = F.lit(None).cast("string"), F.col("page_no").cast("int")
    link = lambda s, t, r, d=nil, p=None: F.struct(s.alias("source"), t.alias("target"), F.lit(r).alias("relation"), d.alias("direction"), (F.lit(None).cast("int") if p is None else p).alias("page_no"))
    me, node = F.col("kb_id"), lambda e: F.concat(F.lit("entity::"), e)
    of = lambda k: F.filter("entities", lambda e: T.entity_kind(e, lex) == k)
    some = lambda c, x: F.filter(F.array(x), lambda _: F.col(c).isNotNull())
    found = F.concat(
        F.transform("entities", lambda e: link(me, node(e), "mentions", p=here)),
        F.transform(of("alarm_code"), lambda e: link(node(e), me, "triggers", p=here)),
        F.transform(of("parameter"), lambda e: link(me, node(e), "depends_on", p=here)),
        some("n_", link(me, F.col("n_"), "adjacent")),
        some("p_", link(me, F.col("p_"), "same_page", p=here)),
        F.transform(F.coalesce("around_prev", none), lambda t: link(me, t, "related_context", F.lit("prev"))),
        F.transform(F.coalesce("around_next", none), lambda t: link(me, t, "related_context", F.lit("next"))),
    )
    return rows.select(F.inline(F.array_distinct(found)))


def nodes(kb: DataFrame, lex: Lexicon = DEFAULT) -> DataFrame:
    """id, node_type, entity_type of all rows and entities."""
    names = kb.select(F.explode("entities").alias("e")).distinct()
    nil = F.lit(None).cast("string")
    return kb.select(F.col("kb_id").alias("id"), F.lit("kb").alias("node_type"), nil.alias("entity_type")).union(names.select(F.concat(F.lit("entity::"), "e"), F.lit("entity"), T.entity_kind(F.col("e"), lex)))


def weight(relation: Column) -> Column:
    out = F.lit(0.25)
    for k, v in EDGE_WEIGHTS.items():
        out = F.when(relation == k, F.lit(v)).otherwise(out)
    return out


def adjacency(edge: DataFrame) -> DataFrame:
    """node, other, relation, weight under both ends that are knowledge rows."""
    both = edge.select(F.inline(F.array(F.struct(F.col("source").alias("node"), F.col("target").alias("other"), "relation"), F.struct(F.col("target").alias("node"), F.col("source").alias("other"), "relation"))))
    return both.where(~F.startswith("node", F.lit("entity::"))).select("node", "other", "relation", weight(F.col("relation")).alias("weight"))


FEW = 200_000  # ids that are sent to all tasks; more are joined


def among(rows: DataFrame, found: DataFrame, on: str = "id") -> DataFrame:
    """The rows whose `on` is an id of found (a written table). Few ids are sent to the rows, so that no other row is shuffled or worked out."""
    ids = found.select(F.col("id").alias(on)).distinct()
    return rows.join(F.broadcast(ids) if bounded(ids, FEW) else ids, on, "left_semi")


MOST = 64  # links of a node that are stored; a larger limit of a query is an error, not a shorter result


@dataclass
class Links:
    """Adjacency with its ranks: node, links (array of r, other, weight, relation), of each node the `most` heaviest; those to entities are ranked, not kept."""

    rows: DataFrame
    most: int


def ranked(adjacent: DataFrame, most: int = MOST) -> Links:
    """Ranks all links once. Each task first keeps the `most` heaviest of a node (a limit within groups that Spark puts before the
    exchange), so a hub sends at most so many links a task and its row holds at most `most`."""
    w = Window.partitionBy("node").orderBy(F.col("weight").desc(), "other", "relation")
    named = adjacent if "relation" in adjacent.columns else adjacent.withColumn("relation", F.lit(None).cast("string"))
    top = named.select("node", "other", "weight", "relation").withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    own = F.when(~F.startswith("other", F.lit("entity::")), F.struct("r", "other", "weight", "relation"))
    return Links(top.groupBy("node").agg(F.array_sort(F.collect_list(own)).alias("links")), most)


def stored(links: Links) -> Links:
    """The same as a table in the shared folder, bucketed by node: a hop shuffles the rows that it starts from, never the links."""
    spark = links.rows.sparkSession
    name = f"links_{uuid.uuid4().hex}"
    writer = links.rows.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/foliospark/{name}")
    writer.bucketBy(shuffle_partitions(spark), "node").sortBy("node").saveAsTable(name)
    return Links(spark.table(name), links.most)


def around(rows: DataFrame, found: DataFrame, lex: Lexicon = DEFAULT) -> Links:
    """The links of the documents that have one of the rows found (id; a written table). No link that a hop takes leaves a document, so from these rows
    the graph is gone through as if all links were made."""
    docs = among(rows.select("doc_id", F.col("kb_id").alias("id")), found).select(F.col("doc_id").alias("id"))
    return stored(ranked(adjacency(edges(among(rows, materialize(docs.distinct(), "documents"), "doc_id"), lex))))


def expand(links: Links, seeds: DataFrame, hops: int | Column = 1, max_expand: int | Column = 16) -> DataFrame:
    """query_id, id, score, distance, parent, relation from seeds (query_id, id, score, and for limits of each query: hops, max_expand):
    hop by hop, of each node the max_expand heaviest links (before entities are skipped), child = parent x weight; a
    node reached on two ways keeps its highest score (then the least parent and relation), the first hop wins; ties by id.
    parent and relation of the link that a node was reached by are null for seeds."""
    limits = seeds.select("query_id", (F.lit(hops) if isinstance(hops, int) else hops).alias("hops"), (F.lit(max_expand) if isinstance(max_expand, int) else max_expand).alias("most")).groupBy("query_id").agg(F.max("hops").alias("hops"), F.max("most").alias("most"), F.count(F.lit(1)).alias("n_"))
    limits = limits.withColumn("most", F.when(F.col("most") <= links.most, F.col("most")).when(F.col("most").isNotNull(), F.raise_error(F.lit(f"max_expand is above the {links.most} links of a node that are stored")).cast("int")))
    seen = seeds.groupBy("query_id", "id").agg(F.max("score").alias("score")).withColumns({"distance": F.lit(0), "parent": F.lit(None).cast(links.rows.schema["node"].dataType), "relation": F.lit(None).cast("string")})
    front = seen
    for hop in range(1, (hops if isinstance(hops, int) else 2) + 1):
        live = front.join(limits, "query_id").where(F.col("hops") >= hop)
        met = live.join(links.rows, live["id"] == links.rows["node"]).select("query_id", "score", F.col("node").alias("parent"), F.inline(F.filter("links", lambda x: x["r"] <= F.col("most"))).alias("r", "other", "weight", "relation"))
        step = met.select("query_id", F.col("other").alias("id"), F.struct((-F.col("score") * F.col("weight")).alias("less"), "parent", "relation").alias("by"))
        best = step.join(seen, ["query_id", "id"], "left_anti").groupBy("query_id", "id").agg(F.min("by").alias("by"))
        front = best.select("query_id", "id", (-F.col("by.less")).alias("score"), F.lit(hop).alias("distance"), "by.parent", "by.relation")
        seen = seen.union(front)
    best = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "id")
    return seen.withColumn("rank", F.row_number().over(best)).join(limits.select("query_id", F.greatest("n_", F.col("most").cast("long")).alias("n_")), "query_id").where("rank <= n_").drop("n_")


def with_neighbours(rows: DataFrame, kb: DataFrame, adjacent: DataFrame, before: int = 2, after: int = 3, most: int = 6) -> DataFrame:
    """rows (with id) and what lies around: context_ids by place, and of the `most` heaviest links those to other rows, as id:relation."""
    w = Window.partitionBy("doc_id").orderBy("pos", "part_no")
    near = lambda a, b: F.collect_list("kb_id").over(w.rowsBetween(a, b))
    placed = kb.select(F.col("kb_id").alias("id"), F.concat(near(-before, -1), near(1, after)).alias("context_ids"))
    asked = rows.select("id").distinct()
    r = Window.partitionBy("node").orderBy(F.col("weight").desc(), "other", "relation")
    links = adjacent.join(asked.withColumnRenamed("id", "node"), "node", "left_semi").withColumn("r", F.row_number().over(r)).where((F.col("r") <= most) & ~F.startswith("other", F.lit("entity::")))
    links = links.groupBy(F.col("node").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "other", "relation"))), lambda x: F.concat(x["other"], F.lit(":"), x["relation"])).alias("graph_neighbours"))
    return rows.join(placed, "id").join(links, "id", "left").withColumn("graph_neighbours", F.coalesce("graph_neighbours", F.array().cast("array<string>")))
