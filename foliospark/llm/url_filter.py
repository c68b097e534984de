"""URL filters by gradient-boosted trees on lexical features, with DataFrame functions only.

Features of a url: lengths, depth of the path, labels of the host, share of digits,
entropy of its characters, parameters, hyphens, and how often urls with its suffix
(last label of the host; its last two labels; file extension) or its first part of the path
are blocked among the labelled ones. Values are put into at most `bins` bins by quantiles of the labelled urls.

Trees are grown level by level: for each leaf, feature and bin one distributed
aggregation over all labelled urls sums gradient and curvature of the logistic
loss; the driver sees these sums only (leaves x features x bins rows), picks the
best splits and takes the values of the leaves from the sums of the last level. While trees
grow, they are literals of one and the same expression, so that Spark compiles it once. The
finished model is a Column expression of its own, so scoring is part of the scan.

Rules (host, path, verdict) label urls and always win where they fit: a rule fits its
host and all subdomains if the path starts with the rule's; the longest one counts.

Cases: a null url or one without :// has empty host and path, all features zero and
no rule; without labelled urls of both verdicts the model says the only verdict
there is, else `allow`; repeated rows count and are judged each; an empty table gives
an empty result; other columns are neither read nor kept.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.runtime import materialize

Rule = tuple[str, str, str]
NUMERIC = ("url_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens")
SUFFIXES = ("tld", "site", "segment", "extension")
FEATURES = (*NUMERIC, *(f"{s}_rate" for s in SUFFIXES))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    df = df.withColumn("rest_", F.coalesce(rest, F.lit("")))
    return (
        df.withColumn("host", ascii_lower(F.regexp_extract("rest_", "^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract("rest_", "^[^/?#]*([^?#]*)", 1))
        .withColumn("query_", F.regexp_extract("rest_", r"^[^?#]*\?([^#]*)", 1))
        .drop("rest_")
    )


def rule_of(rules: list[Rule]) -> tuple[Column, Column]:
    """(the rule that wins, as host and path; its verdict), null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def features(df: DataFrame) -> DataFrame:
    whole = F.concat("host", "path", "query_")
    n = F.length(whole)
    # Shannon entropy: each distinct character with how often it occurs.
    df = df.withColumn("whole_", whole)
    chars = F.filter(F.split("whole_", ""), lambda c: c != "")
    count = lambda c: (F.length("whole_") - F.length(F.replace(F.col("whole_"), c, F.lit("")))).cast("double")
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - count(c) / F.length("whole_") * F.log2(count(c) / F.length("whole_")))
    digits = n - F.length(F.regexp_replace(whole, "[0-9]", ""))
    return (
        df.withColumn("url_length", n.cast("double"))
        .withColumn("path_length", F.length("path").cast("double"))
        .withColumn("depth", F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"))
        .withColumn("labels", F.size(F.filter(F.split("host", r"\."), lambda x: x != "")).cast("double"))
        .withColumn("digit_ratio", F.when(n > 0, digits / n).otherwise(0.0))
        .withColumn("entropy", entropy)
        .withColumn("parameters", F.size(F.filter(F.split("query_", "&"), lambda x: x != "")).cast("double"))
        .withColumn("hyphens", (F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"), F.lit("")))).cast("double"))
        .withColumn("tld", F.substring_index("host", ".", -1))
        .withColumn("site", F.substring_index("host", ".", -2))
        .withColumn("segment", F.regexp_extract("path", "^/([^/]*)", 1))
        .withColumn("extension", F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1))
        .drop("whole_", "query_")
    )


FOLDS = 5


def fold_of() -> Column:
    return F.pmod(F.xxhash64("host", "path"), F.lit(FOLDS)).cast("int")


def suffix_rates(labelled: DataFrame, suffix: str, weight: float = 20.0) -> DataFrame:
    """suffix, fold, rate: the share of blocked urls, drawn towards one half where there are few. Of each fold: that of the other
    folds' urls, so that a url's own label isn't in its feature; fold -1: that of all."""
    each = labelled.groupBy(suffix, fold_of().alias("fold")).agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    every = each.groupBy(suffix).agg(F.sum("s").alias("s_all"), F.sum("n").alias("n_all"))
    folds = labelled.sparkSession.range(-1, FOLDS).select(F.col("id").cast("int").alias("fold"))
    rows = every.crossJoin(F.broadcast(folds)).join(each, [suffix, "fold"], "left")
    s, n = (F.col(f"{c}_all") - F.coalesce(c, F.lit(0)) for c in ("s", "n"))
    return rows.select(suffix, "fold", ((s + weight / 2) / (n + weight)).alias(f"{suffix}_rate"))


def with_rates(df: DataFrame, rates: list[tuple[str, DataFrame]]) -> DataFrame:
    """df (with `said`: its label, if any) and its suffixes' rates; of a labelled url without its own fold."""
    df = df.withColumn("fold", F.when(F.col("said").isNotNull(), fold_of()).otherwise(-1))
    for suffix, table in rates:
        df = df.join(table, [suffix, "fold"], "left").withColumn(f"{suffix}_rate", F.coalesce(f"{suffix}_rate", F.lit(0.5)))
    return df.drop("fold")


class Trees:
    """Boosted trees over binned features (columns b0, b1, ...)."""

    def __init__(self, cuts: list[list[float]], prior: float):
        self.cuts, self.prior, self.trees = cuts, prior, []

    def bin(self, i: int) -> Column:
        """How many cuts lie below the value."""
        c = self.cuts[i]
        return F.size(F.filter(F.array(*map(F.lit, c)), lambda x: x < F.col(FEATURES[i]))) if c else F.lit(0)

    @staticmethod
    def leaf(splits: dict[int, tuple[int, int]], node: int = 1) -> Column:
        """Number of the leaf that a row gets to; splits: node -> (feature, highest bin to the left)."""
        if node not in splits:
            return F.lit(node)
        f, b = splits[node]
        return F.when(F.col(f"b{f}") <= b, Trees.leaf(splits, 2 * node)).otherwise(Trees.leaf(splits, 2 * node + 1))

    @staticmethod
    def value(splits: dict, values: dict[int, float], node: int = 1) -> Column:
        if node not in splits:
            return F.lit(float(values.get(node, 0.0)))
        f, b = splits[node]
        return F.when(F.col(f"b{f}") <= b, Trees.value(splits, values, 2 * node)).otherwise(Trees.value(splits, values, 2 * node + 1))

    def margin(self) -> Column:
        out = F.lit(self.prior)
        for splits, values in self.trees:
            out = out + self.value(splits, values)
        return out

    def score(self, df: DataFrame) -> DataFrame:
        """df with the columns b0.. and `p`, the chance of `block`."""
        df = df.select("*", *(self.bin(i).alias(f"b{i}") for i in range(len(FEATURES))))
        return df.withColumn("p", 1 / (1 + F.exp(-self.margin()))).drop(*(f"b{i}" for i in range(len(FEATURES))))


Sums = list[tuple[int, float, float]]  # bin, gradient, curvature


def _best(rows: Sums, decay: float) -> tuple[float, int] | None:
    """(gain, highest bin to the left) of the best split of one leaf by one feature."""
    rows = sorted(rows)
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    left_g = left_h = 0.0
    best = None
    for b, x, y in rows[:-1]:
        left_g, left_h = left_g + x, left_h + y
        gain = left_g**2 / (left_h + decay) + (g - left_g) ** 2 / (h - left_h + decay) - g**2 / (h + decay)
        gain = round(gain, 6)
        if gain > 1e-6 and (best is None or gain > best[0]):
            best = gain, b
    return best


def _total(rows: Sums) -> tuple[float, float]:
    return sum(r[1] for r in rows), sum(r[2] for r in rows)


def _table(splits: dict[int, tuple[int, int]], values: dict[int, float], nodes: int) -> dict[str, list]:
    """A tree as lists: for each node its feature (-1: none), its highest bin to the left and its value."""
    f, b = ([splits.get(i, (-1, 0))[j] for i in range(nodes)] for j in (0, 1))
    return {"f": f, "b": b, "v": [float(values.get(i, 0.0)) for i in range(nodes)]}


def _literal(tables: list[dict[str, list]]) -> Column:
    """Trees as one literal, which Spark folds before it compiles the query."""
    return F.from_json(F.lit(json.dumps(tables)), "array<struct<f: array<int>, b: array<int>, v: array<double>>>")


def _node(tree: Column, depth: int) -> Column:
    """The node of a tree (of _table) that a row with the bins `bins` gets to."""
    right = lambda node: (F.get("bins", F.get(tree["f"], node)) > F.get(tree["b"], node)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), lambda node, _: F.when(F.get(tree["f"], node) < 0, node).otherwise(2 * node + right(node)))


def fit(labelled: DataFrame, trees: int = 16, depth: int = 3, bins: int = 16, rate: float = 0.4, decay: float = 1.0) -> Trees:
    """From rows with the features and y (1: block), all of which are used."""
    names = [*(F.percentile_approx(f, [i / bins for i in range(1, bins)], 10_000).alias(f) for f in FEATURES)]
    stats = labelled.agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("s"), *names).first()
    n, s = stats["n"], stats["s"]
    if s in (0, n):
        return Trees([[] for _ in FEATURES], math.inf if n and s else -math.inf)
    model = Trees([sorted(set(stats[f])) for f in FEATURES], math.log(s / (n - s)))
    binned = labelled.select("y", F.array(*(model.bin(i) for i in range(len(FEATURES)))).alias("bins")).groupBy("y", "bins").agg(F.count(F.lit(1)).alias("w"))
    binned = materialize(binned, "binned-urls")
    nodes = 2 << depth
    grown = [_table({}, {}, nodes)] * trees  # trees to come add nothing
    for t in range(trees):
        splits: dict[int, tuple[int, int]] = {}
        leaves: dict[int, tuple[float, float]] = {}
        margin = F.aggregate(_literal(grown), F.lit(model.prior), lambda m, tree: m + F.get(tree["v"], _node(tree, depth)))
        scored = binned.withColumn("p", 1 / (1 + F.exp(-margin)))
        for level in range(depth):
            leaf = _node(F.get(_literal([_table(splits, {}, nodes)]), F.lit(0)), depth)
            rows = scored.select(leaf.alias("leaf"), ((F.col("y") - F.col("p")) * F.col("w")).alias("g"), (F.col("p") * (1 - F.col("p")) * F.col("w")).alias("h"), F.posexplode("bins").alias("feature", "bin"))
            found: dict[int, dict[int, Sums]] = {}
            for r in rows.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                found.setdefault(r["leaf"], {}).setdefault(r["feature"], []).append((r["bin"], r["g"], r["h"]))
            parted = False
            for leaf, by_feature in sorted(found.items()):
                leaves[leaf] = _total(sorted(by_feature[0]))
                tried = [(got[0], -f, got[1]) for f, x in by_feature.items() if (got := _best(x, decay))] if leaf >= 1 << level else []
                if tried:
                    _, f, b = max(tried)
                    splits[leaf], parted = (-f, b), True
                    sides = sorted(by_feature[-f])
                    leaves[2 * leaf], leaves[2 * leaf + 1] = _total([x for x in sides if x[0] <= b]), _total([x for x in sides if x[0] > b])
            if not parted:
                break
        if not splits:
            return model
        values = {k: round(rate * g / (h + decay), 9) for k, (g, h) in leaves.items() if k not in splits}
        model.trees.append((splits, values))
        grown[t] = _table(splits, values, nodes)
    return model


def judged(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, said (its verdict) and features of every row."""
    name, said = rule_of(rules)
    pages = split_url(df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url")))
    return features(pages).withColumn("rule", name).withColumn("said", said).drop("url")


def learned(rows: DataFrame, trees: int, depth: int) -> tuple[Trees, list[tuple[str, DataFrame]]]:
    """The model and the suffixes' rates, from the rows with a label."""
    labelled = rows.where("said is not null").withColumn("y", (F.col("said") == "block").cast("int"))
    rates = [(s, materialize(suffix_rates(labelled, s), f"rates-{s}")) for s in SUFFIXES]
    return fit(with_rates(labelled, rates), trees, depth), rates


def held_out(df: DataFrame, rules: list[Rule], trees: int = 16, depth: int = 3, threshold: float = 0.5, **columns: str) -> DataFrame:
    """n, accuracy, block_recall, block_precision over one labelled url in five, by a model that learned from the others."""
    rows = judged(df, rules, **columns)
    out = F.pmod(F.xxhash64("path", "host"), F.lit(5)) == 0
    model, rates = learned(rows.where(~out), trees, depth)
    test = model.score(with_rates(rows.where(out & F.col("said").isNotNull()).withColumnRenamed("said", "true_").withColumn("said", F.lit(None).cast("string")), rates))
    hit, block = (F.col("p") >= threshold) == (F.col("true_") == "block"), F.col("true_") == "block"
    share = lambda c, on: F.avg(F.when(on, c.cast("double")))
    return test.agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("accuracy"), share(hit, block).alias("block_recall"), share(block, F.col("p") >= threshold).alias("block_precision"))


def url_filter(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", trees: int = 16, depth: int = 3, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block of every row; the model learns from the urls that a rule fits."""
    rows = judged(df, rules, id_col, url_col)
    model, rates = learned(rows, trees, depth)
    scored = model.score(with_rates(rows, rates))
    verdict = F.coalesce("said", F.when(F.col("p") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("p").alias("p_block"))
