"""Point-in-time features by a dyadic tree over the moments at which they are asked.

Every sale asks at its own moment t. What happened to a client (a click, a sale, a line of a sale) is
active for the moments t of an interval [from, to): from the time at which it had happened and was known, to the end of
the window. The client's probes are put in order (client, t), so a probe is a rank, an interval is a range of ranks, and a time tree over
ranks has as many levels as the client has probes, whatever the resolution of the clock.

1. Two global sorts merge events with probes and count the probes before each end of each interval
   (ordered_scan.prefix_sums; probes moved by each window's length give all ends in one pass).
2. Each range of ranks is split into its canonical nodes; events are summed per node and window, in the map tasks first.
   Nodes over 2**TOP probes are handed down to their parts of that size after the sums, so no key is hot.
3. Items are distinct over nodes: before the split, an item's ranges are cut where an earlier one of the
   same item already holds (ordered_scan.running_max), so that a node counts no item twice and no probe meets it twice.
4. Probes are exploded to their ancestors, joined by node, and summed.

Nothing but one row a partition reaches the driver. Cases: rows without a client or time ask nothing and count nowhere; without an arrival, a row
is never known (but a sale still counts for labels); a line without shipped_at or a sale never counts;
null numbers are 0 cents; a null item is no item; a null click_id is never the last; a null sale_id adds no seconds to its time; a click counts
once if all its columns are equal; repeated sales ask and count each by itself, repeated lines count each; tied times are told apart by the
larger click_id; an empty table of sales gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.ordered_scan import prefix_sums, running_max
from foliospark.runtime import materialize

MINUTE = 60_000_000
DAY = 1440 * MINUTE
TOP = 12
FEATURES = ["n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents"]
CLICK, SALE, LINE, PROBE = 0, 1, 2, 3
# A time and a click_id as one decimal, so that the latest click is a maximum that hash aggregation can hold.
_TIMES, _PLUS = 10**20, 1 << 63


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a column of times, without a zone or with one."""
    c = F.col(f"`{name}`")
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    at = F.hour(c) * 3600 + F.minute(c) * 60
    return F.unix_date(c.cast("date")).cast("long") * DAY + at.cast("long") * 1_000_000 + (F.expr(f"extract(SECOND FROM `{name}`)") * 1_000_000).cast("long")


def cents(name: str) -> Column:
    return F.coalesce(F.floor(100 * F.col(f"`{name}`").cast("double") + 0.5), F.lit(0)).cast("long")


def probes_of(sales: DataFrame, spread: int = 259200) -> DataFrame:
    """sale_id, client, sold, known, cents, t: the sales that ask, with their moment t in microseconds."""
    moved = F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % spread, F.lit(0)) * 1_000_000
    out = sales.select("sale_id", F.col("client_id").cast("long").alias("client"), micros(sales, "sold_at").alias("sold"), micros(sales, "arrived_at").alias("arrived"), cents("total").alias("cents"))
    return out.where("client is not null and sold is not null").withColumn("t", F.col("sold") + moved)


def nodes_of(ranges: DataFrame) -> DataFrame:
    """Each row with lo < hi once for each canonical node (level, node) of [lo, hi)."""
    at = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.floor(F.log2(F.col("hi") - F.col("lo"))).cast("int") + 1)))
    at = at.withColumns({"l": F.expr("shiftright(lo + shiftleft(1L, level) - 1, level)"), "r": F.expr("shiftright(hi, level)")}).where("l < r")
    ends = F.array(F.when(F.col("l") % 2 == 1, F.col("l")), F.when(F.col("r") % 2 == 1, F.col("r") - 1))
    return at.withColumn("node", F.explode(ends)).where("node is not null").drop("l", "r", "lo", "hi")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("level", "node", "d").agg(*(F.sum(c).alias(c) for c in [*FEATURES, "n_later"]), F.max("last").alias("last"))


def point_in_time(sales: DataFrame, clicks: DataFrame, lines: DataFrame, windows: tuple[int, ...] = (2, 14), ahead: int = 7, known_after: int = 240) -> DataFrame:
    """For each sale that asks and each window (days): sale_id, d, t_us, label, FEATURES, last_click_id.

    ahead: days in which a further sale makes the label true. known_after: minutes from a row's arrival until it is known.
    """
    asked = probes_of(sales)
    wait = known_after * MINUTE
    longest = max(windows)
    hi = [f"hi{d}" for d in windows]

    # First order: by what happened when. Probes stand at t and, moved, at t - d and t + ahead.
    zero = F.lit(0).cast("long")
    seen = clicks.select("click_id", micros(clicks, "ts").alias("x"), micros(clicks, "arrived_at").alias("arrived"), F.col("client_id").cast("long").alias("client"), "kind", "value", "props")
    seen = seen.where("client is not null and x is not null and arrived is not null").distinct()
    events = seen.select("client", "x", F.lit(CLICK).alias("kind"), F.col("click_id").cast("long").alias("id"), (F.col("arrived") + wait).alias("known"), F.coalesce((F.col("kind") == "purchase").cast("long"), zero).alias("n"), cents("value").alias("cents"))
    events = events.where(F.col("known") < F.col("x") + longest * DAY)
    events = events.unionByName(asked.select("client", F.col("sold").alias("x"), F.lit(SALE).alias("kind"), F.col("sale_id").cast("long").alias("id"), (F.col("arrived") + wait).alias("known"), F.lit(1).cast("long").alias("n"), "cents"))
    moves = F.array(zero, *(F.lit(-d * DAY) for d in windows), F.lit(ahead * DAY))
    probes = asked.select("client", "t", F.col("sale_id").cast("long").alias("id"), F.posexplode(moves).alias("move", "by"))
    probes = probes.select("client", (F.col("t") + F.col("by")).alias("x"), F.lit(PROBE).alias("kind"), "id", F.col("t").alias("known"), zero.alias("n"), zero.alias("cents"), "move")
    names = ["at", *hi, "lab"]
    both = events.withColumn("move", F.lit(-1)).unionByName(probes)
    both = both.withColumns({f"is_{n}": (F.col("move") == i).cast("int") for i, n in enumerate(names)}).withColumn("kept", F.col("move") <= 0)
    ordered = prefix_sums(both, ["client", "x", "kind", "id"], {n: f"is_{n}" for n in names}, "kept", "when")
    ordered = ordered.select("client", "x", "kind", "id", "known", "n", "cents", *names)

    # Second order: by when it was known. Lines come in with their sale's ends.
    own = ordered.where(F.col("kind") == SALE)
    sent = lines.select("sale_id", "item_id", micros(lines, "shipped_at").alias("shipped"), cents("amount").alias("cents")).where("sale_id is not null and shipped is not null")
    sent = sent.groupBy(F.col("sale_id").cast("long").alias("id"), F.col("item_id").cast("long").alias("item"), "shipped").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    sold = own.where("known is not null").select("client", "id", "x", "known", *hi)
    shipped = sent.join(sold, "id").select("client", F.greatest("known", "x", "shipped").alias("from"), F.lit(LINE).alias("kind"), F.col("item").alias("id"), "x", "n", "cents", *hi)
    active = ordered.where((F.col("kind") != PROBE) & F.col("known").isNotNull() & (F.col("at") < F.col(f"hi{longest}")))
    active = active.select("client", F.greatest("known", "x").alias("from"), "kind", "id", "x", "n", "cents", *hi).unionByName(shipped).where(F.col("from") < F.col("x") + longest * DAY)
    asks = ordered.where(F.col("kind") == PROBE)
    marks = asks.select("client", F.col("known").alias("from"), "kind", "id", F.col("known").alias("x"), "n", "cents", *(zero.alias(h) for h in hi))
    known = active.unionByName(marks).withColumn("kept", F.col("kind") != PROBE).withColumn("is_probe", (F.col("kind") == PROBE).cast("int"))
    known = prefix_sums(known, ["client", "from", "kind", "id"], {"lo": "is_probe"}, "kept", "known")

    # Ranges of ranks, one for each window that some probe falls into.
    ends = F.array(*(F.struct(F.lit(d).alias("d"), F.col(h).alias("hi")) for d, h in zip(windows, hi, strict=True)))
    ranges = known.withColumn("end", F.explode(ends)).select("kind", "id", "x", "n", "cents", "lo", "end.*").where("lo < hi")
    of = {k: F.col("kind") == k for k in (CLICK, SALE, LINE)}
    amount = {"n_clicks": of[CLICK].cast("long"), "n_purchases": F.when(of[CLICK], F.col("n")), "click_cents": F.when(of[CLICK], F.col("cents")), "n_sales": of[SALE].cast("long"), "sale_cents": F.when(of[SALE], F.col("cents")), "n_lines": F.when(of[LINE], F.col("n")), "line_cents": F.when(of[LINE], F.col("cents"))}
    last = F.when(of[CLICK], F.expr(f"cast(cast(x as decimal(17,0)) * {_TIMES}BD + (cast(id as decimal(20,0)) + {_PLUS}BD) as decimal(38,0))"))
    none = {"n_items": zero, "n_later": zero}
    counted = ranges.select("d", "lo", "hi", *(F.coalesce(amount.get(f, none.get(f)), zero).alias(f) for f in [*FEATURES, "n_later"]), last.alias("last"))
    # Items: only the part of a range that no earlier range of the item covers.
    of_items = ranges.where(of[LINE] & F.col("id").isNotNull()).select("id", F.col("d").cast("long").alias("d"), "lo", "hi")
    of_items = running_max(of_items, ["id", "d"], "lo", "hi", "to", "items").withColumn("lo", F.greatest("lo", F.coalesce("to", zero)))

    def only(df: DataFrame, name: str) -> DataFrame:
        return df.where("lo < hi").select(F.col("d").cast("int").alias("d"), "lo", "hi", *(F.lit(int(f == name)).cast("long").alias(f) for f in [*FEATURES, "n_later"]), F.lit(None).cast("decimal(38,0)").alias("last"))

    later = only(own.select(F.lit(windows[0]).alias("d"), F.col("lab").alias("lo"), F.col("at").alias("hi")), "n_later")
    nodes = materialize(summed(nodes_of(reduce(DataFrame.unionByName, [counted, only(of_items, "n_items"), later]))), "nodes")
    parts = nodes.where(f"level > {TOP}").withColumn("node", F.explode(F.expr(f"sequence(shiftleft(node, level - {TOP}), shiftleft(node + 1, level - {TOP}) - 1)"))).withColumn("level", F.lit(TOP))
    nodes = nodes.where(f"level < {TOP}").unionByName(summed(nodes.where(f"level = {TOP}").unionByName(parts)))

    # Probes meet their ancestors, no higher than their client's number of probes reaches.
    many = materialize(asks.groupBy("client").count().where("count > 1"), "probes")
    up = asks.select("client", F.col("at").alias("rank")).join(many, "client", "left")
    level = F.least(F.floor(F.log2(F.coalesce("count", F.lit(1)))).cast("int") + 1, F.lit(TOP))
    up = up.select("rank", F.explode(F.sequence(F.lit(0), level)).alias("level")).withColumn("node", F.expr("shiftright(rank, level)"))
    met = up.join(nodes, ["level", "node"])
    found = met.groupBy("rank").agg(
        *(F.sum(F.when(F.col("d") == d, F.col(f))).alias(f"{f}_{d}") for d in windows for f in FEATURES),
        *(F.max(F.when(F.col("d") == d, F.col("last"))).alias(f"last_{d}") for d in windows),
        F.sum("n_later").alias("n_later"),
    )
    out = asks.select(F.col("id").alias("sale_id"), F.col("known").alias("t_us"), F.col("at").alias("rank")).join(found, "rank", "left")
    click = lambda d: F.expr(f"cast(last_{d} % {_TIMES}BD - {_PLUS}BD as long)")
    each = F.array(*(F.struct(F.lit(d).cast("int").alias("d"), *(F.coalesce(F.col(f"{f}_{d}"), zero).alias(f) for f in FEATURES), click(d).alias("last_click_id")) for d in windows))
    out = out.select("sale_id", "t_us", (F.coalesce("n_later", zero) > 0).alias("label"), F.explode(each).alias("x"))
    return out.select("sale_id", "x.d", "t_us", "label", *(f"x.{f}" for f in FEATURES), "x.last_click_id")
