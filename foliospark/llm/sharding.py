"""Resharding by minimum-cost flow: shards get equal bytes, and the fewest bytes move.

The driver sees sizes only: the old shards' bytes and the new capacities (a row a shard). Between them it solves a minimum-cost
flow, where a byte that stays costs nothing and a byte that moves costs one (or what `cost` says). Each old shard's rows are put in one order,
large ones first, and cut where the flow says, so that
the cuts fall between small ones; what a block on a cut gives too much is moved by a further flow, up to ROUNDS in all, until sizes are equal to a thousandth. A block is all rows of one text: equal texts go together, but a text
that holds over 1/PARTS of a shard's share (of bytes or of rows) is split by the hash of doc_id into blocks of about that size.

Nothing is gathered: running sums over the blocks and the slots in each shard come from ordered scans (ordered_scan.prefix_sums).
`reshard_table` does this for a table kept in folders by shard and rewrites only the folders that lose rows and appends to those that gain.

Cases: a null text has size 1, as the empty one, and both count as the same text; repeated rows get a slot each; a text longer than a shard's share makes its shard as much larger;
null ids are placed like any other; an empty table gives no rows; columns not named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.columns import private
from foliospark.llm.ordered_scan import prefix_sums
from foliospark.runtime import materialize

SHARDS = 8
OLD = 6
PARTS = 8
ROUNDS = 3


def flow(supply: list[int], capacity: list[int], cost: list[list[int]] | None = None) -> list[list[int]]:
    """How many units each source sends to each sink at the least cost; all supply is sent, so capacity must hold it.

    Successive shortest paths. cost[i][j] is not negative; by default 0 where i = j and 1 elsewhere.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities don't hold what there is")
    n, m = len(supply), len(capacity)
    cost = cost or [[int(i != j) for j in range(m)] for i in range(n)]
    sent = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Cheapest paths from all sources with supply to sinks: forward along i -> j, back along j -> i where units flow.
        far = float("inf")
        at_i, at_j = [0 if x else far for x in left], [far] * m
        from_j, from_i = [-1] * n, [-1] * m
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if at_i[i] + cost[i][j] < at_j[j]:
                        at_j[j], from_i[j], changed = at_i[i] + cost[i][j], i, True
                    if sent[i][j] and at_j[j] - cost[i][j] < at_i[i]:
                        at_i[i], from_j[i], changed = at_j[j] - cost[i][j], j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: at_j[j])
        path, j = [], end
        while True:
            i = from_i[j]
            path.append((i, j))
            if from_j[i] < 0:
                break
            j = from_j[i]
        back = [(path[k][0], path[k + 1][1]) for k in range(len(path) - 1)]
        amount = min([left[path[-1][0]], room[end], *(sent[i][j] for i, j in back)])
        for i, j in path:
            sent[i][j] += amount
        for i, j in back:
            sent[i][j] -= amount
        left[path[-1][0]] -= amount
        room[end] -= amount
    return sent


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def _target(old: str, at: str, sent: list[list[int]]) -> Column:
    """The new shard of a block of shard `old` that begins `at` so many bytes: first what stays, then the transfers."""
    out = F.lit(None).cast("int")
    for i, row in enumerate(sent):
        order = sorted((j for j in range(len(row)) if row[j]), key=lambda j: (j != i, j)) or [0]
        to, cut = F.lit(order[-1]), sum(row)
        for j in reversed(order):
            # Cuts from the last to the first, so that the earliest interval is asked first.
            to = F.when(F.col(at) < cut, F.lit(j)).otherwise(to)
            cut -= row[j]
        out = F.when(F.col(old) == i, to).otherwise(out)
    return out


def placed(rows: DataFrame, n_old: int, shards: int) -> DataFrame:
    """rows: id, size, text_hash, and old (shard of 0 to n_old - 1, or null: dealt by hash). Adds block, part, old, shard."""
    total = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not total[1]:
        return rows.withColumns({"part": F.lit(0), "shard": F.lit(0)})
    most, most_rows = max(1, total[0] // (shards * PARTS)), max(1, total[1] // (shards * PARTS))
    same = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    parts = F.greatest(F.ceil(F.col("bytes") / most), F.ceil(F.col("rows") / most_rows)).cast("int")
    # At most twice shards * PARTS texts can be over their share, and a text of one row can't be split: a bounded broadcast.
    large = same.where((F.col("rows") > 1) & ((F.col("bytes") > most) | (F.col("rows") > most_rows))).select("text_hash", F.least(parts, F.col("rows")).cast("int").alias("parts"))
    cut = rows.join(F.broadcast(large), "text_hash", "left").withColumn("part", F.coalesce(F.expr("pmod(xxhash64(id, 'part'), parts)"), F.lit(0)).cast("int")).drop("parts")
    cut = cut.withColumn("old", F.coalesce("old", F.expr(f"pmod(xxhash64(text_hash, part), {n_old})")).cast("int"))
    blocks = cut.groupBy("old", "text_hash", "part").agg(F.sum("size").alias("bytes"))
    blocks = materialize(blocks.withColumns({"now": F.col("old"), "kept": F.lit(True)}), "blocks")
    for again in range(ROUNDS):
        sizes = {r["now"]: r["bytes"] for r in blocks.groupBy("now").agg(F.sum("bytes").alias("bytes")).collect()}
        supply = [sizes.get(i, 0) for i in range(max(n_old, shards))]
        goal = equal_capacities(sum(supply), shards)
        if all(abs(x - y) <= y / 1000 for x, y in zip(supply, [*goal, *[0] * n_old], strict=False)):
            break
        sent = flow(supply, goal)
        starts = F.array(*(F.lit(sum(supply[:i])).cast("long") for i in range(len(supply))))
        # At first only large blocks are put in order, so that each shard keeps small ones for the rounds to come.
        down = -F.col("bytes") if again else F.when(F.col("bytes") > min(goal) // 100, -F.col("bytes")).otherwise(0)
        ranged = prefix_sums(blocks.withColumn("down", down), ["now", "down", "text_hash", "part"], {"at": "bytes"}, "kept", "cuts")
        ranged = ranged.withColumn("at", F.col("at") - F.element_at(starts, F.col("now") + 1))
        blocks = materialize(ranged.withColumn("now", _target("now", "at", sent)).drop("at", "down"), "blocks")
    return cut.join(blocks.select("old", "text_hash", "part", F.col("now").alias("shard")), ["old", "text_hash", "part"])


def slots(df: DataFrame) -> DataFrame:
    """df (with shard, id) with `slot`: a number in the shard from 0 on without gaps, in the order of id."""
    df = materialize(df.withColumns({"one": F.lit(1), "kept": F.lit(True)}), "placed")
    n = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    starts = [sum(c for s, c in n.items() if s < k) for k in range(max(n, default=0) + 1)]
    out = prefix_sums(df, ["shard", "id"], {"slot": "one"}, "kept", "slots")
    return out.withColumn("slot", F.col("slot") - F.element_at(F.array(*(F.lit(x).cast("long") for x in starts)), F.col("shard") + 1)).drop("one", "kept")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size (UTF-8 bytes of the text and 1), text_crc32, text_hash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, n_old: int = OLD) -> DataFrame:
    """id, size, text_crc32, old, shard, slot: rows of n_old shards by the hash of their text, moved to `shards` of equal bytes."""
    # The texts are read once; all else works on this table of a few longs a row.
    return slots(placed(materialize(sized(docs), "sized").withColumn("old", F.lit(None).cast("int")), n_old, shards)).select("id", "size", "text_crc32", "old", "shard", "slot")


def reshard_table(spark: SparkSession, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> dict[str, list[int]]:
    """Moves rows of the Parquet table at `path` (folders shard=0, shard=1, ...) until its first `shards` shards are equal in bytes.

    Folders that lose rows are written again, those that gain get new files, all others stay as they are. Returns which shards lost and gained.
    Rows that move or are written again are staged first, so a job that fails before the last two writes leaves the table as it was.
    """
    table = spark.read.parquet(path)
    (row_at,) = private(table, "row_at")
    # Rows are told apart by their place in the stage, ids may repeat.
    staged = materialize(table.withColumn(row_at, F.monotonically_increasing_id()), "reshard")
    n_old = (staged.agg(F.max("shard")).first()[0] or 0) + 1
    rows = sized(staged, row_at, text_col).join(staged.select(F.col(row_at).alias("id"), F.col("shard").cast("int").alias("old")), "id")
    new = materialize(placed(rows, n_old, shards).select(F.col("id").alias(row_at), F.col("shard").alias("to")), "reshard")
    both = staged.join(new, row_at).drop(row_at)
    moves = both.where("shard <> to").groupBy("shard", "to").count().collect()
    lost, gained = sorted({r["shard"] for r in moves}), sorted({r["to"] for r in moves})
    # Only gains: new files beside those that are there. Losses: the folder as it should be.
    columns = [c for c in table.columns if c != "shard"]
    result = materialize(both.where(F.col("to").isin(lost) | ((F.col("shard") != F.col("to")) & F.col("to").isin(gained))).select(*columns, F.col("to").alias("shard")), "reshard") if moves else None
    if result is not None:
        result.where(~F.col("shard").isin(lost)).write.mode("append").partitionBy("shard").parquet(path)
        result.where(F.col("shard").isin(lost)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
        for shard in range(shards, n_old):  # nothing is left of these, and an overwrite doesn't see them
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return {"lost": lost, "gained": gained}
