"""Sharding by k-d tree partitioning (DataFrame operations only).

The documents are points in a space of metadata (length, source, language, id);
their weight is their size in bytes.  A node that has to give m leaves is split
along its widest dimension at the weighted quantile floor(m/2) / m (the weighted
median where m is even), until each leaf holds about the target bytes.

All nodes of a level are split together.  A split point is found by narrowing:
each pass sums the weights over equal slices of every node's current key range
(at most nodes x SLICES partial sums), and the range shrinks to the smallest and
largest key of the slice that the quantile falls in, until a single key is left.
A key is the coordinate followed by bits of a row hash, so ties in a coordinate
(a source that holds a third of all rows) are split as well.  The tree has one
entry per shard; only it and each pass's chosen slices reach the driver.

Each leaf's slots are numbered by counts over hash slices of the leaf, then
within each slice, so no task holds a whole shard.

Defined cases: null text has no bytes and crc 0; null source, language or id
share a coordinate of their own; repeated rows are placed one by one; an empty
table gives an empty result; with fewer distinct rows than shards some shards
stay empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_key, stage, table

SHARDS = 40
OVERHEAD = 16                  # bytes of a document besides its text
SLICES = 4096                  # of a key range in one pass
SLOT_SLICES = 1024             # of a shard, for its slot numbers
TIE_BITS = 31
DIMENSIONS = ("by_length", "by_source", "by_lang", "by_id")


def points(docs: DataFrame) -> DataFrame:
    """(id, size, crc, _row, hash and a key for each dimension)."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = row_key(docs).select(
        "id", (F.octet_length(data) + OVERHEAD).cast("long").alias("size"), F.crc32(data).alias("crc"),
        F.monotonically_increasing_id().alias("_row"), "source", "lang", "key")

    def spread(c: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(c), F.lit(1 << 20)) / F.lit(float(1 << 20)), F.lit(0.0))
    rows = stage(rows.select("id", "size", "crc", "_row", F.log("size").alias("by_length"), spread("source").alias("by_source"),
                             spread("lang").alias("by_lang"), F.coalesce(F.col("id").cast("double"), F.lit(0.0)).alias("by_id"),
                             F.xxhash64("id", "key", "_row").alias("hash")), "points")
    span = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in DIMENSIONS for f in (F.min, F.max)]).first()
    low = {c: span[f"min_{c}"] or 0.0 for c in DIMENSIONS}
    width = {c: ((span[f"max_{c}"] or 0.0) - low[c]) or 1.0 for c in DIMENSIONS}
    # key: the coordinate, then hash bits, as one sortable number
    tie = F.shiftrightunsigned(F.col("hash"), 64 - TIE_BITS)
    keys = {_key(c): F.shiftleft(F.floor((F.col(c) - F.lit(low[c])) / F.lit(width[c]) * F.lit(float((1 << 30) - 1)))
                                 .cast("long"), TIE_BITS) + tie for c in DIMENSIONS}
    return stage(rows.withColumns(keys).drop(*DIMENSIONS), "keys")


def _key(dimension: str) -> str:
    return f"key_{dimension}"


class Node:
    def __init__(self, first: int, leaves: int) -> None:
        self.first, self.leaves = first, leaves
        self.dimension = self.split = None

    def children(self) -> list[Node]:
        left = self.leaves // 2
        return [Node(self.first, left), Node(self.first + left, self.leaves - left)]


def _placed(splits: list[tuple[Node, Node, Node]]) -> Column:
    """First shard of the node that a row is in, as nested conditions."""
    by_first = {(n.first, n.leaves): (n, a, b) for n, a, b in splits}

    def at(first: int, leaves: int) -> Column:
        if (first, leaves) not in by_first:
            return F.lit(first)
        n, a, b = by_first[first, leaves]
        return F.when(F.col(_key(n.dimension)) <= F.lit(n.split), at(a.first, a.leaves)).otherwise(at(b.first, b.leaves))
    return at(0, splits[0][0].leaves) if splits else F.lit(0)


def grow_tree(rows: DataFrame, shards: int = SHARDS) -> Column:
    """The shard of a row of ``points``."""
    spark = rows.sparkSession
    splits: list[tuple[Node, Node, Node]] = []
    level = [Node(0, shards)] if shards > 1 else []
    while level:
        placed = rows.withColumn("node", _placed(splits))
        widths = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("size").alias("total"),
            *[(F.max(_key(c)) - F.min(_key(c))).alias(c) for c in DIMENSIONS]).collect()}     # one row per node
        open_ = {}
        for n in level:
            r = widths.get(n.first)
            n.dimension = max(DIMENSIONS, key=lambda c: (r[c] if r else 0, c))
            n.split = 0
            if r:
                open_[n.first] = {"node": n, "goal": r["total"] * (n.leaves // 2) / n.leaves, "before": 0, "lo": 0, "hi": 1 << 62}
        keyed = placed.withColumn("k", F.coalesce(*[F.when(F.col("node") == f, F.col(_key(o["node"].dimension))) for f, o in open_.items()],
                                                  F.lit(None).cast("long"))) if open_ else None
        while open_:
            ranges = spark.createDataFrame([(f, o["lo"], o["hi"], max(1, -(-(o["hi"] - o["lo"] + 1) // SLICES)), float(o["goal"]), o["before"])
                                            for f, o in open_.items()],
                                           "node int, lo long, hi long, width long, goal double, before long")
            cut = (keyed.join(F.broadcast(ranges), "node").filter((F.col("k") >= F.col("lo")) & (F.col("k") <= F.col("hi")))
                   .withColumn("slice", F.expr("(k - lo) div width"))
                   .groupBy("node", "slice", "goal", "before")
                   .agg(F.sum("size").alias("w"), F.min("k").alias("lo"), F.max("k").alias("hi")))
            order = Window.partitionBy("node").orderBy("slice")
            sums = cut.withColumn("upto", F.col("before") + F.sum("w").over(order)) \
                .withColumn("last", F.max("slice").over(Window.partitionBy("node")))
            chosen = (sums.filter((F.col("upto") >= F.col("goal")) | (F.col("slice") == F.col("last")))
                      .groupBy("node").agg(F.min_by(F.struct("lo", "hi", "upto", "w"), "slice").alias("x")).collect())
            for r in chosen:                                                      # one row per open node
                o, x = open_[r["node"]], r["x"]
                o["lo"], o["hi"], o["before"] = x["lo"], x["hi"], x["upto"] - x["w"]
                if x["lo"] == x["hi"]:
                    # the row at the quantile goes to the side that is nearer
                    left = x["upto"] - o["goal"] <= o["goal"] - o["before"]
                    o["node"].split = x["lo"] if left else x["lo"] - 1
                    del open_[r["node"]]
        nxt = []
        for n in level:
            a, b = n.children()
            splits.append((n, a, b))
            nxt += [c for c in (a, b) if c.leaves > 1]
        level = nxt
    return _placed(splits)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(id, size, crc, shard, slot) of every row."""
    rows = points(docs)
    placed = rows.select("id", "size", "crc", "_row", grow_tree(rows, shards).cast("int").alias("shard"),
                         F.pmod("hash", F.lit(SLOT_SLICES)).alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    base = counts.select("shard", "part", (F.sum("rows").over(Window.partitionBy("shard").orderBy("part"))
                                           - F.col("rows")).alias("base"))
    inner = Window.partitionBy("shard", "part").orderBy("_row")
    return (placed.withColumn("n", F.row_number().over(inner)).join(base, ["shard", "part"])
            .select("id", "size", "crc", "shard", (F.col("base") + F.col("n") - 1).cast("long").alias("slot")))


def q_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_kd_shards": q_kd_shards}
ORACLES: dict = {}
