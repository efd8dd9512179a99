"""Benchmark decontamination by a prefix-filtered set join (DataFrame
operations only).

An item's windows are its runs of ``window`` consecutive words (a shorter item
is one window).  A window is the set of its word shingles (``SHINGLE`` words, or
all of them when the window is shorter).  To hold a window, a document must hold
all of its shingles, so the necessary prefix, in order of rarity over all
documents, is one shingle: the rarest.  Documents' shingles are joined with
these prefix tokens only.  A joined pair fixes where the window would begin; the
positional bound (it begins at or after the first word) and the length bound (it
ends within the text) drop most pairs, and the words themselves are compared
over that item-sized window.

The word array stays inside the scan's stage when the prefix tokens are few
enough to broadcast (their number is counted first); beyond ``broadcast_rows``
the shingles are shuffled to the tokens with just their position, and come back
to the words of the matching rows.

Defined cases: null or word-free texts have no words, no hits and are clean;
items without words match nothing; a null item_id counts as the empty string;
repeated rows each get their row; empty tables give clean or empty results;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_or_null, row_key, stage, table, without
from .words import gram_hashes, words

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 200_000


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(wid, size, words, items): distinct windows with the ids of their items."""
    w = benchmark.select(F.coalesce(column_or_null(benchmark, "item_id", "string"), F.lit("")).alias("item"),
                         words(column_or_null(benchmark, "text", "string")).alias("w"))
    n = F.size("w")
    at = F.explode(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))))
    runs = (w.filter(n > 0).select("item", "w", at.alias("at"))
            .select("item", F.slice("w", F.col("at") + 1, window).alias("words")))
    return (runs.groupBy("words").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64("words").alias("wid"), F.size("words").alias("size"), "words", "items"))


def prefix_tokens(windows: DataFrame, seen: DataFrame) -> DataFrame:
    """(hash, offset, wid, size, words): the rarest shingle of each window by the
    counts ``seen(hash, docs)``; ties by hash."""
    grams = (_window_grams(windows).join(seen, "hash", "left")
             .withColumn("rank", F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "hash", "offset")))
    best = grams.groupBy("wid", "words").agg(F.min("rank").alias("rank"))
    return best.select("wid", "words", F.size("words").alias("size"), "rank.hash", "rank.offset")


def _window_grams(windows: DataFrame) -> DataFrame:
    size = F.least(F.lit(SHINGLE), F.size("words"))
    hashed = F.when(size == 1, gram_hashes("words", 1)).when(size == 2, gram_hashes("words", 2)) \
        .otherwise(gram_hashes("words", SHINGLE))
    whole = F.slice(hashed, F.lit(1), F.size("words") - size + 1)
    return windows.select("wid", "words", F.posexplode_outer(whole).alias("offset", "hash"))


def _shared(small: DataFrame, bound: int) -> DataFrame:
    """The frame, marked for broadcast when it has at most ``bound`` rows."""
    return F.broadcast(small) if small.count() <= bound else small


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows, windows): ``rows`` (id, key, n_words, start, wid) has one row per
    document row with NULL start and wid, and one per occurrence of a window."""
    windows = stage(item_windows(benchmark, window), "windows")
    text = row_key(docs).select("id", "key", words("text").alias("w"))
    sizes = [r[0] for r in windows.select(F.least(F.lit(SHINGLE), "size").alias("s")).distinct().orderBy("s").collect()]
    if not sizes:
        return (text.select("id", "key", F.size("w").cast("long").alias("n_words"),
                            F.lit(None).cast("int").alias("start"), F.lit(None).cast("long").alias("wid")), windows)
    # one array of hashes for each shingle size in use; position i of size number s is i + s * n
    n = F.size("w")
    grams = text.select("id", "key", "w", F.concat(*[gram_hashes("w", s) for s in sizes]).alias("grams"))
    known = _shared(stage(_window_grams(windows).select("hash").distinct(), "grams"), broadcast_rows)
    seen = (grams.select(F.explode_outer("grams").alias("hash")).join(known, "hash")
            .groupBy("hash").agg(F.count("*").alias("docs")))
    tokens = stage(prefix_tokens(windows, seen), "tokens").select("hash", "offset", "wid", "size", "words")

    few = tokens.count() <= broadcast_rows
    # one row of its own for every document (at -1), so that one pass gives both
    own = F.array(F.lit(None).cast("long"))
    spread = (grams.select("id", "key", "w", F.posexplode_outer(F.concat(own, F.col("grams"))).alias("at", "hash"))
              .select("id", "key", "w", "hash", F.when(F.col("at") == 0, -1)
                      .otherwise((F.col("at") - 1) % F.greatest(n, F.lit(1))).alias("pos")))
    start = F.col("pos") - F.col("offset")
    bounds = (start >= 0) & (start + F.col("size") <= n)
    verified = bounds & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("words"))
    if few:
        found = spread.join(F.broadcast(tokens), "hash", "left").filter((F.col("pos") == -1) | verified)
        rows = found.select("id", "key", n.cast("long").alias("n_words"),
                            F.when(F.col("pos") >= 0, start).alias("start"), "wid")
    else:
        base = text.select("id", "key", n.cast("long").alias("n_words"),
                           F.lit(None).cast("int").alias("start"), F.lit(None).cast("long").alias("wid"))
        near = (spread.filter("pos >= 0").select("id", "key", "pos", "hash").join(tokens, "hash")
                .filter(start >= 0).withColumnsRenamed({"id": "_i", "key": "_k"}).distinct())
        whole = text.dropDuplicates(["id", "key"])
        rows = base.unionByName(
            near.join(whole, F.col("_i").eqNullSafe(F.col("id")) & F.col("_k").eqNullSafe(F.col("key")))
            .filter(verified).select("id", "key", n.cast("long").alias("n_words"), start.alias("start"), "wid"))
    return rows, windows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document row: (id, key, n_words, n_hit, items, contaminated)."""
    rows, windows = hits(docs, benchmark, window, broadcast_rows)
    rows = stage(rows, "hits")
    found = rows.filter("wid is not null").select("id", "key", "start", "wid").distinct()
    spans = (found.join(windows.select("wid", "size"), "wid")
             .groupBy("id", "key", "start").agg(F.max("size").alias("size")))
    order = Window.partitionBy("id", "key").orderBy("start")
    reach = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.select("id", "key", F.greatest(
        F.lit(0), F.col("start") + F.col("size") - F.greatest("start", F.coalesce(reach, F.lit(0)))).alias("fresh"))
    words_hit = fresh.groupBy("id", "key").agg(F.sum("fresh").alias("n_hit"))
    items = (found.select("id", "key", "wid").distinct().join(windows.select("wid", F.explode("items").alias("item")), "wid")
             .groupBy("id", "key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    marks = (words_hit.join(items, words_hit["id"].eqNullSafe(items["id"]) & (words_hit["key"] == items["key"]))
             .select(words_hit["id"].alias("_i"), words_hit["key"].alias("_k"), "n_hit", "items"))
    return (rows.filter("wid is null and start is null").select("id", "key", "n_words")
            .join(marks, F.col("id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k")), "left")
            .select("id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a window of a benchmark item go."""
    return without(docs, contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated"))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


QUERIES = {"op10_decontaminate": q_decontaminate}
ORACLES: dict = {}
