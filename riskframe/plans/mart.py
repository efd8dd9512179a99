"""Client feature mart: the flagship query.

customer ⟕ ORD block (orders ⟕ per-order line summary, i.e. a two-hop roll-up,
with ACTIVE / CLOSED subset aggregates and one-hot frequencies)
⟕ EVT block (events, every column x {min,max,mean,sum,var})
then post-join ratios.  Each block is a single ``groupBy`` on the client key;
the joins reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import safe_divide
from ..operators.aggspec import aggregate_block, agg_exprs, dummy_mean_exprs
from ..operators.encode import fit_vocabularies, fit_vocabulary
from ..operators.joins import join_blocks
from . import tables as T

KEY = "c_custkey"

# ---- aggregation specs (column: aggs) ---------------------------------------
LINE_SPEC = {"l_quantity": ["min", "max", "size"]}            # line -> order
ORD_SPEC = {
    "o_orderkey": ["nunique"],
    "o_totalprice": ["min", "max", "mean", "var", "sum"],
    "DAYS_ORDER": ["min", "max", "mean"],
    "l_quantity_MIN": ["min"],
    "l_quantity_MAX": ["max"],
    "l_quantity_SIZE": ["mean", "sum"],
}
SUBSET_SPEC = {
    "o_totalprice": ["min", "max", "mean", "sum"],
    "DAYS_ORDER": ["max", "mean"],
    "l_quantity_SIZE": ["mean", "sum"],
}
EVT_SPEC_AGGS = ["min", "max", "mean", "sum", "var"]

# post-join ratios: (name, numerator, denominator)
POST_JOIN_RATIOS = [
    ("NEW_ACTIVE_AMOUNT_RATIO", "ACTIVE_o_totalprice_SUM", "ORD_o_totalprice_SUM"),
    ("NEW_ACTIVE_RATE", "ACTIVE_COUNT", "ORD_COUNT"),
    ("NEW_CLOSED_RATE", "CLOSED_COUNT", "ORD_COUNT"),
    ("NEW_LINES_PER_ORDER", "ORD_l_quantity_SIZE_SUM", "ORD_COUNT"),
    ("NEW_EVT_VALUE_PER_ORDER", "EVT_value_SUM", "ORD_COUNT"),
]


def line_summary(lineitem: DataFrame, vocab: dict) -> DataFrame:
    """lineitem -> one row per order (``l_quantity_{MIN,MAX,SIZE}`` and line
    return-flag frequencies)."""
    return lineitem.groupBy("l_orderkey").agg(
        *agg_exprs(LINE_SPEC, None), *dummy_mean_exprs(vocab, None))


def mart_vocabulary(spark: SparkSession, sf_dir: str) -> dict:
    """All one-hot vocabularies of the mart, fitted in one job."""
    return fit_vocabularies({
        "lineitem": (T.table(spark, sf_dir, "lineitem"), ["l_returnflag"]),
        "orders": (T.table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"]),
        "events": (T.table(spark, sf_dir, "events"), ["event_type"])}, max_categories=T.MAX_DUMMIES)


def orders_block(spark: SparkSession, sf_dir: str, vocab: dict | None = None) -> DataFrame:
    vocab = vocab or mart_vocabulary(spark, sf_dir)
    orders = T.table(spark, sf_dir, "orders")
    lineitem = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    line_vocab = vocab["lineitem"]
    lines = line_summary(lineitem, line_vocab)
    ord_vocab = vocab["orders"]
    o = (orders.withColumn("DAYS_ORDER", T.day_offset("o_orderdate"))
         .join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
         .withColumnRenamed("o_custkey", KEY))
    spec = dict(ORD_SPEC)
    for v in list(line_vocab["l_returnflag"]) + ["nan"]:
        spec[f"l_returnflag_{v}_MEAN"] = ["mean"]
    return aggregate_block(
        o, KEY, "ORD", spec,
        subsets={"ACTIVE": F.col("o_orderstatus") == T.ORDER_STATUS_ACTIVE,
                 "CLOSED": F.col("o_orderstatus") == T.ORDER_STATUS_CLOSED},
        subset_spec=SUBSET_SPEC,
        vocabulary=ord_vocab,
        count_name="ORD_COUNT",
    )


def events_block(spark: SparkSession, sf_dir: str, vocab: dict | None = None) -> DataFrame:
    """Every non-id column (value + event_type dummies) x min/max/mean/sum/var."""
    ev = T.table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    values = vocab["events"] if vocab else fit_vocabulary(ev, ["event_type"], max_categories=T.MAX_DUMMIES)
    dummies = {f"event_type_{v}": F.when(F.col("event_type") == v, 1.0).otherwise(0.0)
               for v in values["event_type"]}
    dummies["event_type_nan"] = F.when(F.col("event_type").isNull(), 1.0).otherwise(0.0)
    ev = ev.withColumns(dummies).drop("event_type").withColumnRenamed("user_id", KEY)
    spec = {c: EVT_SPEC_AGGS for c in ev.columns if c != KEY}
    return aggregate_block(ev, KEY, "EVT", spec, count_name="EVT_COUNT")


def add_post_join_ratios(df: DataFrame, ratios=POST_JOIN_RATIOS) -> DataFrame:
    """Ratio columns, only where both inputs exist."""
    new = {name: safe_divide(num, den) for name, num, den in ratios
           if num in df.columns and den in df.columns}
    return df.withColumns(new) if new else df


def feature_blocks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    vocab = mart_vocabulary(spark, sf_dir)
    return {"ORD": orders_block(spark, sf_dir, vocab), "EVT": events_block(spark, sf_dir, vocab)}


def client_feature_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = T.application(spark, sf_dir)
    out = join_blocks(base, feature_blocks(spark, sf_dir), KEY)
    return add_post_join_ratios(out)


def build_full_dataset(spark: SparkSession, sf_dir: str, out_dir: str | None = None,
                       threshold: float = 0.995):
    """Entry point 1: base table, feature blocks each pruned of
    low-information columns (F11) before joining, join audit (D4),
    post-join ratios (B13), split on target nullness (H3).  With ``out_dir``
    the train / test tables are written as Parquet (A6) and the reports as
    CSV (A7).  Returns (train, test, pruning report, join audit)."""
    from ..operators.joins import join_audit
    from ..operators.profile import drop_low_information_columns
    from ..operators.split import split_on_target
    from ..session import cut_lineage
    from ..sources.files import write_parquet, write_report_csv
    base = T.application(spark, sf_dir)
    pruned, reports = {}, None
    for name, blk in feature_blocks(spark, sf_dir).items():
        blk = cut_lineage(blk)  # read by the pruning statistics, the audit and the join
        kept, rep = drop_low_information_columns(blk, [KEY], threshold)
        pruned[name] = kept
        rep = rep.select(F.lit(name).alias("block"), "*")
        reports = rep if reports is None else reports.unionByName(rep)
    audit = join_audit(base, pruned, KEY)
    full = add_post_join_ratios(join_blocks(base, pruned, KEY))
    train, test = split_on_target(full)
    if out_dir:
        write_parquet(train, f"{out_dir}/train")
        write_parquet(test, f"{out_dir}/test")
        write_report_csv(reports, f"{out_dir}/low_information_features")
        write_report_csv(audit, f"{out_dir}/join_report")
    return train, test, reports, audit
