"""Domain feature blocks (E1, E2, E5, E7-E9, B13, D3): the reference's tables
rolled up to one row per client, from aggregation specifications.

Each builder takes tables with the reference's column names and returns one
block keyed on ``SK_ID_CURR``, in one hash aggregate with all of its subsets
(``aggspec.aggregate_block``).  Text columns become category frequencies; the
vocabularies are fitted once and can be shared between train and test.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip_at_zero, nullify_sentinels, safe_divide
from ..session import ensure_checkpoint_dir
from ..sources.files import hand_over_bucketed
from .aggspec import agg_exprs, aggregate_block, dummy_mean_exprs
from .joins import join_blocks

KEY = "SK_ID_CURR"

# The aggregation specifications of the reference (column: aggregates).
BUREAU_BALANCE_SPEC = {"MONTHS_BALANCE": ["min", "max", "size"]}
BUREAU_SPEC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
PREVIOUS_SPEC = {
    "SK_ID_PREV": ["nunique"],
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}
PREVIOUS_SENTINELS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
POS_SPEC = {"MONTHS_BALANCE": ["max", "mean", "size"], "SK_DPD": ["max", "mean"], "SK_DPD_DEF": ["max", "mean"]}
INSTALMENTS_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}
CARD_AGGREGATES = ["min", "max", "mean", "sum", "var"]
BUREAU_SUBSETS = {"ACTIVE": ("CREDIT_ACTIVE", "Active"), "CLOSED": ("CREDIT_ACTIVE", "Closed")}
PREVIOUS_SUBSETS = {"APPROVED": ("NAME_CONTRACT_STATUS", "Approved"), "REFUSED": ("NAME_CONTRACT_STATUS", "Refused")}
POST_JOIN_RATIOS = [
    ("NEW_BUREAU_DEBT_RATIO", "BURO_AMT_CREDIT_SUM_DEBT_SUM", "BURO_AMT_CREDIT_SUM_SUM"),
    ("NEW_ACTIVE_DEBT_RATIO", "ACTIVE_AMT_CREDIT_SUM_DEBT_SUM", "ACTIVE_AMT_CREDIT_SUM_SUM"),
    ("NEW_APPROVAL_RATE", "APPROVED_COUNT", "PREV_COUNT"),
    ("NEW_REFUSAL_RATE", "REFUSED_COUNT", "PREV_COUNT"),
    ("NEW_LATE_PAYMENT_RATIO", "INSTAL_DPD_SUM", "INSTAL_COUNT"),
    ("NEW_POS_DPD_RATIO", "POS_SK_DPD_DEF_MEAN", "POS_COUNT"),
    ("NEW_CREDIT_TO_PREV_CREDIT_RATIO", "AMT_CREDIT", "PREV_AMT_CREDIT_MEAN"),
    ("NEW_CURRENT_TO_APPROVED_CREDIT_RATIO", "AMT_CREDIT", "APPROVED_AMT_CREDIT_MEAN"),
    ("NEW_CURRENT_TO_INCOME_CREDIT_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
]

Vocabulary = Mapping[str, Sequence[str]]


def _subsets(spec: Mapping[str, tuple[str, str]]):
    return {name: F.col(column) == value for name, (column, value) in spec.items()}


def bureau_block(bureau: DataFrame, balance: DataFrame, vocabulary: Vocabulary, balance_vocabulary: Vocabulary,
                 buckets: int | None = None) -> DataFrame:
    """E1 + E2 + E3: monthly history -> credit -> client.  With ``buckets`` the
    credits move to that many partitions by client before they are aggregated."""
    months = balance.groupBy("SK_ID_BUREAU").agg(*agg_exprs(BUREAU_BALANCE_SPEC, None),
                                                 *dummy_mean_exprs(balance_vocabulary, None))
    frequencies = {c: ["mean"] for c in months.columns if c.endswith("_MEAN")}
    credits = bureau.join(months, "SK_ID_BUREAU", "left")
    return aggregate_block(credits.repartition(buckets, KEY) if buckets else credits, KEY, "BURO", {**BUREAU_SPEC, **frequencies},
                           _subsets(BUREAU_SUBSETS), BUREAU_SPEC, vocabulary, "BURO_COUNT")


def previous_block(previous: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """E5 + E6: previous applications, sentinel days as NULL, asked over granted."""
    p = nullify_sentinels(previous, [c for c in PREVIOUS_SENTINELS if c in previous.columns])
    p = p.withColumn("APP_CREDIT_PERC", safe_divide("AMT_APPLICATION", "AMT_CREDIT"))
    return aggregate_block(p, KEY, "PREV", PREVIOUS_SPEC, _subsets(PREVIOUS_SUBSETS), PREVIOUS_SPEC, vocabulary, "PREV_COUNT")


def pos_block(pos: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """E7."""
    return aggregate_block(pos, KEY, "POS", POS_SPEC, vocabulary=vocabulary, count_name="POS_COUNT")


def instalments_block(instalments: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Payment share and difference, days past due and before due."""
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    i = instalments.withColumns({
        "PAYMENT_PERC": safe_divide("AMT_PAYMENT", "AMT_INSTALMENT"), "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "DPD": clip_at_zero(late), "DBD": clip_at_zero(-late)})
    return aggregate_block(i, KEY, "INSTAL", INSTALMENTS_SPEC, vocabulary=vocabulary, count_name="INSTAL_COUNT")


def card_block(card: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Every column but the ids, dummies included, by every aggregate."""
    dummies = {}
    for c, values in vocabulary.items():
        dummies.update({f"{c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0) for v in values})
        dummies[f"{c}_nan"] = F.when(F.col(c).isNull(), 1.0).otherwise(0.0)
    d = card.drop("SK_ID_PREV").withColumns(dummies).drop(*vocabulary)
    return aggregate_block(d, KEY, "CC", {c: CARD_AGGREGATES for c in d.columns if c != KEY}, count_name="CC_COUNT")


def post_join_ratios(df: DataFrame) -> DataFrame:
    """Each ratio whose two columns exist."""
    return df.withColumns({name: safe_divide(a, b) for name, a, b in POST_JOIN_RATIOS if a in df.columns and b in df.columns})


def five_blocks(application: DataFrame, tables: Mapping[str, DataFrame], vocabularies: Mapping[str, Vocabulary],
                buckets: int | None = None, gathered: Sequence[str] = ()) -> DataFrame:
    """D3 + B13: application left-joined with all five blocks (every client keeps
    one row), then the nine ratios.  ``tables`` and ``vocabularies``: bureau,
    balance, previous, pos, instalments, card.  With ``buckets`` the application
    and each block are handed over as tables bucketed by client, for builds that
    read the blocks again: the five joins then have no shuffle.  The blocks' rows
    are then moved by client before they are aggregated: a row is far narrower
    than the partial sums of a block, and the aggregates and buckets move nothing
    more.  ``gathered`` names the tables that are bucketed so already."""
    v = vocabularies
    if buckets:
        tables = {n: t if n in ("bureau", "balance", *gathered) else t.repartition(buckets, KEY) for n, t in tables.items()}
    blocks = {
        "BURO": bureau_block(tables["bureau"], tables["balance"], v["bureau"], v["balance"], buckets),
        "PREV": previous_block(tables["previous"], v["previous"]),
        "POS": pos_block(tables["pos"], v["pos"]),
        "INSTAL": instalments_block(tables["instalments"], v.get("instalments")),
        "CC": card_block(tables["card"], v["card"])}
    if buckets:
        folder = f"{ensure_checkpoint_dir(application.sparkSession).rstrip('/')}/blocks-{uuid.uuid4().hex}"
        application = hand_over_bucketed(application, KEY, buckets, f"{folder}/application")
        blocks = {n: hand_over_bucketed(b, KEY, buckets, f"{folder}/{n.lower()}", clustered=True) for n, b in blocks.items()}
    return post_join_ratios(join_blocks(application, blocks, KEY))
