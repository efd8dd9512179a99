"""The corpus pipeline: five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet to the shared folder and read again as the next stage's ``docs``.  All
but the last return the columns of their input.  Null, empty and repeated rows
go through each stage as its operator's docstring says; packing gives every row
that is left at least one piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.common import stage, table
from riskframe.llm.decontaminate import stage_decontaminate
from riskframe.llm.language_ppm import stage_language
from riskframe.llm.ngram_join import stage_near_duplicates
from riskframe.llm.packing import stage_packing
from riskframe.llm.quality_lines import stage_quality

STAGES = [
    ("quality_rules", stage_quality),
    ("language_id", stage_language),
    ("ngram_jaccard_join", stage_near_duplicates),
    ("benchmark_decontamination", stage_decontaminate),
    ("packing", stage_packing),
]

#: SQL can express neither the PPM model nor the tokenizer; tests/llm holds a
#: brute-force version of the whole pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
