"""From raw documents to packed training sequences, as stages that are written and read again."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitepulse.llm.common import on_workers, stored, table  # noqa: E402
from sitepulse.llm.exact import exact_stage  # noqa: E402
from sitepulse.llm.mixing import mix_stage  # noqa: E402
from sitepulse.llm.packing import packing_stage  # noqa: E402
from sitepulse.llm.simhash import simhash_stage  # noqa: E402
from sitepulse.llm.toxicity import toxicity_stage  # noqa: E402

STAGES = [
    ("toxicity", on_workers(toxicity_stage)),
    ("exact_dedup", on_workers(exact_stage)),
    ("simhash_dedup", on_workers(simhash_stage)),
    ("source_mix", on_workers(mix_stage)),
    ("packing", on_workers(packing_stage)),
]

# The classifier, the fingerprints and the tokenizer have no SQL form; tests/llm/test_pipeline.py
# compares the stages with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one (pieces and their sequences)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
