"""From raw documents to token ids: five stages, each a written table the next one reads.

Needs the subpackage `candlewright.llm`. `run` gives the last stage's rows. No SQL says the same
(weak supervision, similarity groups and piece ids are no SQL), so `ORACLE_SQL` is None. The
stages are tested one by one: near copies and leaks against brute force, lines against SQL, the rules'
measures and the pieces' scores against plain Python. The whole run is tested for what it must not keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewright.llm import queries as _queries
from candlewright.session import scratch_path

STAGES = [
    ("quality_rules", _queries.stage_quality),
    ("line_dedup", _queries.stage_lines),
    ("near_copies", _queries.stage_near_copies),
    ("decontamination", _queries.stage_leaks),
    ("sentencepiece", _queries.stage_pieces),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
