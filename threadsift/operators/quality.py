"""Counters taken on the way, and the quality report."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift.operators.clean import CAST_RULES, CLEANING_RULES, INGEST_RULES, REJECT
from threadsift.sources.single_file import write_single_file

ROWS_READ = "rows_read"
PRESENT = "_present_"


def reject_counts(rules: tuple[str, ...]) -> list[Column]:
    """Rows read and rows per broken rule, over a tagged DataFrame."""
    return [F.count(F.lit(1)).alias(ROWS_READ)] + [
        F.count_if(F.col(REJECT) == F.lit(rule)).alias(rule) for rule in rules
    ]


def present_fields(fields: list[str]) -> tuple[list[Column], Column]:
    """Aggregates that tell for each field whether any row has a value, and the column of bits they
    are taken from."""
    bits = F.lit(0)
    for place, name in enumerate(fields):
        bits = bits.bitwiseOR(F.when(F.col(name).isNotNull(), 1 << place).otherwise(0))
    aggregates = [
        F.max(F.col(PRESENT).bitwiseAND(F.lit(1 << place))).alias(f"{PRESENT}{name}") for place, name in enumerate(fields)
    ]
    return aggregates, bits.alias(PRESENT)


def fields_without_values(counts: dict) -> list[str]:
    """Fields that no row read has a value in; none when no row was read."""
    if not counts[ROWS_READ]:
        return []
    return [name.removeprefix(PRESENT) for name, value in counts.items() if name.startswith(PRESENT) and not value]


def extraction_metrics(counts: dict) -> dict[str, int]:
    kept = counts[ROWS_READ] - sum(counts[r] for r in INGEST_RULES)
    return {"total_records": kept, **{r: counts[r] for r in INGEST_RULES}}


def after_ingest(counts: dict) -> dict[str, int]:
    """Counters of the transform stage, from a pass that applied the ingest rules as well."""
    kept = counts[ROWS_READ] - sum(counts[r] for r in INGEST_RULES)
    return {**counts, ROWS_READ: kept, **dict.fromkeys(INGEST_RULES, 0)}


def transformation_metrics(counts: dict) -> dict[str, int]:
    initial = counts[ROWS_READ]
    cleaned = initial - sum(counts[r] for r in CLEANING_RULES)
    return {
        "initial_records": initial,
        "after_cleaning": cleaned,
        "cleaning_removed": initial - cleaned,
        **{r: counts[r] for r in CLEANING_RULES + CAST_RULES},
        "final_records": cleaned - sum(counts[r] for r in CAST_RULES),
    }


def one_row(spark: SparkSession) -> DataFrame:
    """One row in one partition, to hang literals on."""
    return spark.range(0, 1, 1, 1)


class QualityMetrics:
    """Collects ``stage -> metric -> value`` with the run's start and end."""

    COLUMNS = "stage string, metric string, value double"

    def __init__(self) -> None:
        self.start_time = datetime.now(timezone.utc)
        self.metrics: dict[str, dict[str, float]] = {}
        self.schemas: dict[str, str] = {}

    def add_metric(self, stage: str, name: str, value: float) -> None:
        self.metrics.setdefault(stage, {})[name] = value

    def add_metrics(self, stage: str, values: dict[str, float]) -> None:
        for name, value in values.items():
            self.add_metric(stage, name, value)

    def add_schema(self, name: str, df: DataFrame) -> None:
        """Records a schema, as the inspection before and after the transform."""
        self.schemas[name] = df.schema.simpleString()

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """One row per metric, built from literals: a local list would start Python workers."""
        rows = [
            F.struct(F.lit(stage), F.lit(name), F.lit(float(value)))
            for stage, values in self.metrics.items()
            for name, value in values.items()
        ]
        table = F.array(*rows).cast(f"array<struct<{self.COLUMNS}>>")
        return one_row(spark).select(F.inline(table))

    def save_table(self, spark: SparkSession, path: str) -> None:
        self.to_dataframe(spark).write.mode("overwrite").parquet(path)

    def report(self) -> dict:
        return {
            "pipeline_start": self.start_time.isoformat(),
            "pipeline_end": datetime.now(timezone.utc).isoformat(),
            "metrics": self.metrics,
            "schemas": self.schemas,
        }

    def save_report(self, spark: SparkSession, path: str, single_file: bool = False) -> None:
        """The report as JSON, in a folder or as one file of that name."""
        text = one_row(spark).select(F.lit(json.dumps(self.report(), indent=2)).alias("value"))
        if single_file:
            write_single_file(spark, text, path)
        else:
            text.write.mode("overwrite").text(path)
