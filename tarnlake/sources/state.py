"""Watermarks and run logs as append-only tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "table_name string, watermark timestamp, batch_id string, saved_at timestamp"


def save_watermarks(spark: SparkSession, path: str, marks: dict[str, datetime | None], batch_id: str, at: datetime) -> None:
    """Append the tables that have a new watermark."""
    rows = [(t, w, batch_id, at) for t, w in sorted(marks.items()) if w is not None]
    if rows:
        spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(path)


def latest_watermarks(state: DataFrame) -> DataFrame:
    return state.groupBy("table_name").agg(F.max_by("watermark", F.struct("saved_at", "watermark")).alias("watermark"))


def load_watermarks(spark: SparkSession, path: str) -> dict[str, datetime]:
    """One row per source table, so it fits the driver."""
    try:
        state = spark.read.schema(STATE).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    return {r.table_name: r.watermark for r in latest_watermarks(state).collect()}


def log_run(spark: SparkSession, path: str, kind: str, run: dict) -> None:
    """Append one run as a JSON row."""
    row = [(kind, json.dumps(run, default=str, sort_keys=True))]
    spark.createDataFrame(row, "kind string, run string").coalesce(1).write.mode("append").json(path)
