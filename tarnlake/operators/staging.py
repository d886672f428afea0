"""Staging: column mapping under schema-evolution policies, typing, log
compaction and the partition layout."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.sources import landing


@dataclass
class Mapped:
    source: str
    target: str
    kind: str = "string"


@dataclass
class TableConfig:
    """How one raw table becomes a staged one.

    mode: strict | flexible | pass_through; missing: error | null | warn | skip;
    unmapped: keep | drop. ``dedup_first`` drops deleted keys whole; without it
    deletes are filtered before the latest version is chosen, so an older
    version of a deleted row comes back.
    """

    name: str
    mapping: list[Mapped]
    key: str = "gpk"
    order_by: list[str] = field(default_factory=lambda: ["extraction_time"])
    mode: str = "flexible"
    missing: str = "null"
    unmapped: str = "keep"
    timestamps: dict[str, list[str]] = field(default_factory=dict)
    partitions: dict[str, str] = field(default_factory=dict)  # part name -> column
    dedup_first: bool = True

    @classmethod
    def load(cls, path: str | Path, **changes) -> TableConfig:
        """From a JSON file with numbered mapping entries."""
        c = json.loads(Path(path).read_text())
        evolution = c.get("schema_evolution", {})
        listed = lambda k: [c[k][i] for i in sorted(c.get(k, {}), key=int)]
        mapping = [Mapped(m["input_column"], m["output_column"], m.get("output_type", "string")) for m in listed("mapping")]
        stamps = {}
        for t in listed("timestamp_cols"):
            found = [t[k] for k in ("format", "pattern") if k in t] or list(t.get("formats", []))
            stamps[t["col"]] = [p for p in found if p]
        return cls(
            **{
                "name": c["target_table"],
                "mapping": mapping,
                "order_by": listed("merge_cols") or ["extraction_time"],
                "mode": evolution.get("mode", "flexible"),
                "missing": evolution.get("missing_columns", "null"),
                "unmapped": evolution.get("unmapped_columns", "keep"),
                "timestamps": stamps,
                "partitions": {p["name"]: p["col"] for p in listed("partitions")},
            }
            | changes
        )


KINDS = {"string": "string", "float": "double", "int": "int", "boolean": "boolean", "timestamp": "timestamp"}


def drift(df: DataFrame, config: TableConfig) -> DataFrame:
    """(table_name, change, column_name) of missing and unmapped columns."""
    sources, targets = {m.source for m in config.mapping}, {m.target for m in config.mapping}
    rows = [(config.name, "missing", m.source) for m in config.mapping if m.source not in df.columns]
    rows += [(config.name, "unmapped", c) for c in df.columns if c not in sources | targets]
    return df.sparkSession.createDataFrame(rows, "table_name string, change string, column_name string")


def apply_mapping(df: DataFrame, config: TableConfig) -> DataFrame:
    """Rename inputs to outputs under the mode and the two policies."""
    absent = [m for m in config.mapping if m.source not in df.columns]
    if absent and config.missing == "error":
        raise ValueError(f"{config.name} lacks {', '.join(m.source for m in absent)}")
    if absent and config.missing == "warn":
        warnings.warn(f"{config.name} lacks {', '.join(m.source for m in absent)}", stacklevel=2)
    if config.missing == "null":
        df = df.withColumns({m.source: F.lit(None).cast("string") for m in absent})
    if config.mode == "pass_through":
        return df
    present = [m for m in config.mapping if m.source in df.columns]
    mapped = [F.col(f"`{m.source}`").alias(m.target) for m in present]
    if config.mode == "strict":
        return df.select(*mapped)
    if config.mode != "flexible":
        raise ValueError(f"unknown mode {config.mode}")
    used = {m.source for m in present} | {m.target for m in present}
    rest = [] if config.unmapped == "drop" else [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*mapped, *rest)


def typed(c: Column, kind: str, patterns: list[str] | None = None) -> Column:
    if kind == "boolean":
        return clean.parse_boolean(c)
    if kind == "float":
        return clean.parse_numeric(c)
    if kind == "int":
        return clean.parse_numeric(c).try_cast("int")
    if kind == "timestamp":
        known = [F.try_to_timestamp(c, F.lit(p)) for p in patterns or []]
        return F.coalesce(*known, clean.parse_timestamp(c), c.try_cast("timestamp"))
    return c


def apply_types(df: DataFrame, config: TableConfig) -> DataFrame:
    """Declared types; what does not parse becomes NULL. Typed input stays."""
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    kinds = {(m.source if config.mode == "pass_through" else m.target): m.kind for m in config.mapping}
    todo = {c: k for c, k in kinds.items() if c in text and k != "string"}
    todo |= {c: "timestamp" for c in config.timestamps if c in text}
    return df.withColumns({c: typed(F.col(f"`{c}`"), k, config.timestamps.get(c)) for c, k in todo.items()})


def keep_latest(df: DataFrame, key: str | list[str], order_by: list[str], ties: list[str] | None = None) -> DataFrame:
    """The newest row per key: order columns descending, NULLs last.

    Null keys form one group. Ties fall to ``ties`` (default: a hash of the
    whole row), so the choice does not depend on partitioning. Runs as one
    shuffle on the key; the rank filter prunes each task before it.
    """
    keys = [key] if isinstance(key, str) else key
    if not set(keys) <= set(df.columns):
        return df
    order = [F.col(c).desc_nulls_last() for c in order_by if c in df.columns]
    last = [F.col(c).desc_nulls_last() for c in ties] if ties else [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    w = W.partitionBy(*keys).orderBy(*order, *last)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def compact(df: DataFrame, key: str | list[str], order_by: list[str], op: str = "op", dedup_first: bool = True) -> DataFrame:
    """Latest live version per key out of a change log."""
    alive = clean.live(F.col(op)) if op in df.columns else F.lit(True)
    if dedup_first:
        return keep_latest(df, key, order_by).where(alive)
    return keep_latest(df.where(alive), key, order_by)


def partition_columns(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    """year, month or day of a timestamp column; NULL becomes 0."""
    of = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    made = {name: F.coalesce(of[name](F.col(c)), F.lit(0)) for name, c in parts.items() if c in df.columns}
    return df.withColumns(made)


def stage(df: DataFrame, config: TableConfig, batch_id: str, processed_at: Column | None = None) -> DataFrame:
    """The whole staging plan of one table as one lazy DataFrame."""
    df = apply_types(apply_mapping(df, config), config)
    names = {m.source: m.target for m in config.mapping} if config.mode != "pass_through" else {}
    order = [c if c in df.columns else names.get(c, c) for c in config.order_by]
    key = config.key if config.key in df.columns else names.get(config.key, config.key)
    df = compact(df, key, order, dedup_first=config.dedup_first)
    df = partition_columns(df, config.partitions)
    return df.withColumns({"_batch_id": F.lit(batch_id), "_processed_at": F.current_timestamp() if processed_at is None else processed_at})


def run_compaction(spark: SparkSession, raw: str, target: str, config: TableConfig, batch_id: str) -> dict:
    """Landing zone to staged table; {'status', 'rows_in', 'rows_out', 'path'}."""
    df = landing.read_landing(spark, raw)
    if not df.columns or df.isEmpty():
        return {"table": config.name, "status": "empty", "rows_in": 0, "rows_out": 0, "path": target}
    # Counted as the rows pass by, so the raw files are not read again for it.
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    landing.write_partitioned(stage(df, config, batch_id), target, list(config.partitions))
    return {"table": config.name, "status": "success", "rows_in": seen.get["n"], "rows_out": spark.read.parquet(target).count(), "path": target}


def run_all(spark: SparkSession, jobs: list[tuple[str, str, TableConfig]], batch_id: str) -> dict:
    """Every table in name order; one failing table does not stop the others."""
    results = []
    for raw, target, config in sorted(jobs, key=lambda j: j[2].name):
        try:
            results.append(run_compaction(spark, raw, target, config, batch_id))
        except Exception as e:  # reported in the result of this table
            results.append({"table": config.name, "status": "failed", "rows_in": 0, "rows_out": 0, "path": target, "error": str(e)})
    return {"tables": results, "rows_out": sum(r["rows_out"] for r in results), "failed": sum(r["status"] == "failed" for r in results)}
