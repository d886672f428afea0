"""Full and incremental loads: audit columns, delete marks, watermarks."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from fnmatch import fnmatch

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake.sources import jdbc, landing

AUDIT = ("extraction_time", "gpk", "env", "region", "op")


@dataclass
class SourceTable:
    """A table to ingest. ``delete_when``: (column, value) that marks deletes."""

    schema: str
    name: str
    id_column: str = "id"
    tracking: str | None = None
    pattern: str = jdbc.TRACKING_PATTERN
    delete_when: tuple[str, str] | None = None
    prefix: str = "raw_"


def batch_id(at: datetime) -> str:
    return at.strftime("%Y%m%d_%H%M%S")


def select_tables(tables: list[SourceTable], rules: list[dict]) -> list[SourceTable]:
    """Tables named by selection rules {action, schema, table} with wildcards
    (``%``); a later rule overrides an earlier one. No rules: every table."""

    def fits(pattern: str, value: str) -> bool:
        return fnmatch(value, pattern.replace("%", "*"))

    out = []
    for t in tables:
        chosen = not rules
        for r in rules:
            if fits(r.get("schema", "%"), t.schema) and fits(r.get("table", "%"), t.name):
                chosen = r.get("action", "include") == "include"
        if chosen:
            out.append(t)
    return out


@dataclass
class Mappings:
    """What a mapping document says: tables, their prefix, renamed schemas."""

    tables: list[SourceTable]
    prefix: str
    schemas: dict[str, str]


def read_mappings(document: dict, settings: dict | None = None) -> Mappings:
    """A document of selection and transformation rules.

    Explicit selections name the tables, with id column, tracking column and
    delete mark in their change-capture block; the first prefix rule for tables
    counts, else the settings' own; rename rules map schemas.
    """
    by_kind: dict[tuple, list[dict]] = {}
    for r in document.get("rules", []):
        by_kind.setdefault((r.get("rule-type"), r.get("rule-action"), r.get("rule-target")), []).append(r)
    place = lambda r: r.get("object-locator", {})
    prefixes = by_kind.get(("transformation", "add-prefix", "table"), [])
    prefix = prefixes[0].get("value", "") if prefixes else (settings or {}).get("task_settings", {}).get("table_prefix", "")
    schemas: dict[str, str] = {}
    for r in by_kind.get(("transformation", "rename", "schema"), []):
        schemas.setdefault(place(r).get("schema-name"), r.get("value"))
    tables = []
    for kind, rules in by_kind.items():
        for r in rules if kind[:2] == ("selection", "explicit") else ():
            cdc = r.get("cdc-config", {})
            gone = cdc.get("delete-column"), cdc.get("delete-value")
            more = {"delete_when": gone} if all(gone) else {}
            tables.append(SourceTable(place(r)["schema-name"], place(r)["table-name"], cdc.get("id-column", "id"), cdc.get("tracking-column"), prefix=prefix, **more))
    return Mappings(tables, prefix, schemas)


def target_path(t: SourceTable, kind: str, batch: str, schemas: dict[str, str] | None = None, default: str | None = None) -> str:
    """<schema>/<prefix><table>/<kind>/<batch> below the landing zone."""
    schema = (schemas or {}).get(t.schema, default or t.schema)
    return f"{schema}/{t.prefix}{t.name}/{kind}/{batch}"


def audit_columns(
    df: DataFrame,
    at: datetime,
    id_column: str = "id",
    op: str = "I",
    env: str = "dev",
    region: str = "local",
    delete_when: tuple[str, str] | None = None,
    enabled: tuple[str, ...] = AUDIT,
) -> DataFrame:
    """Add the enabled audit columns. A NULL id gives a NULL gpk; without an id
    column a generated row number stands in."""
    ident = F.col(id_column) if id_column in df.columns else F.monotonically_increasing_id()
    code: Column = F.lit(op)
    if delete_when and delete_when[0] in df.columns:
        code = F.when(F.col(delete_when[0]).eqNullSafe(F.lit(delete_when[1])), "D").otherwise(code)
    made = {
        "extraction_time": F.lit(at.isoformat(timespec="microseconds")),
        "gpk": F.concat(ident.cast("string"), F.lit("~"), F.lit(at.strftime("%Y%m%d%H%M%S"))),
        "env": F.lit(env),
        "region": F.lit(region),
        "op": code,
    }
    return df.withColumns({k: v for k, v in made.items() if k in enabled})


def add_columns(df: DataFrame, table: str, rules: list[dict], at: datetime, op: str = "I") -> DataFrame:
    """Declarative columns: {table, column, expression}; ``%`` matches any table.

    ``$name`` is a column; CURRENT_TIMESTAMP, EXTRACTION_TIMESTAMP and
    OPERATION_TYPE are this batch's; the rest is SQL.
    """
    words = {
        "CURRENT_TIMESTAMP": f"'{at.isoformat(timespec='microseconds')}'",
        "EXTRACTION_TIMESTAMP": f"'{at.strftime('%Y%m%d%H%M%S')}'",
        "OPERATION_TYPE": f"'{op}'",
    }
    # Quoted literals are matched first and stay as they are.
    token = re.compile(r"'(?:[^']|'')*'|\$(\w+)|\b(" + "|".join(words) + r")\b(?!\s*\()")

    def put(m: re.Match) -> str:
        return f"`{m[1]}`" if m[1] else words[m[2]] if m[2] else m[0]

    for r in rules:
        if fnmatch(table, r.get("table", "%").replace("%", "*")):
            df = df.withColumn(r["column"], F.expr(token.sub(put, r["expression"])))
    return df


def op_counts(df: DataFrame, op: str = "op") -> DataFrame:
    return df.agg(*[F.count_if(F.col(op) == c).alias(name) for c, name in (("I", "inserts"), ("U", "updates"), ("D", "deletes"))])


def mark_inserts(changes: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Turn U into I for keys not seen before."""
    seen = known.select(key).distinct().withColumn("_seen", F.lit(True))
    new = (F.col("op") == "U") & F.col("_seen").isNull()
    return changes.join(seen, key, "left").withColumn("op", F.when(new, "I").otherwise(F.col("op"))).drop("_seen")


def new_watermark(df: DataFrame, tracking: str, pattern: str = jdbc.TRACKING_PATTERN) -> datetime | None:
    """Greatest tracking value as a time, not as text."""
    text = dict(df.dtypes)[tracking] == "string"
    at = F.try_to_timestamp(F.col(tracking), F.lit(pattern)) if text else F.col(tracking)
    return df.agg(F.max(at)).first()[0]


def _write_observed(df: DataFrame, table: SourceTable, path: str, fmt: str) -> dict:
    """Write a batch and take its counts and watermark from the rows as they
    pass by: the source is read once, and what is reported is what was written,
    even where the source changes meanwhile. A batch without rows leaves no
    folder. (A stage that Spark runs again may be observed twice: there is none
    between reading and writing.)"""
    seen, measures = Observation(), [F.count(F.lit(1)).alias("rows")]
    measures += [F.count_if(F.col("op") == c).alias(name) for c, name in (("I", "inserts"), ("U", "updates"), ("D", "deletes"))]
    if table.tracking in df.columns:
        text = df.schema[table.tracking].dataType.simpleString() == "string"
        measures.append(F.max(F.try_to_timestamp(F.col(table.tracking), F.lit(table.pattern)) if text else F.col(table.tracking)).alias("watermark"))
    landing.write_raw(df.observe(seen, *measures), path, fmt)
    found = {"watermark": None} | seen.get
    if not found["rows"]:
        landing.remove(df.sparkSession, path)
    return found


def full_load(df: DataFrame, table: SourceTable, zone: str, at: datetime, fmt: str = "csv") -> dict:
    """All rows as one batch. A source found empty writes no batch."""
    path = f"{zone}/{target_path(table, 'full_load', batch_id(at))}"
    done = _write_observed(audit_columns(df, at, table.id_column, "I"), table, path, fmt)
    return {"table": table.name, "status": "success", "rows": done["rows"], "path": path if done["rows"] else None, "watermark": done["watermark"]}


def cdc_load(df: DataFrame, table: SourceTable, zone: str, at: datetime, watermark: datetime | None = None, fmt: str = "csv") -> dict:
    """Changed rows since the watermark; an empty batch keeps the watermark."""
    changed = jdbc.incremental(df, table.tracking, watermark, table.pattern)
    path = f"{zone}/{target_path(table, 'cdc', batch_id(at))}"
    done = _write_observed(audit_columns(changed, at, table.id_column, "U", delete_when=table.delete_when), table, path, fmt)
    counts = {c: done[c] for c in ("rows", "inserts", "updates", "deletes")}
    return {"table": table.name, "status": "success"} | counts | {"path": path if done["rows"] else None, "watermark": done["watermark"] or watermark}


def snapshot_changes(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """Changes between two snapshots of a table without a log: op, the row, and
    the columns that changed.

    I and U carry the row after the change, D the row that went. Rows are
    compared null-safely over the new snapshot's columns (a column only one side
    has counts as null on the other). Snapshots hold one row a key; of several
    the one of least hash counts, and rows with a null in the key take no part.
    One full join of two plain shuffles on the key.
    """
    keys = [key] if isinstance(key, str) else key
    columns = new.columns
    sides = []
    for df, name in ((old, "_old"), (new, "_new")):
        have = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in columns])
        row = F.struct(*[F.col(f"`{c}`") for c in columns])
        clean_rows = have.where(F.forall(F.array(*[F.col(f"`{k}`").isNotNull() for k in keys]), lambda x: x))
        sides.append(clean_rows.groupBy(*keys).agg(F.min_by(row, F.xxhash64(row)).alias(name)))
    both = sides[0].join(sides[1], keys, "full")
    before, after = F.col("_old"), F.col("_new")
    changed = F.filter(F.array(*[F.when(~before[c].eqNullSafe(after[c]), F.lit(c)) for c in columns if c not in keys]), lambda c: c.isNotNull())
    op = F.when(before.isNull(), "I").when(after.isNull(), "D").when(F.size(changed) > 0, "U")
    out = both.select(op.alias("op"), F.coalesce(after, before).alias("_row"), F.when(op == "U", changed).alias("changed_columns")).where("op is not null")
    return out.select("op", *[F.col("_row")[c].alias(c) for c in columns], "changed_columns")


def apply_snapshot(old: DataFrame, changes: DataFrame, key: str | list[str]) -> DataFrame:
    """The snapshot that ``snapshot_changes`` came from, out of the one before."""
    keys = [key] if isinstance(key, str) else key
    come = changes.where("op != 'D'").drop("op", "changed_columns")
    return old.join(changes.select(*keys), keys, "left_anti").unionByName(come, allowMissingColumns=True)


def run_tables(tables: list[SourceTable], load: Callable[[SourceTable], dict], spark: SparkSession | None = None, at_once: int = 1) -> dict:
    """Run every table; a failure is recorded and the rest go on.

    With a session up to ``at_once`` tables run side by side, each in a
    scheduler pool of its own name, so that short loads are not held up behind
    long ones; results come in the order of the tables.
    """

    def one(t: SourceTable) -> dict:
        if spark is not None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{t.schema}.{t.name}")
        try:
            return load(t)
        except Exception as e:  # reported in the result of this table
            return {"table": t.name, "status": "failed", "rows": 0, "error": str(e)}

    if spark is None or at_once < 2:
        results = [one(t) for t in tables]
    else:
        with ThreadPoolExecutor(at_once) as pool:
            # Wrapped one by one: each thread needs properties of its own.
            results = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(one), t) for t in tables]]
    ok = [r for r in results if r["status"] == "success"]
    return {"results": results, "succeeded": len(ok), "failed": len(results) - len(ok), "rows": sum(r["rows"] for r in ok)}
