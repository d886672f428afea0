"""Schema contracts, the versioned registry, the catalog and lineage."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators.alerts import metric_rows
from tarnlake.operators.staging import TableConfig
from tarnlake.session import materialize, release

# What a new and a missing column cost.
NEW_COST, MISSING_COST = 5, 10

FIELDS = "table_name string, position int, column_name string, data_type string, nullable boolean"
REGISTRY = f"{FIELDS}, asset_type string, version int, is_active boolean, created_by string, created_at timestamp"


def canonical(t: T.DataType) -> str:
    """Engine-neutral name of a type."""
    name = t.typeName()
    if isinstance(t, T.DecimalType):
        return f"decimal({t.precision},{t.scale})"
    if isinstance(t, T.ArrayType):
        return f"array<{canonical(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{canonical(t.keyType)},{canonical(t.valueType)}>"
    if isinstance(t, T.StructType):
        return f"struct<{','.join(f'{f.name}:{canonical(f.dataType)}' for f in t)}>"
    if isinstance(t, (T.CharType, T.VarcharType)):
        return "string"
    if isinstance(t, T.DayTimeIntervalType):
        return "interval"
    table = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint", "float": "float", "double": "double"}
    table |= {"timestamp_ntz": "timestamp", "void": "string", "variant": "json"}
    return table.get(name, name)


# Names of database types and what they become.
DATABASE_TYPES = {
    "integer": "integer",
    "bigint": "bigint",
    "smallint": "smallint",
    "numeric": "decimal",
    "real": "float",
    "double precision": "double",
    "character varying": "string",
    "varchar": "string",
    "character": "string",
    "char": "string",
    "text": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp without time zone": "timestamp",
    "timestamp with time zone": "timestamp",
    "time without time zone": "time",
    "time with time zone": "time",
    "bytea": "binary",
    "json": "json",
    "jsonb": "json",
    "uuid": "string",
    "array": "array",
}


def database_type(name: str) -> str:
    """Engine-neutral name of a database type; lengths are left out, and a type
    that the table does not list is a string."""
    return DATABASE_TYPES.get(re.sub(r"\s*\(.*?\)", "", name.lower()).strip(), "string")


def schema_rows(df: DataFrame, table: str) -> DataFrame:
    rows = [(table, i + 1, f.name, canonical(f.dataType), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, FIELDS)


def expected_schema(spark: SparkSession, config: TableConfig, staged: bool = False) -> DataFrame:
    """Columns that a config says a raw (or staged) table has."""
    rows = [(config.name, i + 1, m.target if staged else m.source, m.kind if staged else "string", True) for i, m in enumerate(config.mapping)]
    return spark.createDataFrame(rows, FIELDS)


def drift(expected: DataFrame, actual: DataFrame, types: bool = False) -> DataFrame:
    """(column_name, change, expected_type, actual_type, severity)."""
    e = expected.select("column_name", F.col("data_type").alias("expected_type"))
    a = actual.select("column_name", F.col("data_type").alias("actual_type"))
    change = F.when(F.col("expected_type").isNull(), "new").when(F.col("actual_type").isNull(), "missing")
    if types:
        change = change.when(F.col("expected_type") != F.col("actual_type"), "type_changed")
    out = e.join(a, "column_name", "full").withColumn("change", change).where("change is not null")
    return out.withColumn("severity", F.when(F.col("change") == "missing", "error").otherwise("warning"))


def integrity(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Counts and the score max(0, matched / expected * 100 - 5 new - 10 missing)."""
    both = expected.select("column_name", F.lit(1).alias("e")).join(actual.select("column_name", F.lit(1).alias("a")), "column_name", "full")
    out = both.agg(
        F.count("e").alias("expected"),
        F.count_if(F.col("e").isNotNull() & F.col("a").isNotNull()).alias("matched"),
        F.count_if(F.col("e").isNull()).alias("new"),
        F.count_if(F.col("a").isNull()).alias("missing"),
    )
    share = F.coalesce(F.col("matched") / F.nullif(F.col("expected"), F.lit(0)) * 100, F.lit(100.0))
    score = F.greatest(F.lit(0.0), share - NEW_COST * F.col("new") - MISSING_COST * F.col("missing"))
    return out.withColumn("integrity", F.round(score, 2))


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def active(registry: DataFrame) -> DataFrame:
    return registry.where("is_active")


def evolution(registry: DataFrame, found: DataFrame) -> DataFrame:
    """(table_name, column_name, change, old_type, new_type) against the active
    versions of the tables in ``found``."""
    tables = found.select("table_name").distinct()
    old = active(registry).join(tables, "table_name", "left_semi").select("table_name", "column_name", F.col("data_type").alias("old_type"))
    known = old.select("table_name").distinct()
    new = found.join(known, "table_name", "left_semi").select("table_name", "column_name", F.col("data_type").alias("new_type"))
    both = old.join(new, ["table_name", "column_name"], "full")
    change = (
        F.when(F.col("old_type").isNull(), "column_added")
        .when(F.col("new_type").isNull(), "column_removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    return both.withColumn("change", change).where("change is not null")


def register(registry: DataFrame, found: DataFrame, asset_type: str, by: str, at: str) -> DataFrame:
    """The registry with new versions of the tables whose fields changed.

    An unchanged schema keeps its version; a changed one gets the next, and
    the version before is no longer active.
    """
    sign = F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("column_name", "data_type", "nullable")))), 256)
    now = active(registry).groupBy("table_name").agg(sign.alias("old"), F.max("version").alias("v"))
    top = registry.groupBy("table_name").agg(F.max("version").alias("top"))
    come = found.groupBy("table_name").agg(sign.alias("new")).join(now, "table_name", "left").join(top, "table_name", "left")
    changed = come.where(F.col("old").isNull() | (F.col("old") != F.col("new")))
    changed = changed.select("table_name", (F.coalesce("top", F.lit(0)) + 1).cast("int").alias("version"))
    rows = found.join(changed, "table_name").select(
        *[F.col(c) for c in ("table_name", "position", "column_name", "data_type", "nullable")],
        F.lit(asset_type).alias("asset_type"),
        "version",
        F.lit(True).alias("is_active"),
        F.lit(by).alias("created_by"),
        F.lit(at).cast("timestamp").alias("created_at"),
    )
    old = registry.join(changed.select("table_name", F.lit(True).alias("_c")), "table_name", "left")
    old = old.withColumn("is_active", F.col("is_active") & F.col("_c").isNull()).select(registry.columns)
    return old.unionByName(rows)


def get_schema(registry: DataFrame, table: str, version: int | None = None) -> DataFrame:
    """Fields of the active or of one version, in order."""
    df = registry.where(F.col("table_name") == table)
    return df.where(F.col("is_active") if version is None else F.col("version") == version).orderBy("position")


def schema_history(registry: DataFrame, table: str) -> DataFrame:
    df = registry.where(F.col("table_name") == table)
    return df.groupBy("version", "is_active", "created_by", "created_at").agg(F.count(F.lit(1)).alias("columns")).orderBy(F.desc("version"))


def changes_since(log: DataFrame, since: str, column: str = "detected_at") -> DataFrame:
    return log.where(F.col(column) >= F.lit(since).cast("timestamp"))


def catalog_summary(registry: DataFrame) -> DataFrame:
    tables = active(registry).select("asset_type", "table_name").distinct()
    return tables.groupBy("asset_type").agg(F.count(F.lit(1)).alias("tables"), F.array_sort(F.collect_list("table_name")).alias("names"))


def asset_type(table: str) -> str:
    return "dimension" if table.startswith("dim_") else "fact" if table.startswith("fact_") else "other"


def crawl_lake(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, path, file_count, size_bytes, partition_keys) of the first
    path level below ``root``; files are listed by Spark's file source."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    rest = F.expr(f"substring(path, instr(path, '{root.rstrip('/').split('://')[-1]}') + {len(root.rstrip('/').split('://')[-1]) + 1})")
    named = files.select("length", rest.alias("rest")).withColumn("table_name", F.substring_index("rest", "/", 1))
    keys = F.filter(F.split("rest", "/"), lambda x: x.contains("="))
    named = named.withColumn("keys", F.transform(keys, lambda x: F.substring_index(x, "=", 1)))
    out = named.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("size_bytes"), F.max("keys").alias("partition_keys")
    )
    return out.withColumn("path", F.concat(F.lit(root.rstrip("/") + "/"), "table_name"))


def run_crawler(spark: SparkSession, registry: DataFrame, root: str, by: str, at: str) -> tuple[DataFrame, dict]:
    """Register every table below ``root``; an unreadable one is counted only."""
    counts, found = {"new": 0, "updated": 0, "unchanged": 0, "failed": 0}, None
    known = {r.table_name for r in active(registry).select("table_name").distinct().collect()}
    for t in crawl_lake(spark, root).select("table_name", "path").collect():  # one row per table
        try:
            rows = schema_rows(spark.read.parquet(t.path), t.table_name)
        except Exception:  # counted; the crawl goes on
            counts["failed"] += 1
            continue
        found = rows if found is None else found.unionByName(rows)
        counts["new"] += t.table_name not in known
    if found is None:
        return registry, counts
    counts["updated"] = evolution(registry, found).select("table_name").distinct().count()
    counts["unchanged"] = len({r.table_name for r in found.select("table_name").distinct().collect()} & known) - counts["updated"]
    return register(registry, found, "staging", by, at), counts


def crawl_catalog(spark: SparkSession, patterns: tuple[str, ...] = ("dim_*", "fact_*", "etl_*")) -> DataFrame:
    """(table_name, asset_type, row_count) of catalog tables by name pattern."""
    names = sorted({t.name for p in patterns for t in spark.catalog.listTables(pattern=p)})
    rows = [(n, asset_type(n), spark.table(n).count()) for n in names]
    return spark.createDataFrame(rows, "table_name string, asset_type string, row_count long")


def _shorter(*links: DataFrame) -> DataFrame:
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out.groupBy("source", "target").agg(F.min("distance").alias("distance"))


def lineage_closure(edges: DataFrame) -> DataFrame:
    """(source, target, distance) of every pair of assets joined by a path.

    Paths are doubled: each round joins the paths found with one another, so a
    chain of n steps takes about log2(n) rounds; it ends when a round finds
    neither a new pair nor a shorter path. Cycles end too, and give the pair of
    an asset with itself. The result is as large as the closure, which lineage
    graphs (assets, not rows) keep small beside the data.
    """
    paths = edges.where("source is not null and target is not null").select("source", "target", F.lit(1).cast("long").alias("distance"))
    paths, state = materialize(_shorter(paths), "lineage"), None
    while (now := paths.agg(F.count(F.lit(1)), F.sum("distance")).first()) != state:
        state, old = now, paths
        onward = paths.select(F.col("source").alias("target"), F.col("target").alias("_far"), F.col("distance").alias("_more"))
        joined = paths.join(onward, "target").select("source", F.col("_far").alias("target"), (F.col("distance") + F.col("_more")).alias("distance"))
        paths = materialize(_shorter(paths, joined), "lineage")
        release(old)
    return paths


def upstream(edges: DataFrame, asset: str) -> DataFrame:
    """(asset, distance) of everything that ``asset`` is made from, however far;
    ``edges`` has source and target.

    Steps double: what lies within d steps of the asset and paths of up to d
    steps give what lies within 2d. Paths are only followed from assets reached
    by some path, so a round costs one join of the paths with themselves and one
    with the assets found. An asset on a cycle is not its own source.
    """
    step = edges.where("source is not null and target is not null").select("source", "target", F.lit(1).cast("long").alias("distance"))
    jumps = materialize(_shorter(step), "lineage")
    seen = materialize(jumps.where(F.col("target") == asset).select(F.col("source").alias("asset"), "distance"), "lineage")
    state = None
    while (now := seen.agg(F.count(F.lit(1)), F.sum("distance")).first()) != state:
        state, old = now, (seen, jumps)
        further = seen.join(jumps.withColumnRenamed("distance", "_more"), F.col("asset") == F.col("target")).select(F.col("source").alias("asset"), (F.col("distance") + F.col("_more")).alias("distance"))
        seen = materialize(seen.unionByName(further).groupBy("asset").agg(F.min("distance").alias("distance")), "lineage")
        onward = jumps.select(F.col("source").alias("target"), F.col("target").alias("_far"), F.col("distance").alias("_more"))
        joined = jumps.join(onward, "target").select("source", F.col("_far").alias("target"), (F.col("distance") + F.col("_more")).alias("distance"))
        jumps = materialize(_shorter(jumps, joined), "lineage")
        release(*old)
    release(jumps)
    return seen.where(F.col("asset") != asset)


RUNS = (
    "run_id string, pipeline_name string, status string, start_time timestamp, end_time timestamp, "
    "records_read long, records_written long, records_rejected long, error_message string, run_metadata string"
)
TASK_RUNS = "run_id string, task_name string, task_type string, status string, start_time timestamp, end_time timestamp, records_processed long, error_message string"


def record_run(spark: SparkSession, root: str, run: dict, tasks: list[dict]) -> None:
    """Append a pipeline run and its task runs to the run tables below ``root``;
    fields that are not given are NULL."""
    for name, shape, rows in (("pipeline_runs", RUNS, [run]), ("task_runs", TASK_RUNS, [{"run_id": run["run_id"]} | t for t in tasks])):
        fields = [c.split()[0] for c in shape.split(", ")]
        if rows:
            spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], shape).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def run_history(spark: SparkSession, root: str) -> DataFrame:
    """Runs with their duration, tasks and failed tasks, newest first."""
    runs, tasks = (spark.read.schema(s).parquet(f"{root}/{n}") for n, s in (("pipeline_runs", RUNS), ("task_runs", TASK_RUNS)))
    counted = tasks.groupBy("run_id").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("status") == "failed").alias("failed_tasks"), F.sum("records_processed").alias("records_processed"))
    seconds = F.timestamp_diff("SECOND", "start_time", "end_time").alias("seconds")
    out = runs.join(counted, "run_id", "left").select("run_id", "pipeline_name", "status", seconds, "records_read", "records_written", "records_rejected", F.coalesce("tasks", F.lit(0)).alias("tasks"), F.coalesce("failed_tasks", F.lit(0)).alias("failed_tasks"), "records_processed", "error_message", "start_time")
    return out.orderBy(F.desc("start_time"), "run_id")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of greatest ``order`` per key."""
    w = W.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def drift_log(found: DataFrame, table: str, stage: str, at: str) -> DataFrame:
    """Drift rows as a log table to append."""
    return found.select(
        F.lit(table).alias("table_name"), F.lit(stage).alias("stage"), "column_name", "change", "severity", F.lit(at).cast("timestamp").alias("detected_at")
    )


def drift_metrics(score: DataFrame, table: str, at: str) -> DataFrame:
    """The integrity score of a table and how many columns are new and missing,
    as gauges; ``score`` is what ``integrity`` gives."""
    names = {"schema_integrity_score": "integrity", "schema_new_columns_count": "new", "schema_missing_columns_count": "missing"}
    named = score.select(*[F.col(c).cast("double").alias(n) for n, c in names.items()])
    return metric_rows(named, list(names), {"table_name": table}, at)


def compare_stages(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """Schema and rows of two stages of a table in one frame: a row a column with
    where it is and its types, and the rows of both stages beside it."""
    sides = [schema_rows(df, table).select("column_name", F.col("position").alias(f"{n}_position"), F.col("data_type").alias(f"{n}_type")) for df, n in ((source, "source"), (target, "target"))]
    place = F.when(F.col("target_type").isNull(), "source_only").when(F.col("source_type").isNull(), "target_only").otherwise("both")
    rows = [df.agg(F.count(F.lit(1)).alias(f"{n}_rows")) for df, n in ((source, "source"), (target, "target"))]
    out = sides[0].join(sides[1], "column_name", "full").withColumn("place", place)
    out = out.crossJoin(F.broadcast(rows[0])).crossJoin(F.broadcast(rows[1]))  # one row each
    return out.select(F.lit(table).alias("table_name"), "column_name", "place", "source_type", "target_type", "source_rows", "target_rows", (F.col("target_rows") - F.col("source_rows")).alias("row_change"))


def crawl_footers(spark: SparkSession, root: str, tables: list[str], parts: dict[str, list[str]] | None = None) -> DataFrame:
    """(table_name, partition, row_count) of Parquet tables below ``root``, from
    the files' footers alone: Spark answers counts by partition columns from
    row-group metadata, and no data page is read."""
    conf = spark.conf
    before = {k: conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    conf.set("spark.sql.sources.useV1SourceList", "")
    conf.set("spark.sql.parquet.aggregatePushdown", True)
    try:
        found = []
        for t in tables:
            keys = (parts or {}).get(t, [])
            df = spark.read.parquet(f"{root}/{t}").groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            part = F.concat_ws("/", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]) if keys else F.lit("")
            # Written while the footers answer: the settings are the session's.
            answered = materialize(df.select(F.lit(t).alias("table_name"), part.alias("partition"), "row_count"), "footers")
            found.append(answered.withColumn("row_count", F.coalesce("row_count", F.lit(0))))
    finally:
        for k, v in before.items():
            conf.set(k, v)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def crawl_warehouse(spark: SparkSession, patterns: tuple[str, ...] = ("dim_*", "fact_*", "etl_*")) -> DataFrame:
    """(table_name, asset_type, position, column_name, data_type, nullable, is_key)
    of catalog tables by name pattern. Keys are the columns that the catalog
    marks as bucketing or partitioning the table, and the surrogate key of a
    dimension (the column named after it with ``_sk``)."""
    rows = []
    for name in sorted({t.name for p in patterns for t in spark.catalog.listTables(pattern=p)}):
        marked = {c.name: c.isBucket or c.isPartition for c in spark.catalog.listColumns(name)}
        own = f"{name.removeprefix('dim_').removeprefix('fact_')}_sk"
        rows += [(name, asset_type(name), i + 1, f.name, canonical(f.dataType), f.nullable, bool(marked.get(f.name)) or f.name == own) for i, f in enumerate(spark.table(name).schema)]
    return spark.createDataFrame(rows, "table_name string, asset_type string, position int, column_name string, data_type string, nullable boolean, is_key boolean")
