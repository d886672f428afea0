"""Readers and writers of the landing zone and of staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.functions import clean


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: Quotes are doubled inside quoted fields, which may hold line breaks.
CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def read_landing(spark: SparkSession, path: str, null_words: bool = True) -> DataFrame:
    """All CSV files below ``path``, strings, united by column name.

    One read over files with different headers would map columns by position,
    so files are grouped by their header line first: the first line of each
    file, found inside the tasks. A field that spans lines leaves an odd number
    of quotes on the line where it begins: only files with such a line are read
    whole by one task each, all others are split like any text. Where all files
    have one header and none such a line, which is the rule, their paths never
    reach the driver. No files: a frame without columns.
    """
    found = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
    try:
        lines = spark.read.options(**found).text(path)
        lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
        odd = F.regexp_count("value", F.lit('"')) % 2 == 1
        first = F.when(F.col("block") == 0, F.col("value"))
        lines = lines.withColumns({"odd": odd, "first": first, "nth": F.when(F.col("block") == 0, F.monotonically_increasing_id())})
        headers = lines.groupBy("path").agg(F.min_by("first", "nth").alias("line"), F.max("odd").alias("whole"))
        headers = headers.withColumn("line", F.regexp_replace("line", r"^\x{FEFF}", ""))
        kinds = headers.select("line", "whole").distinct().collect()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], "struct<>")
        raise
    if not kinds:
        return spark.createDataFrame([], "struct<>")
    if len(kinds) == 1:
        df = spark.read.options(**CSV | {"multiLine": kinds[0].whole}, **found).csv(path)
    else:
        groups = headers.groupBy("line", "whole").agg(F.collect_list("path").alias("paths")).collect()
        df = _union([spark.read.options(**CSV | {"multiLine": g.whole}).csv(sorted(g.paths)) for g in sorted(groups)])
    return df.select(*[clean.null_words(F.col(f"`{c}`")).alias(c) for c in df.columns]) if null_words else df


def read_batch(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """A batch as ``write_raw`` wrote it, with the types it had."""
    return spark.read.schema(schema).options(**CSV).csv(path) if fmt == "csv" else spark.read.parquet(path)


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """CSV (types inferred) and Parquet below one prefix; unreadable files are
    skipped. A column whose types differ between the two becomes text."""
    kinds = {"csv": {"header": True, "inferSchema": True}, "parquet": {"mergeSchema": True}}
    frames = []
    for kind, options in kinds.items():
        r = spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}").option("ignoreCorruptFiles", True)
        try:
            df = r.options(**options).load(path)
        except Exception as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e) and "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        if df.columns:
            frames.append(df)
    if len(frames) == 2:
        kinds = [dict(f.dtypes) for f in frames]
        differ = [c for c in kinds[0] if kinds[1].get(c, kinds[0][c]) != kinds[0][c]]
        frames = [f.withColumns({c: F.col(f"`{c}`").cast("string") for c in differ}) for f in frames]
    return _union(frames) if frames else spark.createDataFrame([], "struct<>")


def read_one(spark: SparkSession, path: str) -> DataFrame:
    """A single CSV or Parquet object by its suffix."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.options(**CSV).csv(path)


def write_raw(df: DataFrame, path: str, fmt: str = "csv", compression: str = "snappy") -> None:
    """A raw batch; a batch folder is written once."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt}")
    w = df.write.mode("errorifexists")
    (w.options(header=True, quote='"', escape='"').csv(path) if fmt == "csv" else w.option("compression", compression).parquet(path))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)


def write_partitioned(df: DataFrame, path: str, parts: list[str], dynamic: bool = False) -> None:
    """Overwrite a staged table, one folder per partition value.

    ``rebalance`` rather than a plain repartition: adaptive execution splits a
    value that holds very many rows. Parts that ``df`` lacks: no partitioning.
    """
    if not parts or not set(parts) <= set(df.columns):
        df.write.mode("overwrite").parquet(path)
        return
    w = df.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts)
    (w.option("partitionOverwriteMode", "dynamic") if dynamic else w).parquet(path)


def initial_load(spark: SparkSession, csv: str, target: str) -> int:
    """CSV as strings, NULL as '', replacing the target; returns the rows."""
    spark.read.options(**CSV).csv(csv).na.fill("").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).count()


def register_table(spark: SparkSession, name: str, path: str, ddl: str) -> DataFrame:
    """A typed external table over staged Parquet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def read_raw(spark: SparkSession, zone: str, table: str, schema: str = "main", prefix: str = "raw_") -> DataFrame:
    """All batches of a raw table, full loads and changes."""
    return read_landing(spark, f"{zone}/{schema}/{prefix}{table}")


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")
