"""Relational sources over JDBC, and the same extracts over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRACKING_PATTERN = "M/d/yyyy H:mm"


@dataclass
class JdbcSource:
    """A database read by Spark's own JDBC reader."""

    url: str
    properties: dict = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str, split_by: str | None = None, bounds: tuple | None = None, parts: int = 8, fetch: int = 10_000) -> DataFrame:
        """A whole table; with ``split_by`` and its bounds in parallel ranges."""
        r = spark.read.format("jdbc").option("url", self.url).options(**self.properties).option("fetchsize", fetch).option("dbtable", name)
        if split_by and bounds:
            r = r.option("partitionColumn", split_by).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
        return r.load()

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        return spark.read.format("jdbc").option("url", self.url).options(**self.properties).option("query", sql).load()

    def changed(self, spark: SparkSession, table: str, condition: str) -> DataFrame:
        """Rows that meet a condition in the database's own SQL, so that text
        times are compared there and only changed rows travel."""
        return self.query(spark, f"SELECT * FROM {table} WHERE {condition}")

    def count(self, spark: SparkSession, table: str) -> int:
        """Rows of a table, counted by the database."""
        return int(self.query(spark, f"SELECT count(*) AS n FROM {table}").first()[0])

    def tables(self, spark: SparkSession, schema: str) -> DataFrame:
        return self.query(spark, f"SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE'")

    def columns(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return self.query(
            spark,
            "SELECT column_name, data_type, is_nullable, column_default, ordinal_position FROM information_schema.columns "
            f"WHERE table_schema = '{schema}' AND table_name = '{table}'",
        )


def incremental(df: DataFrame, tracking: str, watermark: str | datetime | None, pattern: str = TRACKING_PATTERN, inclusive: bool = False) -> DataFrame:
    """Rows changed after the watermark, compared as times.

    Text is parsed on both sides; a text comparison would put September after
    December. ``inclusive`` reads rows of the watermark's own minute again, for
    a later dedup. Without a watermark all rows come.
    """
    text = dict(df.dtypes)[tracking] == "string"
    at = F.try_to_timestamp(F.col(tracking), F.lit(pattern)) if text else F.col(tracking)
    if watermark is None:
        return df
    mark = F.try_to_timestamp(F.lit(watermark), F.lit(pattern)) if isinstance(watermark, str) else F.lit(watermark)
    return df.where(at >= mark if inclusive else at > mark)


def describe(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) of a frame."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
