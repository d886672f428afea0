"""Relational sources through any Python database driver.

A Spark data source reads a table in key ranges, one query a range and shard;
filters that the database can judge travel with the query. The class below has
the interface of the JDBC source, for databases whose JDBC driver is not at hand.
"""

from __future__ import annotations

import importlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "tarnlake_db"
#: Rows that a task holds at a time.
FETCH = 10_000
MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
#: Where the column list of a table is found: SQLite has no information schema.
CATALOG = {
    "sqlite3": (
        "SELECT name AS table_name FROM sqlite_master WHERE type = 'table' ORDER BY name",
        "SELECT name AS column_name, lower(type) AS data_type, CASE \"notnull\" WHEN 0 THEN 'YES' ELSE 'NO' END AS is_nullable, "
        "dflt_value AS column_default, cid + 1 AS ordinal_position FROM pragma_table_info('{table}')",
    )
}
INFORMATION = (
    "SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE'",
    "SELECT column_name, data_type, is_nullable, column_default, ordinal_position FROM information_schema.columns WHERE table_schema = '{schema}' AND table_name = '{table}'",
)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class KeyRange(InputPartition):
    """One shard's rows whose key lies in [low, high), or is null."""

    shard: int
    where: str = ""
    values: tuple = ()


class DatabaseReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, dict(options)
        self.driver = options["driver"]
        self.shards = json.loads(options["shards"])
        self.key, self.parts = options.get("key"), int(options.get("parts", 1))
        self.source = f"({options['query']}) AS q" if options.get("query") else options["table"]
        self.pushed: list[tuple[str, tuple]] = [(options["where"], ())] if options.get("where") else []

    def _connect(self, shard: int):
        module = importlib.import_module(self.driver)
        return module.connect(**self.shards[shard]), MARKS[module.paramstyle]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Comparisons of a column with a plain value go into the query; Spark
        judges the rest, and times, whose text form is the database's own."""
        mark = MARKS[importlib.import_module(self.driver).paramstyle]
        for f in filters:
            column = _quoted(".".join(f.attribute)) if hasattr(f, "attribute") else None
            plain = lambda *v: all(isinstance(x, (int, float, str)) and not isinstance(x, bool) for x in v)
            if type(f) in COMPARED and plain(f.value):
                self.pushed.append((f"{column} {COMPARED[type(f)]} {mark}", (f.value,)))
            elif isinstance(f, In) and f.value and plain(*f.value):
                self.pushed.append((f"{column} IN ({', '.join([mark] * len(f.value))})", tuple(f.value)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.pushed.append((f"{column} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", ()))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Equal ranges of each shard's whole-number key, and its null keys."""
        found: list[InputPartition] = []
        for i in range(len(self.shards)):
            if not self.key or self.parts < 2:
                found.append(KeyRange(i))
                continue
            key, (base, mark) = _quoted(self.key), self._connect(i)
            try:
                cursor = base.cursor()
                cursor.execute(f"SELECT min({key}), max({key}) FROM {self.source}")
                low, high = cursor.fetchone()
            finally:
                base.close()
            if isinstance(low, int) and isinstance(high, int):
                cuts = sorted({low + (high + 1 - low) * j // self.parts for j in range(self.parts + 1)})
                found += [KeyRange(i, f"{key} >= {mark} AND {key} < {mark}", (a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
                found.append(KeyRange(i, f"{key} IS NULL"))
            else:
                found.append(KeyRange(i))
        return found

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        wheres = [*self.pushed, *([(partition.where, partition.values)] if partition.where else [])]
        sql = f"SELECT {', '.join(_quoted(f.name) for f in self.schema)} FROM {self.source}"
        if wheres:
            sql += " WHERE " + " AND ".join(f"({w})" for w, _ in wheres)
        shape, (base, _) = to_arrow_schema(self.schema), self._connect(partition.shard)
        try:
            cursor = base.cursor()
            cursor.execute(sql, tuple(v for _, values in wheres for v in values))
            while rows := cursor.fetchmany(FETCH):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)
        finally:
            base.close()


class DatabaseSource(DataSource):
    """Options: driver (a DB-API module), shards (JSON list of its connect
    arguments), table or query, where (the database's own SQL), key and parts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DatabaseReader:
        return DatabaseReader(schema, self.options)


#: Database types and the types they are read as; others are read as text.
READ_AS = {"int": "bigint", "integer": "bigint", "bigint": "bigint", "smallint": "bigint", "real": "double", "double": "double", "double precision": "double", "float": "double"}


@dataclass
class Database:
    """One logical database on one or more shards with the same tables.

    ``shards`` are the connect arguments of each; executors connect by
    themselves, so a file database must lie where all of them see it.
    """

    driver: str
    shards: list[dict]
    schema: str = "main"
    options: dict = field(default_factory=dict)

    def _ask(self, sql: str, shard: int = 0) -> list[tuple]:
        base = importlib.import_module(self.driver).connect(**self.shards[shard])
        try:
            cursor = base.cursor()
            cursor.execute(sql)
            return cursor.fetchall()
        finally:
            base.close()

    def tables(self) -> list[str]:
        sql = CATALOG.get(self.driver, INFORMATION)[0].format(schema=self.schema)
        return sorted({r[0] for i in range(len(self.shards)) for r in self._ask(sql, i)})

    def columns(self, spark: SparkSession, table: str) -> DataFrame:
        """(column_name, data_type, is_nullable, column_default, ordinal_position)."""
        rows = self._ask(CATALOG.get(self.driver, INFORMATION)[1].format(schema=self.schema, table=table))
        return spark.createDataFrame(rows, "column_name string, data_type string, is_nullable string, column_default string, ordinal_position int")

    def count(self, table: str) -> int:
        """Rows of a table, counted by the databases."""
        return sum(self._ask(f"SELECT count(*) FROM {table}", i)[0][0] for i in range(len(self.shards)))

    def _shape(self, table: str) -> str:
        rows = self._ask(CATALOG.get(self.driver, INFORMATION)[1].format(schema=self.schema, table=table))
        return ", ".join(f"`{r[0]}` {READ_AS.get((r[1] or '').lower(), 'string')}" for r in rows)

    def _read(self, spark: SparkSession, shape: str, **options: object) -> DataFrame:
        spark.dataSource.register(DatabaseSource)
        spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
        r = spark.read.format(FORMAT).schema(shape).option("driver", self.driver).option("shards", json.dumps(self.shards))
        return r.options(**{k: str(v) for k, v in (self.options | options).items() if v is not None}).load()

    def table(self, spark: SparkSession, name: str, split_by: str | None = None, parts: int = 8, where: str | None = None) -> DataFrame:
        """A whole table, in ``parts`` key ranges of each shard; filters that
        Spark pushes become part of the queries."""
        return self._read(spark, self._shape(name), table=name, key=split_by, parts=parts, where=where)

    def query(self, spark: SparkSession, sql: str, shape: str) -> DataFrame:
        """The rows of a query, run on every shard."""
        return self._read(spark, shape, query=sql)

    def changed(self, spark: SparkSession, table: str, condition: str, split_by: str | None = None, parts: int = 8) -> DataFrame:
        """Rows that meet a condition in the database's own SQL, so that only
        changed rows travel."""
        return self.table(spark, table, split_by, parts, condition)


def write_shards(df: DataFrame, folder: str, table: str, key: str) -> Database:
    """Write ``df`` as SQLite shards below a folder that all executors see, one
    file a task, indexed by ``key``; times as text. A task that is run again
    replaces its own file at its end; no rows: one shard with an empty table."""
    os.makedirs(folder, exist_ok=True)
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    plain = df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, times) else F.col(f"`{f.name}`") for f in df.schema])
    kinds = {"bigint": "bigint", "int": "bigint", "double": "double", "float": "double"}
    cols = ", ".join(f"{_quoted(f.name)} {kinds.get(f.dataType.simpleString(), 'text')}" for f in plain.schema)
    marks = ", ".join("?" * len(plain.columns))

    def put(rows: Iterator[T.Row]) -> None:
        import sqlite3

        path = f"{folder}/shard-{TaskContext.get().partitionId():05d}.db"
        made = f"{path}.{uuid.uuid4().hex}"
        base = sqlite3.connect(made)
        base.execute(f"CREATE TABLE {table} ({cols})")
        base.executemany(f"INSERT INTO {table} VALUES ({marks})", (tuple(r) for r in rows))
        base.execute(f"CREATE INDEX by_{key} ON {table} ({_quoted(key)})")
        base.commit()
        base.close()
        os.replace(made, path)

    plain.foreachPartition(put)
    names = sorted(n for n in os.listdir(folder) if n.endswith(".db"))
    if not names:
        import sqlite3

        base = sqlite3.connect(f"{folder}/shard-00000.db")
        base.execute(f"CREATE TABLE {table} ({cols})")
        base.commit()
        base.close()
        names = ["shard-00000.db"]
    return Database("sqlite3", [{"database": f"{folder}/{n}"} for n in names])
