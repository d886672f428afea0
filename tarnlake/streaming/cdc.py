"""Change capture with Structured Streaming over a directory of change files."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo
from pyspark.sql.types import StructField, StructType

from tarnlake.functions import clean
from tarnlake.operators import ingest
from tarnlake.operators.alerts import SUPPRESS_MINUTES

#: A flush every ten seconds or so many files.
FLUSH, FILES_PER_FLUSH = "10 seconds", 100


def change_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", files: int = FILES_PER_FLUSH) -> DataFrame:
    """Change events (table_name, op, row fields) as they arrive."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files).load(path)


def captured(events: DataFrame, tables: list[str]) -> DataFrame:
    """Events of the monitored tables; updates carry the row after the change."""
    known = events.where(F.col("table_name").isin(tables) & F.col("op").isin("I", "U", "D"))
    return known.select("*", "after.*").drop("after") if "after" in events.columns else known


def capture(
    events: DataFrame, tables: list[str], out: str, checkpoint: str, id_column: str = "id", once: bool = True, at: datetime | None = None
) -> StreamingQuery:
    """Write each micro-batch, with audit columns, to a folder per table.
    ``at`` stands in for the time of the micro-batch.

    Resumes from the checkpoint; a batch that is run again replaces its own
    folder, so no event is written twice.
    """

    def flush(batch: DataFrame, n: int) -> None:
        now = at or datetime.now()
        audited = ingest.audit_columns(batch.withColumnRenamed("op", "_op"), now, id_column).withColumn("op", F.col("_op")).drop("_op")
        audited.persist()
        for t in tables:
            rows = audited.where(F.col("table_name") == t).drop("table_name")
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{out}/{t}/batch={n}")
        audited.unpersist()

    w = captured(events, tables).writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=FLUSH)).start()


#: The column of the state that tells which micro-batch brought a row.
BROUGHT = "_brought_"


def _ready(spark: SparkSession, root: str) -> bool:
    """Whether a query with its checkpoint below ``root`` has finished a batch."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(f"{root}/checkpoint/commits/[0-9]*")
    return len(found.getFileSystem(conf).globStatus(found) or []) > 0


def _started(w: DataStreamWriter, spark: SparkSession, root: str, once: bool) -> StreamingQuery:
    """Start a query whose state lies in Spark's RocksDB store; the session's
    own choice of store is as before afterwards."""
    conf, key = spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        w = w.option("checkpointLocation", f"{root}/checkpoint")
        return (w.trigger(availableNow=True) if once else w.trigger(processingTime=FLUSH)).start()
    finally:
        conf.set(key, before)


def apply_changes(events: DataFrame, key: str, order_by: list[str], root: str, once: bool = True) -> StreamingQuery:
    """Keep the current state of a table under change events.

    The newest row of each key (order columns descending, nulls last) is a
    streaming aggregate, kept in Spark's state store (its checkpoint lies below
    ``root``); ties fall to a hash of the whole row, as in the batch compaction.
    Deletes are kept as tombstones: a late older event must not revive a row. A
    micro-batch touches the state of its own keys only, holds one row of a key
    at a time, and writes the rows that are now current to a folder of its own
    below ``root/changes``; one that is run again replaces its folder. A
    restarted query goes on where the last batch ended.
    """
    now = F.unix_micros(F.current_timestamp())  # the micro-batch's time, the same if it is run again
    columns = [F.col(f"`{c}`") for c in events.columns]
    # Of equal rows the one that came first stays, so that a repeat is no change.
    rank = F.struct(*[F.col(f"`{c}`") for c in order_by if c in events.columns], F.bitwise_not(F.xxhash64(*columns)), -F.col(BROUGHT))
    newest = events.withColumn(BROUGHT, now).groupBy(key).agg(F.max_by(F.struct(*columns, BROUGHT), rank).alias("_row"))
    changed = newest.where(F.col("_row")[BROUGHT] == now).select("_row.*").drop(BROUGHT)

    def append(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={n}")

    return _started(changed.writeStream.outputMode("update").foreachBatch(append), events.sparkSession, root, once)


def current_state(spark: SparkSession, root: str, live_only: bool = False) -> DataFrame | None:
    """The state after the last finished batch, read from the state store, with
    tombstones unless ``live_only``. None before the first batch."""
    if not _ready(spark, root):
        return None
    df = spark.read.format("statestore").option("path", f"{root}/checkpoint").load()
    row = df.schema["value"].dataType.names[0]  # the aggregate's row, then its rank
    df = df.select(F.col("value")[row].alias("_row")).select("_row.*").drop(BROUGHT)
    return df.where("op IS NULL OR op != 'D'") if live_only else df


#: Times of a key that are gathered before repeats among them are folded.
FOLD_ROWS = 1_000_000


def _folded(times: array, codes: array, texts: dict[tuple, int]) -> tuple[array, array, dict[tuple, int]]:
    """Distinct times in order, each with the texts of least severity name and
    message (the first two; null before any), and only the texts still used."""
    t, c, known = np.frombuffer(times, np.int64), np.frombuffer(codes, np.int32), list(texts)
    rank = np.empty(len(known), np.int32)
    rank[sorted(range(len(known)), key=lambda i: [(v is not None, v) for v in known[i][:2]])] = np.arange(len(known), dtype=np.int32)
    order = np.lexsort((rank[c], t))
    t, c = t[order], c[order]
    first = np.ones(len(t), bool)
    first[1:] = t[1:] != t[:-1]
    used, c = np.unique(c[first], return_inverse=True)
    return array("q", t[first].tobytes()), array("i", c.astype(np.int32).tobytes()), {known[i]: n for n, i in enumerate(used)}


class _Quiet(StatefulProcessor):
    """Keeps the time of the last alert emitted for a key, in microseconds."""

    def __init__(self, names: list[str], step: int, expire: bool):
        self.names, self.step, self.expire = names, step, expire
        self.text = [j for j, n in enumerate(names) if n not in ("dedup_key", "at")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "at bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        old = last = self.last.get()[0] if self.last.exists() else None
        # Per time a number and the place of its texts, not the row: 12 bytes.
        times, codes, texts, folded = array("q"), array("i"), {}, 0
        for r in rows:
            if last is None or r.at >= last + self.step:
                times.append(r.at)
                codes.append(texts.setdefault(tuple(r[i] for i in self.text), len(texts)))
                if len(times) >= max(FOLD_ROWS, 2 * folded):
                    times, codes, texts = _folded(times, codes, texts)
                    folded = len(times)
        times, codes, texts = _folded(times, codes, texts)
        known, t, i = list(texts), np.frombuffer(times, np.int64), 0
        while i < len(t):
            last = int(t[i])
            said = dict(zip(self.text, known[codes[i]], strict=True))
            yield Row(*self.names)(*[key[0] if n == "dedup_key" else last if n == "at" else said[j] for j, n in enumerate(self.names)])
            i = int(np.searchsorted(t, last + self.step))
        if last != old:
            self.last.update((last,))
            if self.expire:
                self.handle.registerTimer((last + self.step) // 1000 + 1)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.last.exists() and (self.last.get()[0] + self.step) // 1000 < expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def suppressed_alerts(alerts: DataFrame, root: str, minutes: int = SUPPRESS_MINUTES, late: str | None = None, once: bool = True) -> StreamingQuery:
    """Alert stream to ``root/alerts``, repeats suppressed across micro-batches.

    The state of a key is the time of its last emitted alert, kept in Spark's
    state store; a micro-batch holds the distinct times of a key that it brings
    (12 bytes each, and their texts once), which the stream's own rate limit bounds. With ``late`` (an interval) that
    state is cleared by an event-time timer once it can suppress nothing more;
    alerts later than that are then dropped by Spark's watermark. Without it
    the state stays, one time a key, and no alert is dropped for its lateness.
    An alert older than the last emitted one counts as a repeat.
    """
    keyed = alerts.where("created_at is not null").withColumn("dedup_key", clean.alert_key(F.col("alert_type"), F.col("source"), F.col("title")))
    keyed = keyed.select("severity", "message", "alert_type", "source", "title", "dedup_key", F.unix_micros("created_at").alias("at"), "created_at")
    if late:
        keyed = keyed.withWatermark("created_at", late)
    quiet = _Quiet(keyed.columns[:-1], minutes * 60_000_000, late is not None)
    shape = StructType([StructField(f.name, f.dataType) for f in keyed.schema if f.name != "created_at"])
    out = keyed.groupBy("dedup_key").transformWithState(quiet, shape, "Append", "EventTime" if late else "None")
    out = out.select("dedup_key", "alert_type", "severity", "source", "title", "message", F.timestamp_micros("at").alias("created_at"))
    return _started(out.writeStream.format("parquet").option("path", f"{root}/alerts"), alerts.sparkSession, root, once)


def lag_seconds(batch: DataFrame, event_time: str, as_of: str) -> DataFrame:
    """How far behind the newest event is."""
    age = clean.seconds_between(F.max(F.col(event_time).cast("timestamp_ntz")), F.lit(as_of))
    return batch.agg(age.alias("lag_seconds"))


def poll(spark: SparkSession, read, tables: list[ingest.SourceTable], zone: str, marks: dict, at: datetime) -> dict:
    """One polling round: changed rows of every table since its watermark."""
    return ingest.run_tables(tables, lambda t: ingest.cdc_load(read(t), t, zone, at, marks.get(t.name)))
