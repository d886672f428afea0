"""Alerts, metrics and logs as tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.session import materialize, release

ALERT = "alert_type string, severity string, source string, title string, message string, created_at timestamp"
# Severities from worst to least, score limits, lookback.
SEVERITIES = ("critical", "error", "warning", "info")
SCORE_LIMITS = {"completeness": 80.0, "uniqueness": 90.0, "validity": 90.0, "timeliness": 70.0, "overall": 75.0}
INTEGRITY_WARN, INTEGRITY_ERROR = 95.0, 80.0
REJECT_WARN, REJECT_CRITICAL = 5.0, 10.0
SUPPRESS_MINUTES = 60
#: Distinct times of a key that one task chains together.
BLOCK_ROWS = 50_000


def _alert(df: DataFrame, kind: str, severity, source, title, message, at: str) -> DataFrame:
    return df.select(
        F.lit(kind).alias("alert_type"),
        severity.alias("severity"),
        source.alias("source"),
        title.alias("title"),
        message.alias("message"),
        F.lit(at).cast("timestamp").alias("created_at"),
    )


def drift_alerts(drift: DataFrame, integrity: DataFrame, table: str, at: str) -> DataFrame:
    """New columns warn, missing ones are errors, a low integrity score is one
    or the other."""
    t = F.lit(table)
    rows = _alert(drift, "schema_drift", F.col("severity"), t, F.concat_ws(" ", "change", F.lit("column"), "column_name"), F.col("change"), at)
    low = integrity.where(F.col("integrity") < INTEGRITY_WARN)
    level = F.when(F.col("integrity") < INTEGRITY_ERROR, "error").otherwise("warning")
    return rows.unionByName(_alert(low, "schema_integrity", level, t, F.lit("schema integrity is low"), F.col("integrity").cast("string"), at))


def score_alerts(dimensions: DataFrame, at: str, limits: dict[str, float] | None = None) -> DataFrame:
    """Scores under their limit; under half of it they are critical."""
    limits = limits or SCORE_LIMITS
    table = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    scores = dimensions.unpivot(["table_name"], list(limits), "dimension", "score").withColumn("limit", table[F.col("dimension")])
    low = scores.where(F.col("score") < F.col("limit"))
    level = F.when(F.col("score") < F.col("limit") / 2, "critical").otherwise("warning")
    title = F.concat(F.col("dimension"), F.lit(" below limit"))
    message = F.format_string("%.2f < %.2f", "score", "limit")
    return _alert(low, "quality_score", level, F.col("table_name"), title, message, at)


def rejection_alerts(totals: DataFrame, summary: DataFrame, table: str, at: str) -> DataFrame:
    high = totals.where(F.col("rejection_rate") > REJECT_WARN)
    level = F.when(F.col("rejection_rate") > REJECT_CRITICAL, "critical").otherwise("warning")
    t = F.lit(table)
    rate = _alert(high, "rejection_rate", level, t, F.lit("rejection rate is high"), F.col("rejection_rate").cast("string"), at)
    worst = summary.where("severity = 'critical' AND records > 0")
    return rate.unionByName(_alert(worst, "critical_rule", F.lit("critical"), t, F.col("rule"), F.col("records").cast("string"), at))


def pii_alerts(scan: DataFrame, at: str, critical_from: int = 5) -> DataFrame:
    level = F.when(F.col("sensitivity") >= critical_from, "critical").otherwise("warning")
    title = F.concat_ws(" ", "pii_type", F.lit("in"), "column_name")
    return _alert(scan, "pii_detected", level, F.col("table_name"), title, F.col("matches").cast("string"), at)


def run_checks(
    at: str,
    table: str,
    drift: tuple[DataFrame, DataFrame] | None = None,
    dimensions: DataFrame | None = None,
    rejections: tuple[DataFrame, DataFrame] | None = None,
    pii: DataFrame | None = None,
) -> DataFrame | None:
    """The alerts of every check whose input is given, as one frame."""
    found = []
    if drift is not None:
        found.append(drift_alerts(*drift, table, at))
    if dimensions is not None:
        found.append(score_alerts(dimensions, at))
    if rejections is not None:
        found.append(rejection_alerts(*rejections, table, at))
    if pii is not None:
        found.append(pii_alerts(pii, at))
    return reduce(DataFrame.unionByName, found) if found else None


def built_alert(spark: SparkSession, kind: str, severity: str, source: str, title: str, message: str, at: str) -> DataFrame:
    """One alert; an unknown severity becomes a warning."""
    level = severity if severity in SEVERITIES else "warning"
    df = spark.range(1)
    return _alert(df, kind, F.lit(level), F.lit(source), F.lit(title), F.lit(message), at)


def freshness_alerts(tables: DataFrame, as_of: str, hours: float = 24.0) -> DataFrame:
    """Tables (table_name, last_update) that are older than allowed."""
    age = clean.seconds_between(F.col("last_update"), F.lit(as_of)) / 3600
    late = tables.withColumn("age", age).where(F.col("age") > hours)
    return _alert(late, "freshness", F.lit("warning"), F.col("table_name"), F.lit("table is stale"), clean.rounded(F.col("age")).cast("string"), as_of)


def _slot(t: str, step: int):
    return F.expr(f"({t} - pmod({t}, {step})) div {step}")


def _blocks(times: DataFrame, step: int, rows: int) -> DataFrame:
    """Times with ``block`` and their key's last block, ``final``. A block is a run
    of whole slots of one step, closed by the first that brings it to ``rows``
    times; the windows read one row for each of the key's slots."""
    dealt = times.withColumn("slot", _slot("t", step))
    before = W.partitionBy("dedup_key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = dealt.groupBy("dedup_key", "slot").agg(F.count(F.lit(1)).alias("n"))
    slots = slots.withColumn("block", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / rows))
    slots = slots.withColumn("final", F.max("block").over(W.partitionBy("dedup_key")))
    return dealt.join(slots.drop("n"), ["dedup_key", "slot"]).select("dedup_key", "t", "block", "final")


def _followers(t: np.ndarray, step: int) -> np.ndarray:
    """Of sorted times, the place of the first that is ``step`` or more after each."""
    return np.searchsorted(t, t + step)


def _passages(blocks: DataFrame, step: int) -> DataFrame:
    """(dedup_key, source, at) for every time at which a chain may enter a block:
    ``at`` is one step after the last time that the chain keeps there.

    A chain enters in the block's first slot or, where that suppresses none but
    earlier times, at the first time of a later slot.
    """

    def passages(table: pa.Table) -> pa.Table:
        t = np.sort(table.column("t").to_numpy())
        nxt = _followers(t, step)
        last = np.where(nxt == len(t), np.arange(len(t)), np.minimum(nxt, len(t) - 1))
        while not np.array_equal(last, last[last]):
            last = last[last]
        n = np.searchsorted(t, (t[0] // step + 1) * step) + 1
        key = table.column("dedup_key").slice(0, 1).combine_chunks()
        source = t[:n]
        return pa.table({"dedup_key": key.take(pa.array(np.zeros(len(source), np.int64))), "source": source, "at": t[last[:n]] + step})

    return blocks.groupBy("dedup_key", "block").applyInArrow(passages, "dedup_key string, source long, at long")


def _chains(entered: DataFrame, step: int) -> DataFrame:
    """(dedup_key, t) kept in every block, from the time that is marked ``entry``."""

    def chain(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("t").to_numpy())
        t, entry = table.column("t").to_numpy()[order], np.flatnonzero(table.column("entry").to_numpy()[order])
        nxt, kept, i = _followers(t, step), [], int(entry[0]) if len(entry) else len(t)
        while i < len(t):
            kept.append(i)
            i = int(nxt[i])
        return pa.table({"dedup_key": table.column("dedup_key").slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(kept), np.int64))), "t": t[kept]})

    return entered.groupBy("dedup_key", "block").applyInArrow(chain, "dedup_key string, t long")


def _links(times: DataFrame, probes: DataFrame, step: int) -> DataFrame:
    """(dedup_key, t, next): the first time of the key at or after each probe's ``at``.

    Times lie in slots of one step. What follows is in the slot of ``at`` or is
    the first time of a later slot, so no task sorts more than a slot of a key,
    or one row for each of the key's slots.
    """
    both = times.select("dedup_key", F.lit(None).cast("long").alias("source"), F.col("t").alias("at")).unionByName(probes).withColumn("slot", _slot("at", step))
    found = F.when(F.col("source").isNull(), F.col("at"))
    near = W.partitionBy("dedup_key", "slot").orderBy(F.desc("at"), F.col("source").isNotNull())
    asked = both.withColumn("here", F.last(found, ignorenulls=True).over(near.rowsBetween(W.unboundedPreceding, 0))).where("source is not null")
    slots = both.groupBy("dedup_key", "slot").agg(F.min(found).alias("first"))
    later = W.partitionBy("dedup_key").orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)
    after = slots.select("dedup_key", "slot", F.last("first", ignorenulls=True).over(later).alias("after"))
    linked = asked.join(after, ["dedup_key", "slot"]).select("dedup_key", F.col("source").alias("t"), F.coalesce("here", "after").alias("next"))
    return linked.where("next is not null")


def _reached(first: DataFrame, links: DataFrame) -> DataFrame:
    """Times on the chains of links that begin at ``first``.

    Each round goes four times as far as all rounds before it; it ends when no
    link is that long, which none is at last since every link leads to a later
    time. Every round is written, so the plan stays short.
    """
    hop = lambda a, b: a.join(b.select("dedup_key", F.col("t").alias("next"), F.col("next").alias("_far")), ["dedup_key", "next"]).select("dedup_key", "t", F.col("_far").alias("next"))
    step = lambda seen, j: seen.unionByName(j.join(seen, ["dedup_key", "t"], "left_semi").select("dedup_key", F.col("next").alias("t")))
    seen, jump = materialize(first, "reached"), materialize(links, "links")
    while not jump.isEmpty():
        old = seen, jump
        twice = materialize(hop(jump, jump.toDF(*jump.columns)), "links")
        seen = materialize(step(step(seen, jump), twice).distinct(), "reached")
        jump = materialize(hop(twice, twice.toDF(*twice.columns)), "links")
        release(*old, twice)
    release(jump)
    return seen


def suppress(alerts: DataFrame, minutes: int = SUPPRESS_MINUTES, last_emitted: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop repeats within ``minutes`` of the last alert *kept* for their key.

    Suppressed alerts do not extend the window. ``last_emitted`` (dedup_key,
    emitted_at) seeds the chain, so batches continue one another. The distinct
    times of a key are cut into blocks of about ``block_rows``; every time at
    which a chain may enter a block is linked to the one at which it enters the
    next, the entries that a key's first time leads to are found by doubling
    these links, and each block then keeps its own times. No task holds more
    than a block, or a slot of ``minutes`` where that has more times; the block
    size changes the work, not the result. Of alerts at one time the one of
    least severity name and message stays; alerts without a time or with a null
    in their key's parts take the same rules (a null is left out of the key),
    those without a time are dropped.
    """
    keyed = alerts.withColumn("dedup_key", clean.alert_key(F.col("alert_type"), F.col("source"), F.col("title"))).where("created_at is not null")
    step = minutes * 60_000_000
    times = keyed.select("dedup_key", F.unix_micros("created_at").alias("t")).distinct()
    if last_emitted is not None:
        seeds = last_emitted.groupBy("dedup_key").agg(F.max(F.unix_micros("emitted_at")).alias("_last"))
        times = times.join(seeds, "dedup_key", "left").where(F.col("_last").isNull() | (F.col("t") >= F.col("_last") + step)).drop("_last")
    times = materialize(times, "times")
    blocks = materialize(_blocks(times, step, block_rows), "blocks")
    entries, crossed = times.groupBy("dedup_key").agg(F.min("t").alias("t")), blocks.where("block < final")
    spent = [times, blocks]
    if not crossed.isEmpty():
        probes = materialize(_passages(crossed, step), "probes")
        entries = _reached(entries, _links(times, probes, step))
        spent += [probes, entries]
    marked = blocks.join(entries.withColumn("entry", F.lit(True)), ["dedup_key", "t"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kept = materialize(_chains(marked, step), "kept")
    release(*spent)
    kept = kept.select("dedup_key", F.timestamp_micros("t").alias("created_at"))
    first = keyed.groupBy("dedup_key", "created_at").agg(F.min(F.struct("severity", "message")).alias("_m"), *[F.min(c).alias(c) for c in ("alert_type", "source", "title")])
    out = first.join(kept, ["dedup_key", "created_at"], "left_semi")
    return out.select("dedup_key", "alert_type", "_m.severity", "source", "title", "_m.message", "created_at")


def acknowledge(alerts: DataFrame, keys: list[str], by: str, at: str) -> DataFrame:
    hit = F.col("dedup_key").isin(keys) & (F.col("status") == "open")
    return alerts.withColumns(
        {
            "status": F.when(hit, "acknowledged").otherwise(F.col("status")),
            "acknowledged_by": F.when(hit, by).otherwise(F.col("acknowledged_by")),
            "acknowledged_at": F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("acknowledged_at")),
        }
    )


def resolve(alerts: DataFrame, keys: list[str], note: str, at: str) -> DataFrame:
    hit = F.col("dedup_key").isin(keys) & (F.col("status") != "resolved")
    return alerts.withColumns(
        {
            "status": F.when(hit, "resolved").otherwise(F.col("status")),
            "resolution": F.when(hit, note).otherwise(F.col("resolution")),
            "resolved_at": F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("resolved_at")),
        }
    )


def opened(alerts: DataFrame) -> DataFrame:
    """New alerts with their life-cycle columns."""
    blank = {c: F.lit(None).cast(t) for c, t in (("acknowledged_by", "string"), ("acknowledged_at", "timestamp"), ("resolution", "string"), ("resolved_at", "timestamp"))}
    return alerts.withColumns({"status": F.lit("open")} | blank)


def severity_rank(c: str = "severity"):
    rank = F.lit(len(SEVERITIES))
    for i, s in reversed(list(enumerate(SEVERITIES))):
        rank = F.when(F.col(c) == s, i).otherwise(rank)
    return rank


def open_alerts(alerts: DataFrame, severity: str | None = None, limit: int = 100) -> DataFrame:
    """Unresolved alerts, worst first, then newest."""
    df = alerts.where("status != 'resolved'")
    df = df if severity is None else df.where(F.col("severity") == severity)
    return df.orderBy(severity_rank(), F.desc("created_at"), "dedup_key").limit(limit)


METRIC = "name string, kind string, value double, labels map<string,string>, recorded_at timestamp"


def metric(spark: SparkSession, name: str, kind: str, value: float, labels: dict, at: str) -> DataFrame:
    row = [(name, kind, float(value), {k: str(v) for k, v in labels.items()})]
    return spark.createDataFrame(row, METRIC.rsplit(",", 1)[0]).withColumn("recorded_at", F.lit(at).cast("timestamp"))


def metric_rows(df: DataFrame, names: list[str], labels: dict, at: str) -> DataFrame:
    """Columns of a one-row frame as gauge rows."""
    long = df.unpivot([], [F.col(n).cast("double").alias(n) for n in names], "name", "value")
    tags = F.create_map(*[F.lit(str(x)) for kv in labels.items() for x in kv])
    return long.select("name", F.lit("gauge").alias("kind"), "value", tags.alias("labels"), F.lit(at).cast("timestamp").alias("recorded_at"))


def run_metrics(spark: SparkSession, pipeline: str, seconds: float, status: str, at: str, rows: int = 0, rejected: int = 0, table: str = "all") -> DataFrame:
    """Duration of a run, and the rows it processed and rejected if any."""
    out = metric(spark, "pipeline_run_duration_seconds", "histogram", seconds, {"pipeline_name": pipeline, "status": status}, at)
    where = {"pipeline_name": pipeline, "table_name": table}
    for name, n, tag in (("pipeline_rows_processed", rows, {"stage": "complete"}), ("pipeline_rows_rejected", rejected, {"reason": "quality_check"})):
        if n > 0:
            out = out.unionByName(metric(spark, name, "counter", n, where | tag, at))
    return out


def check_metrics(results: DataFrame, at: str) -> DataFrame:
    """Results (table_name, check_name, success, severity) as counters of
    passed and failed checks."""
    name = F.when(F.col("success"), "dq_check_passed").otherwise("dq_check_failed")
    tags = F.create_map(F.lit("table_name"), "table_name", F.lit("check_name"), "check_name")
    worse = F.map_concat(tags, F.create_map(F.lit("severity"), F.col("severity")))
    labels = F.when(F.col("success"), tags).otherwise(worse)
    return results.select(name.alias("name"), F.lit("counter").alias("kind"), F.lit(1.0).alias("value"), labels.alias("labels"), F.lit(at).cast("timestamp").alias("recorded_at"))


def table_metrics(tables: DataFrame, stage: str, at: str) -> DataFrame:
    """Tables (table_name, row_count, last_update) as gauges of size and age."""
    age = clean.seconds_between(F.col("last_update"), F.lit(at)) / 3600
    long = tables.select("table_name", F.col("row_count").cast("double").alias("data_row_count"), age.alias("data_freshness_hours"))
    long = long.unpivot(["table_name"], ["data_row_count", "data_freshness_hours"], "name", "value").where("value is not null")
    tags = F.create_map(F.lit("table_name"), "table_name", F.lit("stage"), F.lit(stage))
    return long.select("name", F.lit("gauge").alias("kind"), "value", tags.alias("labels"), F.lit(at).cast("timestamp").alias("recorded_at"))


def roll_up(metrics: DataFrame, by: list[str]) -> DataFrame:
    """Counters add up, gauges show their last value, histograms summarise."""
    tags = [F.col("labels")[b].alias(b) for b in by]
    df = metrics.select("name", "kind", "value", "recorded_at", *tags)
    value = F.when(F.first("kind") == "counter", F.sum("value")).when(F.first("kind") == "gauge", F.max_by("value", "recorded_at")).otherwise(F.avg("value"))
    return df.groupBy("name", "kind", *by).agg(value.alias("value"), F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def log_row(spark: SparkSession, level: str, event: str, fields: dict, at: str) -> DataFrame:
    row = [(level, event, {k: str(v) for k, v in fields.items()})]
    return spark.createDataFrame(row, "level string, event string, fields map<string,string>").withColumn("logged_at", F.lit(at).cast("timestamp"))


def quality_report(results: DataFrame) -> DataFrame:
    """Per (table_name, stage): expectations, passes, rate, blocking failures."""
    ok = F.count_if("success")
    return results.groupBy("table_name", "stage").agg(
        F.count(F.lit(1)).alias("evaluated"),
        ok.alias("successful"),
        F.round(ok * 100.0 / F.count(F.lit(1)), 2).alias("success_pct"),
        F.count_if(F.col("blocking") & ~F.col("success")).alias("blocking_failures"),
    )
