"""Registered queries of the operating side: sources, change capture, rules,
profiles that merge, lineage, catalogs, alert and fact life cycles."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.operators import alerts, contracts, expectations, ingest, profiling, rejects, staging, warehouse
from tarnlake.plans.jobs import AT, DAY, _folder
from tarnlake.plans.registry import AS_OF, LOG, ORACLE_SQL, _log, query
from tarnlake.sources import database, landing, state
from tarnlake.streaming import cdc

# -- streams ------------------------------------------------------------------


def _stream(t, table: str) -> DataFrame:
    source = t.spark.readStream.schema(getattr(t, table).schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return source.parquet(f"{t.sf_dir}/{table}*")


def _finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _event_alerts(events: DataFrame) -> DataFrame:
    parts = {"alert_type": F.lit("event"), "severity": F.lit("warning"), "source": F.col("event_type"), "title": F.lit("t"), "message": F.lit("m")}
    return events.select(*[c.alias(n) for n, c in parts.items()], F.col("ts").cast("timestamp").alias("created_at"))


@query(ORACLE_SQL["alert_dedup"])
def alert_dedup_stream(t):
    """The alerts of the events suppressed as a stream, state kept by Spark."""
    root = _folder(t, "alerts")
    _finish(cdc.suppressed_alerts(_event_alerts(_stream(t, "events")), root))
    kept = t.spark.read.schema(alerts.ALERT).parquet(f"{root}/alerts")
    return kept.select("source", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    f"SELECT 'log_' || event_type AS table_name, op, event_id::VARCHAR || '~20240201000000' AS gpk, 'dev' AS env, 'local' AS region, event_id, user_id, value::DOUBLE AS value FROM {LOG} WHERE event_type IN ('signup', 'error', 'click')"
)
def stream_capture(t):
    """Change events of the monitored tables fanned out to a folder each, with
    audit columns; the batch's own time is set for comparison."""
    root, tables = _folder(t, "capture"), ["log_signup", "log_error", "log_click"]
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    events = _stream(t, "events").select(F.concat(F.lit("log_"), "event_type").alias("table_name"), op.alias("op"), F.struct("event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("value")).alias("after"))
    _finish(cdc.capture(events, tables, f"{root}/out", f"{root}/checkpoint", "event_id", at=AT))
    found = [t.spark.read.parquet(f"{root}/out/{n}").withColumn("table_name", F.lit(n)) for n in tables if t.events.where(F.col("event_type") == n[4:]).limit(1).count()]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("table_name", "op", "gpk", "env", "region", "event_id", "user_id", F.col("value").cast("double").alias("value"))


@query(f"SELECT event_type, date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '{AS_OF}') AS lag_seconds FROM events GROUP BY 1")
def stream_lag(t):
    """How far behind the newest event of each kind is."""
    whole = t.events.withColumn("ts", F.date_trunc("second", "ts"))
    kinds = [r.event_type for r in t.events.select("event_type").distinct().collect()]
    out = None
    for k in sorted(kinds):
        one = cdc.lag_seconds(whole.where(F.col("event_type") == k), "ts", AS_OF).withColumn("event_type", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out.select("event_type", "lag_seconds")


@query(
    "SELECT 'orders' AS table_name, count(*) AS row_count, strftime(max(o_orderdate), '%Y-%m-%d %H:%M') AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' "
    "UNION ALL SELECT 'events', count(*), strftime(max(ts), '%Y-%m-%d %H:%M') FROM events WHERE ts > TIMESTAMP '2024-01-10'"
)
def polled_tables(t):
    """One polling round over two tables, side by side, since their watermarks."""
    tables = [ingest.SourceTable("shop", "orders", "o_orderkey", "o_orderdate"), ingest.SourceTable("shop", "events", "event_id", "ts")]
    marks = {"orders": datetime(1997, 1, 1), "events": datetime(2024, 1, 10)}
    zone = _folder(t, "zone")
    done = ingest.run_tables(tables, lambda x: ingest.cdc_load(getattr(t, x.name), x, zone, AT, marks[x.name], "parquet"), t.spark, at_once=2)
    if done["failed"]:
        raise RuntimeError(str(done["results"]))
    state.save_watermarks(t.spark, f"{zone}/marks", {r["table"]: r["watermark"] for r in done["results"]}, ingest.batch_id(AT), AT)
    kept = state.load_watermarks(t.spark, f"{zone}/marks")
    rows = [(r["table"], r["rows"], kept[r["table"]].strftime("%Y-%m-%d %H:%M")) for r in done["results"]]
    return t.spark.createDataFrame(rows, "table_name string, row_count long, watermark string")


# -- change capture without a log ---------------------------------------------


def _snapshots(t) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    old = t.orders.where(k % 7 != 0).withColumns({"o_totalprice": F.when(k % 5 == 0, price + 1).otherwise(price), "o_orderstatus": F.when(k % 11 != 0, status)})
    return old, t.orders.where(k % 13 != 0)


@query(
    "WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 <> 0), "
    "n AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 13 <> 0), "
    "j AS (SELECT coalesce(n.k, o.k) AS k, CASE WHEN o.k IS NULL THEN 'I' WHEN n.k IS NULL THEN 'D' WHEN o.p IS DISTINCT FROM n.p OR o.s IS DISTINCT FROM n.s THEN 'U' END AS op, "
    "CASE WHEN n.k IS NULL THEN o.p ELSE n.p END AS p, CASE WHEN n.k IS NULL THEN o.s ELSE n.s END AS s, o.s IS DISTINCT FROM n.s AS cs, o.p IS DISTINCT FROM n.p AS cp FROM o FULL JOIN n ON o.k = n.k) "
    "SELECT k AS o_orderkey, op, s AS o_orderstatus, p AS o_totalprice, CASE WHEN op = 'U' THEN concat_ws(',', CASE WHEN cs THEN 'o_orderstatus' END, CASE WHEN cp THEN 'o_totalprice' END) END AS changed FROM j WHERE op IS NOT NULL"
)
def snapshot_diff(t):
    """Changes of a table without a log, from two snapshots."""
    found = ingest.snapshot_changes(*_snapshots(t), "o_orderkey")
    return found.select("o_orderkey", "op", "o_orderstatus", "o_totalprice", F.array_join("changed_columns", ",").alias("changed"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 13 <> 0")
def snapshot_applied(t):
    """The old snapshot with its changes applied as a stream: the new snapshot."""
    old, new = _snapshots(t)
    root, shape = _folder(t, "changes"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    first = old.select(F.lit("I").alias("op"), *shape, F.lit(0).alias("seq"))
    then = ingest.snapshot_changes(old, new, "o_orderkey").select("op", *shape, F.lit(1).alias("seq"))
    for df in (first, then):
        df.write.mode("append").parquet(f"{root}/log")
        _finish(cdc.apply_changes(t.spark.readStream.schema(first.schema).parquet(f"{root}/log"), "o_orderkey", ["seq"], f"{root}/state"))
    return cdc.current_state(t.spark, f"{root}/state", live_only=True).select(*shape)


# -- databases ----------------------------------------------------------------


def _orders_database(t) -> database.Database:
    where = urlsplit(_folder(t, "database"))
    if where.scheme not in ("", "file"):
        raise ValueError("a file database needs a folder that is mounted on every executor")
    return database.write_shards(t.orders, where.path, "orders", "o_orderkey")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders")
def database_extract(t):
    """Orders written to a sharded database and extracted in key ranges."""
    return _orders_database(t).table(t.spark, "orders", "o_orderkey", 4)


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders "
    "WHERE o_orderdate > TIMESTAMP '1997-06-01' AND o_custkey > 20 AND o_orderstatus IN ('F', 'O')"
)
def database_changed(t):
    """Rows changed since a watermark, judged by the database; Spark's own
    filters travel with the query."""
    rows = _orders_database(t).changed(t.spark, "orders", "o_orderdate > '1997-06-01 00:00:00'", "o_orderkey", 3)
    rows = rows.where((F.col("o_custkey") > 20) & F.col("o_orderstatus").isin("F", "O"))
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query(
    "SELECT 'orders' AS table_name, column_name, data_type, ordinal_position, (SELECT count(*) FROM orders) AS row_count, (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE FROM orders) AS total FROM (VALUES "
    "('o_orderkey', 'bigint', 1), ('o_custkey', 'bigint', 2), ('o_orderstatus', 'text', 3), ('o_totalprice', 'double', 4), ('o_orderdate', 'text', 5), ('o_orderpriority', 'text', 6)) v(column_name, data_type, ordinal_position)"
)
def database_columns(t):
    """What the database itself says: tables, columns, rows, and a query of its own."""
    db = _orders_database(t)
    (name,) = db.tables()
    sums = db.query(t.spark, "SELECT CAST(round(sum(o_totalprice) * 100) AS INTEGER) AS cents FROM orders", "cents bigint")
    total = (sums.agg(F.sum("cents")).scalar() / 100).alias("total")
    return db.columns(t.spark, name).select(F.lit(name).alias("table_name"), "column_name", "data_type", "ordinal_position", F.lit(db.count(name)).cast("long").alias("row_count"), total)


@query(
    "SELECT 'orders' AS table_name, count(*) AS row_count, count(*) FILTER (o_orderstatus <> 'F') AS updates, count(*) FILTER (o_orderstatus = 'F') AS deletes, 0::BIGINT AS inserts, "
    "strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01'"
)
def observed_load(t):
    """Counts and watermark of a changed batch, taken as it is written."""
    table = ingest.SourceTable("shop", "orders", "o_orderkey", "o_orderdate", delete_when=("o_orderstatus", "F"))
    done = ingest.cdc_load(t.orders, table, _folder(t, "zone"), AT, datetime(1997, 6, 1), "parquet")
    row = (done["table"], *[done[c] for c in ("rows", "updates", "deletes", "inserts")], done["watermark"].strftime("%Y-%m-%d %H:%M:%S"))
    return t.spark.createDataFrame([row], "table_name string, row_count long, updates long, deletes long, inserts long, watermark string")


# -- JSON ---------------------------------------------------------------------


@query(
    "SELECT event_id, m::VARCHAR AS merged, (m->>'$.k')::BIGINT AS k, (m->>'$.seen.ids[1]')::BIGINT AS second, json_array_length(m, '$.seen.ids')::INT AS n_ids, "
    "json_extract(m, '$.seen')::VARCHAR AS seen FROM (SELECT event_id, json_merge_patch(props, json_object('seen', json_object('at', event_id, 'ids', json_array(user_id, event_id, event_type)))) AS m FROM events)"
)
def json_typed(t):
    """Properties merged with an object; numbers, objects and arrays as they are."""
    ids = F.concat(F.lit("["), "user_id", F.lit(","), "event_id", F.lit(',"'), "event_type", F.lit('"]'))
    more = F.concat(F.lit('{"seen":{"at":'), "event_id", F.lit(',"ids":'), ids, F.lit("}}"))
    m = F.col("merged")
    return t.events.select("event_id", clean.json_merge(F.col("props"), more).alias("merged")).select(
        "event_id", "merged", clean.json_value(m, "k", "bigint").alias("k"), clean.json_value(m, "seen.ids[1]", "bigint").alias("second"),
        clean.json_length(m, "seen.ids").alias("n_ids"), F.to_json(clean.json_value(m, "seen", "variant")).alias("seen"),
    )


# -- rules and profiles -------------------------------------------------------

R = expectations.QualityRule
ORDER_RULES = [
    R("priority_not_null", "null_check", "o_orderpriority"),
    R("status_not_null", "null_check", "o_orderstatus"),
    R("price_range", "range_check", "o_totalprice", {"min": 1000, "max": 300000}),
    R("priority_format", "regex_check", "o_orderpriority", {"pattern": "^[1-3]-"}),
    R("status_number", "type_check", "o_orderstatus", {"type": "int"}),
    R("no_json", "type_check", "o_orderpriority", {"type": "string", "disallow_json": True}),
    R("customer_unique", "uniqueness_check", "o_custkey"),
    R("order_fresh", "freshness_check", "o_orderdate", {"max_hours": 24 * 700}),
    R("customer_known", "referential", "o_custkey", {"table": "customer", "key": "c_custkey"}),
    R("price_or_final", "custom_sql", None, {"condition": "o_totalprice > 5000 OR o_orderstatus = 'F'"}),
    R("campaign_not_null", "null_check", "campaign"),
]
_JSON = "'{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"o_totalprice\":' || o_totalprice || ',\"o_orderdate\":\"' || o_orderdate || '\",\"o_orderpriority\":\"' || o_orderpriority || '\"}'"
_BAD = {
    "priority_not_null": "o_orderpriority IS NULL",
    "status_not_null": "o_orderstatus IS NULL",
    "price_range": "o_totalprice < 1000 OR o_totalprice > 300000",
    "priority_format": "NOT regexp_matches(o_orderpriority, '^[1-3]-')",
    "status_number": "TRY_CAST(o_orderstatus AS INT) IS NULL",
    "no_json": "false",
    "customer_unique": "o_custkey IN (SELECT o_custkey FROM o GROUP BY 1 HAVING count(*) > 1)",
    "order_fresh": "date_diff('second', o_orderdate::TIMESTAMP, TIMESTAMP '1999-06-01') > 24 * 700 * 3600",
    "customer_known": "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "price_or_final": "NOT (o_totalprice > 5000 OR o_orderstatus = 'F')",
}


@query(
    "WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders), "
    f"b AS ({' UNION ALL '.join(f'''SELECT '{n}' AS rule, count(*) AS failed, array_to_string((list(j ORDER BY j))[1:5], chr(10)) AS samples FROM (SELECT {_JSON} AS j FROM o WHERE {w})''' for n, w in _BAD.items())} "
    "UNION ALL SELECT 'campaign_not_null', count(*), '' FROM o) "
    "SELECT rule, n AS checked, n - failed AS passed, failed, round((n - failed) * 100.0 / n, 2)::DOUBLE AS pass_rate, coalesce(samples, '') AS samples FROM b, (SELECT count(*) AS n FROM o)"
)
def rules_of_orders(t):
    """All rules of a table compiled together, every result column."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    found = expectations.run_rules(orders, ORDER_RULES, {"customer": t.customer.where("c_acctbal > 0")}, "1999-06-01 00:00:00")
    return found.withColumns({"samples": F.array_join("samples", "\n"), "pass_rate": F.col("pass_rate").cast("double")})


@query(
    "SELECT c AS column_name, count(*) AS row_count, count(*) FILTER (v IS NULL) AS null_count, round(count(*) FILTER (v IS NULL) * 100.0 / count(*), 2)::DOUBLE AS null_pct, min(x) AS low, max(x) AS high, "
    "true AS distinct_near, true AS median_near FROM (SELECT 'user_id' AS c, user_id::VARCHAR AS v, user_id::DOUBLE AS x FROM events UNION ALL SELECT 'event_type', CASE WHEN event_id % 9 > 0 THEN event_type END, NULL FROM events "
    "UNION ALL SELECT 'value', value::VARCHAR, value FROM events) GROUP BY 1"
)
def merged_profile(t):
    """Profiles by day, stored and merged: exact counts and bounds, distinct
    values and the median within the sketches' error of the exact ones."""
    rows = t.events.select("ts", "user_id", F.when(F.col("event_id") % 9 > 0, F.col("event_type")).alias("event_type"), "value")
    store = _folder(t, "profiles")
    profiling.sketch_columns(rows.withColumn("ts", F.to_date("ts")), F.col("ts")).where("column_name != 'ts'").write.parquet(store)
    merged = profiling.sketched_profile(profiling.merge_sketches(t.spark.read.schema(profiling.SKETCH).parquet(store)))
    exact = rows.agg(*[F.countDistinct(c).alias(c) for c in ("user_id", "event_type", "value")])
    exact = exact.unpivot([], ["user_id", "event_type", "value"], "column_name", "distinct_exact")
    below = merged.select("column_name", F.col("quantiles")[1].alias("median")).where("median is not null").alias("m")
    # The share of rows up to the estimated median must be about a half.
    long = rows.select(F.col("user_id").cast("double").alias("user_id"), "value").unpivot([], ["user_id", "value"], "column_name", "v")
    ranks = long.join(F.broadcast(below), "column_name").groupBy("column_name").agg(F.avg(F.when(F.col("v") <= F.col("median"), 1.0).otherwise(0.0)).alias("upto"), F.avg(F.when(F.col("v") < F.col("median"), 1.0).otherwise(0.0)).alias("under"))
    out = merged.join(exact, "column_name").join(ranks, "column_name", "left")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_exact")) <= 0.05 * F.col("distinct_exact")
    middle = F.coalesce((F.col("upto") >= 0.48) & (F.col("under") <= 0.52), F.lit(True))
    return out.select("column_name", "row_count", "null_count", F.col("null_pct").cast("double").alias("null_pct"), "low", "high", near.alias("distinct_near"), middle.alias("median_near"))


# -- lineage, registry, catalogs ----------------------------------------------


@query(
    "WITH RECURSIVE e AS (SELECT DISTINCT 'n' || n_nationkey AS s, 'n' || ((n_nationkey + 1) % (SELECT count(*) FROM nation)) AS t FROM nation UNION SELECT DISTINCT s_name, 'n' || s_nationkey FROM supplier), "
    "w AS (SELECT s, t, 1 AS d FROM e UNION SELECT w.s, e.t, w.d + 1 FROM w JOIN e ON w.t = e.s WHERE w.d < 60) SELECT s AS source, t AS target, min(d)::BIGINT AS distance FROM w GROUP BY 1, 2"
)
def lineage_of_all(t):
    """All paths from suppliers through a ring of nations, cycles included."""
    ring = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("source"), F.concat(F.lit("n"), (F.col("n_nationkey") + 1) % t.nation.agg(F.count(F.lit(1))).scalar()).alias("target"))
    more = t.supplier.select(F.col("s_name").alias("source"), F.concat(F.lit("n"), "s_nationkey").alias("target"))
    return contracts.lineage_closure(ring.unionByName(more))


@query(
    "SELECT event_type AS run_id, 'events' AS pipeline_name, CASE WHEN n % 2 = 0 THEN 'success' ELSE 'failed' END AS status, 90::BIGINT AS seconds, n AS records_read, n - bad AS records_written, bad AS records_rejected, "
    "2::BIGINT AS tasks, (n % 2)::BIGINT AS failed_tasks, n + (n - bad) AS records_processed FROM (SELECT event_type, count(*) AS n, count(*) FILTER (value > 90) AS bad FROM events GROUP BY 1)"
)
def pipeline_runs(t):
    """Runs and their tasks written to the run tables, then read as history."""
    root, start, end = _folder(t, "runs"), datetime(2024, 2, 1, 1), datetime(2024, 2, 1, 1, 1, 30)
    for r in t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 90).alias("bad")).collect():  # one row a kind
        status = "failed" if r.n % 2 else "success"
        run = {"run_id": r.event_type, "pipeline_name": "events", "status": status, "start_time": start, "end_time": end, "records_read": r.n, "records_written": r.n - r.bad, "records_rejected": r.bad}
        tasks = [{"task_name": "read", "task_type": "extract", "status": "success", "records_processed": r.n}, {"task_name": "write", "task_type": "load", "status": status, "records_processed": r.n - r.bad}]
        contracts.record_run(t.spark, root, run, tasks)
    return contracts.run_history(t.spark, root).drop("error_message", "start_time")


@query("SELECT 'orders' AS table_name, 'o_orderstatus=' || o_orderstatus AS partition, count(*) AS row_count FROM orders GROUP BY o_orderstatus UNION ALL SELECT 'customers', '', count(*) FROM customer")
def footer_counts(t):
    """Rows of a written lake by partition, from the files' footers."""
    root = _folder(t, "lake")
    landing.write_partitioned(t.orders, f"{root}/orders", ["o_orderstatus"])
    t.customer.write.parquet(f"{root}/customers")
    return contracts.crawl_footers(t.spark, root, ["orders", "customers"], {"orders": ["o_orderstatus"]})


@query(
    "SELECT k AS user_id, n AS expected, m AS matched, w AS new, x AS missing, greatest(0, round(m * 100.0 / n - 5 * w - 10 * x, 2))::DOUBLE AS integrity FROM (SELECT user_id AS k, 5::BIGINT AS n, "
    "count(DISTINCT event_type) FILTER (event_type IN ('view', 'click', 'purchase', 'error', 'refund')) AS m, count(DISTINCT event_type) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'error', 'refund')) AS w, "
    "5 - count(DISTINCT event_type) FILTER (event_type IN ('view', 'click', 'purchase', 'error', 'refund')) AS x FROM events WHERE user_id < 8 GROUP BY 1)"
)
def schema_integrity(t):
    """Contract scores: the kinds that users send against those agreed on."""
    agreed = t.spark.createDataFrame([(c,) for c in ("view", "click", "purchase", "error", "refund")], "column_name string")
    out = None
    for (u,) in t.events.where("user_id < 8").select("user_id").distinct().orderBy("user_id").collect():  # eight at most
        score = contracts.integrity(agreed, t.events.where(F.col("user_id") == u).select(F.col("event_type").alias("column_name")).distinct()).withColumn("user_id", F.lit(u))
        out = score if out is None else out.unionByName(score)
    return out.withColumn("integrity", F.col("integrity").cast("double"))


@query(
    "SELECT 'schema_integrity_score' AS name, 'gauge' AS kind, greatest(0, round(m * 100.0 / 3 - 5 * w - 10 * (3 - m), 2))::DOUBLE AS value, 'events' AS table_name FROM d UNION ALL SELECT 'schema_new_columns_count', 'gauge', w::DOUBLE, 'events' FROM d "
    "UNION ALL SELECT 'schema_missing_columns_count', 'gauge', (3 - m)::DOUBLE, 'events' FROM d".replace("SELECT 'schema_integrity", "WITH d AS (SELECT count(DISTINCT event_type) FILTER (event_type IN ('view', 'click', 'refund')) AS m, count(DISTINCT event_type) FILTER (event_type NOT IN ('view', 'click', 'refund')) AS w FROM events) SELECT 'schema_integrity", 1)
)
def drift_gauges(t):
    """The three drift metrics of a contract, over the kinds of events."""
    agreed = t.spark.createDataFrame([(c,) for c in ("view", "click", "refund")], "column_name string")
    found = contracts.drift_metrics(contracts.integrity(agreed, t.events.select(F.col("event_type").alias("column_name")).distinct()), "events", AS_OF)
    return found.select("name", "kind", "value", F.col("labels")["table_name"].alias("table_name"))


_SIDES = "(VALUES ('o_orderkey', 'both', 'bigint', 'bigint'), ('o_custkey', 'both', 'bigint', 'string'), ('o_orderstatus', 'source_only', 'string', NULL), ('o_totalprice', 'both', 'double', 'double'), ('o_orderdate', 'both', 'timestamp', 'timestamp'), ('o_orderpriority', 'both', 'string', 'string'), ('op', 'target_only', NULL, 'string')) v(column_name, place, source_type, target_type)"


@query(f"SELECT 'orders' AS table_name, column_name, place, source_type, target_type, a AS source_rows, b AS target_rows, b - a AS row_change FROM {_SIDES}, (SELECT count(*) AS a, count(*) FILTER (o_orderkey % 4 > 0) AS b FROM orders)")
def compare_two_stages(t):
    """Schema and rows of two stages of a table in one call."""
    later = t.orders.where("o_orderkey % 4 > 0").drop("o_orderstatus").withColumns({"op": F.lit("I"), "o_custkey": F.col("o_custkey").cast("string")})
    return contracts.compare_stages(t.orders, later, "orders")


def _registry(t) -> DataFrame:
    """Two versions of the events' kinds as a schema: those of the first days, then all."""
    rows = lambda df: df.groupBy(F.concat(F.lit("user_"), (F.col("user_id") % 5).cast("string")).alias("table_name"), F.col("event_type").alias("column_name")).agg(F.count(F.lit(1)).alias("n")).select(
        "table_name", F.lit(1).alias("position"), "column_name", F.when(F.col("n") > 20, "bigint").otherwise("int").alias("data_type"), F.lit(True).alias("nullable")
    )
    first = contracts.register(contracts.empty_registry(t.spark), rows(t.events.where("user_id % 5 < 3 AND event_type != 'error'")), "staging", "a", "2024-01-01")
    return contracts.register(first, rows(t.events), "staging", "b", "2024-01-02")


@query(
    "WITH k AS (SELECT user_id % 5 AS u, count(DISTINCT event_type) AS n, count(DISTINCT event_type) FILTER (event_type <> 'error') AS m FROM events GROUP BY 1) "
    "SELECT 'user_' || u AS table_name, 1 AS version, u > 2 AS is_active, CASE WHEN u > 2 THEN 'b' ELSE 'a' END AS created_by, CASE WHEN u > 2 THEN n ELSE m END AS columns FROM k "
    "UNION ALL SELECT 'user_' || u, 2, true, 'b', n FROM k WHERE u < 3"
)
def registry_history(t):
    """Versions of every registered schema, with who made them."""
    registry = _registry(t)
    out = None
    for i in range(5):
        one = contracts.schema_history(registry, f"user_{i}").withColumn("table_name", F.lit(f"user_{i}"))
        out = one if out is None else out.unionByName(one)
    return out.select("table_name", "version", "is_active", "created_by", "columns")


@query(
    "WITH k AS (SELECT user_id % 5 AS u, event_type, CASE WHEN count(*) > 20 THEN 'bigint' ELSE 'int' END AS ty FROM events WHERE event_type <> 'error' GROUP BY 1, 2) "
    "SELECT 'user_' || u AS table_name, event_type AS column_name, ty AS data_type, 1 AS version FROM k WHERE u < 3"
)
def registry_version(t):
    """The fields of one version of a schema."""
    registry = _registry(t)
    found = [contracts.get_schema(registry, f"user_{i}", 1) for i in range(3)]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("table_name", "column_name", "data_type", "version")


@query("SELECT 'staging' AS asset_type, count(DISTINCT user_id % 5) AS tables, string_agg(DISTINCT 'user_' || (user_id % 5), ',' ORDER BY 'user_' || (user_id % 5)) AS names FROM events")
def catalog_counts(t):
    """Tables of the registry by kind."""
    found = contracts.catalog_summary(_registry(t))
    return found.withColumn("names", F.array_join("names", ","))


@query("SELECT 'events' AS table_name, 'raw' AS stage, event_type AS column_name, 'new' AS change, 'warning' AS severity FROM (SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('view', 'click')) UNION ALL SELECT 'events', 'raw', 'refund', 'missing', 'error' FROM events HAVING count(*) > 0")
def drift_history(t):
    """Drift rows logged twice and read from a time on."""
    seen = lambda df: df.select(F.col("event_type").alias("column_name")).distinct().withColumn("data_type", F.lit("string"))
    agreed = t.spark.createDataFrame([(c, "string") for c in ("view", "click", "refund")], "column_name string, data_type string")
    early = contracts.drift_log(contracts.drift(agreed, seen(t.events.where("user_id < 3"))), "events", "raw", "2024-01-01")
    log = early.unionByName(contracts.drift_log(contracts.drift(agreed, seen(t.events)), "events", "raw", "2024-02-01"))
    return contracts.changes_since(log, "2024-01-15").drop("detected_at")


# -- rejections and alerts ----------------------------------------------------

REJECT = (rejects.Rule("expensive", "custom", (), "value > 90", "critical"), rejects.Rule("errors", "regex", ("event_type",), "^error$", "warning"))


@query(
    "SELECT 'WARNING' AS log_level, 'rejection_handler' AS logger_name, 'events' AS source, 'Rejected ' || bad || '/' || n || ' records (' || round(bad * 100.0 / n, 2)::DOUBLE || '%)' AS message, "
    "n AS total_records, bad AS rejected_records, 2 AS rules FROM (SELECT count(*) AS n, count(*) FILTER (value > 90 OR event_type = 'error') AS bad FROM events)"
)
def rejection_logged(t):
    """The log row of a table's rejections."""
    log = rejects.rejection_log(rejects.totals(t.events, REJECT), rejects.summary(t.events, REJECT), "events", AS_OF)
    of = lambda p, k: clean.json_value(F.col("log_metadata"), p, k)
    return log.select("log_level", "logger_name", "source", "message", of("total_records", "bigint").alias("total_records"), of("rejected_records", "bigint").alias("rejected_records"), clean.json_length(F.col("log_metadata"), "rules").alias("rules"))


@query("SELECT event_id, event_type, 'events' AS table_name, DATE '2024-02-01' AS rejection_date, 'b1' AS batch_id, CASE WHEN value > 90 AND event_type = 'error' THEN 'expensive,errors' WHEN value > 90 THEN 'expensive' ELSE 'errors' END AS reasons FROM events WHERE value > 90 OR event_type = 'error'")
def quarantined(t):
    """Rejected rows appended to quarantine folders, with their reasons."""
    path = _folder(t, "quarantine")
    _, bad = rejects.split(t.events, REJECT, F.lit(AS_OF).cast("timestamp"))
    reasons = F.array_join(F.transform("_rejection_reason", lambda v: v["rule"]), ",").alias("reasons")
    kept = t.spark.read.parquet(path) if rejects.quarantine(bad, path, "events", "b1", "2024-02-01") else bad.withColumns({"table_name": F.lit("events"), "rejection_date": F.lit("2024-02-01").cast("date"), "batch_id": F.lit("b1")})
    return kept.select("event_id", "event_type", "table_name", "rejection_date", "batch_id", reasons)


@query(
    "SELECT 'pii_detected' AS alert_type, 'warning' AS severity, 'documents' AS source, p || ' in text' AS title, n::VARCHAR AS message FROM ("
    "SELECT 'email' AS p, count(*) FILTER (regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[A-Z|a-z]{2,}')) AS n FROM documents) WHERE n > 0"
)
def alert_pii(t):
    """Alerts of personal data found in the documents (one kind compared)."""
    found = alerts.pii_alerts(rejects.scan_pii(t.documents, "documents", ["text"]).where("pii_type = 'email'"), AS_OF)
    return found.drop("created_at")


@query(
    "WITH a AS (SELECT event_type AS source, max(date_trunc('second', ts)) AS at FROM events GROUP BY 1) "
    "SELECT source, CASE source WHEN 'error' THEN 'resolved' WHEN 'click' THEN 'acknowledged' ELSE 'open' END AS status, CASE WHEN source = 'click' THEN 'ops' END AS acknowledged_by, CASE WHEN source = 'error' THEN 'fixed' END AS resolution, source <> 'error' AS listed FROM a"
)
def alert_life_cycle(t):
    """Alerts opened, acknowledged, resolved and listed."""
    newest = _event_alerts(t.events).groupBy("alert_type", "severity", "source", "title", "message").agg(F.max("created_at").alias("created_at"))
    keyed = alerts.opened(newest.withColumn("dedup_key", clean.alert_key(F.col("alert_type"), F.col("source"), F.col("title"))))
    key = {r.source: r.dedup_key for r in keyed.where("source in ('click', 'error')").select("source", "dedup_key").collect()}
    done = alerts.resolve(alerts.acknowledge(keyed, [key[s] for s in ("click",) if s in key], "ops", AS_OF), [key[s] for s in ("error",) if s in key], "fixed", AS_OF)
    listed = alerts.open_alerts(done, limit=1000).select("dedup_key", F.lit(True).alias("listed"))
    out = done.join(listed, "dedup_key", "left")
    return out.select("source", "status", "acknowledged_by", "resolution", F.coalesce("listed", F.lit(False)).alias("listed"))


@query("SELECT 'WARNING' AS level, 'late' AS event, user_id::VARCHAR AS user_id, count(*)::VARCHAR AS events FROM events WHERE user_id < 5 GROUP BY user_id")
def log_rows(t):
    """Structured log rows with their fields."""
    counts = t.events.where("user_id < 5").groupBy("user_id").count().collect()  # five at most
    out = None
    for r in counts:
        one = alerts.log_row(t.spark, "WARNING", "late", {"user_id": r.user_id, "events": r["count"]}, AS_OF)
        out = one if out is None else out.unionByName(one)
    return out.select("level", "event", F.col("fields")["user_id"].alias("user_id"), F.col("fields")["events"].alias("events"))


# -- loads and staged tables --------------------------------------------------


@query(
    "SELECT o_orderkey, 'dev/' || o_orderstatus AS place, o_orderkey || '-20240201000000' AS stamp, 'I' AS kind FROM orders WHERE o_orderkey % 2 = 0"
)
def added_columns(t):
    """Columns added by the rules of a mapping document, tables selected by it."""
    place = lambda n: {"schema-name": "shop", "table-name": n}
    rules = [{"rule-type": "selection", "rule-action": "explicit", "object-locator": place(n)} for n in ("orders", "parts")]
    rules += [{"rule-type": "transformation", "rule-action": "add-prefix", "rule-target": "table", "value": "in_"}]
    named = ingest.read_mappings({"rules": rules})
    (table,) = ingest.select_tables(named.tables, [{"schema": "shop", "table": "ord%"}])
    columns = [
        {"table": "ord%", "column": "place", "expression": "concat('dev/', $o_orderstatus)"},
        {"table": "%", "column": "stamp", "expression": "concat($o_orderkey, '-', EXTRACTION_TIMESTAMP)"},
        {"table": "orders", "column": "kind", "expression": "OPERATION_TYPE"},
        {"table": "parts", "column": "never", "expression": "1"},
    ]
    out = ingest.add_columns(t.orders.where("o_orderkey % 2 = 0"), table.name, columns, AT)
    path = f"{_folder(t, 'zone')}/{ingest.target_path(table, 'full_load', 'b1')}"
    landing.write_raw(out, path, "parquet")
    if "/shop/in_orders/full_load/b1" not in path or "never" in out.columns:
        raise RuntimeError(path)
    return landing.read_one(t.spark, f"{path}/*.parquet").select("o_orderkey", "place", "stamp", "kind")


@query("SELECT name, n AS row_count FROM (SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem)")
def tables_side_by_side(t):
    """Full loads of three tables at once, each in a scheduler pool of its own;
    a failing one is recorded and holds up none."""
    zone = _folder(t, "zone")
    tables = [ingest.SourceTable("shop", n, k) for n, k in (("orders", "o_orderkey"), ("nowhere", "id"), ("customer", "c_custkey"), ("lineitem", "l_orderkey"))]
    done = ingest.run_tables(tables, lambda x: ingest.full_load(getattr(t, x.name), x, zone, AT, "parquet"), t.spark, at_once=3)
    rows = [(r["table"], t.spark.read.parquet(r["path"]).count() if r["path"] else 0) for r in done["results"] if r["status"] == "success"]
    if done["failed"] != 1 or done["rows"] != sum(n for _, n in rows):
        raise RuntimeError(str(done))
    return t.spark.createDataFrame(rows, "name string, row_count long")


@query("SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE '' END AS c_mktsegment, c_nationkey::INT AS c_nationkey FROM customer")
def initial_csv_load(t):
    """A CSV loaded as text, missing values as '', registered as a typed table."""
    zone, name = _folder(t, "initial"), f"initial_{datetime.now().strftime('%H%M%S%f')}"
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey")
    landing.write_raw(rows, f"{zone}/csv")
    landing.initial_load(t.spark, f"{zone}/csv", f"{zone}/table")
    table = landing.register_table(t.spark, name, f"{zone}/table", "c_custkey string, c_mktsegment string, c_nationkey string")
    out = table.select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("int").alias("c_nationkey"))
    return out


@query(
    "SELECT e.event_id::VARCHAR AS event_id, e.user_id::VARCHAR AS user_id, 'b9' AS batch, '2024-02-01' AS processed FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id::VARCHAR DESC) AS nth FROM events) e WHERE nth = 1"
)
def staged_marks(t):
    """Staged rows marked with their batch and time; several tables in one run."""
    marks = {"batch": F.col("_batch_id"), "processed": F.date_format("_processed_at", "yyyy-MM-dd")}
    raw = t.events.withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).select("event_id", "user_id", "at")
    config = staging.TableConfig("e", [staging.Mapped("event_id", "event_id"), staging.Mapped("user_id", "user_id"), staging.Mapped("at", "at")], key="user_id", order_by=["at", "event_id"])
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    out = staging.stage(text, config, "b9", F.lit("2024-02-01").cast("timestamp"))
    return out.select("event_id", "user_id", *[c.alias(n) for n, c in marks.items()])


# -- facts end to end ---------------------------------------------------------


@query(
    "WITH l AS (SELECT DISTINCT trim((c_custkey % 11)::VARCHAR) AS k, min(c_nationkey::VARCHAR) AS c FROM customer WHERE c_custkey % 11 < 8 GROUP BY 1), s AS (SELECT (o_orderkey % 13)::VARCHAR AS k, min(o_orderpriority) AS c FROM orders GROUP BY 1), "
    "n AS (SELECT k, c, row_number() OVER (ORDER BY k) AS sk FROM l), m AS (SELECT k, c, row_number() OVER (ORDER BY k) + (SELECT count(*) FROM n) AS sk FROM s WHERE k NOT IN (SELECT k FROM n)) "
    "SELECT k AS area_id, 'Area ' || k AS area_name, c AS compound_id, sk AS area_sk FROM n UNION ALL SELECT k, 'Area ' || k, c, sk FROM m UNION ALL SELECT '-1', 'Unknown', 'Unknown', -1"
)
def area_from_two_sources(t):
    """Areas of leads, then those that only sales know."""
    named = lambda df: df.withColumn("area_name", F.concat(F.lit("Area "), "area_id"))
    leads = named(t.customer.where("c_custkey % 11 < 8").select((F.col("c_custkey") % 11).cast("string").alias("area_id"), F.col("c_nationkey").cast("string").alias("compound_id")))
    sales = named(t.orders.select((F.col("o_orderkey") % 13).cast("string").alias("area_id"), F.col("o_orderpriority").alias("compound_id")))
    dim = warehouse.load_from_sources(warehouse.empty_dimension(t.spark, "area_id", "area_sk", ["area_name", "compound_id"]), [leads, sales], "area_id", "area_sk", "2024-01-01", ["area_name", "compound_id"])
    return warehouse.with_unknown(dim, "area_sk", "area_id").select("area_id", "area_name", "compound_id", "area_sk")


def _fact_sql(where: str, price: str) -> str:
    return (
        "SELECT o_orderkey AS sale_id, o_custkey AS lead_id, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey ELSE -1 END AS lead_sk, coalesce(p.sk, -1) AS property_type_sk, coalesce(a.sk, -1) AS area_sk, coalesce(c.sk, -1) AS sale_category_sk, "
        f"{DAY.format('o_orderdate')} AS reservation_date_sk, {DAY.format('o_orderdate + INTERVAL 3 DAY')} AS update_date_sk, CASE WHEN o_orderkey % 2 = 0 THEN {DAY.format('o_orderdate + INTERVAL 9 DAY')} END AS contract_date_sk, "
        f"CAST({price} AS DECIMAL(15,2))::DOUBLE AS unit_value, CAST({price} AS DECIMAL(15,2))::DOUBLE AS expected_value, CAST({price} AS DECIMAL(15,2))::DOUBLE AS actual_value, 'u' || (o_orderkey % 3) AS unit_location, (o_orderkey % 9)::INT AS payment_years, "
        f"md5(o_orderkey || '|' || o_custkey || '|' || CAST({price} AS DECIMAL(15,2))::VARCHAR || '|' || o_orderstatus) AS record_hash "
        "FROM orders LEFT JOIN p ON o_orderpriority = p.k LEFT JOIN c ON o_orderstatus = c.k LEFT JOIN a ON (o_orderkey % 6)::VARCHAR = a.k WHERE " + where
    )


def _members(name: str, column: str, where: str = "true") -> str:
    return f"{name} AS (SELECT k, row_number() OVER (ORDER BY k) AS sk FROM (SELECT DISTINCT {column} AS k FROM orders WHERE {where}))"


@query(
    f"WITH {_members('p', 'o_orderpriority')}, {_members('c', 'o_orderstatus')}, {_members('a', '(o_orderkey % 6)::VARCHAR', 'o_orderkey % 6 < 4')} "
    f"{_fact_sql('o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0', 'o_totalprice')} UNION ALL {_fact_sql('o_orderkey % 5 = 0', 'o_totalprice * 2')}"
)
def facts_reloaded(t):
    """Sales loaded, then a corrected batch deletes and reloads its keys, twice;
    the facts are read back from the table, all columns."""
    root, k = _folder(t, "facts"), F.col("o_orderkey")

    def staged(rows: DataFrame, factor: int, op: str) -> DataFrame:
        price = F.col("o_totalprice") * factor
        return rows.select(
            F.lit(op).alias("op"), k.alias("sale_id"), F.col("o_custkey").alias("lead_id"), F.col("o_orderpriority").alias("property_type"), (k % 6).cast("string").alias("area_id"),
            F.col("o_orderstatus").alias("sale_category"), F.col("o_orderdate").alias("sale_date"), F.date_add("o_orderdate", 3).alias("reservation_update_date"),
            F.when(k % 2 == 0, F.date_add("o_orderdate", 9)).alias("contract_date"), price.alias("unit_value"), price.alias("expected_value"), price.alias("actual_value"),
            F.concat(F.lit("u"), (k % 3).cast("string")).alias("unit_location"), (k % 9).cast("int").alias("payment_years"),
        )

    every = staged(t.orders, 1, "I")
    dims = warehouse.load_dimensions(
        every, {"property": ("property_type", "type_name", "property_type_sk"), "category": ("sale_category", "category_name", "sale_category_sk"), "area": ("area_id", "area_id", "area_sk")}, "2024-01-01",
        {"area": F.col("area_id").cast("int") < 4},
    ) | {"date": warehouse.date_dimension(t.spark, "1990-01-01", "2010-12-31")}
    leads = t.customer.where("c_custkey % 10 != 0").select(F.col("c_custkey").alias("lead_id"), F.col("c_custkey").alias("lead_sk"))
    loads = [staged(t.orders.where(k % 3 == 0), 1, "I"), *[staged(t.orders.where(k % 5 == 0), 2, "U")] * 2]
    for n, rows in enumerate(loads):
        facts = warehouse.fact_sales(rows, leads, dims)
        old = t.spark.read.parquet(f"{root}/v{n - 1}") if n else facts.limit(0)
        warehouse.replace_by_key(old, facts, "sale_id").write.parquet(f"{root}/v{n}")
    money = {c: F.col(c).cast("double") for c in ("unit_value", "expected_value", "actual_value")}
    return t.spark.read.parquet(f"{root}/v{len(loads) - 1}").withColumns(money)


# -- crawls and jobs ----------------------------------------------------------


@query(
    "SELECT 'orders' AS table_name, 2 AS version, 7 AS columns, 3 AS file_partitions, 'o_orderstatus' AS partition_keys, (SELECT count(*) FROM orders) AS row_count UNION ALL "
    "SELECT 'parts', 1, 6, 0, '', (SELECT count(*) FROM part)".replace("3 AS file", "(SELECT count(DISTINCT o_orderstatus) FROM orders)::INT AS file")
)
def lake_crawled(t):
    """A lake crawled twice: the registry gains a version of the table that
    changed, files and partitions are listed, rows counted from footers."""
    root = _folder(t, "lake")
    landing.write_partitioned(t.orders, f"{root}/orders", ["o_orderstatus"])
    t.part.write.parquet(f"{root}/parts")
    registry, first = contracts.run_crawler(t.spark, contracts.empty_registry(t.spark), root, "crawler", AS_OF)
    landing.write_partitioned(t.orders.withColumn("channel", F.lit("web")), f"{root}/orders", ["o_orderstatus"])
    registry, second = contracts.run_crawler(t.spark, registry, root, "crawler", AS_OF)
    if (first["new"], second["updated"], second["unchanged"]) != (2, 1, 1):
        raise RuntimeError(f"{first} {second}")
    columns = contracts.active(registry).groupBy("table_name", "version").agg(F.count(F.lit(1)).cast("int").alias("columns"))
    rows = contracts.crawl_footers(t.spark, root, ["orders", "parts"], {"orders": ["o_orderstatus"]})
    counted = rows.groupBy("table_name").agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("partition") != "").cast("int").alias("file_partitions"))
    files = contracts.crawl_lake(t.spark, root).select("table_name", F.array_join("partition_keys", ",").alias("partition_keys"))
    return columns.join(counted, "table_name").join(files, "table_name").select("table_name", "version", "columns", "file_partitions", "partition_keys", "row_count")


@query(
    "SELECT * FROM (VALUES ('dim_member', 'dimension', 'member', 'string', false), ('dim_member', 'dimension', 'member_sk', 'bigint', true), ('fact_order', 'fact', 'o_orderkey', 'bigint', false), "
    "('fact_order', 'fact', 'status', 'string', true)) v(table_name, asset_type, column_name, data_type, is_key) JOIN (SELECT 'dim_member' AS table_name, count(DISTINCT o_orderpriority) AS row_count FROM orders UNION ALL SELECT 'fact_order', count(*) FROM orders) c USING (table_name)"
)
def warehouse_crawled(t):
    """Columns, keys and rows of the warehouse, from the catalog."""
    mark = _folder(t, "m").rsplit("-", 1)[1]
    names = {f"dim_member_{mark}": "dim_member", f"fact_order_{mark}": "fact_order"}
    dim, fact = names
    members = warehouse.number_rows(t.orders.select(F.col("o_orderpriority").alias("member")).distinct(), ["member"], f"member_{mark}_sk")
    place = _folder(t, "warehouse")
    members.write.option("path", f"{place}/dim").saveAsTable(dim)
    t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status")).write.partitionBy("status").option("path", f"{place}/fact").saveAsTable(fact)
    try:
        columns = contracts.crawl_warehouse(t.spark, (dim, fact))
        counts = contracts.crawl_catalog(t.spark, (dim, fact)).select("table_name", "row_count")
        plain = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        named = columns.join(counts, "table_name").withColumn("column_name", F.regexp_replace("column_name", f"_{mark}", ""))
        return named.select(plain[F.col("table_name")].alias("table_name"), "asset_type", "column_name", "data_type", "is_key", "row_count")
    finally:
        for n in names:
            t.spark.sql(f"DROP TABLE IF EXISTS {n}")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def latest_events(t):
    """The row of greatest order per key."""
    return contracts.latest(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query(
    "SELECT 'newest' AS table_name, 'success' AS status, (SELECT count(*) FROM events) AS rows_in, (SELECT count(DISTINCT user_id) FROM events) AS rows_out UNION ALL "
    "SELECT 'kinds', 'success', (SELECT count(*) FROM events), (SELECT count(DISTINCT event_type) FROM events) UNION ALL SELECT 'nothing', 'empty', 0, 0 FROM events HAVING count(*) > 0"
)
def staged_tables(t):
    """Raw tables staged in one job; one without files is told and stops none."""
    root, steps = _folder(t, "stage"), []
    raw = t.events.select(*[F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "event_type")])
    config = lambda name, key: staging.TableConfig(name, [staging.Mapped(c, c) for c in raw.columns], key=key, order_by=["event_id"])
    found: dict = {}
    jobs = [(f"{root}/raw", f"{root}/newest", config("newest", "user_id")), (f"{root}/none", f"{root}/nothing", config("nothing", "user_id")), (f"{root}/raw", f"{root}/kinds", config("kinds", "event_type"))]
    steps = [("write", lambda: landing.write_raw(raw, f"{root}/raw/full_load/b1")), ("stage", lambda: found.update(staging.run_all(t.spark, jobs, "b1")))]
    if warehouse.run_steps(steps) != ["write", "stage"] or found["failed"]:
        raise RuntimeError(str(found))
    rows = [(r["table"], r["status"], r["rows_in"], r["rows_out"]) for r in found["tables"]]
    return t.spark.createDataFrame(rows, "table_name string, status string, rows_in long, rows_out long")


# -- scalars ------------------------------------------------------------------


@query(
    "SELECT event_id, strftime(CASE event_id % 7 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN ts WHEN 3 THEN date_trunc('minute', ts) WHEN 4 THEN date_trunc('day', ts) "
    "WHEN 5 THEN CASE WHEN day(ts) <= 12 THEN make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), 0) ELSE date_trunc('minute', ts) END "
    "ELSE CASE WHEN day(ts) <= 12 THEN make_timestamp(year(ts), day(ts), month(ts), 0, 0, 0) ELSE date_trunc('day', ts) END END, '%Y-%m-%d %H:%M:%S.%f') AS parsed, event_id % 7 > 6 AS failed FROM events"
)
def timestamp_patterns(t):
    """Every accepted pattern of a timestamp text; of the ambiguous ones the
    first that fits counts."""
    written = F.lit(None).cast("string")
    for i, p in enumerate(clean.TIMESTAMP_PATTERNS):
        written = F.when(F.col("event_id") % 7 == i, F.date_format("ts", p)).otherwise(written)
    parsed = clean.parse_timestamp(written)
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"), parsed.isNull().alias("failed"))


@query(
    "SELECT event_id::VARCHAR AS event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag, CASE WHEN event_id % 5 > 0 THEN user_id END::INT AS n, "
    "CASE WHEN event_id % 3 > 0 THEN CAST(value AS DECIMAL(18,2))::DOUBLE END AS price FROM events"
)
def typed_columns(t):
    """Text columns given their types; what does not parse becomes NULL."""
    k = F.col("event_id")
    flag = F.when(k % 4 == 0, " yes ").when(k % 4 == 1, "F").when(k % 4 == 2, "1").otherwise("maybe")
    n = F.when(k % 5 > 0, F.col("user_id").cast("string")).otherwise("n/a")
    price = F.when(k % 3 > 0, F.concat(F.lit("$ "), F.format_number(F.col("value").cast("decimal(18,2)"), 2))).otherwise("-")
    raw = t.events.select(k.cast("string").alias("event_id"), flag.alias("flag"), n.alias("n"), price.alias("price"))
    kinds = {"flag": "boolean", "n": "int", "price": "float"}
    config = staging.TableConfig("e", [staging.Mapped(c, c, kinds.get(c, "string")) for c in raw.columns])
    return staging.apply_types(staging.apply_mapping(raw, config), config)
