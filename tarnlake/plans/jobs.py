"""Registered queries that run whole jobs: loads into the landing zone, staging
and the star load. What they write goes below the shared folder."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.operators import alerts, contracts, expectations, ingest, profiling, rejects, staging, warehouse
from tarnlake.plans.registry import AS_OF, LOG, _log, query
from tarnlake.session import shared_dir
from tarnlake.sources import landing

AT = datetime(2024, 2, 1)


def _folder(t, name: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/tarnlake/{name}-{uuid.uuid4().hex}"


# -- landing zone and staging -------------------------------------------------


@query(
    "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderkey || '~20240201000000' AS gpk, 'I' AS op, 'dev' AS env, 'local' AS region, "
    "o_orderpriority, (SELECT count(*) FROM orders) AS batch_rows, (SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M') FROM orders) AS watermark FROM orders"
)
def full_load_batch(t):
    """A full load written as CSV and read again from the landing zone."""
    zone, table = _folder(t, "zone"), ingest.SourceTable("shop", "orders", "o_orderkey", "o_orderdate")
    done = ingest.full_load(t.orders, table, zone, AT)
    mark = done["watermark"] and done["watermark"].strftime("%Y-%m-%d %H:%M")
    raw = landing.read_raw(t.spark, zone, "orders", "shop") if done["rows"] else ingest.audit_columns(t.orders, AT, "o_orderkey")
    columns = ["o_orderkey", "gpk", "op", "env", "region", "o_orderpriority"]
    return raw.select(*[F.col(c).cast("string") for c in columns], F.lit(done["rows"]).cast("long").alias("batch_rows"), F.lit(mark).alias("watermark"))


@query(
    "WITH c AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'U' END AS op FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01') "
    "SELECT o_orderkey, op, (SELECT count(*) FILTER (op = 'U') FROM c) AS updates, (SELECT count(*) FILTER (op = 'D') FROM c) AS deletes FROM c"
)
def cdc_load_batch(t):
    """Rows changed since a watermark, deletes marked, as a Parquet batch."""
    table = ingest.SourceTable("shop", "orders", "o_orderkey", "o_orderdate", delete_when=("o_orderstatus", "F"))
    done = ingest.cdc_load(t.orders, table, _folder(t, "zone"), AT, datetime(1997, 6, 1), "parquet")
    raw = t.spark.read.parquet(done["path"]) if done["rows"] else ingest.audit_columns(t.orders.limit(0), AT, "o_orderkey")
    return raw.select("o_orderkey", "op", *[F.lit(done[c]).cast("long").alias(c) for c in ("updates", "deletes")])


STAGED = staging.TableConfig(
    "staged_events",
    [
        staging.Mapped("event_id", "event_id"),
        staging.Mapped("user_id", "user_id"),
        staging.Mapped("event_type", "kind"),
        staging.Mapped("value", "value", "float"),
        staging.Mapped("at", "happened_at", "timestamp"),
        staging.Mapped("campaign", "campaign"),
    ],
    key="user_id",
    order_by=["at", "event_id"],
    timestamps={"happened_at": ["yyyy-MM-dd HH:mm:ss.SSSSSS"]},
    partitions={"year": "happened_at", "month": "happened_at"},
)


@query(
    "SELECT user_id::VARCHAR AS user_id, event_id::VARCHAR AS event_id, event_type AS kind, value::DOUBLE AS value, NULL::VARCHAR AS campaign, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS happened_at, year(ts)::INT AS year, month(ts)::INT AS month, (SELECT count(*) FROM events) AS rows_in "
    f"FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id::VARCHAR DESC) AS nth FROM {LOG}) WHERE nth = 1 AND op <> 'D'"
)
def staging_job(t):
    """Raw CSV batches of two shapes to a typed, compacted, partitioned table."""
    raw, target = _folder(t, "raw"), _folder(t, "staged")
    log = _log(t).withColumn("at", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).drop("ts")
    landing.write_raw(log.where("event_id % 2 = 0"), f"{raw}/full_load/b1")
    landing.write_raw(log.where("event_id % 2 = 1").select(*reversed(log.columns)), f"{raw}/cdc/b2")
    done = staging.run_compaction(t.spark, raw, target, STAGED, "b2")
    shape = "user_id string, event_id string, kind string, value double, campaign string, happened_at timestamp, year int, month int"
    staged = t.spark.read.schema(shape).parquet(target) if done["rows_out"] else t.spark.createDataFrame([], shape)
    stamp = F.date_format("happened_at", "yyyy-MM-dd HH:mm:ss").alias("happened_at")
    return staged.select("user_id", "event_id", "kind", "value", "campaign", stamp, "year", "month", F.lit(done["rows_in"]).cast("long").alias("rows_in"))


@query("SELECT 'staged_events' AS table_name, 'missing' AS change, 'campaign' AS column_name, count(*) AS n FROM events UNION ALL SELECT 'staged_events', 'missing', 'at', count(*) FROM events "
       "UNION ALL SELECT 'staged_events', 'unmapped', 'ts', count(*) FROM events UNION ALL SELECT 'staged_events', 'unmapped', 'props', count(*) FROM events")  # fmt: skip
def staging_drift(t):
    return staging.drift(t.events, STAGED).withColumn("n", t.events.agg(F.count(F.lit(1)).alias("n")).scalar())


# -- star load ----------------------------------------------------------------


def _staged_leads(t) -> DataFrame:
    k = F.col("c_custkey")
    created = F.date_add(F.lit("1995-01-01").cast("date"), (k % 400).cast("int"))
    return t.customer.select(
        F.when(k % 13 == 0, "D").otherwise("I").alias("op"),
        k.cast("string").alias("lead_id"),
        F.col("c_mktsegment").alias("lead_status"),
        F.concat(F.lit("src"), (F.col("c_nationkey") % 5).cast("string")).alias("lead_source"),
        F.when(F.col("c_acctbal") > 0, "credit").otherwise("debit").alias("lead_type"),
        F.col("c_nationkey").cast("string").alias("agent_id"),
        (k % 11).cast("string").alias("area_id"),
        F.when(k % 4 > 0, F.concat(F.lit(" camp"), (k % 4).cast("string"), F.lit(" "))).alias("campaign"),
        F.col("c_acctbal").alias("budget"),
        created.alias("lead_created_at"),
        F.date_add(created, 10).alias("lead_updated_at"),
        F.when(k % 3 == 0, created).alias("date_of_last_contact"),
        F.col("c_name").alias("customer_id"),
        F.lit("x").alias("location"),
        F.lit("phone").alias("contact_method"),
        *[(k % n == 0).alias(c) for n, c in enumerate(("is_buyer", "is_seller", "is_commercial", "is_merged", "has_meeting", "do_not_call"), 2)],
    )


def _dimension(t, source: DataFrame, column: str, key: str, surrogate: str) -> DataFrame:
    members = source.select(F.col(column).alias(key))
    loaded = warehouse.load_dimension(warehouse.empty_dimension(t.spark, key, surrogate), members, key, surrogate, "2024-01-01")
    return warehouse.with_unknown(loaded, surrogate, key)


def _sql_dim(name: str, column: str, source: str = "l WHERE agent_id::INT < 20") -> str:
    return f"{name} AS (SELECT k, row_number() OVER (ORDER BY k) AS sk FROM (SELECT DISTINCT trim({column}) AS k FROM {source}) WHERE k <> '')"


STAGED_LEADS = (
    "l AS (SELECT c_custkey::VARCHAR AS lead_id, c_mktsegment AS lead_status, 'src' || (c_nationkey % 5) AS lead_source, "
    "CASE WHEN c_acctbal > 0 THEN 'credit' ELSE 'debit' END AS lead_type, c_nationkey::VARCHAR AS agent_id, (c_custkey % 11)::VARCHAR AS area_id, "
    "CASE WHEN c_custkey % 4 > 0 THEN ' camp' || (c_custkey % 4) || ' ' END AS campaign, CAST(c_acctbal AS DECIMAL(15,2)) AS budget, "
    "DATE '1995-01-01' + (c_custkey % 400)::INT AS created, c_custkey AS n, c_name FROM customer)"
)
LEAD_DIMS = (("status", "lead_status", "status_name"), ("source", "lead_source", "source_name"), ("type", "lead_type", "type_name"), ("agent", "agent_id", "agent_id"), ("area", "area_id", "area_id"), ("campaign", "campaign", "campaign_name"))
DAY = "strftime({}, '%Y%m%d')::INT"


@query(
    f"WITH {STAGED_LEADS}, {', '.join(_sql_dim('d_' + n, c) for n, c, _ in LEAD_DIMS)} "
    "SELECT lead_id, coalesce(s.sk, -1) AS lead_status_sk, coalesce(o.sk, -1) AS lead_source_sk, coalesce(y.sk, -1) AS lead_type_sk, coalesce(g.sk, -1) AS agent_sk, "
    f"coalesce(a.sk, -1) AS area_sk, coalesce(c.sk, -1) AS campaign_sk, {DAY.format('created')} AS created_date_sk, {DAY.format('created + 10')} AS updated_date_sk, "
    f"CASE WHEN n % 3 = 0 THEN {DAY.format('created')} END AS last_contact_date_sk, c_name AS customer_id, budget::DOUBLE AS budget, 'x' AS location, 'phone' AS contact_method, n % 2 = 0 AS is_buyer, "
    "n % 3 = 0 AS is_seller, n % 4 = 0 AS is_commercial, n % 5 = 0 AS is_merged, n % 6 = 0 AS has_meeting, n % 7 = 0 AS do_not_call, md5(lead_id || '|' || lead_status || '|' || budget::VARCHAR || '|' || (created + 10)::VARCHAR) AS record_hash FROM l "
    "LEFT JOIN d_status s ON lead_status = s.k LEFT JOIN d_source o ON lead_source = o.k LEFT JOIN d_type y ON lead_type = y.k LEFT JOIN d_agent g ON agent_id = g.k "
    "LEFT JOIN d_area a ON area_id = a.k LEFT JOIN d_campaign c ON trim(campaign) = c.k WHERE n % 13 <> 0"
)
def star_fact_leads(t):
    """Six dimensions loaded, then the facts of leads with every lookup."""
    staged = _staged_leads(t)
    seen = staged.where(F.col("agent_id").cast("int") < 20)
    named = {"agent": "agent_sk", "area": "area_sk", "campaign": "campaign_sk"}
    dims = warehouse.load_dimensions(seen, {n: (c, key, named.get(n, f"lead_{n}_sk")) for n, c, key in LEAD_DIMS}, "2024-01-01")
    dims["date"] = warehouse.date_dimension(t.spark, "1994-01-01", "1998-12-31")
    facts = warehouse.fact_leads(staged, dims)
    return facts.withColumn("budget", F.col("budget").cast("double"))


@query(
    "WITH l AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS lead_sk FROM customer WHERE c_custkey % 10 <> 0), "
    f"{_sql_dim('p', 'o_orderpriority', 'orders WHERE o_orderkey % 5 <> 0')}, {_sql_dim('c', 'o_orderstatus', 'orders')}, {_sql_dim('a', '(o_orderkey % 6)::VARCHAR', 'orders WHERE o_orderkey % 6 < 4')} "
    "SELECT o_orderkey AS sale_id, o_custkey AS lead_id, coalesce(lead_sk, -1) AS lead_sk, coalesce(p.sk, -1) AS property_type_sk, coalesce(a.sk, -1) AS area_sk, "
    f"coalesce(c.sk, -1) AS sale_category_sk, {DAY.format('o_orderdate')} AS reservation_date_sk, {DAY.format('o_orderdate + INTERVAL 3 DAY')} AS update_date_sk, "
    "NULL::INT AS contract_date_sk, CAST(o_totalprice AS DECIMAL(15,2))::DOUBLE AS actual_value, CAST(o_totalprice AS DECIMAL(15,2))::DOUBLE AS unit_value, CAST(o_totalprice AS DECIMAL(15,2))::DOUBLE AS expected_value, 'x' AS unit_location, 1 AS payment_years, "
    "md5(o_orderkey || '|' || o_custkey || '|' || CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR || '|' || o_orderstatus) AS record_hash "
    "FROM orders LEFT JOIN l ON o_custkey = c_custkey LEFT JOIN p ON o_orderpriority = p.k LEFT JOIN c ON o_orderstatus = c.k LEFT JOIN a ON (o_orderkey % 6)::VARCHAR = a.k"
)
def star_fact_sales(t):
    """Facts of sales with the surrogate key of their lead."""
    price = F.col("o_totalprice")
    staged = t.orders.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("lead_id"), F.col("o_orderpriority").alias("property_type"),
        (F.col("o_orderkey") % 6).cast("string").alias("area_id"), F.col("o_orderstatus").alias("sale_category"), F.col("o_orderdate").alias("sale_date"),
        F.date_add("o_orderdate", 3).alias("reservation_update_date"), F.lit(None).cast("date").alias("contract_date"),
        price.alias("unit_value"), price.alias("expected_value"), price.alias("actual_value"), F.lit("x").alias("unit_location"), F.lit(1).alias("payment_years"),
    )
    leads = warehouse.number_rows(t.customer.where("c_custkey % 10 != 0").select(F.col("c_custkey").alias("lead_id")), ["lead_id"], "lead_sk")
    specs = {"property": ("property_type", "type_name", "property_type_sk"), "area": ("area_id", "area_id", "area_sk"), "category": ("sale_category", "category_name", "sale_category_sk")}
    dims = warehouse.load_dimensions(staged, specs, "2024-01-01", {"property": F.col("sale_id") % 5 != 0, "area": F.col("area_id").cast("int") < 4})
    dims["date"] = warehouse.date_dimension(t.spark, "1990-01-01", "2010-12-31")
    facts = warehouse.fact_sales(staged, leads, dims)
    return facts.withColumns({c: F.col(c).cast("double") for c in ("unit_value", "expected_value", "actual_value")})


@query(
    "WITH o AS (SELECT c_nationkey::VARCHAR AS agent_id, row_number() OVER (ORDER BY c_nationkey::VARCHAR) AS sk FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey < 10)) "
    "SELECT agent_id, sk AS agent_sk, true AS is_current FROM o UNION ALL SELECT '-1', -1, true UNION ALL "
    "SELECT c_nationkey::VARCHAR, (SELECT count(*) FROM o) + row_number() OVER (ORDER BY c_nationkey::VARCHAR), true FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey >= 10)"
)
def dimension_reload(t):
    """A dimension loaded twice: known members keep their keys."""
    agents = t.customer.select(F.col("c_nationkey").cast("string").alias("agent_id"))
    first = _dimension(t, agents.where("cast(agent_id AS int) < 10"), "agent_id", "agent_id", "agent_sk")
    return warehouse.load_dimension(first, agents, "agent_id", "agent_sk", "2024-02-01").select("agent_id", "agent_sk", "is_current")


# -- alerts and profiles ------------------------------------------------------


@query(
    "WITH d AS (SELECT event_type AS table_name, round(count(*) FILTER (value > 50) * 100.0 / count(*), 2) AS completeness, "
    "round(count(DISTINCT user_id) * 100.0 / count(*), 2) AS uniqueness FROM events GROUP BY 1), "
    "u AS (SELECT table_name, 'completeness' AS dimension, completeness AS score, 80.0 AS lim FROM d UNION ALL SELECT table_name, 'uniqueness', uniqueness, 90.0 FROM d) "
    "SELECT 'quality_score' AS alert_type, CASE WHEN score < lim / 2 THEN 'critical' ELSE 'warning' END AS severity, table_name AS source, "
    "dimension || ' below limit' AS title, printf('%.2f < %.2f', score::DOUBLE, lim::DOUBLE) AS message FROM u WHERE score < lim"
)
def alert_scores(t):
    n = F.count(F.lit(1))
    scores = t.events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.round(F.count_if(F.col("value") > 50) * 100.0 / n, 2).alias("completeness"), F.round(F.countDistinct("user_id") * 100.0 / n, 2).alias("uniqueness")
    )
    return alerts.score_alerts(scores, AS_OF, {"completeness": 80.0, "uniqueness": 90.0}).drop("created_at")


@query(
    "SELECT 'freshness' AS alert_type, 'warning' AS severity, u AS source, 'table is stale' AS title, h AS hours FROM "
    f"(SELECT user_id::VARCHAR AS u, round(date_diff('second', max(ts), TIMESTAMP '{AS_OF}') / 3600.0, 2) AS h FROM events GROUP BY 1) WHERE h > 24"
)
def alert_freshness(t):
    last = t.events.groupBy(F.col("user_id").cast("string").alias("table_name")).agg(F.max("ts").alias("last_update"))
    found = alerts.freshness_alerts(last, AS_OF)
    return found.select("alert_type", "severity", "source", "title", F.col("message").cast("double").alias("hours"))


@query(
    "SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.page')) AS with_page, sum(length(props)) AS chars FROM events GROUP BY 1"
)
def json_fields(t):
    """A field of a JSON text by path, counted by kind."""
    page = clean.json_field(F.col("props"), "page")
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(page).alias("with_page"), F.sum(F.length("props")).alias("chars"))


@query(
    "SELECT 'o_totalprice' AS column_name, CAST(quantile_cont(o_totalprice, 0.5) AS DECIMAL(18,1))::DOUBLE AS median, "
    "CAST(quantile_cont(o_totalprice, 0.95) AS DECIMAL(18,1))::DOUBLE AS p95 FROM orders UNION ALL "
    "SELECT 'o_custkey', CAST(quantile_cont(o_custkey, 0.5) AS DECIMAL(18,1))::DOUBLE, CAST(quantile_cont(o_custkey, 0.95) AS DECIMAL(18,1))::DOUBLE FROM orders"
)
def exact_quantiles(t):
    """Quantiles by ranks over range-sorted values; no task holds a column."""
    q = profiling.quantiles(t.orders, ["o_totalprice", "o_custkey"], [0.5, 0.95])
    exact = lambda i: F.get("quantiles", i).cast("decimal(18,1)").cast("double")
    return q.select("column_name", exact(0).alias("median"), exact(1).alias("p95"))


@query(
    "WITH m AS (SELECT event_type, count(*) AS n, max(date_trunc('second', ts)) AS last FROM events GROUP BY 1) "
    "SELECT 'data_row_count' AS name, event_type AS table_name, n::DOUBLE AS value FROM m UNION ALL "
    f"SELECT 'data_freshness_hours', event_type, round(date_diff('second', last, TIMESTAMP '{AS_OF}') / 3600.0, 3)::DOUBLE FROM m"
)
def table_metrics(t):
    sizes = t.events.groupBy(F.col("event_type").alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"), F.max(F.date_trunc("second", "ts")).alias("last_update"))
    found = alerts.table_metrics(sizes, "raw", AS_OF)
    return found.select("name", F.col("labels")["table_name"].alias("table_name"), clean.rounded(F.col("value"), 3).alias("value"))


@query(
    "WITH r AS (SELECT count(*) AS total, count(*) FILTER (event_type = 'purchase') AS bad FROM events), d AS (SELECT round(bad * 100.0 / total, 2)::DOUBLE AS rate FROM r), "
    "k AS (SELECT DISTINCT event_type AS c FROM events), i AS (SELECT greatest(0, round(count(*) FILTER (c IN ('view', 'click')) * 100.0 / 3 - 5 * count(*) FILTER (c NOT IN ('view', 'click')) - 10 * (3 - count(*) FILTER (c IN ('view', 'click'))), 2))::DOUBLE AS score FROM k) "
    "SELECT 'rejection_rate' AS alert_type, CASE WHEN rate > 10 THEN 'critical' ELSE 'warning' END AS severity, 'events' AS source, 'rejection rate is high' AS title, rate::VARCHAR AS message FROM d WHERE rate > 5 "
    "UNION ALL SELECT 'critical_rule', 'critical', 'events', 'purchase', bad::VARCHAR FROM r WHERE bad > 0 "
    "UNION ALL SELECT 'quality_score', CASE WHEN s < 40 THEN 'critical' ELSE 'warning' END, 'events', 'completeness below limit', printf('%.2f < 80.00', s) FROM "
    "(SELECT round(count(*) FILTER (value > 50) * 100.0 / count(*), 2)::DOUBLE AS s FROM events) WHERE s < 80 "
    "UNION ALL SELECT 'schema_drift', 'warning', 'events', 'new column ' || c, 'new' FROM k WHERE c NOT IN ('view', 'click') UNION ALL SELECT 'schema_drift', 'error', 'events', 'missing column refund', 'missing' FROM r "
    "UNION ALL SELECT 'schema_integrity', CASE WHEN score < 80 THEN 'error' ELSE 'warning' END, 'events', 'schema integrity is low', score::VARCHAR FROM i WHERE score < 95 "
    "UNION ALL SELECT 'pii_detected', 'warning', 'documents', 'email in text', n::VARCHAR FROM (SELECT count(*) AS n FROM documents WHERE regexp_matches(text, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[A-Z|a-z]{2,}')) WHERE n > 0"
)
def alert_all_checks(t):
    """Every check over one table in one call: schema drift and integrity of its
    kinds, scores, rejections and personal data, with titles and messages."""
    rules = (rejects.Rule("purchase", "regex", ("event_type",), severity="critical", action="quarantine", pattern="^purchase$"),)
    score = F.round(F.count_if(F.col("value") > 50) * 100.0 / F.count(F.lit(1)), 2)
    scores = t.events.agg(score.alias("completeness")).select(F.lit("events").alias("table_name"), "completeness", *[F.lit(100.0).alias(c) for c in ("uniqueness", "validity", "timeliness", "overall")])
    agreed = t.spark.createDataFrame([(c, "string") for c in ("view", "click", "refund")], "column_name string, data_type string")
    seen = t.events.select(F.col("event_type").alias("column_name")).distinct().withColumn("data_type", F.lit("string"))
    found = alerts.run_checks(
        AS_OF, "events", drift=(contracts.drift(agreed, seen), contracts.integrity(agreed, seen)), dimensions=scores,
        rejections=(rejects.totals(t.events, rules), rejects.summary(t.events, rules)), pii=rejects.scan_pii(t.documents, "documents", ["text"]).where("pii_type = 'email'"),
    )
    return found.drop("created_at")


def _sql_profile(table: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count, round((count(*) - count({column})) * 100.0 / count(*), 2)::DOUBLE AS null_pct, "
        f"count(DISTINCT {column}) AS distinct_count, round(count(DISTINCT {column}) * 100.0 / count({column}), 2)::DOUBLE AS distinct_pct, count({column}) - count(DISTINCT {column}) AS duplicate_count, NULL::VARCHAR AS error FROM {table}"
    )


@query(" UNION ALL ".join(_sql_profile(t, c) for t, c in (("nation", "n_name"), ("nation", "n_regionkey"), ("orders", "o_custkey"), ("orders", "o_orderpriority"))))
def profile_every_table(t):
    """The long profile of several tables, every column of it."""
    found = profiling.profile_all({"orders": t.orders.select("o_custkey", "o_orderpriority"), "nation": t.nation.select("n_name", "n_regionkey")})
    return found.withColumns({c: F.col(c).cast("double") for c in ("null_pct", "distinct_pct")})


E_ = expectations.Expectation
FULL_SUITE = [
    E_("expect_table_columns_to_match_set", {"column_set": ["event_id", "ts", "user_id", "event_type", "value", "props"]}),
    E_("expect_table_columns_to_match_set", {"column_set": ["event_id", "campaign"], "exact_match": False}, True),
    E_("expect_column_values_to_not_match_regex", {"column": "event_type", "regex": "pur"}, True),
    E_("expect_column_values_to_not_match_regex", {"column": "event_type", "regex": "pur", "mostly": 0.5}),
    E_("expect_column_values_to_be_between", {"column": "value", "min_value": 10, "mostly": 0.99}),
    E_("expect_column_values_to_be_in_set", {"column": "campaign", "value_set": ["a"]}),
]
FULL_SQL = (
    "WITH s AS (SELECT count(*) AS n, count(*) FILTER (event_type LIKE 'pur%') AS p, count(*) FILTER (value < 10) AS v FROM events), "
    "e AS (SELECT 1 AS i, 'expect_table_columns_to_match_set' AS expectation, NULL AS column_name, true AS success, false AS blocking, 6::BIGINT AS checked, 0::BIGINT AS failed FROM s "
    "UNION ALL SELECT 2, 'expect_table_columns_to_match_set', NULL, false, true, 2, 1 FROM s "
    "UNION ALL SELECT 3, 'expect_column_values_to_not_match_regex', 'event_type', p = 0, true, n, p FROM s "
    "UNION ALL SELECT 4, 'expect_column_values_to_not_match_regex', 'event_type', (n - p) / n >= 0.5, false, n, p FROM s "
    "UNION ALL SELECT 5, 'expect_column_values_to_be_between', 'value', (n - v) / n >= 0.99, false, n, v FROM s "
    "UNION ALL SELECT 6, 'expect_column_values_to_be_in_set', 'campaign', false, false, 0, 0 FROM s) "
)


@query(FULL_SQL + "SELECT expectation, column_name, success, blocking, checked, failed, CASE WHEN checked = 0 THEN 1.0::DOUBLE ELSE round((checked - failed)::DOUBLE / checked, 6) END AS fraction FROM e")
def expectation_results(t):
    found = expectations.run_suite(t.events, FULL_SUITE)
    return found.select("expectation", "column_name", "success", "blocking", "checked", "failed", F.round("fraction", 6).alias("fraction"))


@query(
    FULL_SQL + "SELECT count(*) AS evaluated, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS unsuccessful, "
    "round(count(*) FILTER (success) * 100.0 / count(*), 2)::DOUBLE AS success_pct, count(*) FILTER (blocking AND NOT success) AS blocking_failures FROM e"
)
def expectation_statistics(t):
    """A checkpoint that reports its blocking failures instead of raising."""
    found = expectations.statistics(expectations.checkpoint(t.events, FULL_SUITE, raise_on_failure=False))
    return found.withColumn("success_pct", F.col("success_pct").cast("double"))


@query(
    FULL_SQL + "SELECT 'events' AS table_name, 'raw' AS stage, count(*) AS evaluated, count(*) FILTER (success) AS successful, "
    "round(count(*) FILTER (success) * 100.0 / count(*), 2)::DOUBLE AS success_pct, count(*) FILTER (blocking AND NOT success) AS blocking_failures FROM e"
)
def quality_report(t):
    results = expectations.run_suite(t.events, FULL_SUITE).withColumns({"table_name": F.lit("events"), "stage": F.lit("raw")})
    return alerts.quality_report(results).withColumn("success_pct", F.col("success_pct").cast("double"))


@query(
    "WITH a AS (SELECT count(*)::DOUBLE AS n, count(DISTINCT o_custkey)::DOUBLE AS d FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'), "
    "b AS (SELECT count(*)::DOUBLE AS n, count(DISTINCT o_custkey)::DOUBLE AS d FROM orders) "
    "SELECT 'o_custkey' AS column_name, 'row_count' AS metric, a.n AS old, b.n AS new, b.n - a.n AS change FROM a, b "
    "UNION ALL SELECT 'o_custkey', 'distinct_count', a.d, b.d, b.d - a.d FROM a, b"
)
def profile_change(t):
    profiles = [profiling.completeness_profile(df.select("o_custkey")) for df in (t.orders.where("o_orderdate < TIMESTAMP_NTZ'1997-01-01'"), t.orders)]
    return profiling.profile_drift(*profiles, ["row_count", "distinct_count"])


@query(
    "SELECT name, 'gauge' AS kind, value FROM (SELECT count(*)::DOUBLE AS row_count, round(count(DISTINCT o_orderkey) * 100.0 / count(*), 2)::DOUBLE AS uniqueness, "
    "sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS revenue FROM orders) UNPIVOT (value FOR name IN (row_count, uniqueness, revenue))"
)
def metric_gauges(t):
    n = F.count(F.lit(1))
    row = t.orders.agg(n.alias("row_count"), F.round(F.countDistinct("o_orderkey") * 100.0 / n, 2).alias("uniqueness"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    return alerts.metric_rows(row, ["row_count", "uniqueness", "revenue"], {"stage": "raw"}, AS_OF).select("name", "kind", "value")


@query(
    "WITH k AS (SELECT DISTINCT event_type AS c FROM events), i AS (SELECT greatest(0, round(count(*) FILTER (c IN ('view', 'purchase')) * 100.0 / 2 - 5 * count(*) FILTER (c NOT IN ('view', 'purchase')) - 10 * (2 - count(*) FILTER (c IN ('view', 'purchase'))), 2))::DOUBLE AS score FROM k) "
    "SELECT 'schema_drift' AS alert_type, 'warning' AS severity, 'events' AS source, 'new column ' || c AS title, 'new' AS message FROM k WHERE c NOT IN ('view', 'purchase') "
    "UNION ALL SELECT 'schema_integrity', CASE WHEN score < 80 THEN 'error' ELSE 'warning' END, 'events', 'schema integrity is low', score::VARCHAR FROM i WHERE score < 95"
)
def alert_integrity(t):
    """Alerts of a contract: kinds not agreed on, and the integrity score."""
    agreed = t.spark.createDataFrame([(c, "string") for c in ("view", "purchase")], "column_name string, data_type string")
    seen = t.events.select(F.col("event_type").alias("column_name")).distinct().withColumn("data_type", F.lit("string"))
    return alerts.drift_alerts(contracts.drift(agreed, seen), contracts.integrity(agreed, seen), "events", AS_OF).drop("created_at")
