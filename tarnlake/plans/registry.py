"""All registered queries of the lakehouse, with the SQL that must agree.

Leads and sales are read from the driver's tables: customers are leads (source:
market segment, agent: nation, budget: account balance), orders are sales,
events are a change log (signup inserts, error deletes, the rest updates).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.functions.pii import PATTERNS
from tarnlake.operators import alerts, contracts, expectations, ingest, profiling, rejects, staging, warehouse
from tarnlake.plans import business
from tarnlake.sources import jdbc

FLAGSHIP = "q07_conversion"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF = "2024-02-01 00:00:00"


class Tables:
    """The tables of one scale folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def _leads(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("lead_id"),
        F.col("c_mktsegment").alias("lead_source"),
        F.col("c_nationkey").alias("agent_id"),
        money("c_acctbal").alias("budget"),
        (F.col("c_acctbal") > 5000).alias("is_buyer"),
        (F.col("c_custkey") % 3 == 0).alias("is_seller"),
    )


def _sales(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_custkey").alias("lead_id"),
        F.col("o_orderpriority").alias("sale_category"),
        F.col("o_orderstatus").alias("sale_status"),
        money("o_totalprice").alias("actual_value"),
        F.col("o_orderdate").alias("sale_date"),
    )


def _log(t: Tables) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return t.events.select("event_id", "user_id", "ts", "event_type", money("value").alias("value"), op.alias("op"))


LEADS = (
    "(SELECT c_custkey AS lead_id, c_mktsegment AS lead_source, c_nationkey AS agent_id, CAST(c_acctbal AS DECIMAL(18,2)) AS budget, "
    "c_acctbal > 5000 AS is_buyer, c_custkey % 3 = 0 AS is_seller FROM customer)"
)
SALES = (
    "(SELECT o_orderkey AS sale_id, o_custkey AS lead_id, o_orderpriority AS sale_category, o_orderstatus AS sale_status, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS actual_value, o_orderdate AS sale_date FROM orders)"
)
LOG = (
    "(SELECT event_id, user_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS value, "
    "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op FROM events)"
)


def exact_mean(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# -- business queries ---------------------------------------------------------


@query(f"SELECT sale_status, count(*) AS lead_count, round(CAST(sum(actual_value) AS DOUBLE) / count(*), 2) AS avg_value FROM {SALES} GROUP BY 1")
def q01_status_avg(t):
    return business.by_group(_sales(t), "sale_status", "actual_value", average="avg_value")


@query(f"SELECT lead_source, count(*) AS lead_count, count(*) FILTER (is_buyer) AS buyers, count(*) FILTER (is_seller) AS sellers FROM {LEADS} GROUP BY 1")
def q02_source_flags(t):
    return business.flags_by_group(_leads(t), "lead_source", {"buyers": F.col("is_buyer"), "sellers": F.col("is_seller")})


@query(f"SELECT CAST(year(sale_date) AS INT) AS year, CAST(month(sale_date) AS INT) AS month, count(*) AS new_leads FROM {SALES} GROUP BY 1, 2")
def q03_monthly_trend(t):
    return business.monthly(_sales(t), "sale_date")


@query(
    "SELECT p_brand, count(*) AS leads, count(DISTINCT p_type) AS unique_types FROM part WHERE p_brand IS NOT NULL AND trim(p_brand) <> '' "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)
def q04_top_campaigns(t):
    return business.top_with_variety(t.part, "p_brand", "p_type", 10, "leads", "unique_types")


@query(
    "SELECT count(*) AS total_sales, CAST(sum(actual_value) AS DOUBLE) AS total_revenue, CAST(min(actual_value) AS DOUBLE) AS min_sale, "
    f"CAST(max(actual_value) AS DOUBLE) AS max_sale, round(CAST(sum(actual_value) AS DOUBLE) / count(*), 2) AS avg_sale FROM {SALES}"
)
def q05_sales_summary(t):
    s = business.value_summary(_sales(t), "actual_value")
    s = exact_mean(s, "total_revenue", "min_sale", "max_sale")
    return s.withColumn("avg_sale", F.round(F.col("total_revenue") / F.col("total_sales"), 2))


@query(f"SELECT sale_category, count(*) AS sale_count, CAST(sum(actual_value) AS DOUBLE) AS total_value FROM {SALES} GROUP BY 1")
def q06_sales_by_category(t):
    return exact_mean(business.value_by_group(_sales(t), "sale_category", "actual_value"), "total_value")


@query(
    "SELECT l.lead_source, count(DISTINCT l.lead_id) AS total_leads, count(DISTINCT s.lead_id) AS converted_leads, "
    "round(count(DISTINCT s.lead_id) * 100.0 / count(DISTINCT l.lead_id), 2)::DOUBLE AS conversion_rate_pct "
    f"FROM {LEADS} l LEFT JOIN {SALES} s ON l.lead_id = s.lead_id GROUP BY 1 HAVING count(DISTINCT l.lead_id) > 10"
)
def q07_conversion(t):
    out = business.conversion(_leads(t), _sales(t), "lead_id", "lead_id", "lead_source")
    return exact_mean(out, "conversion_rate_pct")


@query(
    "SELECT o_custkey AS agent_id, count(*) AS leads_handled, count(*) FILTER (o_orderstatus LIKE '%F%' OR o_orderpriority LIKE '%URGENT%') AS converted, "
    "round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS avg_value, "
    "round(count(*) FILTER (o_orderstatus LIKE '%F%' OR o_orderpriority LIKE '%URGENT%') * 100.0 / count(*), 2)::DOUBLE AS conversion_rate "
    "FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
)
def q08_agent_perf(t):
    won = F.col("sale_status").like("%F%") | F.col("sale_category").like("%URGENT%")
    return exact_mean(business.agents(_sales(t), "lead_id", won, "actual_value", average="avg_value"), "conversion_rate")


@query(
    "SELECT CASE WHEN is_buyer AND is_seller THEN 'Both' WHEN is_buyer THEN 'Buyer' WHEN is_seller THEN 'Seller' ELSE 'Unknown' END AS segment, "
    f"count(*) AS lead_count, round(CAST(sum(budget) AS DOUBLE) / count(*), 2) AS avg_budget FROM {LEADS} GROUP BY 1"
)
def q09_segment_case(t):
    return exact_mean(business.segments(_leads(t), F.col("is_buyer"), F.col("is_seller"), "budget"), "avg_budget")


@query(
    "SELECT c_nationkey::VARCHAR AS nation, count(*) AS lead_count, count(DISTINCT c_mktsegment) AS source_diversity FROM customer WHERE c_nationkey IS NOT NULL "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
)
def q10_geo_top(t):
    df = t.customer.withColumn("nation", F.col("c_nationkey").cast("string"))
    return business.top_with_variety(df, "nation", "c_mktsegment", 15, "lead_count", "source_diversity")


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def q11_inventory_union(t):
    return business.inventory({n: getattr(t, n) for n in COUNTED})


@query(
    "SELECT d.date_actual, count(o.o_orderkey) AS orders FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_actual FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' ORDER BY 1 LIMIT 10) d "
    "JOIN orders o ON CAST(o.o_orderdate AS DATE) = d.date_actual GROUP BY 1"
)
def q12_date_slice(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("date_actual"))
    some = business.date_slice(days.distinct(), "1995-01-01", "1995-12-31")
    return days.join(some, "date_actual").groupBy("date_actual").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "SELECT c_custkey, c_name, n_name, r_name, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS budget FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey"
)
def q13_lead_fact_dims(t):
    fact = t.customer.withColumnRenamed("c_nationkey", "n_nationkey").withColumn("budget", money("c_acctbal").cast("double"))
    dims = [(t.nation, "n_nationkey"), (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")]
    return business.decorated(fact, dims, ["c_custkey", "c_name", "n_name", "r_name", "budget"], "c_custkey")


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name, o_orderstatus, CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS value FROM lineitem "
    "LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey"
)
def q14_sale_fact_dims(t):
    fact = t.lineitem.withColumn("value", money("l_extendedprice").cast("double"))
    dims = [
        (t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
        (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
        (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey"),
    ]
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name", "o_orderstatus", "value"]
    return business.decorated(fact, dims, columns, "l_orderkey")


@query(
    "WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, ts) AS kind FROM events GROUP BY 1, 2), "
    "m AS (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY day) AS before FROM c), "
    "k AS (SELECT user_id, kind, day FROM m WHERE before IS NULL OR before <> kind) "
    "SELECT user_id, kind, day AS effective_from, coalesce(lead(day) OVER w, DATE '9999-12-31') AS effective_to, lead(day) OVER w IS NULL AS is_current "
    "FROM k WHERE user_id IN (SELECT user_id FROM k GROUP BY 1 HAVING count(*) > 1) WINDOW w AS (PARTITION BY user_id ORDER BY day)"
)
def q15_scd2_history(t):
    from pyspark.sql import Window as W

    days = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.max_by("event_type", "ts").alias("kind"))
    before = F.lag("kind").over(W.partitionBy("user_id").orderBy("day"))
    changes = days.withColumn("before", before).where("before is null or before != kind").drop("before")
    dim = warehouse.history(changes, "user_id", "day").drop("day")
    return business.versions(dim, "user_id")


@query(
    "SELECT 'documents' AS dataset, count(*) AS total_rows, count(*) FILTER (l.quality IS NULL) AS null_quality, count(*) FILTER (l.toxic IS NULL) AS null_toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def q16_null_analysis(t):
    return business.null_analysis(t.documents.select("doc_id").join(t.labels, "doc_id", "left"), "documents", ["quality", "toxic"])


@query(
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrence FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10"
)
def q17_duplicate_check(t):
    return business.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    f"SELECT 'b1' AS batch_id, table_name, records_loaded, 'success' AS load_status, '{AS_OF}' AS start_time, '{AS_OF[:-1]}9' AS end_time FROM (SELECT 'customer' AS table_name, count(*) AS records_loaded FROM customer "
    "UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events)"
)
def q18_load_history(t):
    log = warehouse.load_log(t.spark, "b1", {n: getattr(t, n) for n in ("customer", "orders", "events")}, AS_OF, f"{AS_OF[:-1]}9")
    return business.load_history(log).withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_time", "end_time")})


@query("SELECT n_name, count(*) AS lead_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def q19_status_inner(t):
    return business.counts_by_member(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey", "n_name")


@query(
    "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, monthname(o_orderdate) AS month_name, count(*) AS sale_count, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2, 3"
)
def q20_revenue_by_month(t):
    bounds = _sales(t).agg(F.min("sale_date").cast("date").alias("a"), F.max("sale_date").cast("date").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("day"))
    parts = clean.calendar(F.col("day"))
    dates = days.select("day", *[parts[n].alias(n) for n in ("year", "month", "month_name")])
    fact = _sales(t).withColumn("day", F.col("sale_date").cast("date"))
    return exact_mean(business.revenue_by_month(fact, dates, "day", "actual_value"), "revenue")


# -- ingestion and staging ----------------------------------------------------


@query("SELECT event_id, ts, user_id, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n "
       f"FROM {LOG}) WHERE n = 1 AND op <> 'D'")  # fmt: skip
def compact_keep_latest(t):
    return staging.compact(_log(t), "user_id", ["ts", "event_id"]).select("event_id", "ts", "user_id", "op")


@query("SELECT event_id, ts, user_id, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n "
       f"FROM {LOG} WHERE op <> 'D') WHERE n = 1")  # fmt: skip
def compact_deletes_first(t):
    return staging.compact(_log(t), "user_id", ["ts", "event_id"], dedup_first=False).select("event_id", "ts", "user_id", "op")


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n FROM orders GROUP BY 1, 2")
def partition_cols(t):
    df = staging.partition_columns(t.orders, {"year": "o_orderdate", "month": "o_orderdate"})
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT count(*) FILTER (op = 'I') AS inserts, count(*) FILTER (op = 'U') AS updates, count(*) FILTER (op = 'D') AS deletes FROM {LOG}")
def op_counts(t):
    return ingest.op_counts(_log(t))


@query("SELECT event_id, user_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def incremental_since(t):
    from datetime import datetime

    mark = datetime(2024, 1, 20, 12)
    return jdbc.incremental(t.events, "ts", mark).select("event_id", "user_id", "ts")


@query("SELECT event_id, user_id || '~20240201000000' AS gpk, 'test' AS env, 'local' AS region, CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op FROM events")
def audit_rows(t):
    from datetime import datetime

    df = ingest.audit_columns(t.events, datetime(2024, 2, 1), "user_id", "U", "test", delete_when=("event_type", "error"))
    return df.select("event_id", "gpk", "env", "region", "op")


MAPPING = [
    staging.Mapped("c_custkey", "lead_id"),
    staging.Mapped("c_mktsegment", "lead_source"),
    staging.Mapped("c_acctbal", "budget", "float"),
    staging.Mapped("c_campaign", "campaign"),
]


def _mapped(t: Tables, mode: str, **more) -> DataFrame:
    return staging.apply_mapping(t.customer, staging.TableConfig("leads", MAPPING, mode=mode, **more))


@query("SELECT c_custkey AS lead_id, c_mktsegment AS lead_source, c_acctbal AS budget, CAST(NULL AS VARCHAR) AS campaign FROM customer")
def schema_map_strict(t):
    return _mapped(t, "strict")


@query("SELECT c_custkey AS lead_id, c_mktsegment AS lead_source, c_acctbal AS budget, CAST(NULL AS VARCHAR) AS campaign, c_name, c_nationkey FROM customer")
def schema_map_flexible(t):
    return _mapped(t, "flexible")


@query("SELECT *, CAST(NULL AS VARCHAR) AS c_campaign FROM customer")
def schema_map_pass_through(t):
    return _mapped(t, "pass_through")


@query("SELECT c_custkey AS lead_id, c_mktsegment AS lead_source, c_acctbal AS budget FROM customer")
def schema_map_drop_skip(t):
    return _mapped(t, "flexible", unmapped="drop", missing="skip")


# -- scalar functions ---------------------------------------------------------


@query(
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false END AS flag, "
    "TRY_CAST(replace(replace('$' || value::DECIMAL(18,2)::VARCHAR, '$', ''), ',', '') AS DOUBLE) AS amount, "
    "regexp_replace(trim('  ' || event_type || '   x '), '\\s+', ' ', 'g') AS cleaned, date_trunc('minute', ts) AS parsed FROM events"
)
def clean_scalars(t):
    text = F.date_format("ts", "M/d/yyyy H:mm")
    return t.events.select(
        "event_id",
        clean.parse_boolean(F.element_at(F.array(*map(F.lit, (" yes", "T", "0", "false ", "maybe"))), (F.col("event_id") % 5 + 1).cast("int"))).alias("flag"),
        clean.parse_numeric(F.concat(F.lit("$"), money("value").cast("string"))).alias("amount"),
        clean.clean_string(F.concat(F.lit("  "), "event_type", F.lit("   x "))).alias("cleaned"),
        clean.parse_timestamp(text).cast("timestamp_ntz").alias("parsed"),
    )


@query(
    "SELECT status, count(*) AS n FROM (SELECT CASE s WHEN 'NOT INTERESTED' THEN 'NOT_INTERESTED' WHEN 'NO ANSWER' THEN 'UNREACHABLE' WHEN 'NEW' THEN 'NEW' "
    "WHEN 'LOST' THEN 'LOST' ELSE replace(s, ' ', '_') END AS status FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'NEW' WHEN '2-HIGH' THEN "
    "'NO ANSWER' WHEN '3-MEDIUM' THEN 'NOT INTERESTED' WHEN '5-LOW' THEN 'LOST' ELSE 'A B ' || o_orderstatus END AS s FROM orders)) GROUP BY 1"
)
def normalize_status(t):
    p = F.col("o_orderpriority")
    raw = F.when(p == "1-URGENT", " new ").when(p == "2-HIGH", "No Answer").when(p == "3-MEDIUM", "not interested").when(p == "5-LOW", "lost")
    raw = raw.otherwise(F.concat(F.lit("a b "), "o_orderstatus"))
    return t.orders.groupBy(clean.normalize_status(raw).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, md5(o_orderkey || '|' || o_orderstatus || '|' || CAST(o_totalprice AS DECIMAL(15,2))::VARCHAR || '|' || o_orderdate::DATE::VARCHAR) AS record_hash FROM orders")
def record_hash(t):
    fields = [F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(15,2)"), F.col("o_orderdate").cast("date")]
    return t.orders.select("o_orderkey", clean.record_hash(*fields).alias("record_hash"))


@query("SELECT count(*) AS n, count(*) FILTER (json_valid(props)) AS blobs, sum(length(props)) AS chars FROM events")
def json_blobs(t):
    return t.events.agg(F.count(F.lit(1)).alias("n"), F.count_if(clean.is_json_blob(F.col("props"))).alias("blobs"), F.sum(F.length("props")).alias("chars"))


# -- warehouse ----------------------------------------------------------------

CALENDAR = (
    "CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name, "
    "CAST(week(d) AS INT) AS week, CAST(day(d) AS INT) AS day, CAST(dayofweek(d) AS INT) AS day_of_week, dayname(d) AS day_name, "
    "dayofweek(d) IN (0, 6) AS is_weekend"
)


@query(
    f"SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, d AS date_actual, {CALENDAR}, count(*) AS orders "
    "FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL"
)
def dim_date(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    ends = days.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    dates = warehouse.date_dimension(t.spark, *ends) if ends[0] else warehouse.date_dimension(t.spark).limit(0)
    counts = days.groupBy(F.col("day").alias("_d")).agg(F.count(F.lit(1)).alias("orders"))
    return dates.join(counts, F.col("date_actual") == F.col("_d")).drop("_d")


@query(
    "SELECT DISTINCT o_orderpriority AS category FROM orders WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderkey % 1000 = 0)"
    " OR o_orderstatus = 'none'"
)
def dim_new_keys_anti(t):
    have = t.orders.where("o_orderkey % 1000 = 0").select(F.col("o_orderpriority").alias("category")).distinct().withColumn("is_current", F.lit(True))
    return warehouse.new_members(t.orders.select(F.col("o_orderpriority").alias("category")), have, "category")


@query(
    "SELECT l_orderkey, l_linenumber, coalesce(n.sk, -1) AS part_sk, count(*) AS n FROM lineitem LEFT JOIN (SELECT p_partkey, "
    "row_number() OVER (ORDER BY p_partkey) AS sk FROM part WHERE p_size <= 25) n ON l_partkey = p_partkey GROUP BY 1, 2, 3"
)
def dim_unknown_lookup(t):
    members = t.part.where("p_size <= 25").select(F.col("p_partkey"))
    dim = warehouse.number_rows(members, ["p_partkey"], "part_sk").withColumn("is_current", F.lit(True))
    facts = warehouse.look_up(t.lineitem, [warehouse.Lookup(dim, "l_partkey", "p_partkey", "part_sk")])
    return facts.groupBy("l_orderkey", "l_linenumber", "part_sk").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 2 = 1"
)
def fact_upsert(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return warehouse.replace_by_key(rows, rows.where("o_orderkey % 2 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1), "o_orderkey")


@query(
    "WITH d AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS sk FROM customer WHERE c_custkey % 10 <> 0), "
    "i AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 9 <> 0), "
    "o AS (SELECT i.*, row_number() OVER (ORDER BY i.c_custkey) + (SELECT max(sk) FROM d) AS sk FROM i LEFT JOIN d USING (c_custkey) "
    "WHERE d.c_custkey IS NULL OR d.c_mktsegment <> i.c_mktsegment) "
    "SELECT d.c_custkey, d.c_mktsegment, d.sk, o.c_custkey IS NULL AS is_current, DATE '2024-01-01' AS effective_from, "
    "CASE WHEN o.c_custkey IS NULL THEN DATE '9999-12-31' ELSE DATE '2024-02-01' END AS effective_to FROM d LEFT JOIN o USING (c_custkey) "
    "UNION ALL SELECT c_custkey, c_mktsegment, sk, true, DATE '2024-02-01', DATE '9999-12-31' FROM o"
)
def scd2_apply(t):
    base = t.customer.where("c_custkey % 10 != 0").select("c_custkey", "c_mktsegment")
    dates = {"is_current": F.lit(True), "effective_from": F.lit("2024-01-01").cast("date"), "effective_to": F.lit(warehouse.FOREVER).cast("date")}
    dim = warehouse.number_rows(base, ["c_custkey"], "sk").withColumns(dates)
    moved = F.when(F.col("c_custkey") % 7 == 0, "MOVED").otherwise(F.col("c_mktsegment"))
    come = t.customer.where("c_custkey % 9 != 0").select("c_custkey", moved.alias("c_mktsegment"))
    return warehouse.apply_history(dim, come, "c_custkey", "sk", ["c_mktsegment"], "2024-02-01")


# -- profiling and quality ----------------------------------------------------

MEASURES = ("l_quantity", "l_discount", "l_tax")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query(
    _union(
        f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"quantile_cont({c}, 0.5)::DOUBLE AS median, round(sum({c}), 2) AS sum, count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives, "
        f"count(*) FILTER ({c} > 0) AS positives FROM lineitem"
        for c in MEASURES
    )
)
def profile_numeric(t):
    p = profiling.numeric_profile(t.lineitem, list(MEASURES))
    return p.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6), "sum": F.round("sum", 2)})


@query(
    _union(
        f"SELECT '{c}' AS column_name, min(length({c}))::INT AS min_length, max(length({c}))::INT AS max_length, round(avg(length({c})), 2) AS avg_length, "
        f"count(*) FILTER (trim({c}) = '') AS empty_count, count(*) FILTER (regexp_matches({c}, '(?s)^\\s*(\\{{.*\\}}|\\[.*\\])\\s*$')) AS json_count FROM events"
        for c in ("event_type", "props")
    )
)
def profile_string(t):
    return profiling.string_profile(t.events, ["event_type", "props"])


@query(
    "SELECT 'o_orderdate' AS column_name, min(o_orderdate) AS min, max(o_orderdate) AS max, "
    "CAST(floor(date_diff('second', min(o_orderdate), max(o_orderdate)) / 86400.0) AS BIGINT) AS range_days FROM orders"
)
def profile_datetime(t):
    return profiling.datetime_profile(t.orders, ["o_orderdate"])


@query(
    "SELECT 'p_brand' AS column_name, CAST(row_number() OVER (ORDER BY n DESC, p_brand) AS INT) AS rank, p_brand AS value, n, "
    "round(n * 100.0 / sum(n) OVER (), 2)::DOUBLE AS pct FROM (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1) "
    "QUALIFY rank <= 10"
)
def profile_top_values(t):
    return exact_mean(profiling.top_values(t.part, ["p_brand"]), "pct")


PROFILED = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query(
    _union(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS null_pct, count(DISTINCT {c}) AS distinct_count, "
        f"round(count(DISTINCT {c}) * 100.0 / count({c}), 2)::DOUBLE AS distinct_pct, count({c}) - count(DISTINCT {c}) AS duplicate_count FROM customer"
        for c in PROFILED
    )
)
def profile_columns(t):
    return exact_mean(profiling.completeness_profile(t.customer.select(*PROFILED)), "distinct_pct", "null_pct")


@query(
    _union(
        f"SELECT '{c}' AS column_name, q[1]::DOUBLE AS q1, q[2]::DOUBLE AS q3, round(q[1] - 1.5::DOUBLE * (q[2] - q[1]), 6) AS low, round(q[2] + 1.5::DOUBLE * (q[2] - q[1]), 6) AS high, (SELECT count(*) FROM {tb} WHERE {c} < q[1] - 1.5 * (q[2] - q[1]) OR "
        f"{c} > q[2] + 1.5 * (q[2] - q[1])) AS outliers FROM (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM {tb})"
        for tb, c in (("events", "value"),)
    )
)
def iqr_outliers(t):
    return profiling.iqr_outliers(t.events, ["value"]).withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query("SELECT round((1 - (count(*) - count(quality) + count(*) - count(toxic)) / (count(*) * 3.0)) * 100, 2)::DOUBLE AS completeness FROM documents LEFT JOIN labels USING (doc_id)")
def dq_completeness(t):
    return exact_mean(profiling.completeness(t.documents.select("doc_id").join(t.labels, "doc_id", "left")), "completeness")


@query(
    "SELECT round((round(count(DISTINCT n_nationkey) * 100.0 / count(n_nationkey), 2) + round(count(DISTINCT n_regionkey) * 100.0 / count(n_regionkey), 2)) / 2, 2)"
    "::DOUBLE AS uniqueness FROM (SELECT c_custkey AS n_nationkey, c_nationkey AS n_regionkey FROM customer)"
)
def dq_uniqueness(t):
    df = t.customer.select(F.col("c_custkey").alias("n_nationkey"), F.col("c_nationkey").alias("n_regionkey"))
    return exact_mean(profiling.uniqueness(df), "uniqueness")


@query(
    "SELECT round((round(100 - count(*) FILTER (json_valid(props) AND regexp_matches(props, '(?s)^\\s*(\\{.*\\}|\\[.*\\])\\s*$')) * 1.0 / count(props) * 50, 2) + 100) / 2, 2)"
    "::DOUBLE AS validity FROM events"
)
def dq_validity(t):
    return exact_mean(profiling.validity(t.events.select("props", "event_type")), "validity")


@query(
    "SELECT round(CASE WHEN h <= 24 THEN 100 WHEN h <= 48 THEN 80 WHEN h <= 72 THEN 60 ELSE greatest(0, 100 - (h - 24) * 2) END, 2)::DOUBLE AS timeliness "
    f"FROM (SELECT date_diff('second', max(ts), TIMESTAMP '{AS_OF}') / 3600.0 AS h FROM events)"
)
def dq_timeliness(t):
    return profiling.timeliness(t.events.withColumnRenamed("ts", "updated_at"), AS_OF)


@query(
    "WITH o AS (SELECT CASE WHEN o_orderkey % 10 > 0 THEN o_orderkey END AS k, CASE WHEN o_orderkey % 4 = 0 THEN '{}' ELSE o_orderstatus END AS s FROM orders), "
    "d AS (SELECT count(*) AS row_count, round((1 - (count(*) FILTER (k IS NULL) + count(*) FILTER (s IS NULL)) / (count(*) * 2.0)) * 100, 2)::DOUBLE AS completeness, "
    "round((round(count(DISTINCT k) * 100.0 / count(k), 2) + round(count(DISTINCT s) * 100.0 / count(s), 2)) / 2, 2)::DOUBLE AS uniqueness, "
    "round(100 - count(*) FILTER (s = '{}') * 50.0 / count(s), 2)::DOUBLE AS validity, 100.0::DOUBLE AS timeliness FROM o) "
    "SELECT 'orders' AS table_name, 'raw' AS stage, row_count, 2 AS column_count, completeness, uniqueness, validity, timeliness, "
    "round(completeness * 0.30::DOUBLE + uniqueness * 0.25::DOUBLE + validity * 0.25::DOUBLE + timeliness * 0.20::DOUBLE, 2) AS overall FROM d"
)
def dq_overall(t):
    rows = t.orders.select(
        F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderkey")).alias("k"), F.when(F.col("o_orderkey") % 4 == 0, "{}").otherwise(F.col("o_orderstatus")).alias("s")
    )
    out = profiling.dimensions(rows, "orders", "raw", AS_OF)
    return exact_mean(out, "completeness", "uniqueness", "validity", "timeliness", "overall")


@query(
    "WITH s AS (SELECT o_orderkey AS k FROM orders), t AS (SELECT CASE WHEN o_orderkey % 10 = 1 THEN -o_orderkey ELSE o_orderkey END AS k FROM orders WHERE o_orderkey % 10 <> 0) "
    "SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows, (SELECT count(DISTINCT k) FROM s) AS source_keys, "
    "(SELECT count(DISTINCT k) FROM s WHERE k NOT IN (SELECT k FROM t)) AS missing_keys, (SELECT count(DISTINCT k) FROM t WHERE k NOT IN (SELECT k FROM s)) AS new_keys, "
    "round((SELECT count(*) FROM t) * 100.0 / (SELECT count(*) FROM s), 2)::DOUBLE AS row_retention_pct, 66.67::DOUBLE AS column_overlap_pct, "
    "round((SELECT count(DISTINCT k) FROM s WHERE k IN (SELECT k FROM t)) * 100.0 / (SELECT count(DISTINCT k) FROM s), 2)::DOUBLE AS key_integrity_pct"
)
def stage_compare(t):
    key = F.when(F.col("o_orderkey") % 10 == 1, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    later = t.orders.where("o_orderkey % 10 != 0").withColumn("o_orderkey", key).drop("o_orderpriority", "o_orderdate").withColumn("op", F.lit("I"))
    out = profiling.compare_stages(t.orders, later, "o_orderkey")
    return exact_mean(out, "row_retention_pct", "column_overlap_pct", "key_integrity_pct")


@query(
    "SELECT count(*) AS n, 'c_campaign' AS column_name, 'missing' AS change, 'error' AS severity FROM customer UNION ALL "
    "SELECT count(*), 'c_name', 'new', 'warning' FROM customer UNION ALL SELECT count(*), 'c_nationkey', 'new', 'warning' FROM customer"
)
def contract_drift(t):
    config = staging.TableConfig("leads", MAPPING)
    found = contracts.drift(contracts.expected_schema(t.spark, config), contracts.schema_rows(t.customer, "leads"))
    size = t.customer.agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("n", size.scalar()).select("n", "column_name", "change", "severity")


RULES = (
    rejects.Rule("blob", "json_blob", ("props",)),
    rejects.Rule("purchase", "custom", pattern="event_type = 'purchase'", severity="critical"),
    rejects.Rule("x", "regex", ("event_type",), "^cl", action="drop"),
)


@query(
    "SELECT 'clean' AS side, count(*) AS n FROM events WHERE NOT json_valid(props) AND event_type <> 'purchase' AND event_type NOT LIKE 'cl%' UNION ALL "
    "SELECT 'rejected', count(*) FROM events WHERE json_valid(props) OR event_type = 'purchase'"
)
def reject_split(t):
    good, bad = rejects.split(t.events, RULES)
    return business.inventory({"clean": good, "rejected": bad}).select(F.col("table_name").alias("side"), F.col("row_count").alias("n"))


@query(
    "SELECT 'blob' AS rule, 'warning' AS severity, count(*) AS records, 'props' AS columns FROM events WHERE json_valid(props) HAVING count(*) > 0 UNION ALL "
    "SELECT 'purchase', 'critical', count(*), '' FROM events WHERE event_type = 'purchase' HAVING count(*) > 0 UNION ALL "
    "SELECT 'x', 'warning', count(*), 'event_type' FROM events WHERE event_type LIKE 'cl%' HAVING count(*) > 0"
)
def reject_summary(t):
    return rejects.summary(t.events, RULES).withColumn("columns", F.array_join("columns", ","))


SIMPLE_PII = ("email", "phone", "credit_card", "ip_address", "uae_phone", "emirates_id")


@query(
    "SELECT * FROM ("
    + _union(
        f"SELECT 'text' AS column_name, '{n}' AS pii_type, count(*) AS matches, {PATTERNS[n].sensitivity} AS sensitivity FROM documents "
        f"WHERE regexp_matches(text, '{PATTERNS[n].regex}')"
        for n in SIMPLE_PII
    )
    + ") WHERE matches > 0"
)
def pii_scan(t):
    return rejects.scan_pii(t.documents, "documents", ["text"]).drop("table_name")


@query(
    f"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{PATTERNS['email'].regex}', '***@***.***', 'g'), '{PATTERNS['ip_address'].regex}', "
    "'***.***.***.***', 'g')) AS masked FROM documents"
)
def pii_mask(t):
    return rejects.mask_columns(t.documents, {"text": ["email", "ip_address"]}).select("doc_id", F.md5("text").alias("masked"))


#: The ssn pattern without lookaheads, which DuckDB's regular expressions lack.
SSN_SQL = (
    r"\b(?:00[1-9]|0[1-9][0-9]|[1-578][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])"
    r"-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})\b"
)


def _masked_sql() -> str:
    x = "text"
    for n, p in PATTERNS.items():
        x = f"regexp_replace({x}, '{SSN_SQL if n == 'ssn' else p.regex}', '{p.mask}', 'g')"
    return x


@query(f"SELECT doc_id, md5({_masked_sql()}) AS masked FROM documents")
def pii_mask_all(t):
    return rejects.mask_columns(t.documents, {"text": list(PATTERNS)}).select("doc_id", F.md5("text").alias("masked"))


SUITE = [
    expectations.Expectation("expect_table_row_count_to_be_between", {"min_value": 1}, True),
    expectations.Expectation("expect_column_values_to_not_be_null", {"column": "o_custkey", "mostly": 0.99}),
    expectations.Expectation("expect_column_values_to_be_unique", {"column": "o_orderkey"}, True),
    expectations.Expectation("expect_column_values_to_be_in_set", {"column": "o_orderstatus", "value_set": ["O", "F"], "mostly": 0.9}),
    expectations.Expectation("expect_column_values_to_match_regex", {"column": "o_orderpriority", "regex": "\\d-"}),
    expectations.Expectation("expect_column_value_lengths_to_be_between", {"column": "o_orderpriority", "min_value": 1, "max_value": 10}),
    expectations.Expectation("expect_column_to_exist", {"column": "nothing"}),
]


@query(
    "SELECT *, CASE expectation WHEN 'expect_column_to_exist' THEN false WHEN 'expect_column_values_to_be_in_set' THEN (checked - failed)::DOUBLE / checked >= 0.9 WHEN 'expect_column_values_to_not_be_null' "
    "THEN (checked - failed)::DOUBLE / checked >= 0.99 ELSE failed = 0 END AS success FROM (SELECT 'expect_table_row_count_to_be_between' AS expectation, NULL AS column_name, true AS blocking, count(*) AS checked, 0::BIGINT AS failed FROM orders "
    "UNION ALL SELECT 'expect_column_values_to_not_be_null', 'o_custkey', false, count(*), count(*) - count(o_custkey) FROM orders "
    "UNION ALL SELECT 'expect_column_values_to_be_unique', 'o_orderkey', true, (SELECT count(o_orderkey) FROM orders), (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) "
    "UNION ALL SELECT 'expect_column_values_to_be_in_set', 'o_orderstatus', false, count(o_orderstatus), count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders "
    "UNION ALL SELECT 'expect_column_values_to_match_regex', 'o_orderpriority', false, count(o_orderpriority), count(*) FILTER (NOT regexp_matches(o_orderpriority, '^\\d-')) FROM orders "
    "UNION ALL SELECT 'expect_column_value_lengths_to_be_between', 'o_orderpriority', false, count(o_orderpriority), count(*) FILTER (length(o_orderpriority) > 10) FROM orders "
    "UNION ALL SELECT 'expect_column_to_exist', 'nothing', false, 1, 1)"
)
def expectation_suite(t):
    return expectations.run_suite(t.orders, SUITE).drop("fraction", "detail")


@query("SELECT 'part' AS rule, count(*) AS checked, count(*) FILTER (p_partkey IS NULL) AS failed FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size < 40")
def rule_referential(t):
    rule = expectations.QualityRule("part", "referential", "l_partkey", {"table": "part", "key": "p_partkey"})
    out = expectations.execute_rule(t.lineitem, rule, {"part": t.part.where("p_size < 40")})
    return out.select("rule", "checked", "failed")


@query(
    "SELECT 'rows' AS metric, count(*)::DOUBLE AS value, count(*) >= 100 AS holds FROM orders UNION ALL "
    "SELECT 'open_pct', round(count(*) FILTER (o_orderstatus = 'O') * 100.0 / count(*), 2)::DOUBLE, round(count(*) FILTER (o_orderstatus = 'O') * 100.0 / count(*), 2) BETWEEN 0 AND 20 FROM orders"
)
def threshold_alerts(t):
    row = t.orders.agg(
        F.count(F.lit(1)).cast("double").alias("rows"), clean.percent(F.count_if(F.col("o_orderstatus") == "O"), F.count(F.lit(1))).cast("double").alias("open_pct")
    )
    metrics = row.unpivot([], ["rows", "open_pct"], "metric", "value").withColumns({"table_name": F.lit("orders"), "column_name": F.lit(None).cast("string")})
    limits = t.spark.createDataFrame(
        [(None, None, "rows", "min", 100.0, None, "error", True), ("orders", None, "open_pct", "percentage", 0.0, 20.0, "warning", False)],
        "table_name string, column_name string, metric string, kind string, low double, high double, severity string, blocking boolean",
    )
    return expectations.check_thresholds(metrics, limits).select("metric", "value", "holds")


@query(
    "WITH RECURSIVE e AS (SELECT DISTINCT event_type AS k, ts FROM events), s AS (SELECT k, min(ts) AS ts FROM e GROUP BY k UNION ALL "
    "SELECT k, n FROM (SELECT s.k, (SELECT min(e.ts) FROM e WHERE e.k = s.k AND e.ts >= s.ts + INTERVAL 60 MINUTE) AS n FROM s) WHERE n IS NOT NULL) "
    "SELECT k AS source, ts AS created_at FROM s"
)
def alert_dedup(t):
    rows = t.events.select(
        F.lit("event").alias("alert_type"), F.lit("warning").alias("severity"), F.col("event_type").alias("source"), F.lit("t").alias("title"),
        F.lit("m").alias("message"), F.col("ts").cast("timestamp").alias("created_at"),
    )
    return alerts.suppress(rows).select("source", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(_union(f"SELECT '{n}' AS table_name, {v} AS version, {a} AS is_active, {c} AS columns, (SELECT count(*) FROM {s}) AS n" for n, s, v, a, c in (
    ("leads", "customer", 1, "false", 5), ("leads", "customer", 2, "true", 6), ("sales", "orders", 1, "true", 6))))
def registry_versions(t):
    first = contracts.schema_rows(t.customer, "leads").unionByName(contracts.schema_rows(t.orders, "sales"))
    reg = contracts.register(contracts.empty_registry(t.spark), first, "staging", "crawler", AS_OF)
    wider = t.customer.withColumn("extra", F.lit(1))
    reg = contracts.register(reg, contracts.schema_rows(wider, "leads").unionByName(contracts.schema_rows(t.orders, "sales")), "staging", "crawler", AS_OF)
    sizes = business.inventory({"leads": t.customer, "sales": t.orders}).withColumnRenamed("row_count", "n")
    out = reg.groupBy("table_name", "version", "is_active").agg(F.count(F.lit(1)).alias("columns"))
    return out.join(sizes, "table_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def key_reconciliation(t):
    rich = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return profiling.missing_keys(t.orders, rich, "o_custkey").select("o_orderkey", "o_custkey")


# -- further operators --------------------------------------------------------


@query(
    "SELECT round(sum(nulls) * 100.0 / sum(n), 2)::DOUBLE AS null_cell_pct, count(*) FILTER (nulls > 0) AS columns_with_nulls, "
    "count(*) FILTER (d < n - nulls) AS columns_with_duplicates FROM ("
    + _union(f"SELECT count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS d FROM documents LEFT JOIN labels USING (doc_id)" for c in ("doc_id", "quality", "toxic"))
    + ")"
)
def profile_summary(t):
    df = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    out = profiling.profile_summary(profiling.completeness_profile(df))
    return exact_mean(out.select("null_cell_pct", "columns_with_nulls", "columns_with_duplicates"), "null_cell_pct")


@query(
    "SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows, "
    "round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))) * 100.0 / count(*), 2)::DOUBLE AS duplicate_pct FROM lineitem"
)
def duplicate_rate(t):
    return exact_mean(profiling.duplicate_rate(t.lineitem.select("l_orderkey", "l_linenumber")), "duplicate_pct")


@query(
    "SELECT k AS o_custkey, k IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS found FROM (SELECT DISTINCT o_custkey AS k FROM orders "
    "WHERE o_custkey IS NOT NULL ORDER BY 1 LIMIT 100)"
)
def spot_check(t):
    return profiling.spot_check(t.orders, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query(
    "SELECT 'documents' AS table_name, 'text' AS column_name, CASE WHEN any_value(card) THEN 'financial' WHEN any_value(mail) THEN 'pii' ELSE 'sensitive' END AS classification, "
    f"max(s) AS sensitivity, max(s) >= 3 AS needs_masking FROM (SELECT bool_or(regexp_matches(text, '{PATTERNS['credit_card'].regex}')) OVER () AS card, "
    f"bool_or(regexp_matches(text, '{PATTERNS['email'].regex}') OR regexp_matches(text, '{PATTERNS['phone'].regex}')) OVER () AS mail, "
    + "greatest("
    + ", ".join(f"CASE WHEN regexp_matches(text, '{PATTERNS[n].regex}') THEN {PATTERNS[n].sensitivity} ELSE 0 END" for n in SIMPLE_PII)
    + ") AS s FROM documents) HAVING max(s) > 0"
)
def pii_classify(t):
    scan = rejects.scan_pii(t.documents, "documents", ["text"])
    return rejects.classify(scan).select("table_name", "column_name", "classification", "sensitivity", "needs_masking")


@query(
    "SELECT event_type AS name, CAST(count(*) AS DOUBLE) AS value, count(*) AS n, 1.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM events GROUP BY 1"
)
def metrics_rollup(t):
    rows = t.events.select(
        F.col("event_type").alias("name"), F.lit("counter").alias("kind"), F.lit(1.0).alias("value"), F.create_map(F.lit("t"), F.lit("events")).alias("labels"),
        F.col("ts").cast("timestamp").alias("recorded_at"),
    )
    return alerts.roll_up(rows, ["t"]).select("name", "value", "n", "low", "high")


@query(
    "SELECT source, severity FROM (SELECT event_type AS source, CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'error' ELSE 'warning' END AS severity, "
    "min(ts) AS seen FROM events GROUP BY 1) ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'error' THEN 1 ELSE 2 END, seen DESC LIMIT 3"
)
def alert_severity_rank(t):
    level = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "purchase", "error").otherwise("warning")
    rows = t.events.groupBy(F.col("event_type").alias("source")).agg(F.min("ts").cast("timestamp").alias("created_at"), F.min(level).alias("severity"))
    rows = rows.withColumns({"dedup_key": F.col("source"), "status": F.lit("open")})
    return alerts.open_alerts(rows, limit=3).select("source", "severity")


@query(
    "SELECT 'segment' AS rule, (SELECT count(*) FROM customer) AS checked, coalesce(sum(n), 0)::BIGINT AS failed FROM (SELECT count(*) AS n FROM customer "
    "WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey HAVING count(*) > 1)"
)
def rule_uniqueness(t):
    rule = expectations.QualityRule("segment", "uniqueness_check", "c_nationkey")
    return expectations.execute_rule(t.customer, rule).select("rule", "checked", "failed")


@query(f"SELECT 'fresh' AS rule, count(*) AS checked, count(*) FILTER (date_diff('second', ts, TIMESTAMP '{AS_OF}') > 240 * 3600) AS failed FROM events")
def rule_freshness(t):
    rule = expectations.QualityRule("fresh", "freshness_check", "ts", {"max_hours": 240})
    return expectations.execute_rule(t.events, rule, as_of=AS_OF).select("rule", "checked", "failed")


@query("SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS sk FROM lineitem")
def surrogate_keys(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    return warehouse.number_rows(t.lineitem.select(order), order, "sk").select("l_orderkey", "l_partkey", "l_linenumber", "sk")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 3 = 0")
def insert_missing(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return warehouse.insert_missing(rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), "o_orderkey")


@query(
    "SELECT event_id, CASE WHEN user_id NOT IN (SELECT user_id FROM events WHERE ts <= TIMESTAMP '2024-01-02 00:00:00') AND event_type NOT IN ('signup', 'error') THEN 'I' "
    "WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op FROM events"
)
def mark_inserts(t):
    known = t.events.where("ts <= timestamp_ntz'2024-01-02 00:00:00'")
    return ingest.mark_inserts(_log(t), known, "user_id").select("event_id", "op")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'closed' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def update_where(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return warehouse.update_where(rows, F.col("o_orderstatus") == "O", {"o_orderstatus": F.lit("closed")})


@query(
    "WITH RECURSIVE e AS (SELECT DISTINCT n_name AS s, r_name AS t FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT DISTINCT s_name, n_name FROM supplier "
    "JOIN nation ON s_nationkey = n_nationkey), w AS (SELECT s AS asset, 1 AS distance FROM e WHERE t = 'ASIA' UNION SELECT e.s, w.distance + 1 FROM e JOIN w ON e.t = w.asset) "
    "SELECT asset, min(distance) AS distance FROM w GROUP BY 1"
)
def lineage_upstream(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    edges = places.select(F.col("n_name").alias("source"), F.col("r_name").alias("target"))
    more = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("source"), F.col("n_name").alias("target"))
    return contracts.upstream(edges.unionByName(more).distinct(), "ASIA")


@query("SELECT event_id, user_id, op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n " f"FROM {LOG}) WHERE n = 1 AND op <> 'D'")
def stream_apply(t):
    """The change log applied as a stream, run to the end of the files there."""
    import uuid

    from tarnlake.session import shared_dir
    from tarnlake.streaming import cdc

    root = f"{shared_dir(t.spark).rstrip('/')}/tarnlake/stream-{uuid.uuid4().hex}"
    stream = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    events = stream.parquet(f"{t.sf_dir}/events*")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    q = cdc.apply_changes(events.select("event_id", "user_id", "ts", op.alias("op")), "user_id", ["ts", "event_id"], root)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    state = cdc.current_state(t.spark, root, live_only=True)
    return (t.events.limit(0).select("event_id", "user_id", F.lit("").alias("op")) if state is None else state).select("event_id", "user_id", "op")
