import pytest
from pyspark.sql import functions as F

from tarnlake.operators import warehouse as w

LEADS = "lead_id string, lead_status string, lead_source string, lead_type string, agent_id string, area_id string, compound_id string, campaign string, budget double, " \
    "lead_created_at timestamp, lead_updated_at timestamp, date_of_last_contact timestamp, customer_id string, location string, contact_method string, op string, " \
    "is_buyer boolean, is_seller boolean, is_commercial boolean, is_merged boolean, has_meeting boolean, do_not_call boolean"  # fmt: skip


def lead(i, status=" New ", source="web", agent="7", area="1", compound="c", op="U"):
    return (i, status, source, "x", agent, area, compound, "camp", 10.5, None, None, None, "c", "l", "m", op, True, False, False, False, False, False)


def dim(spark, rows, key, sk, attributes=None):
    src = spark.createDataFrame(rows, f"{key} string" + "".join(f", {a} string" for a in attributes or []))
    return w.with_unknown(w.load_dimension(w.empty_dimension(spark, key, sk, attributes), src, key, sk, "2024-01-01", attributes), sk, key)


def test_dimension_keys(spark):
    rows = [(" a ", "x"), ("b", "y"), ("b", "z"), ("", "q"), (None, "q")]
    d = dim(spark, rows, "k", "sk", ["v"])
    got = {r.k: (r.sk, r.v, r.is_current) for r in d.collect()}
    assert got == {"a": (1, "x", True), "b": (2, "y", True), "-1": (-1, "Unknown", True)}
    more = spark.createDataFrame([("c", "w"), ("a", "other")], "k string, v string")
    again = w.load_dimension(d, more, "k", "sk", "2024-02-01", ["v"])
    assert {r.k: r.sk for r in again.collect()} == {"a": 1, "b": 2, "-1": -1, "c": 3}
    assert w.load_dimension(again, more, "k", "sk", "2024-03-01", ["v"]).count() == 4
    assert w.with_unknown(again, "sk", "k").count() == 4


def test_facts(spark):
    staged = spark.createDataFrame([lead("1"), lead("2", None, "nowhere", None), lead("3", op="D"), lead("4", op=None)], LEADS)
    staged = staged.withColumn("lead_created_at", F.lit("2024-03-05 10:00:00").cast("timestamp"))
    dates = w.date_dimension(spark, "2024-01-01", "2024-12-31")
    dims = {"date": dates, "status": dim(spark, [("New",)], "status_name", "lead_status_sk"), "source": dim(spark, [("web",)], "source_name", "lead_source_sk")}
    dims |= {"type": dim(spark, [("x",)], "type_name", "lead_type_sk"), "agent": dim(spark, [("7",)], "agent_id", "agent_sk")}
    dims |= {"area": dim(spark, [("1",)], "area_id", "area_sk"), "campaign": dim(spark, [("camp",)], "campaign_name", "campaign_sk")}
    got = {r.lead_id: r for r in w.fact_leads(staged, dims).collect()}
    assert set(got) == {"1", "2"}  # a NULL operation is not '!= D' here
    assert (got["1"].lead_status_sk, got["1"].lead_source_sk, got["1"].created_date_sk, got["1"].updated_date_sk) == (1, 1, 20240305, None)
    assert (got["2"].lead_status_sk, got["2"].lead_source_sk, got["2"].agent_sk) == (-1, -1, -1)
    facts = w.fact_leads(staged, dims)
    twice = w.replace_by_key(w.replace_by_key(facts, facts, "lead_id"), facts, "lead_id")
    assert twice.count() == 2
    leads = w.number_rows(facts.select("lead_id"), ["lead_id"], "lead_sk")
    sales = spark.createDataFrame(
        [("s1", "1", 5.0, 6.0, 7.0, "flat", "1", "P", None, None, None, "loc", 3, "U"), ("s2", "9", 5.0, 6.0, None, "hut", "2", "Q", None, None, None, "loc", None, "U")],
        "sale_id string, lead_id string, unit_value double, expected_value double, actual_value double, property_type string, area_id string, sale_category string, "
        "sale_date timestamp, reservation_update_date timestamp, contract_date timestamp, unit_location string, payment_years int, op string",
    )
    more = {"date": dates, "area": dims["area"], "property": dim(spark, [("flat",)], "type_name", "property_type_sk")}
    more["category"] = dim(spark, [("P",)], "category_name", "sale_category_sk")
    s = {r.sale_id: r for r in w.fact_sales(sales, leads, more).collect()}
    assert (s["s1"].lead_sk, s["s1"].property_type_sk, s["s1"].sale_category_sk) == (1, 1, 1)
    assert (s["s2"].lead_sk, s["s2"].property_type_sk, s["s2"].area_sk) == (-1, -1, -1)


def test_history(spark):
    d = w.apply_history(w.empty_dimension(spark, "k", "sk", ["v"]), spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, v string"), "k", "sk", ["v"], "2024-01-01")
    change = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1"), (None, "x")], "k string, v string")
    d = w.apply_history(d, change, "k", "sk", ["v"], "2024-02-01")
    rows = sorted((r.k, r.v, r.is_current, str(r.effective_from), str(r.effective_to), r.sk) for r in d.collect())
    assert rows == [
        ("a", "1", True, "2024-01-01", "9999-12-31", 1),
        ("b", "1", False, "2024-01-01", "2024-02-01", 2),
        ("b", "2", True, "2024-02-01", "9999-12-31", 4),
        ("c", "1", True, "2024-01-01", "9999-12-31", 3),
        ("d", "1", True, "2024-02-01", "9999-12-31", 5),
    ]
    assert w.apply_history(d, change, "k", "sk", ["v"], "2024-03-01").count() == 5


def test_number_rows_is_gapless(spark):
    df = spark.range(1000).repartition(7)
    got = w.number_rows(df, ["id"], "n", 10).collect()
    assert all(r.n == r.id + 11 for r in got) and len(got) == 1000
    assert w.number_rows(df.limit(0), ["id"], "n").count() == 0


def test_upserts_and_steps(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z"), (2, "z")], "k int, v string")
    assert sorted(map(tuple, w.insert_missing(a, b, "k").collect())) == [(1, "x"), (2, "z")]
    assert w.update_where(a, F.col("v") == "x", {"v": F.lit("q")}).first().v == "q"
    done = []
    assert w.run_steps([("one", lambda: done.append(1))]) == ["one"]
    with pytest.raises(RuntimeError, match="two"):
        w.run_steps([("one", lambda: None), ("two", lambda: 1 / 0), ("three", lambda: done.append(3))])
    assert done == [1]
    days = w.date_dimension(spark)
    assert days.count() == 5844 and days.where("date_sk = 20240107").first().day_of_week == 0
    log = w.load_log(spark, "b", {"a": a}, "2024-01-01", "2024-01-02")
    assert log.first().records_loaded == 1
