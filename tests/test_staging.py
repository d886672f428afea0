from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.operators import ingest, staging
from tarnlake.sources import jdbc, landing, state

CONFIG = staging.TableConfig(
    "leads",
    [staging.Mapped("id", "lead_id"), staging.Mapped("buyer", "is_buyer", "boolean"), staging.Mapped("budget", "budget", "float")]
    + [staging.Mapped("created_at", "lead_created_at", "timestamp"), staging.Mapped("extraction_time", "extraction_time", "timestamp")],
    key="id",
    timestamps={"lead_created_at": ["M/d/yyyy H:mm"]},
    partitions={"year": "lead_created_at", "month": "lead_created_at"},
)
RAW = "id string, buyer string, budget string, created_at string, extraction_time string, op string, extra string"
ROWS = [
    ("1", "TRUE", "$1,200.50", "5/1/2023 4:05", "2023-06-01 00:00:00", "I", "a"),
    ("1", "no", "9", "05/01/2023 04:05", "2023-06-02 00:00:00", "U", "b"),
    ("2", " t ", "abc", "13/2/2023", "2023-06-01 00:00:00", "I", None),
    ("2", None, "1", None, "2023-06-03 00:00:00", "D", None),
    ("3", "maybe", "", "garbage", "2023-06-01T01:02:03.123456", None, "c"),
    (None, "0", "5", "2023-07-01 00:00:00", None, "U", "d"),
]


def test_stage_types_dedups_and_partitions(spark):
    df = staging.stage(spark.createDataFrame(ROWS, RAW), CONFIG, "b1", F.lit("2024-01-01").cast("timestamp"))
    got = {r.lead_id: r for r in df.collect()}
    assert set(got) == {"1", "3", None}
    assert (got["1"].is_buyer, got["1"].budget, got["1"].extra, got["1"].year, got["1"].month) == (False, 9.0, "b", 2023, 5)
    assert got["3"].is_buyer is None and got["3"].budget is None and (got["3"].year, got["3"].month) == (0, 0)
    assert got[None].year == 2023 and got["1"]._batch_id == "b1"
    parity = staging.stage(spark.createDataFrame(ROWS, RAW), staging.TableConfig(**{**CONFIG.__dict__, "dedup_first": False}), "b1")
    assert {r.lead_id for r in parity.collect()} == {"1", "2", "3", None}
    assert staging.stage(spark.createDataFrame([], RAW), CONFIG, "b").count() == 0


def test_modes_and_policies(spark):
    df = spark.createDataFrame([("1", "x")], "id string, extra string")
    with_ = lambda **k: staging.TableConfig(**{**CONFIG.__dict__, **k})
    assert staging.apply_mapping(df, with_(mode="strict")).columns == ["lead_id", "is_buyer", "budget", "lead_created_at", "extraction_time"]
    assert staging.apply_mapping(df, with_(missing="skip")).columns == ["lead_id", "extra"]
    assert staging.apply_mapping(df, with_(missing="skip", unmapped="drop")).columns == ["lead_id"]
    assert "buyer" in staging.apply_mapping(df, with_(mode="pass_through")).columns
    with pytest.raises(ValueError, match="lacks"):
        staging.apply_mapping(df, with_(missing="error"))
    found = {(r.change, r.column_name) for r in staging.drift(df, CONFIG).collect()}
    assert ("missing", "budget") in found and ("unmapped", "extra") in found


def test_keep_latest_ties_do_not_depend_on_partitions(spark):
    rows = [("a", 1, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    picks = {staging.keep_latest(df.repartition(n), "k", ["o"]).first().v for n in (1, 3, 7)}
    assert len(picks) == 1
    assert staging.keep_latest(df, "absent", ["o"]).count() == 50


def test_landing_unites_by_name(spark, tmp_path):
    (tmp_path / "full_load/b1").mkdir(parents=True)
    (tmp_path / "full_load/b1/a.csv").write_text("id,name,x\n1,NA,5\n2,b,6\n")
    (tmp_path / "full_load/b1/b.csv").write_text("x,id\r\n7,3\r\n")
    (tmp_path / "full_load/b1/empty.csv").write_text("")
    got = {r.id: (r.name, r.x) for r in landing.read_landing(spark, str(tmp_path)).collect()}
    assert got == {"1": (None, "5"), "2": ("b", "6"), "3": (None, "7")}
    assert landing.read_landing(spark, str(tmp_path / "nothing")).columns == []


def test_compaction_job(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    spark.createDataFrame(ROWS, RAW).coalesce(1).write.option("header", True).csv(raw)
    for _ in range(2):  # a second run gives the same
        result = staging.run_compaction(spark, raw, out, CONFIG, "b1")
        assert (result["status"], result["rows_in"], result["rows_out"]) == ("success", 6, 3)
    assert spark.read.parquet(out).where("year = 2023").count() == 2
    both = staging.run_all(spark, [(raw, out, CONFIG), (f"{tmp_path}/none", out, CONFIG)], "b2")
    assert both["failed"] == 0 and [r["status"] for r in both["tables"]] == ["success", "empty"]


def test_writers_and_mixed_reader(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    landing.write_raw(df, f"{tmp_path}/z/csv1")
    landing.write_raw(df, f"{tmp_path}/z/p1", "parquet")
    with pytest.raises(ValueError):
        landing.write_raw(df, f"{tmp_path}/z/x", "avro")
    with pytest.raises(Exception, match="exists"):
        landing.write_raw(df, f"{tmp_path}/z/csv1")
    assert landing.read_mixed(spark, f"{tmp_path}/z").count() == 2
    assert landing.read_one(spark, f"{tmp_path}/z/csv1").count() == 1
    assert landing.read_mixed(spark, f"{tmp_path}/none").columns == []
    landing.write_partitioned(df, f"{tmp_path}/np", ["absent"])
    assert landing.initial_load(spark, f"{tmp_path}/z/csv1", f"{tmp_path}/init") == 1
    t = landing.register_table(spark, "ext_v", f"{tmp_path}/z/p1", "id int, v string")
    assert t.first().v == "a"
    spark.sql("DROP TABLE ext_v")


AT = datetime(2023, 12, 2, 1, 2, 3)
TABLE = ingest.SourceTable("shop", "leads", tracking="updated_at", delete_when=("status", "deleted"))
SOURCE = [("1", "9/30/2023 1:00", "new"), ("2", "12/1/2023 1:00", "deleted"), ("3", "12/1/2023 1:00", "new"), (None, None, None)]


def source(spark):
    return spark.createDataFrame(SOURCE, "id string, updated_at string, status string")


def test_watermarks_compare_as_times(spark, tmp_path):
    df = source(spark)
    assert ingest.new_watermark(df, "updated_at") == datetime(2023, 12, 1, 1)
    assert [r.id for r in jdbc.incremental(df, "updated_at", "9/30/2023 1:00").collect()] == ["2", "3"]
    assert jdbc.incremental(df, "updated_at", datetime(2023, 12, 1, 1)).count() == 0
    assert jdbc.incremental(df, "updated_at", datetime(2023, 12, 1, 1), inclusive=True).count() == 2
    path = f"{tmp_path}/state"
    assert state.load_watermarks(spark, path) == {}
    state.save_watermarks(spark, path, {"a": datetime(2023, 1, 1), "b": None}, "x", AT)
    state.save_watermarks(spark, path, {"a": datetime(2023, 2, 1)}, "y", datetime(2024, 1, 1))
    assert state.load_watermarks(spark, path) == {"a": datetime(2023, 2, 1)}
    state.log_run(spark, f"{path}-log", "cdc", {"rows": 3})
    assert spark.read.json(f"{path}-log").first().kind == "cdc"


def test_loads(spark, tmp_path):
    zone = str(tmp_path)
    full = ingest.full_load(source(spark), TABLE, zone, AT)
    assert full["rows"] == 4 and full["path"].endswith("shop/raw_leads/full_load/20231202_010203")
    raw = landing.read_landing(spark, full["path"])
    assert {r.gpk for r in raw.collect()} == {"1~20231202010203", "2~20231202010203", "3~20231202010203", None}
    cdc = ingest.cdc_load(source(spark), TABLE, zone, AT, datetime(2023, 10, 1))
    assert (cdc["rows"], cdc["updates"], cdc["deletes"], cdc["watermark"]) == (2, 1, 1, datetime(2023, 12, 1, 1))
    none = ingest.cdc_load(source(spark), TABLE, zone, datetime(2024, 1, 1), datetime(2024, 1, 1))
    assert none["rows"] == 0 and none["watermark"] == datetime(2024, 1, 1)

    def broken(t):
        raise OSError("down")

    assert ingest.run_tables([TABLE], broken)["failed"] == 1
    assert ingest.run_tables([TABLE], lambda t: full)["rows"] == 4
    seen = spark.createDataFrame([("2",)], "id string")
    marked = ingest.mark_inserts(landing.read_landing(spark, cdc["path"]), seen, "id")
    assert {r.id: r.op for r in marked.collect()} == {"2": "D", "3": "I"}


def test_rules(spark):
    tables = [ingest.SourceTable("a", "t1"), ingest.SourceTable("b", "t2")]
    picked = ingest.select_tables(tables, [{"action": "include", "schema": "%", "table": "t%"}, {"action": "exclude", "schema": "b"}])
    assert [t.name for t in picked] == ["t1"]
    df = ingest.add_columns(source(spark).limit(1), "leads", [{"table": "%", "column": "g", "expression": "$id||'~'||EXTRACTION_TIMESTAMP"}], AT)
    assert df.first().g == "1~20231202010203"
    assert jdbc.describe(df).count() == 4


def test_scalars(spark):
    texts = ["5/1/2023 4:05", "2023-05-01T04:05:00", "2023-05-01T04:05:00.5", "13/2/2023", "x", "", None, " Not Interested ", "yes", "a\t b", "$1,0 0.5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    c = F.col("t")
    r = {x.i: x for x in df.select("i", clean.parse_timestamp(c).alias("ts"), clean.parse_boolean(c).alias("b"), clean.clean_string(c).alias("s"),
        clean.normalize_status(c).alias("st"), clean.parse_numeric(c).alias("n"), clean.null_words(c).alias("z")).collect()}
    assert r[0].ts == datetime(2023, 5, 1, 4, 5) and r[1].ts == r[0].ts and r[3].ts == datetime(2023, 2, 13) and r[4].ts is None
    assert r[8].b is True and r[4].b is None and r[5].s is None and r[9].s == "a b"
    assert r[7].st == "NOT_INTERESTED" and r[6].st == "UNKNOWN" and r[8].st == "YES" and r[10].n == 100.5 and r[4].n is None and r[5].z is None


def test_json_blobs(spark):
    texts = {'{"a":1}': True, "[1,2]": True, "{bad}": False, '{"a":1} x}': False, "[1],[2]": False, '  {"a": 1} ': True, "plain": False, None: False, "": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.b for r in df.select("t", clean.is_json_blob(F.col("t")).alias("b")).collect()}
    assert got == texts


def test_batch_is_what_was_written(spark, tmp_path):
    """A source that gains a row between reads: nothing is skipped later."""
    src = f"{tmp_path}/src"
    shape = "id long, updated_at timestamp, text string"
    spark.createDataFrame([(1, datetime(2024, 1, 1), 'a "quoted"\nline, x'), (2, datetime(2024, 1, 2), "")], shape).write.parquet(src)
    reads = []

    def late(batches):
        yield from batches

    df = spark.read.schema(shape).parquet(src).mapInArrow(late, shape)
    table = ingest.SourceTable("shop", "t", "id", "updated_at")
    written = landing.write_raw

    def write_then_grow(*args):
        written(*args)
        spark.createDataFrame([(3, datetime(2024, 1, 9), "late")], shape).write.mode("append").parquet(src)
        reads.append(1)

    landing.write_raw = write_then_grow
    try:
        done = ingest.full_load(df, table, f"{tmp_path}/zone", AT)
    finally:
        landing.write_raw = written
    assert reads and done["rows"] == 2 and done["watermark"] == datetime(2024, 1, 2)
    again = ingest.cdc_load(spark.read.schema(shape).parquet(src), table, f"{tmp_path}/zone", AT, done["watermark"])
    assert again["rows"] == 1 and again["watermark"] == datetime(2024, 1, 9)
    raw = landing.read_raw(spark, f"{tmp_path}/zone", "t", "shop")
    assert {r.id: r.text for r in raw.collect()}["1"] == 'a "quoted"\nline, x' and raw.count() == 3


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfid,note\r\n1,"two\r\nlines, ""q"""\r\n2,x\r\n')
    (tmp_path / "b.csv").write_text("note,id\n" + "y" * 70000 + ",3\n")
    got = {r.id: r.note for r in landing.read_landing(spark, str(tmp_path)).collect()}
    assert got["2"] == "x" and got["3"] == "y" * 70000 and got["1"].replace("\r", "") == 'two\nlines, "q"'


def test_column_rules_leave_literals(spark):
    df = spark.createDataFrame([("v",)], "name string")
    rules = [{"column": "a", "expression": "concat($name, '$5 OPERATION_TYPE', OPERATION_TYPE)"}]
    assert ingest.add_columns(df, "t", rules, AT, "U").first().a == "v$5 OPERATION_TYPEU"


def test_missing_columns_warn(spark):
    config = staging.TableConfig("t", [staging.Mapped("a", "b"), staging.Mapped("x", "y")], missing="warn")
    with pytest.warns(UserWarning, match="t lacks x"):
        assert staging.apply_mapping(spark.createDataFrame([("1",)], "a string"), config).columns == ["b"]


def test_only_files_with_broken_lines_are_read_whole(spark, tmp_path):
    z = tmp_path / "z"
    z.mkdir()
    (z / "a.csv").write_text("id,v\n" + "".join(f"{i},x{i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        plain = landing.read_landing(spark, str(z))
        assert plain.count() == 3000 and plain.rdd.getNumPartitions() > 3
        (z / "b.csv").write_text('id,v\n9000,"two\nlines"\n9001,"say ""hi"""\n')
        (z / "c.csv").write_text('v,id,w\n"q ""x""",9002,1\n')
        both = landing.read_landing(spark, str(z))
        got = {r.id: (r.v, r.w) for r in both.where("id >= '9'").collect() if int(r.id) >= 9000}
        assert got == {"9000": ("two\nlines", None), "9001": ('say "hi"', None), "9002": ('q "x"', "1")} and both.count() == 3003
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_types_that_differ_between_formats(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.csv").write_text("id,v,n\n1,word,5\n2,x,6\n")
    spark.createDataFrame([(3, 7, 8)], "id int, v long, n int").write.parquet(f"{tmp_path}/m/p")
    got = {(r.id, r.v, r.n) for r in landing.read_mixed(spark, f"{tmp_path}/m").collect()}
    assert got == {(1, "word", 5), (2, "x", 6), (3, "7", 8)}
