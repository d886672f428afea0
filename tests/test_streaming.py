import json
import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tarnlake.operators import alerts, ingest, staging
from tarnlake.streaming import cdc

SCHEMA = "table_name string, op string, seq long, after struct<id: string, v: string>"


def put(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps({"table_name": t, "op": o, "seq": s, "after": {"id": i, "v": v}}) + "\n" for t, o, s, i, v in rows))
    time.sleep(0.01)


def run(q):
    q.awaitTermination(120)
    assert q.exception() is None


def test_capture_fans_out_and_resumes(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(src, "1.json", [("leads", "I", 1, "a", "x"), ("other", "I", 2, "z", "z"), ("sales", "D", 3, "s", None)])
    events = cdc.change_stream(spark, str(src), SCHEMA)
    run(cdc.capture(events, ["leads", "sales"], out, cp))
    put(src, "2.json", [("leads", "U", 4, "a", "y")])
    run(cdc.capture(events, ["leads", "sales"], out, cp))
    leads = spark.read.parquet(f"{out}/leads")
    assert sorted((r.id, r.v, r.op) for r in leads.collect()) == [("a", "x", "I"), ("a", "y", "U")]
    assert {"gpk", "env", "region", "extraction_time"} <= set(leads.columns)
    assert spark.read.parquet(f"{out}/sales").first().op == "D"


def test_apply_keeps_current_state(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "state")
    assert cdc.current_state(spark, root) is None
    src.mkdir()
    events = cdc.captured(cdc.change_stream(spark, str(src), SCHEMA, files=1), ["leads"])
    put(src, "1.json", [("leads", "I", 1, "a", "x"), ("leads", "I", 2, "b", "x")])
    put(src, "2.json", [("leads", "U", 4, "a", "z"), ("leads", "D", 3, "b", None)])
    run(cdc.apply_changes(events, "id", ["seq"], root))
    assert [(r.id, r.v) for r in cdc.current_state(spark, root, live_only=True).collect()] == [("a", "z")]
    put(src, "3.json", [("leads", "U", 2, "b", "late"), ("leads", "I", 9, "c", "n")])
    run(cdc.apply_changes(events, "id", ["seq"], root))
    assert sorted(r.id for r in cdc.current_state(spark, root, live_only=True).collect()) == ["a", "c"]


def test_suppression_across_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    row = lambda m: json.dumps({"alert_type": "k", "severity": "warning", "source": "s", "title": "t", "message": "m", "created_at": f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z"})
    schema = "alert_type string, severity string, source string, title string, message string, created_at timestamp"
    for k, ms in enumerate(([0, 30], [59, 61], [90, 125])):
        (src / f"{k}.json").write_text("\n".join(map(row, ms)))
        df = spark.readStream.schema(schema).json(str(src))
        run(cdc.suppressed_alerts(df, str(tmp_path / "out")))
    got = spark.read.parquet(str(tmp_path / "out/alerts"))
    assert sorted(r.created_at.hour * 60 + r.created_at.minute for r in got.collect()) == [0, 61, 125]


def test_lag_and_poll(spark, tmp_path):
    df = spark.createDataFrame([("1", "1/1/2024 0:30")], "id string, updated_at string")
    stamped = df.withColumn("at", F.lit("2024-01-01 00:30:00").cast("timestamp_ntz"))
    assert cdc.lag_seconds(stamped, "at", "2024-01-01 01:00:00").first()[0] == 1800
    t = ingest.SourceTable("s", "t", tracking="updated_at")
    got = cdc.poll(spark, lambda _: df, [t], str(tmp_path), {"t": datetime(2023, 1, 1)}, datetime(2024, 1, 2))
    assert got["rows"] == 1 and got["results"][0]["watermark"] == datetime(2024, 1, 1, 0, 30)


def test_restarted_stream_gives_the_same_state(spark, tmp_path):
    """Batches one by one, with restarts, against one batch compaction of all rows."""
    rnd, shape = random.Random(3), "id long, at timestamp, v double, op string"
    src, root = f"{tmp_path}/src", f"{tmp_path}/root"
    when = lambda n: datetime(2024, 1, 1) + timedelta(hours=n)
    rows = [(rnd.choice([None, *range(12)]), when(rnd.randrange(6)) if rnd.random() < 0.9 else None, rnd.choice([None, 0.5, float("nan")]), rnd.choice("IUD")) for _ in range(120)]
    for at in range(0, 120, 40):
        spark.createDataFrame(rows[at : at + 40], shape).coalesce(1).write.mode("append").parquet(src)
        run(cdc.apply_changes(spark.readStream.schema(shape).parquet(src), "id", ["at", "v"], root))
    want = staging.keep_latest(spark.createDataFrame(rows, shape), "id", ["at", "v"])
    assert sorted(map(repr, cdc.current_state(spark, root).collect())) == sorted(map(repr, want.select("id", "at", "v", "op").collect()))
    live = cdc.current_state(spark, root, live_only=True)
    assert 0 < live.count() < want.count() and live.where("op = 'D'").count() == 0
    # Nothing new: the state stays, and nothing is written to the change log.
    before = spark.read.parquet(f"{root}/changes").count()
    run(cdc.apply_changes(spark.readStream.schema(shape).parquet(src), "id", ["at", "v"], root))
    assert spark.read.parquet(f"{root}/changes").count() == before and cdc.current_state(spark, root).count() == want.count()


ALERT = "alert_type string, severity string, source string, title string, message string, created_at timestamp"


def test_stream_suppresses_as_the_batch_does(spark, tmp_path):
    rnd, src = random.Random(5), f"{tmp_path}/src"
    rows = sorted((("k", rnd.choice(["warning", "error", None]), rnd.choice(["a", "b", None]), "t", rnd.choice("mn"), datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(900))) for _ in range(150)), key=lambda r: r[5])
    for at in range(0, 150, 50):
        spark.createDataFrame(rows[at : at + 50], ALERT).coalesce(1).write.mode("append").parquet(src)
        run(cdc.suppressed_alerts(spark.readStream.schema(ALERT).parquet(src), f"{tmp_path}/out"))
    got = spark.read.parquet(f"{tmp_path}/out/alerts")
    want = alerts.suppress(spark.createDataFrame(rows, ALERT)).select(got.columns)
    assert 20 < want.count() < 60
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_timers_clear_what_can_suppress_no_more(spark, tmp_path):
    src, root = f"{tmp_path}/src", f"{tmp_path}/out"
    put_at = lambda source, day: spark.createDataFrame([("k", "error", source, "t", "m", datetime(2024, 1, day))], ALERT).coalesce(1).write.mode("append").parquet(src)
    for source, day in (("a", 1), ("b", 10), ("b", 20), ("b", 30)):
        put_at(source, day)
        run(cdc.suppressed_alerts(spark.readStream.schema(ALERT).parquet(src), root, late="1 day"))
    state = spark.read.format("statestore").option("path", f"{root}/checkpoint").option("stateVarName", "last").load()
    assert 1 <= state.count() < 2  # of two keys; a's time has passed
    assert spark.read.parquet(f"{root}/alerts").count() == 4


def test_state_is_kept_without_python(spark, tmp_path, capsys):
    """Rows pass through the engine only; late and repeated rows are no change."""
    src, root, shape = f"{tmp_path}/src", f"{tmp_path}/root", "id long, seq int, v string, op string"
    for rows in ([(1, 5, "a", "I"), (2, 5, "b", "I"), (None, 1, "n", "I")], [(1, 4, "late", "U"), (2, 5, "b", "I"), (3, 1, "c", "I"), (None, 2, None, "D")]):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(src)
        q = cdc.apply_changes(spark.readStream.schema(shape).parquet(src), "id", ["seq"], root)
        run(q)
        q.explain()
        plan = capsys.readouterr().out
        assert "StateStoreSave" in plan and "Py" not in plan.replace("PythonForeach", "")
    want = {0: [(1, "a"), (2, "b"), (None, "n")], 1: [(3, "c"), (None, None)]}
    changes = spark.read.parquet(f"{root}/changes").collect()
    assert {n: sorted([(r.id, r.v) for r in changes if r.batch == n], key=repr) for n in want} == {n: sorted(w, key=repr) for n, w in want.items()}
    assert sorted((r.id, r.v) for r in cdc.current_state(spark, root, live_only=True).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_many_times_of_a_key_are_held_as_numbers(tmp_path):
    """A key's times of one micro-batch take bytes, not rows."""
    import tracemalloc
    from types import SimpleNamespace as N

    from pyspark.sql import Row

    kept = {}
    state = N(exists=lambda: "at" in kept, get=lambda: (kept["at"],), update=lambda v: kept.update(at=v[0]))
    quiet = cdc._Quiet(["severity", "message", "alert_type", "source", "title", "dedup_key", "at"], 1000, False)
    quiet.init(N(getValueState=lambda *_: state))
    shape, n = Row(*quiet.names), 100_000
    rows = (shape("warning" if i % 3 else "error", "m%d" % (i % 2), "k", "s", "t", "key", i * 7919 % n) for i in range(n))
    tracemalloc.start()
    got = [(r.at, r.severity, r.message) for r in quiet.handleInputRows(("key",), rows, None)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [a for a, *_ in got] == list(range(0, n, 1000)) and kept["at"] == n - 1000
    assert peak < 100 * n
