import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm.chat import ROLES, STATES, Model, features, fit_model, format_chats, marker

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def test_markers():
    assert marker("User: hi") == (2, "hi") and marker("**Assistant:** ok") == (3, "ok") and marker("### System:") == (1, "")
    assert marker("<|im_start|>user") == (2, "") and marker("[Human]: x") == (2, "x") and marker("AI (draft): y") == (3, "y")
    assert marker("usernames: x")[0] == 0 and marker("A plan")[0] == 0 and marker("")[0] == 0


def test_decode_is_the_best_path():
    model = Model.from_counts([(0, 0, 1, 5), (1, 2, 1, 9), (2, 4, 3, 30), (-1, 1, 2, 50)])
    values = np.array([f for t in ("System: be kind", "What?\nUser: why", "x" * 700) for f, _ in features(t, t[0] == "S")])
    seen = model.seen(values)

    def score(path):
        s = model.start[path[0]] + seen[0, path[0]]
        return s + sum(model.step[a, b] + seen[k + 1, b] for k, (a, b) in enumerate(zip(path, path[1:], strict=False)))

    best = max(itertools.product(range(len(STATES)), repeat=len(values)), key=score)
    assert score(tuple(model.decode(values, model.start))) == pytest.approx(score(best))


def test_transcript_in_one_record(spark):
    text = "System: Be brief.\nHuman: What is it?\nI mean this.\nAI: A thing.\nWith parts.\n\nHuman: Thanks"
    rows = [(1, 0, None, text, "z"), (2, 0, None, None, "z"), (None, None, None, "User: a", "z"), (3, 1, "user", "", "z"), (3, 1, "user", "", "z")]
    got = {(r.conv_id, r.part): r for r in format_chats(spark.createDataFrame(rows, SCHEMA)).where("conv_id = 1 or conv_id is null").collect()}
    assert [got[1, k].role for k in range(4)] == ["system", "user", "assistant", "user"]
    assert got[1, 1].text == "What is it?\nI mean this." and got[1, 2].rendered == "<|assistant|>\nA thing.\nWith parts.\n<|end|>"
    assert got[None, 0].role == "user"
    assert format_chats(spark.createDataFrame(rows, SCHEMA)).where("conv_id = 3").count() == 2
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_agree_with_whole(spark, tiny):
    talks = spark.read.parquet(f"{tiny}/conversations.parquet")
    one = talks.select(F.lit(1).alias("conv_id"), (F.col("conv_id") * 10 + F.col("turn")).alias("turn"), "role", "text")
    model = fit_model(one)
    cols = ["conv_id", "turn", "part", "role", "n_lines", "text"]
    whole = sorted(map(tuple, format_chats(one, model).select(cols).collect()))
    assert whole == sorted(map(tuple, format_chats(one, model, block=40).select(cols).collect()))
    assert {r[3] for r in whole} >= {"user", "assistant"}


def test_held_out_accuracy(spark):
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    model = fit_model(talks.where("conv_id % 2 = 0"))
    rest = talks.where("conv_id % 2 = 1")
    got = format_chats(rest, model).where("part = 0").select("conv_id", "turn", F.col("role").alias("found"))
    both = rest.join(got, ["conv_id", "turn"])
    right = both.where("role = found").count() / both.count()
    assert both.count() == rest.count() and right > 0.9


def test_marked_transcripts_recover_roles(spark):
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    line = F.concat(F.initcap("role"), F.lit(": "), "text")
    parts = F.array_sort(F.collect_list(F.struct("turn", line.alias("l"))))
    whole = talks.groupBy("conv_id").agg(F.concat_ws("\n", F.transform(parts, lambda x: x["l"])).alias("text")).withColumn("turn", F.lit(0))
    got = format_chats(whole, fit_model(talks)).select("conv_id", F.col("part").cast("long").alias("turn"), F.col("role").alias("found"))
    both = talks.join(got, ["conv_id", "turn"])
    assert both.where("role = found").count() >= 0.97 * talks.count()
    assert set(ROLES) == {r.found for r in got.select("found").distinct().collect()}


def test_any_rows_against_plain_viterbi(spark, tiny):
    """Null and repeated conversations and turns, blocks of three records,
    against one pass over each whole conversation."""
    import random

    rnd = random.Random(4)
    says = ["User: why?", "Assistant: so.", "plain words", "System: be brief\nHuman: now\nAI: yes", "What is it?", "", None, "x" * 5000, "line\n" * 60]
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, 0, 1, 2, 2, 7000, -5]), None, rnd.choice(says), "z") for _ in range(120)]
    rows += [(3, 4, None, "same", "z")] * 20
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit_model(spark.read.parquet(f"{tiny}/conversations.parquet"))
    talks = {}
    for r in df.withColumn("tie", F.xxhash64("text")).collect():
        talks.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.tie, r.turn, r.text))
    want = []
    for c, records in talks.items():
        lines = []
        for *_, turn, text in sorted(records, key=lambda r: r[:3]):
            opens = turn is not None and turn <= 0
            lines += [(turn, k == 0, rest, v) for k, (v, rest) in enumerate(features(text, opens))]
        path = model.decode(np.array([v for *_, v in lines]), model.start)
        parts = []
        for (turn, opens, rest, _), s in zip(lines, path, strict=True):
            role, first = STATES[s]
            if opens or first:
                parts.append([c, turn, 0 if opens else parts[-1][2] + 1, ROLES[role], []])
            parts[-1][4].append(rest)
        want += [(c, t, k, role, len(x), "\n".join(x).strip()) for c, t, k, role, x in parts]
    cols = ["conv_id", "turn", "part", "role", "n_lines", "text"]
    for block in (1000, 3):
        got = [tuple(r) for r in format_chats(df, model, block=block).select(cols).collect()]
        off = sum((Counter(got) - Counter(want)).values())  # of equally good paths blocks may find another
        assert off <= (0 if block == 1000 else 0.03 * len(want)), (block, [(r[:5], r[5][:20]) for r in (Counter(got) - Counter(want))], [(r[:5], r[5][:20]) for r in (Counter(want) - Counter(got))])


def test_block_borders_lie_on_a_best_path():
    rnd = np.random.default_rng(6)
    for _ in range(40):
        model = Model.from_counts([(int(rnd.integers(0, 6)), int(rnd.integers(0, 6)), int(rnd.integers(0, 2)), int(rnd.integers(1, 50))) for _ in range(12)])
        texts = [["User: a\nb", "what?", "AI: so\nmore", "x" * int(rnd.integers(1, 900)), ""][int(rnd.integers(0, 5))] for _ in range(12)]
        lines = [[v for v, _ in features(t, False)] for t in texts]
        whole = np.array(sum(lines, []))
        seen = model.seen(whole)

        def score(path, seen=seen, model=model):
            return model.start[path[0]] + seen[0, path[0]] + sum(model.step[a, b] + seen[k + 1, b] for k, (a, b) in enumerate(zip(path, path[1:], strict=False)))

        blocks = [np.array(sum(lines[i : i + 3], [])) for i in range(0, 12, 3)]
        path = []
        for values, (a, z) in zip(blocks, model.borders([model.transfer(v) for v in blocks]), strict=True):
            only = lambda s: np.where(np.arange(len(STATES)) == s, 0.0, -np.inf)
            path += model.decode(values, only(a), only(z)).tolist()
        assert score(path) == pytest.approx(score(model.decode(whole, model.start).tolist()))
