import random

import pytest
from pyspark.sql import functions as F

from stratum.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All conversations against all others."""
    logs = {}
    for conv, turn, role, text in set(rows):
        logs.setdefault(conv, []).append((turn is None, turn or 0, role or "unknown", text or ""))
    logs = {conv: [t[2:] for t in sorted(turns)] for conv, turns in logs.items()}
    out = []
    for conv, log in logs.items():
        rank = (conv is None, conv or 0)
        if any(len(o) > len(log) and o[: len(log)] == log or o == log and (c is None, c or 0) < rank for c, o in logs.items()):
            continue
        safe = [(r.replace("<|", "< |"), x.replace("<|", "< |")) for r, x in log]
        out.append((conv, len(log), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in safe)))
    return sorted(out, key=str)


def got(df, stretch):
    parts = {}
    for r in chat.format_conversations(df, stretch).collect():
        parts.setdefault(r.conv_id, []).append((r.part, r.n_turns, r.text))
    return sorted(((c, sum(p[1] for p in v), "".join(p[2] for p in sorted(v))) for c, v in parts.items()), key=str)


def logs(seed):
    rng = random.Random(seed)
    rows, number = [], 0
    for _ in range(30):
        talk = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "no", None, "<|im_end|>x", "é" * 3])) for _ in range(rng.randint(1, 9))]
        for size in {len(talk), rng.randint(1, len(talk)), rng.randint(1, len(talk))}:
            first = rng.choice([0, 0, 1, 5])
            rows += [(number, first + i * rng.choice([1, 1, 2]) if rng.random() < 0.2 else first + i, *t) for i, t in enumerate(talk[:size])]
            number += 1
    rows += [(None, 0, "user", "hi"), (None, 1, "user", "only here"), (900, None, "user", "no turn"), (900, 0, "user", "a")]
    return rows + rows[:5] + [(901, 0, "user", "long " * 50_000)]


@pytest.mark.parametrize("seed,stretch", [(1, 1024), (2, 3), (3, 1)])
def test_against_every_pair(spark, seed, stretch):
    rows = logs(seed)
    assert got(spark.createDataFrame(rows, TURNS), stretch) == plain(rows)


def test_given_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    found = got(df, 1024)
    assert found == plain(rows) and found


def test_long_conversation_and_clashing_columns(spark):
    df = spark.range(5000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                  F.col("id").cast("string").alias("text"), F.lit(1).alias("part"), F.lit(2).alias("h1"), F.lit(3).alias("place"))
    found = chat.format_conversations(df).collect()
    assert len(found) == 5 and sum(r.n_turns for r in found) == 5000
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).collect() == []


def test_no_python_in_the_plan(spark):
    df = chat.format_conversations(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
