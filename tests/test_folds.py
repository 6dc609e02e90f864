"""Order-dependent folds against brute force, with one group that holds most rows."""

import random

from pyspark.sql import functions as F
from wiretext import rows

from tidewatch.operators.ordered import carry_forward, later_max, live_items
from tidewatch.operators.upsert import upsert, upsert_into

rng = random.Random(5)
DATA = [(n, "hot" if rng.random() < 0.6 else f"g{rng.randrange(4)}", rng.randrange(6), rng.randrange(100)) for n in range(3000)]


def frame(spark, parts=7):
    data = DATA[:]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "arrival INT, grp STRING, item INT, v INT").repartition(parts)
    return df.withColumn("chunk", F.expr("arrival div 64"))


def test_carry_forward(spark):
    got = carry_forward(frame(spark), "grp", F.when(F.col("v") < 5, F.col("arrival")), "last")
    want, seen = [], {}
    for n, g, _, v in DATA:
        if v < 5:
            seen[g] = n
        want.append((n, seen.get(g)))
    assert sorted(rows(got, "arrival", "last")) == want


def test_later_max(spark):
    got = later_max(frame(spark), "grp", F.when(F.col("v") % 3 == 0, F.col("v")), "top")
    want, seen = [], {}
    for n, g, _, v in reversed(DATA):
        want.append((n, seen.get(g)))
        if v % 3 == 0:
            seen[g] = max(v, seen.get(g, -1))
    assert sorted(rows(got, "arrival", "top")) == sorted(want)


def test_live_items(spark):
    ops = frame(spark).withColumn("is_delete", F.col("v") < 3)
    ops = ops.withColumns({"a": F.col("v"), "b": F.col("v") + 1000})
    got = live_items(ops, ["grp"], ["item"], ["a"], ["b"])
    live = {}
    for n, g, item, v in DATA:
        if v < 3:
            live = {k: x for k, x in live.items() if k[0] != g}
        else:
            first = live[(g, item)][0] if (g, item) in live else (v, n)
            live[(g, item)] = (first, v + 1000, n)
    want = sorted((g, item, first[0], b, first[1], n) for (g, item), (first, b, n) in live.items())
    assert sorted(rows(got, "grp", "item", "a", "b", "created", "arrival")) == want


def test_upsert_does_not_depend_on_partitioning_or_replay(spark):
    results = []
    for parts in (1, 5, 13):
        df = frame(spark, parts).drop("chunk")
        results.append(rows(upsert(df, ["grp"], ["item"]), "grp", "item", "v"))
    assert results[0] == results[1] == results[2]
    df = frame(spark).drop("chunk")
    once = upsert(df, ["grp"], keep_order=True)
    again = upsert_into(once, df, ["grp"])
    assert rows(once, *once.columns) == rows(again, *once.columns)
    first = {g: i for n, g, i, v in reversed(DATA)}
    last = {g: v for n, g, i, v in DATA}
    assert results[0] == sorted(((g, first[g], last[g]) for g in first), key=repr)


def test_upsert_reduces_before_the_shuffle(spark):
    plan = upsert(frame(spark).drop("chunk"), ["grp"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning(grp")
