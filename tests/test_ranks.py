"""Ranks and quantiles from counts by value against plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.functions import stats
from topicloom.operators import entropy, ranks


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, 0.0, -0.0, 1.5, float("nan"), float(rng.randrange(40))])) for i in range(600)]
    rows += [(1000, "alone", 3.0), (1001, "flat", 2.0), (1002, "flat", 2.0), (1003, "none", None)]
    return spark.createDataFrame(rows, "id int, g string, x double").repartition(5).cache()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_equal_the_windows(table, by):
    known = table.where("x is not null")
    want = {r.id: r.p for r in known.select("id", stats.percentile_rank(F.col("x"), *by).alias("p")).collect()}
    got = {r.id: r.p for r in ranks.percentile_ranks(table, "x", "p", by).collect()}
    assert len(got) == table.count() and {k: v for k, v in got.items() if v is not None} == pytest.approx(want)
    if by:
        want = {r.id: r.p for r in known.select("id", stats.share_at_or_below(F.col("x"), "g").alias("p")).collect()}
        got = {r.id: r.p for r in ranks.shares_at_or_below(table, "x", "p", by).collect()}
        assert {k: v for k, v in got.items() if v is not None} == pytest.approx(want)


def test_quantiles_are_linear(table):
    rows = table.where("not isnan(x)")
    got = {r.g: (r.a, r.b, r.c) for r in ranks.quantiles(rows, "x", {"a": 0.0, "b": 0.35, "c": 0.9}, ["g"]).collect()}
    held = {}
    for r in rows.where("x is not null").collect():
        held.setdefault(r.g, []).append(r.x)
    assert got.keys() == held.keys() and all(got[g] == pytest.approx(tuple(np.quantile(v, [0, 0.35, 0.9]))) for g, v in held.items())
    assert ranks.quantiles(rows.limit(0), "x", {"a": 0.5}).collect() == [(None,)]


def test_no_window_holds_a_group(table):
    """The windows are by range, or over the ranges' sums."""
    plan = ranks.percentile_ranks(table, "x", "p")._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.splitlines() if "Window [" in line]
    assert specs and all("_part" in line or "_sum" in line for line in specs)


def test_numbers_follow_the_order(spark, table):
    got = [r.id for r in ranks.numbered(table, [F.desc("x"), F.asc("id")], "n").orderBy("n").collect()]
    assert got == [r.id for r in table.orderBy(F.desc("x"), F.asc("id")).collect()]
    assert ranks.numbered(table.limit(0), [F.asc("id")], "n").collect() == []


def test_entropies(spark):
    rows = spark.createDataFrame([("t", "a", ["x", "y"]), ("t", "b", ["x", "x"]), ("t", None, []), ("u", "a", None), ("v", None, None)], "t string, s string, i array<string>")
    p = np.array([2, 1]) / 3
    want = {"t": (1.0 - (p * np.log(p)).sum() / np.log(2)) / 2, "u": 0.0, "v": 0.0}
    assert {r.t: r.entropy for r in entropy.mean_entropy(rows, "t", ["s", "i"]).collect()} == pytest.approx(want)
