import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.ordering import exact_quantiles, label_codes, median_by_counts, running_total


@pytest.mark.parametrize("hot_share", [0.0, 0.4, 1.0])
def test_running_total_matches_a_plain_loop_with_hot_values(spark, hot_share):
    rng = random.Random(3)
    rows = [(i, 500 if rng.random() < hot_share else rng.randint(0, 10_000), f"g{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v bigint, g string").repartition(7)
    got = {r.id: (r.run, r.run_total) for r in running_total(df, [F.desc("v"), F.asc("id")], "v", "run").collect()}
    total, expected = 0, {}
    for i, v, _ in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += v
        expected[i] = total
    assert got == {i: (t, total) for i, t in expected.items()}
    grouped = {r.id: r.run for r in running_total(df, [F.desc("v"), F.asc("id")], "v", "run", by=["g"]).collect()}
    sums = {}
    for i, v, g in sorted(rows, key=lambda r: (-r[1], r[0])):
        sums[g] = sums.get(g, 0) + v
        assert grouped[i] == sums[g]


def test_ranges_share_a_hot_value(spark):
    df = spark.range(4000).select(F.col("id"), F.lit(1).cast("bigint").alias("v"))
    plan = running_total(df, [F.desc("v"), F.asc("id")], "v", "run")
    sizes = plan.inputFiles()
    assert len(sizes) > 1  # one value, yet several ranges
    assert plan.agg(F.max("run")).first()[0] == 4000


def test_quantiles_and_medians_are_exact(spark):
    rng = random.Random(5)
    for n in (1, 2, 7, 100):
        values = [rng.choice([1.0, 2.0, rng.random()]) for _ in range(n)]
        df = spark.createDataFrame(list(enumerate(values)), "id int, x double")
        got = {r.p: r.quantile for r in exact_quantiles(df, "x", ["id"], [0, 0.25, 0.5, 0.75, 1]).collect()}
        for p, q in got.items():
            assert np.isclose(q, np.quantile(values, p)), (n, p)
        assert np.isclose(median_by_counts(df, [], "x", "m").first().m, np.median(values))
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 5), ("b", 2), ("b", 4), ("b", None)], "k string, x int")
    assert {r.k: r.m for r in median_by_counts(df, ["k"], "x", "m").collect()} == {"a": 1.0, "b": 3.0}


def test_label_codes_follow_sorted_order(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x")], "p string, q string")
    got = {(r.column_name, r.label): r.code for r in label_codes({"p": df, "q": df}).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("q", "x"): 0, ("q", "y"): 1}
