import math
import random
from statistics import NormalDist

from pyspark.sql import functions as F

from shelfwise.functions.normal import norm_cdf, norm_ppf
from shelfwise.functions.scalars import clip_low, fixed_text, flag, lookup, own_state_flag, ratio, tidy


def test_normal_functions_match_the_standard_library(spark):
    normal = NormalDist()
    xs = [-40.0, -9.0, -7.5, -3.0, -0.2, 0.0, 0.4, 2.5, 7.2, 8.5, 38.0] + [random.Random(1).gauss(0, 3) for _ in range(300)]
    ps = [1e-12, 1e-6, 0.01, 0.074, 0.075, 0.1, 0.5, 0.75, 0.9, 0.95, 0.98, 0.999999] + [i / 307 for i in range(1, 307)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", norm_cdf(F.col("x")).alias("y")).collect()
    assert all(abs(r.y - normal.cdf(r.x)) < 1e-12 for r in got)
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", norm_ppf(F.col("p")).alias("z")).collect()
    assert all(math.isclose(r.z, normal.inv_cdf(r.p), rel_tol=1e-12, abs_tol=1e-14) for r in got)
    shifted = spark.range(1).select(norm_ppf(F.lit(0.75), 10.0, 2.0).alias("q"), norm_cdf(F.lit(12.0), 10.0, 2.0).alias("p")).first()
    assert math.isclose(shifted.q, NormalDist(10, 2).inv_cdf(0.75)) and math.isclose(shifted.p, normal.cdf(1.0))
    edge = spark.createDataFrame([(0.0,), (1.0,)], "p double").select(norm_ppf(F.col("p")).alias("z")).collect()
    assert [r.z for r in edge] == [None, None]


def test_null_stays_null_and_guards_hold(spark):
    df = spark.createDataFrame([(None, 0.0), (-2.0, 4.0), (3.0, 0.0)], "a double, b double")
    rows = df.select(clip_low(F.col("a"), 0.0).alias("clip"), ratio(F.col("a"), F.col("b"), 7.0).alias("r"), flag(F.col("a") > 0).alias("f")).collect()
    assert [(r.clip, r.r, r.f) for r in rows] == [(None, 7.0, 0), (0.0, -0.5, 0), (3.0, 7.0, 1)]


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.25, 2.5), (0.35, 3.5), (9.075, 0.5)], "a double, b double")
    even = [(r[0], r[1]) for r in df.select(F.bround("a", 1), F.bround("b", 0)).collect()]
    assert even == [(0.2, 2.0), (0.4, 4.0), (9.1, 0.0)]
    noisy = spark.createDataFrame([(446101.40499999997,)], "a double").select(tidy("a", 2)).first()[0]
    assert noisy == 446101.41
    assert spark.createDataFrame([(2.4949996,)], "a double").select(tidy("a", 2)).first()[0] == 2.49


def test_lookup_and_own_state_flag(spark):
    df = spark.createDataFrame(
        [("CA", 1, 0, 0), ("TX", 0, 1, 0), ("WI", 0, 0, 1), ("NY", 0, 0, 1), ("CA", None, 1, 1)],
        "state string, snap_CA int, snap_TX int, snap_WI int",
    )
    assert [r[0] for r in df.select(own_state_flag(F.col("state"))).collect()] == [1, 1, 1, 1, 0]
    assert [r[0] for r in df.select(lookup(F.col("state"), {"CA": 1.0}, 9.0)).collect()] == [1.0, 9.0, 9.0, 9.0, 1.0]


def test_fixed_text_is_that_of_the_exact_binary_value(spark):
    draw = random.Random(5)
    xs = [175.765, 0.125, 2.675, 0.375, 0.005, 0.015, 1.005, 0.0, 1.0, 0.004999, 1e-12, 1e7 + 0.125, 2.0**39 + 0.125, 123456789.125, 1e15, -2.675, -0.125, 99.995, 0.995, 64.0, 63.999999]
    xs += [round(draw.uniform(0, 300), 3) for _ in range(400)] + [draw.randint(0, 10**6) / 8 for _ in range(200)] + [draw.uniform(0, 1) * 10 ** draw.randint(-8, 9) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed_text(F.col("x"), 2).alias("t")).collect()
    assert [(r.x, r.t) for r in got if r.t != f"{r.x:.2f}"] == []
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(fixed_text(F.col("x"), 2).alias("t")).first().t is None
