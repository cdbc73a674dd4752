import random

import pytest
from pyspark.sql import functions as F

from pulsemill.functions.measures import approx_quantiles, on_grid, quantile_at, with_measures

EDGE_CASES = [
    # duration_ms, length_seconds, seconds, pct
    (45_000, 3_600, 45.0, 1.25),
    (None, 3_600, None, None),
    (-1, 3_600, None, None),
    (0, 3_600, 0.0, 0.0),
    (1_500, None, 1.5, None),
    (1_500, 0, 1.5, None),
    (7_200_000, 3_600, 7_200.0, 200.0),
]


def test_edge_cases(spark):
    rows = [(d, n) for d, n, _, _ in EDGE_CASES]
    df = with_measures(spark.createDataFrame(rows, "duration_ms long, length_seconds long"))
    got = [(r.duration_ms, r.length_seconds, r.engagement_seconds, r.engagement_pct) for r in df.collect()]
    assert got == EDGE_CASES


def expected(duration, length):
    seconds = round(duration / 1000.0, 3)
    return seconds, round((seconds / length) * 100, 2)


def test_rounding_is_that_of_exact_values(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(0, 400_000), rng.randrange(1, 8_000)) for _ in range(100_000)]
    # Shares that lie on or next to a tie of the second decimal.
    pairs += [(k * 5 + 5, 1_000) for k in range(4_000)]
    pairs += [(70_884, 1_584), (1, 8_000), (25, 2_000), (2_675, 100_000), (5, 1_000_000)]
    pairs += [(rng.randrange(0, 10**12), rng.randrange(1, 50)) for _ in range(5_000)]
    df = with_measures(spark.createDataFrame(pairs, "duration_ms long, length_seconds long"))
    wrong = [
        (r, expected(r.duration_ms, r.length_seconds)) for r in df.collect()
        if (r.engagement_seconds, r.engagement_pct) != expected(r.duration_ms, r.length_seconds)
    ]
    assert wrong == []


def test_grid_swallows_summation_noise(spark):
    df = spark.createDataFrame([(1.00005,), (1.00005 - 2e-16,), (1.00005 + 2e-16,)], "x double")
    assert {r[0] for r in df.select(on_grid(F.col("x"))).collect()} == {1.0001}


def test_quantile_array_and_single_offset_agree(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    row = df.agg(
        approx_quantiles("x", 100, 100_000).alias("all"), quantile_at("x", 100, 90, 100_000).alias("p90"),
        quantile_at("x", 2, 1, 100_000).alias("median"),
    ).first()
    assert len(row["all"]) == 101
    assert row["all"][90] == row["p90"] == 900.0
    assert row["median"] == pytest.approx(500.0)
