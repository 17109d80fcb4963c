import random
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import order_stats
from riskspark.operators.order_stats import (
    column_values,
    extent,
    iqr_outliers,
    order_statistics,
    quartiles,
)
from riskspark.operators.reports import amount_histogram
from tests.helpers import rows


def _frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(4)


SHAPES = {
    "distinct": [random.Random(1).random() * 1000 for _ in range(4000)],
    "hot value": [7.0] * 2500 + [float(i) for i in range(1500)],
    "two values": [1.0] * 2000 + [2.0] * 2000,
    "one value": [3.0] * 100,
    "skewed": [2.0 ** (i % 60) for i in range(3000)],
    "with nan and null": [float("nan"), None] * 50 + [float(i) for i in range(500)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_ranks_are_exact_through_every_narrowing(spark, shape):
    values = sorted(v for v in SHAPES[shape] if v is not None and v == v)
    n = len(values)
    ranks = [1, 2, n // 4, n // 2, n - n // 4 + 1, n]
    got = order_statistics(_frame(spark, SHAPES[shape]), "v", ranks, n, values[0])
    assert got == {r: values[r - 1] for r in ranks}


def test_exact_for_decimals_beyond_double_precision(spark):
    values = [D("12345678901234567.00") + D(i) / 100 for i in range(1000)]
    got = order_statistics(_frame(spark, values, "decimal(20,2)"), "v", [250, 751], 1000, values[0])
    assert got == {250: values[249], 751: values[750]}


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,2)"])
def test_a_coarse_sketch_only_costs_rounds(spark, monkeypatch, kind):
    """With a sketch far too coarse for the data the answers stay exact."""
    monkeypatch.setattr(order_stats, "SKETCH_ACCURACY", 20)
    big = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(9_000)).cast(kind).alias("v"))
    values = sorted(r[0] for r in big.collect())
    assert extent(big, "v") == (20_000, values[0])
    got = order_statistics(big, "v", [5_000, 15_001], 20_000, values[0])
    assert got == {5_000: values[4_999], 15_001: values[15_000]}


@pytest.mark.parametrize("values, expected", [
    ([1.0, 2.0, 3.0], None),
    ([1.0, 2.0, 3.0, 4.0], (1.0, 4.0)),
    ([float(i) for i in range(1, 8)], (2.0, 7.0)),
])
def test_tile_quartiles(spark, values, expected):
    assert quartiles(_frame(spark, values), "v", "ntile") == expected


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 101, 1000])
def test_linear_quartiles_equal_numpy(spark, n):
    values = [random.Random(i).random() * 100 for i in range(n)]
    got = quartiles(_frame(spark, values), "v", "linear")
    assert got == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])), rel=1e-12)


def test_outliers(spark):
    values = [float(i) for i in range(100)] + [1000.0, -1000.0, float("nan")]
    df = _frame(spark, values)
    assert rows(iqr_outliers(df, "v", "linear")) == [(-1000.0,), (1000.0,)]
    assert rows(iqr_outliers(df, "v", "ntile")) == [(-1000.0,), (1000.0,)]
    decimals = _frame(spark, [D(i) for i in range(100)] + [D(1000)], "decimal(18,3)")
    assert rows(iqr_outliers(decimals, "v", "linear")) == [(D("1000.000"),)]


@pytest.mark.parametrize("method", ["ntile", "linear"])
def test_no_values_no_outliers(spark, method):
    assert iqr_outliers(_frame(spark, []), "v", method).isEmpty()
    assert iqr_outliers(_frame(spark, [None, None]), "v", method).isEmpty()


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        quartiles(_frame(spark, [1.0]), "v", "median")


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "v")
    _frame(spark, [float(i) for i in range(100)] + [1000.0]).write.parquet(path)
    out = iqr_outliers(spark.read.parquet(path), "v", "linear")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(v," in plan and "GreaterThan(v," in plan and out.count() == 1


def test_column_values_is_one_column(spark):
    df = spark.range(3).withColumn("x", F.lit(1.0))
    assert column_values(df, "x").columns == ["v"]


@pytest.mark.parametrize("values", [
    [random.Random(5).randint(0, 10_000) / 100 for _ in range(500)],
    [5.0] * 8,
    [0.0, 100.0],
])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(D(str(v)),) for v in values], "amount decimal(18,2)")
    counts, edges = np.histogram(values, bins=20)
    got = {r.bin: r for r in amount_histogram(df).collect()}
    assert {b: r.txn_count for b, r in got.items()} == {i + 1: c for i, c in enumerate(counts)}
    for b, r in got.items():
        assert (r.bin_start, r.bin_end) == pytest.approx((edges[b - 1], edges[b]))


def test_histogram_of_nothing(spark):
    assert amount_histogram(spark.createDataFrame([], "amount decimal(18,2)")).collect() == []


def test_searches_among_the_same_candidates_share_one_sketch(spark):
    values = order_stats.column_values(spark.range(100).select(F.col("id").cast("decimal(18,2)").alias("x")), "x")
    searches = [order_stats._Search(k, 100, 0) for k in (25, 26, 75, 76)]
    kind = values.schema["v"].dataType
    asked = [order_stats._asked(s, searches) for s in searches]
    found = values.agg(*[order_stats._bracket(s, kind, a).alias(str(s.k)) for s, a in zip(searches, asked, strict=True)])
    assert found._jdf.queryExecution().executedPlan().toString().count("partial_percentile_approx(") == 1
