"""Published versions of marts, ranked parts, mergeable sketches."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators import ranked, sketches
from riskspark.sources import versions
from tests.helpers import rows


def _write(spark, root, n, die=False):
    version = versions.new_version(root)
    spark.range(n).write.parquet(f"{version}/a")
    if die:
        raise RuntimeError("the run dies")
    spark.range(n).write.parquet(f"{version}/b")
    versions.publish(spark, root, version)
    return version


def test_a_run_that_dies_leaves_the_marts_before(spark, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, root)
    _write(spark, root, 3)
    with pytest.raises(RuntimeError):
        _write(spark, root, 5, die=True)
    assert versions.read_published(spark, root, "a").count() == 3
    assert versions.read_published(spark, root, "b").count() == 3


def test_old_versions_go_and_unfinished_ones_after_their_time(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    with pytest.raises(RuntimeError):
        _write(spark, root, 1, die=True)
    made = [_write(spark, root, n) for n in (2, 3, 4)]
    assert versions.published(spark, root) == made[1:]
    assert len([p for p in (tmp_path / "marts").iterdir() if p.name.startswith("version-")]) == 3  # one unfinished
    monkeypatch.setattr(versions, "UNFINISHED_HOURS", 0)
    versions.publish(spark, root, made[1])  # an older one may be published again
    assert versions.read_published(spark, root, "a").count() == 3
    assert len([p for p in (tmp_path / "marts").iterdir() if p.name.startswith("version-")]) == 2


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_numbers_over_parts_equal_a_plain_sort(spark, tmp_path, n):
    path = str(tmp_path / "ranked")
    # a third of the rows share one score
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        ranked.write_ranked(df, path, [F.desc("score"), F.col("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [(k + 1, r.id) for k, r in enumerate(sorted(df.collect(), key=lambda r: (-r.score, r.id)))]
    assert rows(ranked.numbered(spark, path), "position", "id") == want
    if n > 1:
        assert spark.read.parquet(f"{path}/parts").count() > 1
    for first, size in ((1, 10), (240, 60), (n - 3, 10), (n + 1, 5)):
        if first > 0:
            assert rows(ranked.page(spark, path, first, size), "position", "id") == want[first - 1 : first - 1 + size]


def test_a_page_is_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "ranked")
    ranked.write_ranked(spark.range(500), path, [F.col("id")])
    plan = ranked.page(spark, path, 100, 5)._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "EqualTo(part," in plan and "Exchange" not in plan


TXN = "transaction_id bigint, customer_id bigint, bank_id bigint, amount decimal(18,2), txn_date date"


def test_merged_sketches_keep_to_their_error(spark, tmp_path):
    path = str(tmp_path / "sketches")
    txn = spark.range(60_000).select(
        F.col("id").alias("transaction_id"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4).alias("bank_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000_000)) / 100).cast("decimal(18,2)").alias("amount"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("txn_date"),
    )
    for k in (0, 1, 2, 1):
        sketches.add_load(txn.where(F.col("transaction_id") % 3 == k), path, k)
    assert spark.read.parquet(path).count() <= 3 * 4 * 3
    got = sketches.approx_features(spark, path, []).first()
    assert got.n_rows == 60_000
    for p, c in zip(sketches.QUARTILES, ("q1_amount", "median_amount", "q3_amount")):
        share = txn.where(F.col("amount").cast("double") <= got[c]).count() / 60_000
        assert abs(share - p) <= 4 * sketches.RANK_ERROR
    exact = txn.select("customer_id").distinct().count()
    assert abs(got.distinct_customers - exact) <= 4 * sketches.DISTINCT_ERROR * exact
    per_bank = {r.bank_id: r.n_rows for r in sketches.approx_features(spark, path, ["bank_id"]).collect()}
    assert per_bank == {r.bank_id: r["count"] for r in txn.groupBy("bank_id").count().collect()}


def test_sketches_of_little(spark, tmp_path):
    path = str(tmp_path / "sketches")
    few = spark.createDataFrame([(1, 1, 1, None, None), (2, None, 2, None, None)], TXN)
    sketches.add_load(few, path, 0)
    got = rows(sketches.approx_features(spark, path, ["bank_id"]), "bank_id", "n_rows", "q1_amount", "distinct_customers")
    assert got == [(1, 1, None, 1), (2, 1, None, 0)]
    assert sketches.approx_outliers(few, path).count() == 0
    some = spark.createDataFrame([(k, 1, 1, k, None) for k in range(1, 9)] + [(9, 1, 1, 900, None)], "transaction_id int, customer_id int, bank_id int, amount int, txn_date date")
    some = some.select(*[F.col(f).cast(t).alias(f) for f, t in (x.split(" ") for x in TXN.split(", "))])
    sketches.add_load(some, path, 0)
    assert rows(sketches.approx_outliers(some, path), "transaction_id") == [(9,)]
