"""Features by load against features of all rows at once."""

import random
from datetime import timedelta

import pytest

from riskspark.operators import features, snapshots
from tests.helpers import DAY, banks, customers, rows, sanctions, txns


def _tables(spark):
    r = random.Random(4)
    c = customers(spark, *[(k, "Low", r.choice(["North", "East"])) for k in range(1, 9)])
    b = banks(spark, *[(k, 0.5) for k in range(1, 5)])
    s = sanctions(spark, (1, 1, 1), (2, 1, 1), (3, 2, 5))
    loads = [
        txns(spark, *[(100 * k + i, r.randint(1, 7), r.randint(1, 3), r.choice([5, 9500.25, 77.1]), r.randint(0, 1), DAY + timedelta(days=r.randint(0, 99))) for i in range(30)])
        for k in range(5)
    ]
    return c, b, s, loads


def _same(spark, path, c, b, s, loads):
    whole = loads[0]
    for load in loads[1:]:
        whole = whole.unionByName(load)
    assert rows(snapshots.customer_features(path, c, s)) == rows(features.customer_features(c, whole, s))
    assert rows(snapshots.bank_features(path, b, s)) == rows(features.bank_features(b, whole, s))
    assert rows(snapshots.region_features(path, c)) == rows(features.region_features(c, whole))


def test_loads_corrections_and_compaction(spark, tmp_path):
    c, b, s, loads = _tables(spark)
    path = str(tmp_path / "snapshot")
    for k, load in enumerate(loads[:4]):
        snapshots.add_load(load, path, k)
    _same(spark, path, c, b, s, loads[:4])
    untouched = {p: p.stat().st_mtime_ns for k in (0, 1, 3) for p in (tmp_path / "snapshot" / "customers" / f"load={k}").glob("*.parquet")}
    loads[2] = loads[2].where("transaction_id % 2 = 0")  # a late correction, and a repeated load
    snapshots.add_load(loads[2], path, 2)
    snapshots.add_load(loads[2], path, 2)
    _same(spark, path, c, b, s, loads[:4])
    assert {p: p.stat().st_mtime_ns for p in untouched} == untouched
    for upto in (1, 2, 2):
        snapshots.compact(spark, path, upto)
        _same(spark, path, c, b, s, loads[:4])
    with pytest.raises(ValueError, match="compacted"):
        snapshots.add_load(loads[2], path, 2)
    snapshots.add_load(loads[4], path, 4)
    _same(spark, path, c, b, s, loads)


def test_a_load_that_was_folded_but_not_removed_counts_once(spark, tmp_path):
    """As after a compaction that was stopped before it cleared up."""
    c, b, s, loads = _tables(spark)
    path, removed = str(tmp_path / "snapshot"), snapshots.delete
    for k in range(3):
        snapshots.add_load(loads[k], path, k)
    try:
        snapshots.delete = lambda spark, folder: None if "load=" in folder else removed(spark, folder)
        snapshots.compact(spark, path, 1)
    finally:
        snapshots.delete = removed
    assert len(list((tmp_path / "snapshot" / "customers").glob("load=*"))) == 3
    _same(spark, path, c, b, s, loads[:3])


def test_no_load_reads_another(spark, tmp_path):
    c, b, s, loads = _tables(spark)
    path = str(tmp_path / "snapshot")
    snapshots.add_load(loads[0], path, 0)
    for f in (tmp_path / "snapshot").rglob("*.parquet"):
        f.write_bytes(b"")
    snapshots.add_load(loads[1], path, 1)
    assert sum(r.n for r in spark.read.parquet(f"{path}/customers/load=1").collect()) == 30
    with pytest.raises(ValueError, match="no loads"):
        snapshots.merged(spark, str(tmp_path / "none"), "customers")
