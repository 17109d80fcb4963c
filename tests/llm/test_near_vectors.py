"""Near-duplicate vectors against comparing all pairs, and against their SQL; the calibrated chance."""

import math

import numpy as np
import pytest

from riskspark.llm import near_vectors
from riskspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, like=0.93):
    """vec_id -> (n_links, component) for rows of distinct vec_id."""
    usable = [(i, np.array(v, np.float64), k) for i, v, k in rows if i is not None and k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, _, _ in rows}
    for n, (i, a, k) in enumerate(usable):
        for j, b, m in usable[:n]:
            if k == m and len(a) == len(b) and a @ b / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= like:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen, key=lambda x: (x is not None, x)))
    return out


def rows_of(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_query_equals_its_sql(spark, duck):
    columns = ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(tuple(r) for r in QUERIES["op12_near_vectors"](spark, SF).select(*columns).collect())
    assert got == sorted(map(tuple, duck.execute(ORACLES["op12_near_vectors"]).fetchdf()[columns].itertuples(index=False)))


def clusters(seed=5):
    """Groups with cosines on both sides of the threshold, one group large, chains, and strangers."""
    r = np.random.default_rng(seed)
    rows = []
    for label, size in ((1, 90), (2, 25), (3, 40)):
        centre = r.normal(size=24)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((centre + r.normal(size=24) * r.choice([0.02, 0.05, 0.08])) * 10 ** r.uniform(-3, 3))
        x = r.normal(size=24)
        for _ in range(15):
            x = x + r.normal(size=24) * 0.3
            rows.append(x)
        rows += [*r.normal(size=(60, 24))]
    labels = [k for k, size in ((1, 90), (2, 25), (3, 40)) for _ in range(size + 75)]
    ids = r.permutation(len(rows)) + 100
    return [(int(i), [float(np.float32(x)) for x in v], k) for i, v, k in zip(ids, rows, labels, strict=True)]


@pytest.mark.parametrize("block", [8192, 40])
def test_all_pairs(spark, monkeypatch, block):
    """Also where a label takes several bundles and a bundle several blocks."""
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    monkeypatch.setattr(near_vectors, "RUN", 1 << 12)
    monkeypatch.setattr(near_vectors, "SPREAD", 4)
    rows = clusters()
    got = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert rows_of(got) == plain(rows)
    assert got.where("kept <> (vec_id = component_id)").isEmpty()


def test_awkward_vectors(spark):
    a, b = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, a, 0), (2, a, 0), (3, [2.0, 4.0, 6.0], 0), (4, a, 1), (5, a, None), (6, [0.0, 0.0, 0.0], 0), (7, None, 0), (8, [], 0),
        (9, [1.0, None, 3.0], 0), (10, [1.0, nan, 3.0], 0), (11, [1.0, inf, 3.0], 0), (12, [1.0, 2.0], 0), (13, [-1.0, -2.0, -3.0], 0),
        (14, [1e-42, 2e-42, 3e-42], 0), (15, [1e38, 2e38, 3e38], 0), (16, b, 0), (17, [-0.0, 2.0, 0.0], 3), (18, [0.0, 2.0, 0.0], 3),
    ]
    more = [(*r, 5, 6, 7) for r in [*rows, (None, a, 0), (2, a, 0)]]
    got = near_vectors.near_vectors(spark.createDataFrame(more, SCHEMA + ", node long, lists int, kept int"))
    assert got.count() == len(more)
    assert rows_of(got.where("vec_id is not null")) == plain(rows)
    assert [tuple(r) for r in got.where("vec_id is null").collect()] == [(None, 0, None, True)]
    twice = near_vectors.near_vectors(spark.createDataFrame([(5, a, 0), (5, b, 0), (7, b, 0), (3, a, 0)], SCHEMA))
    assert sorted(tuple(r) for r in twice.collect()) == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 5, True), (7, 1, 5, False)]
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_calibration():
    """The chance of a collision, by drawing pairs; the fewest directions that keep to the chance of missing."""
    r = np.random.default_rng(1)
    x = r.normal(size=2_000_000)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * r.normal(size=len(x))
    directions, t, window = near_vectors.calibrated(50_000)
    p = np.mean((x >= t) & (y >= t) & (np.abs(x - y) <= window))
    assert abs(near_vectors.collision_chance(t, window, 0.93) - p) < 6 * math.sqrt(p / len(x))
    for n in (50_000, 10**8):
        directions, t, window = near_vectors.calibrated(n)
        p = 2 * near_vectors.collision_chance(t, window, 0.93)
        miss = [(1 - p) ** m + m * p * (1 - p) ** (m - 1) for m in (directions, directions - 1)]
        assert miss[0] <= near_vectors.MISS < miss[1]
