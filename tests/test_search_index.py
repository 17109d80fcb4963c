"""Search by index against a plain scan."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators import search_index, views
from tests.helpers import rows

MART = "transaction_id long, customer_name string, bank_name string, severity string, customer_region string, amount double"
NAMES = ["Ann Lee", "ANNA", "Béatrice", "an", "", None, "50% off_", "o'Neil \\ Sons", "Zoë 🎈 Ltd", "aaaa"]
TEXTS = ["", "a", "AN", "ann", "nn l", "béa", "0% o", "_", "%", "' ", "l \\ s", "🎈", "ë 🎈 l", "aaa", "aaaaa", "zzz", "hot name ltd"]


def _order():
    return [F.desc("amount"), F.col("transaction_id")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """A mart of which one name holds a third, and its index over several parts."""
    made = []
    for k in range(300):
        customer = "Hot Name Ltd" if k % 3 == 0 else NAMES[k % 10]
        made.append((k, customer, NAMES[(k * 7) % 9], ["High", "Medium", None][k % 5 % 3], ["Asia", "Europe"][k % 2], float(k % 40)))
    mart = spark.createDataFrame(made, MART)
    path = str(tmp_path_factory.mktemp("search") / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        search_index.write_index(mart, path, _order(), ["customer_name", "bank_name"], ["severity", "customer_region"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return made, path


def _plain(made, text, severity="", region=""):
    def holds(name):
        return name is not None and text.lower() in name.lower()

    return [r for r in made if (not text or holds(r[1]) or holds(r[2])) and severity in ("", r[3]) and region in ("", r[4])]


@pytest.mark.parametrize("text", TEXTS)
def test_search_equals_a_scan(spark, index, text):
    made, path = index
    got = search_index.search(spark, path, text)
    assert got.columns == [f.split(" ")[0] for f in MART.split(", ")]
    assert rows(got, "transaction_id") == [(r[0],) for r in _plain(made, text)]
    assert spark.read.parquet(f"{path}/parts").count() > 1


def test_filters(spark, index):
    made, path = index
    for severity, region in (("High", ""), ("", "Asia"), ("Medium", "Europe"), ("None", "")):
        equals = {"severity": severity, "customer_region": region}
        for text in ("", "a", "ann"):
            want = [(r[0],) for r in _plain(made, text, severity, region)]
            assert rows(search_index.search(spark, path, text, equals), "transaction_id") == want
    # the operator that scans says the same
    mart = spark.createDataFrame(made, MART)
    assert rows(views.search_flagged(mart, "ANN", "High"), "transaction_id") == [(r[0],) for r in _plain(made, "ann", "High")]


def test_pages_follow_each_other(spark, index):
    made, path = index
    numbered = [(k + 1, r) for k, r in enumerate(sorted(made, key=lambda r: (-r[5], r[0])))]
    for text in ("ann", "", "zzz"):
        want = [(n, r[0]) for n, r in numbered if r in _plain(made, text)]
        got, after = [], 0
        while page := rows(search_index.search_page(spark, path, 45, after, text), "position", "transaction_id"):
            assert len(page) == min(45, len(want) - len(got))
            got, after = got + page, page[-1][0]
        assert got == want


def test_names_of_a_gram(spark, index):
    _, path = index
    assert rows(search_index.names_with(spark, path, "ANN")) == [("ann lee",), ("anna",)]
    assert rows(search_index.names_with(spark, path, "an")) == [("an",), ("ann lee",), ("anna",)]


def test_an_empty_mart(spark, tmp_path):
    path = str(tmp_path / "index")
    search_index.write_index(spark.createDataFrame([], MART), path, _order(), ["customer_name"], [])
    for text in ("", "a", "ann"):
        assert search_index.search(spark, path, text).isEmpty()
        assert search_index.search_page(spark, path, 10, 0, text).isEmpty()


def test_scans_are_filtered(spark, index):
    _, path = index

    def plan(df):
        return df._jdf.queryExecution().toString()

    assert "EqualTo(gram," in plan(search_index.names_with(spark, path, "ann lee"))
    whole = plan(search_index.search(spark, path, "ann lee"))
    assert "In(part," in whole or "EqualTo(part," in whole
    page = plan(search_index.search_page(spark, path, 5, 0, "ann"))
    assert "In(place," in page and "Exchange" not in page
