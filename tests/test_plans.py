"""What the plans must look like to hold at scale, and that skew does no harm."""

import re

import pytest
from pyspark.sql import functions as F

from bindings import queries, tpch
from riskspark.operators import banks, cleaning, features, rules
from riskspark.plans.workspace import materialise
from tests.conftest import SF
from tests import helpers
from tests.helpers import rows

FACT_QUERIES = [
    "null_report", "duplicate_keys", "duplicate_rows", "clean_transactions", "quarantine", "customer_features",
    "bank_features", "region_features", "flagged_transactions", "fraud_kpis", "bank_risk_comparison_ranked",
    "amount_histogram", "top_flagged",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_no_python_no_cross_join_no_global_window_over_rows(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    # one-task exchanges carry aggregates only: each is fed by a partial aggregate,
    # or by the distinct bank scores
    for match in re.finditer(r"Exchange SinglePartition[^\n]*\n([^\n]*)", plan):
        assert re.search(r"Aggregate\(keys=\[\]|Aggregate\(keys=\[bank_risk_score|TakeOrdered", match.group(1)), match.group(0)


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(features.customer_signals(tpch.customers(spark, SF), tpch.transactions(spark, SF), tpch.sanctions(spark, SF)))
    assert "l_extendedprice" in plan  # decides which copy of an id is kept
    assert "l_quantity" not in plan and "c_name" not in plan
    assert "PushedFilters: [IsNotNull(l_returnflag)" in plan or "EqualTo(l_returnflag,R)" in plan


def test_dedupe_limits_before_the_shuffle(spark):
    plan = plan_of(tpch.transactions(spark, SF))
    before, after = plan.split("Exchange hashpartitioning(transaction_id", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_aggregation_comes_before_the_join(spark):
    plan = plan_of(features.region_features(tpch.customers(spark, SF), tpch.transactions(spark, SF)))
    join = re.search(r"\w*Join \[customer_id", plan).start()
    per_customer = re.search(r"Aggregate\(keys=\[customer_id#\d+L\], functions=\[partial_count", plan).start()
    assert per_customer > join  # further down the tree


def test_small_dimension_is_broadcast_only_below_the_threshold(spark):
    t = queries._shared(spark, SF)
    assert "BroadcastHashJoin [customer_id" in plan_of(queries._flags(t))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(queries._flags(t))
        assert "Broadcast" not in plan and "SortMergeJoin [customer_id" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tiny_skew_threshold(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def _skewed(spark, n=40_000):
    """A third of the rows belong to one customer; another part lacks the customer."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 16).select(
        F.col("id").alias("transaction_id"),
        hot.cast("bigint").alias("customer_id"),
        (F.col("id") % 20).alias("bank_id"),
        ((F.col("id") * 7919) % 1_000_000).cast("decimal(18,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.expr("date'2024-01-01'").alias("txn_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("location"),
        (F.col("id") % 2).cast("int").alias("is_high_risk"),
        F.lit(1).alias("is_valid_bank_id"),
    )


def test_hot_customer_is_split_in_the_fact_join(spark, tiny_skew_threshold):
    t = _skewed(spark)
    c = spark.range(500).select(F.col("id").alias("customer_id"), F.lit("High").alias("risk_level"))
    b = spark.range(20).select(F.col("id").alias("bank_id"), F.lit(0.5).alias("compliance_score"))
    none = spark.createDataFrame([], "sanction_id bigint, bank_id bigint, customer_id bigint")
    # a join is split only when both its sides come straight from a shuffle, which is
    # one more reason to read the features from a stored mart
    customer_side = materialise(features.customer_signals(c, t, none), "customer_signals")
    bank_side = materialise(features.bank_signals(b, none), "bank_signals")
    scored = rules.score_transactions(features.transaction_flags(t, customer_side, bank_side))
    result = scored.select("transaction_id", "fraud_score", "location")
    got = result.collect()
    assert "skew=true" in plan_of(result)
    assert len(got) == 40_000 and len({r.transaction_id for r in got}) == 40_000


def test_rows_without_a_key_are_spread_over_the_tasks(spark, tiny_skew_threshold):
    t = _skewed(spark).withColumnRenamed("txn_date", "date")
    t = t.withColumn("customer_id", F.when(F.col("transaction_id") % 3 != 1, F.col("customer_id")))
    c = spark.range(400).select(F.col("id").alias("customer_id"))
    b = spark.range(20).select(F.col("id").alias("bank_id"))
    checked = cleaning.check_child(t, "transactions", c, b)
    assert checked.collect() and "skew=true" in plan_of(checked)  # the hot customer
    spread = checked.where("customer_id is null").select(F.pmod(F.xxhash64(*t.columns), F.lit(16)).alias("task"))
    assert spread.groupBy("task").count().agg(F.max("count")).first()[0] < 20_000 / 8
    reasons = {r[0]: r[1] for r in checked.groupBy("reject_reason").count().collect()}
    lacking = t.where("customer_id is null").count()
    unknown = t.where("customer_id >= 400").count()
    assert reasons == {None: 40_000 - lacking - unknown, "missing_customer_id": lacking, "unknown_customer_id": unknown}


def test_hot_transaction_id_is_one_row_per_task(spark):
    t = _skewed(spark).withColumn("transaction_id", F.when(F.col("transaction_id") % 3 == 0, 1).otherwise(F.col("transaction_id")))
    kept = cleaning.one_per_key(t, "transactions")
    assert kept.count() == t.select("transaction_id").distinct().count()
    first = t.where("transaction_id = 1").orderBy(*[c for c in t.columns if c != "transaction_id"]).first()
    assert kept.where("transaction_id = 1").first() == first


def test_rank_table_stays_small(spark):
    df = spark.range(100_000).select(
        F.col("id").alias("bank_id"), F.round(F.pmod(F.xxhash64("id"), F.lit(1001)) / 10, 1).alias("bank_risk_score")
    )
    assert df.select("bank_risk_score").distinct().count() == 1001
    assert rows(banks.rank_banks(df).agg(F.count("*"), F.min("risk_rank")))[0] == (100_000, 1)


def test_the_quarantine_moves_the_fact_once_after_the_look_ups(spark):
    """Keys and hashes of all rows are aggregated; whole rows move only for keys that have several."""


    rows = helpers.txns(spark, (1, 1, 1, 5), (1, 1, 1, 5), (2, 1, 1, 5), (2, 1, 1, 6), (2, 2, 1, 6), (2, 1, 1, 6), (3, 1, 1, 1))
    lost = cleaning.repeated_rows(rows, "transactions", copies=False)
    assert [(r.key, r.reason) for r in lost.collect()] == [(2, "duplicate_key")] * 2
    assert cleaning.repeated_rows(rows, "transactions").count() == 4
    lines = lost._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    semi = [k for k, x in enumerate(lines) if "LeftSemi" in x]
    assert semi
    for k in semi:
        end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
        grouped = [x for x in lines[k + 1 : end] if "Aggregate" in x or "Window" in x]
        assert grouped and not any("currency" in x.split("]")[0] for x in grouped)  # by the key alone
