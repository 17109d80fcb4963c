"""The four risk tables, derived from the given order tables.

Every frame is computed from whole tables. ``clean_tables`` is the well-formed
case; ``raw_tables`` holds the same entities as text with every kind of defect
that cleaning and the quality reports deal with.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.config import RiskConfig
from riskspark.operators.cleaning import CleanTables, dedupe

# Customers have about 30 transactions each here, against one each in the source
# the default was made for, so only the frequent ones should count as frequent.
CONFIG = RiskConfig(high_frequency_min=40)


# The columns used, declared: no footer is read to find them out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return df.join(nation.select("n_nationkey", "r_name"), F.col(nation_key) == F.col("n_nationkey"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _reason() -> Column:
    return (
        F.when(F.col("l_partkey") % 3 == 0, "Fraud")
        .when(F.col("l_partkey") % 3 == 1, "Money Laundering")
        .otherwise("Compliance Violation")
    )


# ----------------------------------------------------------------------- well-formed


#: Ids of the customers and banks that have no transactions start here.
IDLE = 1_000_000_000


def _level(balance: Column) -> Column:
    return F.when(balance < 1000, "High").when(balance < 5000, "Medium").otherwise("Low")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers, and the suppliers as customers who have never bought."""
    active = _with_region(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("r_name").alias("region"),
        _level(F.col("c_acctbal")).alias("risk_level"),
    )
    idle = _with_region(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey").select(
        (F.col("s_suppkey") + IDLE).alias("customer_id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("r_name").alias("region"),
        _level(F.col("s_acctbal")).alias("risk_level"),
    )
    return active.unionByName(idle)


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers, and the nations as banks without transactions."""
    hundredths = F.floor((F.col("s_acctbal") + 1000) / 220).cast("int") + 50
    active = _with_region(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey").select(
        F.col("s_suppkey").alias("bank_id"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("region"),
        (hundredths.cast("double") / 100).alias("compliance_score"),
    )
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    idle = nations.select(
        (F.col("n_nationkey").cast("bigint") + IDLE).alias("bank_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
        ((50 + 2 * F.col("n_nationkey")).cast("double") / 100).alias("compliance_score"),
    )
    return active.unionByName(idle)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per (order, line number); the key is not unique in the table."""
    lines = _lines(spark, sf_dir).withColumn("transaction_id", _line_id())
    first = dedupe(
        lines,
        "transaction_id",
        ["l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"],
    )
    return first.select(
        "transaction_id",
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("bank_id"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(Decimal("0.1"))).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
        F.col("l_linestatus").alias("location"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_high_risk"),
        F.lit(1).alias("is_valid_bank_id"),
    )


def _listed(lines: DataFrame) -> DataFrame:
    """The returned, heavily discounted and heavily taxed lines stand in for the
    sanctions list: a sparse list, as a watchlist is."""
    return lines.where(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.col("l_discount") >= 0.095)
        & (F.col("l_tax") >= 0.075)
    )


def sanctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = F.row_number().over(
        Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
            "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate"
        )
    )
    return _listed(_lines(spark, sf_dir)).select(
        (_line_id() * 100 + copy).alias("sanction_id"),
        F.col("l_suppkey").alias("bank_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("sanction_date"),
        _reason().alias("reason"),
        F.lit(1).alias("is_valid_bank_id"),
    )


def clean_tables(spark: SparkSession, sf_dir: str) -> CleanTables:
    return CleanTables(
        customers(spark, sf_dir),
        banks(spark, sf_dir),
        transactions(spark, sf_dir),
        sanctions(spark, sf_dir),
    )


# -------------------------------------------------------------------- with defects


def _qty(n: int) -> Column:
    return F.col("l_quantity") == n


def _us_date(col: str) -> Column:
    return F.date_format(F.col(col).cast("date"), "MM/dd/yyyy")


def _text(col: Column) -> Column:
    return col.cast("string")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies (nation 3), a second name for the same id (nation 7), blanks,
    a missing id and a level outside the list."""
    bal = F.col("c_acctbal")
    rows = _with_region(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey").select(
        F.when(bal.between(9000, 9100), F.lit(None)).otherwise(_text(F.col("c_custkey"))).alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise("x@example.com").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.when(bal.between(8000, 8050), F.lit(None)).otherwise(F.col("r_name")).alias("region"),
        F.when(bal.between(7000, 7100), "Severe")
        .when(bal < 1000, "High")
        .when(bal < 5000, "Medium")
        .otherwise("Low")
        .alias("risk_level"),
        "c_nationkey",
    )
    renamed = rows.where("c_nationkey = 7").withColumn("name", F.concat(F.lit("Z"), F.trim("name")))
    return rows.unionByName(rows.where("c_nationkey = 3")).unionByName(renamed).drop("c_nationkey")


def raw_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score that is no number, a score above one, and exact copies (nation 5)."""
    bal = F.col("s_acctbal")
    hundredths = F.floor((bal + 1000) / 220).cast("int") + 50
    rows = _with_region(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey").select(
        _text(F.col("s_suppkey")).alias("bank_id"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("region"),
        F.when(bal.between(4000, 4200), "n/a")
        .when(bal.between(6000, 6200), "1.7")
        .otherwise(F.concat(F.lit(" "), _text(hundredths.cast("double") / 100)))
        .alias("compliance_score"),
        "s_nationkey",
    )
    return rows.unionByName(rows.where("s_nationkey = 5")).drop("s_nationkey")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects and other tools' ways of writing numbers, flags and dates, by quantity, tax
    and discount; duplicate ids occur by themselves. What quantity 5 says is sent again
    under another id."""
    rows = _lines(spark, sf_dir).select(
        F.when(_qty(3), F.lit(None))
        .when(_qty(2), F.concat(_text(_line_id()), F.lit(".0")))
        .otherwise(_text(_line_id()))
        .alias("transaction_id"),
        F.when(_qty(7), _text(F.col("o_custkey") + 1_000_000_000_000))
        .when(_qty(11), F.concat(_text(F.col("o_custkey")), F.lit(".00")))
        .when(_qty(17), F.concat(_text(F.col("o_custkey")), F.lit(".5")))
        .otherwise(_text(F.col("o_custkey")))
        .alias("customer_id"),
        F.when(_qty(13), F.lit(None)).otherwise(_text(F.col("l_suppkey"))).alias("bank_id"),
        F.when(_qty(19), "n/a")
        .when(_qty(23), "-5.00")
        .otherwise(_text(F.col("l_extendedprice").cast("decimal(18,2)")))
        .alias("amount"),
        F.when(F.col("l_tax") == 0.01, F.lit(None))
        .when(F.col("l_tax") == 0.02, "  ")
        .otherwise(" USD ")
        .alias("currency"),
        F.when(_qty(29), "13/45/2024")
        .when(F.col("l_discount") == 0.03, _us_date("l_shipdate"))
        .when(F.col("l_discount") == 0.04, F.date_format(F.col("l_shipdate").cast("date"), "M/d/yyyy"))
        .when(F.col("l_discount") == 0.05, F.concat(_text(F.col("l_shipdate").cast("date")), F.lit(" 10:30:00")))
        .when(F.col("l_discount") == 0.06, F.concat(_text(F.col("l_shipdate").cast("date")), F.lit("T00:00:00")))
        .otherwise(_text(F.col("l_shipdate").cast("date")))
        .alias("date"),
        F.col("l_linestatus").alias("location"),
        F.when(_qty(31), F.lit(None))
        .when(_qty(37), "maybe")
        .when(_qty(41), "1.0")
        .when(_qty(43), "0.0")
        .when(F.col("l_returnflag") == "R", "True")
        .otherwise("no")
        .alias("is_high_risk"),
        F.lit("1").alias("is_valid_bank_id"),
        "l_quantity",
    )
    again = rows.where(_qty(5)).withColumn("transaction_id", F.concat(F.lit("9"), F.lpad("transaction_id", 15, "0")))
    return rows.unionByName(again).drop("l_quantity")


def raw_sanctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).where(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.095)
    )
    return lines.select(
        _text(_line_id()).alias("sanction_id"),
        F.when(_qty(13), "999999999999").otherwise(_text(F.col("l_suppkey"))).alias("bank_id"),
        F.when(_qty(7), F.lit(None)).otherwise(_text(F.col("o_custkey"))).alias("customer_id"),
        F.when(_qty(29), "someday")
        .when(F.col("l_tax") == 0.03, _us_date("l_shipdate"))
        .otherwise(_text(F.col("l_shipdate").cast("date")))
        .alias("sanction_date"),
        F.when(_qty(31), F.lit(None)).otherwise(_reason()).alias("reason"),
        F.when(_qty(37), F.lit(None)).otherwise(F.lit("yes")).alias("is_valid_bank_id"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "banks": raw_banks(spark, sf_dir),
        "transactions": raw_transactions(spark, sf_dir),
        "sanctions": raw_sanctions(spark, sf_dir),
    }


def dispositions(spark: SparkSession, sf_dir: str, txns: DataFrame) -> DataFrame:
    """Analysts' decisions, by the priority of the order; low priority is undecided.

    Sheets as they come back: those of urgent orders were cleared before they were
    confirmed, those of medium ones by even customers are dated later and confirmed, and
    low priority comes with blanks.
    """
    decided = F.create_map(
        *[
            F.lit(v)
            for v in (
                "1-URGENT", "Confirmed Fraud",
                "2-HIGH", "Escalated",
                "3-MEDIUM", "Cleared",
                "4-NOT SPECIFIED", "Cleared",
            )
        ]
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.coalesce(decided[F.col("o_orderpriority")], F.lit(" ")).alias("disposition")
    )
    order_key = F.floor(F.col("transaction_id") / 10).cast("bigint")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    medium = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_custkey") % 2 == 0)

    def entry(date: str, made: Column) -> Column:
        return F.struct(F.lit(date).alias("review_date"), made.alias("disposition"))

    # All entries of a transaction from one row, so that transactions and orders are joined once.
    entries = F.array(
        entry("2024-03-05", F.col("disposition")),
        F.when(urgent, entry("2024-01-31", F.lit("Cleared"))),
        F.when(medium, entry("2024-03-06", F.lit("Confirmed Fraud"))),
        F.when(urgent, entry("2024-09-09", F.lit(""))),
    )
    return (
        txns.select("transaction_id", order_key.alias("o_orderkey"))
        .join(orders, "o_orderkey")
        .select("transaction_id", F.explode(F.array_compact(entries)).alias("e"))
        .select("transaction_id", "e.review_date", "e.disposition")
    )


def payment_events(events: DataFrame) -> DataFrame:
    """Events as a timed transaction feed; works on a stream and on a table alike.

    The time column has no zone. Reading it as UTC keeps the day boundaries the same
    in every session time zone.
    """
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("Z"))).alias("event_time"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_high_risk"),
    )
