"""Regional risk monitoring over a transaction stream, with every event accounted for.

Each micro-batch adds a table of partial counts. From time to time the partial counts of
finished batches are folded into one table (``fold``), published as a version of its own,
so that a micro-batch and a reader meet few tables however long the stream has run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.functions.scalars import count_where, safe_pct
from riskspark.plans.workspace import delete, folders, make_folder
from riskspark.sources.versions import new_version, publish, published
from riskspark.streaming.scoring import PARTITION, earlier, feed_id, per_batch, stored_batch

COUNTS = ("txn_count", "high_risk_txn_count", "total_amount")
PARTIAL = (
    "bucket_start timestamp, bucket_end timestamp, region string, txn_count long, high_risk_txn_count long,"
    f" total_amount decimal(38,2), newest timestamp, status string, {PARTITION}"
)
FOLDED = PARTIAL.removesuffix(f", {PARTITION}")
COVER = "feed string, upto long, newest timestamp"
KEYS = ("bucket_start", "bucket_end", "region", "status")
#: Micro-batches after which partial counts are folded.
FOLD_EVERY = 20


def region_monitor_stream(
    txns: DataFrame,
    customers: DataFrame,
    path: str,
    checkpoint: str,
    bucket: str = "1 day",
    lateness: str = "1 hour",
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Count transactions per customer region and time bucket, a partial table per micro-batch.

    ``txns`` needs customer_id, event_time, amount and is_high_risk. A bucket is over once
    the newest event of earlier batches is ``lateness`` past its end; what comes for it
    afterwards is stored as ``late``, events of customers not on file as ``unmatched`` and
    events without a time as ``undated``. Counting per customer comes before the lookup of
    the region, so a customer with very many transactions is one row per task. After every
    ``fold_every`` micro-batches (0: never) the partial tables are folded.
    """
    spark = txns.sparkSession
    make_folder(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        feed = feed_id(spark, checkpoint)
        own, work = f"feed={feed}/batch_id={batch_id}", f"{path}.work/feed={feed}/batch_id={batch_id}"
        arrived = stored_batch(batch, f"{work}/arrived")
        times = F.window("event_time", bucket)
        dated = arrived.where("event_time is not null").withColumn("w", times)
        spans = dated.select("*", F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end")).drop("w")
        none = F.lit(None).cast("timestamp")
        undated = arrived.where("event_time is null").select("*", none.alias("bucket_start"), none.alias("bucket_end"))
        per_customer = (
            spans.unionByName(undated)
            .groupBy("bucket_start", "bucket_end", "customer_id")
            .agg(
                F.count(F.lit(1)).alias("txn_count"),
                count_where(F.col("is_high_risk") == 1).alias("high_risk_txn_count"),
                F.sum("amount").cast("decimal(38,2)").alias("total_amount"),
                F.max("event_time").alias("newest"),
            )
        )
        mark = _newest(spark, path, feed, batch_id)
        late = F.col("bucket_end") + F.expr(f"interval {lateness}") <= F.lit(mark)
        status = (
            F.when(F.col("bucket_start").isNull(), "undated")
            .when(F.col("region").isNull(), "unmatched")
            .when(late, "late")
            .otherwise("counted")
        )
        partial = (
            per_customer.join(customers.select("customer_id", "region"), "customer_id", "left")
            .groupBy("bucket_start", "bucket_end", "region")
            .agg(*[F.sum(c).cast("decimal(38,2)" if c == "total_amount" else "long").alias(c) for c in COUNTS], F.max("newest").alias("newest"))
            .withColumn("status", status)
        )
        partial.write.mode("overwrite").parquet(f"{path}/{own}")
        delete(spark, work)
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold(spark, path)

    return per_batch(txns, write, checkpoint)


def _covered(spark: SparkSession, version: str) -> list[Row]:
    """feed, upto and newest event of the batches folded into a version, a row per feed."""
    return spark.read.parquet(f"{version}/cover").collect()


def _tail(spark: SparkSession, path: str, covered: list[Row]) -> DataFrame:
    """The partial counts of batches that are not folded."""
    tail = spark.read.schema(PARTIAL).parquet(path)
    for c in covered:
        tail = tail.where(~((F.col("feed") == c["feed"]) & (F.col("batch_id") <= c["upto"])))
    return tail


def _newest(spark: SparkSession, path: str, feed: str, batch_id: int) -> datetime | None:
    """The newest event before a batch, from what is known of folded batches and the tables of the others."""
    version = published(spark, f"{path}.folds")[-1:]
    covered = _covered(spark, version[0]) if version else []
    tail = earlier(_tail(spark, path, covered), feed, batch_id).agg(F.max("newest")).first()[0]
    return max([t for t in (tail, *(c["newest"] for c in covered)) if t is not None], default=None)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All partial counts, folded or not."""
    version = published(spark, f"{path}.folds")[-1:]
    if not version:
        return spark.read.schema(PARTIAL).parquet(path)
    tail = _tail(spark, path, _covered(spark, version[0]))
    return spark.read.schema(FOLDED).parquet(f"{version[0]}/counts").unionByName(tail.select(*KEYS, *COUNTS, "newest"))


def fold(spark: SparkSession, path: str) -> None:
    """Fold the partial counts of all batches but the last of each feed, which may be repeated.

    Readers meet the version before or the new one, with the batches it does not cover.
    Partial tables go once the version before last covers them too. One run at a time folds.
    """
    root, met = f"{path}.folds", {}
    for f in folders(spark, path):
        ids = [int(b.rsplit("=", 1)[1]) for b in folders(spark, f)]
        if ids:
            met[f.rsplit("=", 1)[1]] = sorted(ids)
    version = published(spark, root)[-1:]
    covered = _covered(spark, version[0]) if version else []
    done = F.lit(False)
    for feed, ids in met.items():
        done = done | ((F.col("feed") == feed) & (F.col("batch_id") < ids[-1]))
    tail = _tail(spark, path, covered).where(done)
    fresh = {r["feed"]: r["newest"] for r in tail.groupBy("feed").agg(F.max("newest").alias("newest")).collect()}
    known = {c["feed"]: c["newest"] for c in covered}
    cover = [(f, ids[-1] - 1, max([t for t in (fresh.get(f), known.get(f)) if t is not None], default=None)) for f, ids in met.items()]
    cover += [(c["feed"], c["upto"], c["newest"]) for c in covered if c["feed"] not in met]
    rows = tail.select(*KEYS, *COUNTS, "newest")
    if version:
        rows = rows.unionByName(spark.read.schema(FOLDED).parquet(f"{version[0]}/counts"))
    sums = [F.sum(c).cast("decimal(38,2)" if c == "total_amount" else "long").alias(c) for c in COUNTS]
    new = new_version(root)
    rows.groupBy(*KEYS).agg(*sums, F.max("newest").alias("newest")).write.parquet(f"{new}/counts")
    spark.createDataFrame(cover, COVER).coalesce(1).write.parquet(f"{new}/cover")
    publish(spark, root, new)
    if version:  # a reader may still be at the version before
        for c in covered:
            for b in met.get(c["feed"], []):
                if b <= c["upto"]:
                    delete(spark, f"{path}/feed={c['feed']}/batch_id={b}")


def _partials(spark: SparkSession, path: str, lateness: str) -> DataFrame:
    """The partial table, with buckets that are not over yet marked ``open``."""
    stored = _stored(spark, path)
    mark = stored.agg(F.max("newest")).first()[0]
    over = F.col("bucket_end") + F.expr(f"interval {lateness}") <= F.lit(mark)
    return stored.withColumn("status", F.when((F.col("status") == "counted") & ~over, "open").otherwise(F.col("status")))


def region_counts(spark: SparkSession, path: str, lateness: str = "1 hour") -> DataFrame:
    """The counts of every bucket that is over, per region."""
    return (
        _partials(spark, path, lateness)
        .where("status = 'counted'")
        .groupBy("bucket_start", "bucket_end", "region")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
        .select(
            "bucket_start",
            "bucket_end",
            "region",
            "txn_count",
            "high_risk_txn_count",
            safe_pct(F.col("high_risk_txn_count"), F.col("txn_count")).alias("high_risk_txn_pct"),
            "total_amount",
        )
    )


def monitor_accounts(spark: SparkSession, path: str, lateness: str = "1 hour") -> DataFrame:
    """How many events were counted, are in open buckets, came late, lack a customer on file or a time."""
    return _partials(spark, path, lateness).groupBy("status").agg(F.sum("txn_count").alias("txn_count"))
