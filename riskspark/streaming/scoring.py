"""Scoring of newly arriving transactions, and alerts from what was scored.

A transaction counts as scored once per table, however long ago it came. What a run has
met, ids and the hashes of whole rows, is keyed state of the stream (``first_met``), so a
micro-batch reads its own rows and none of the history. What other runs into the same table
have met is read from their id tables (``<path>.ids``).

Every micro-batch is stored, joined as an ordinary batch (so that adaptive execution splits a
customer or bank that owns much of it), and written to a folder of its own. Nothing is
dropped: a transaction without an id, or with a customer or bank newer than the feature
snapshot, goes to ``<path>.set_aside`` with the reason. A row with the id of another, but
different in any column, goes there as ``duplicate_key``; only exact copies of a
transaction leave no row. Those that wait for a customer or bank are scored by ``retry``, once,
when a run starts with a snapshot that knows them; they need not be sent again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskspark.config import DEFAULT, RiskConfig
from riskspark.functions.scalars import count_where
from riskspark.operators.features import transaction_flags
from riskspark.operators.kpis import STANDING, alerts, run_time
from riskspark.operators.rules import score_transactions
from riskspark.plans.workspace import delete, make_folder, move

#: Where a batch lies below a table's path: the run that a checkpoint belongs to, and its batch.
PARTITION = "feed string, batch_id long"
#: Reasons for which a transaction waits for the next snapshot.
WAITING = ("unknown_customer_id", "unknown_bank_id")
#: Feeds of retried transactions begin with this.
RETRY = "retry-"

Then = Callable[[DataFrame, str, int], None]


def feed_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream run that owns a checkpoint; it outlives restarts from it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def earlier(table: DataFrame, feed: str, batch_id: int) -> DataFrame:
    """The rows of a batch table but for those of this batch and of later ones of its feed."""
    return table.where(~((F.col("feed") == feed) & (F.col("batch_id") >= batch_id)))


def stored_batch(batch: DataFrame, path: str) -> DataFrame:
    """The batch as an ordinary table.

    A frame handed over by a stream is planned without adaptive execution, whatever is
    done with it. Read back it is a table of known size.
    """
    batch.write.mode("overwrite").parquet(path)
    return SparkSession.active().read.schema(batch.schema).parquet(path)


def first_met(transactions: DataFrame) -> DataFrame:
    """The first row of every id and of every different row of an id, as ``_kind`` 0 and 1; 2 for rows without id.

    Native streaming state keyed by the id and by a hash of all columns: an exact copy of
    a row met before, however long ago, leaves nothing; a row of kind 1 without one of
    kind 0 has an id that came before with another content. On a stream only the keys are
    kept, in the run's checkpoint.
    """
    columns = transactions.columns
    told = transactions.where("transaction_id is not null").withColumn("_content", F.xxhash64(*columns))
    kinds = told.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1))))
    whole = F.col("_kind") == 1
    rest = [F.when(whole, F.col(c)).alias(c) for c in columns if c != "transaction_id"]
    kinds = kinds.select("_kind", F.when(whole, F.col("_content")).otherwise(0).alias("_content"), "transaction_id", *rest)
    once = kinds.dropDuplicates(["_kind", "transaction_id", "_content"])
    without = transactions.where("transaction_id is null").withColumns({"_kind": F.lit(2), "_content": F.lit(0).cast("long")})
    return once.select("_kind", "_content", *columns).unionByName(without.select("_kind", "_content", *columns))


def score_stream(
    new_txns: DataFrame,
    customer_features: DataFrame,
    bank_features: DataFrame,
    path: str,
    checkpoint: str,
    cfg: RiskConfig = DEFAULT,
    then: Then | None = None,
) -> StreamingQuery:
    """Score what has arrived against the last feature snapshot, until it is used up.

    Scored rows go to ``path``, the others, with a reason, to ``path`` + ".set_aside", and the
    ids met, with the hash of their rows, to ``path`` + ".ids", each below
    feed=<run>/batch_id=<n>; a repeated batch replaces its own folders. Business dates play no
    part in what counts as met. Before the stream starts, what waits is tried again
    (``retry``). ``then`` is called with the stored scores of each batch, the run and the
    batch's number.

    Frequency and sanctions come from the snapshot, so scoring the same rows in a batch
    against the same snapshot gives the same result. Pass stored marts as features: Spark
    then knows their size.
    """
    spark = new_txns.sparkSession
    for folder in (path, f"{path}.set_aside", f"{path}.ids"):
        make_folder(spark, folder)
    columns = new_txns.columns
    ids = T.StructType([new_txns.schema["transaction_id"]]).add("content", "long").add("feed", "string").add("batch_id", "long")
    retry(new_txns.schema, customer_features, bank_features, path, cfg, then)

    def write(batch: DataFrame, batch_id: int) -> None:
        feed = feed_id(spark, checkpoint)
        own, work = f"feed={feed}/batch_id={batch_id}", f"{path}.work/feed={feed}/batch_id={batch_id}"
        arrived = stored_batch(batch, f"{work}/arrived")
        rows = arrived.where("_kind = 1").drop("_kind")
        new_ids = arrived.where("_kind = 0").select("transaction_id")
        # Other runs into the table: their ids, two columns; an empty listing where there are none.
        elsewhere = spark.read.schema(ids).parquet(f"{path}.ids").where(F.col("feed") != feed).select("transaction_id", F.col("content").alias("_other"))
        known = stored_batch(elsewhere.join(new_ids, "transaction_id", "left_semi"), f"{work}/known")
        told = stored_batch(_told(rows, new_ids, known), f"{work}/told")
        fresh = told.where("_fresh").drop("_fresh")
        flags, scored = _judged(fresh.select(*columns), customer_features, bank_features, f"{work}/flags", cfg)
        scored.write.mode("overwrite").parquet(f"{path}/{own}")
        without_id = arrived.where("_kind = 2").select(*columns, F.lit("missing_transaction_id").alias("reason"))
        # Anything else differs from the row that counts for its id: here, or in another run.
        rest, counted = told.where("not _fresh"), known.withColumnRenamed("_other", "_content")
        other = rest.join(counted, ["transaction_id", "_content"], "left_anti").select(*columns, F.lit("duplicate_key").alias("reason"))
        aside = _waiting_rows(fresh.select(*columns), flags).unionByName(without_id).unionByName(other)
        aside.write.mode("overwrite").parquet(f"{path}.set_aside/{own}")
        fresh.select("transaction_id", F.col("_content").alias("content")).write.mode("overwrite").parquet(f"{path}.ids/{own}")
        if then:
            then(spark.read.schema(scored.schema).parquet(f"{path}/{own}"), feed, batch_id)
        delete(spark, work)

    return per_batch(first_met(new_txns), write, checkpoint)


def _told(rows: DataFrame, new_ids: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with ``_fresh``: the first, by all other columns, of an id that is new here and not known elsewhere.

    The ids decide, so one shuffle of the rows by id tells the fresh ones from the rest.
    """
    key = "transaction_id"
    new = new_ids.join(known, key, "left_anti").select(key, F.lit(True).alias("_new"))
    first = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns if c != key])
    fresh = F.col("_new").isNotNull() & (F.row_number().over(first) == 1)
    return rows.join(new, key, "left").withColumn("_fresh", fresh).drop("_new")


def _judged(
    fresh: DataFrame, customer_features: DataFrame, bank_features: DataFrame, work: str, cfg: RiskConfig
) -> tuple[DataFrame, DataFrame]:
    """(stored flags with the reason to wait, scores of those without one)."""
    flags = transaction_flags(fresh, customer_features, bank_features, cfg, how="left")
    reason = F.when(F.col("flag_high_frequency_customer").isNull(), WAITING[0]).when(F.col("flag_low_compliance_bank").isNull(), WAITING[1])
    flags = stored_batch(flags.withColumn("_reason", reason), work)
    return flags, score_transactions(flags.where("_reason is null").drop("_reason"), cfg)


def _waiting_rows(fresh: DataFrame, flags: DataFrame) -> DataFrame:
    """The whole rows of transactions that wait, with the reason."""
    waits = flags.where("_reason is not null").select("transaction_id", F.col("_reason").alias("reason"))
    return fresh.join(waits, "transaction_id").select(*fresh.columns, "reason")


def waiting(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The transactions below ``path`` that wait for a customer or bank and have not been retried with success."""
    aside = T.StructType([*schema.fields]).add("reason", "string").add("feed", "string").add("batch_id", "long")
    scored = T.StructType([schema["transaction_id"]]).add("feed", "string").add("batch_id", "long")
    done = spark.read.schema(scored).parquet(path).where(F.col("feed").startswith(RETRY))  # partitions of retries only
    waits = spark.read.schema(aside).parquet(f"{path}.set_aside").where(F.col("reason").isin(*WAITING))
    return waits.join(done.select("transaction_id"), "transaction_id", "left_anti").select(*schema.names)


def retry(
    schema: T.StructType,
    customer_features: DataFrame,
    bank_features: DataFrame,
    path: str,
    cfg: RiskConfig = DEFAULT,
    then: Then | None = None,
) -> int:
    """Score those waiting whose customer and bank the snapshot knows by now; returns how many.

    Their scores go to ``path`` as a feed of their own, all at once, and that folder says that they
    are scored: a try that fails before it is written is made again by the next, and none is
    scored twice. Those whose customer or bank is still unknown keep waiting.
    """
    spark = customer_features.sparkSession
    work = f"{path}.work/{RETRY}{uuid.uuid4().hex}"
    waits = stored_batch(waiting(spark, schema, path), f"{work}/waiting")
    found = 0
    if not waits.isEmpty():
        _, scored = _judged(waits, customer_features, bank_features, f"{work}/flags", cfg)
        found = scored.count()
        if found:
            feed = f"{RETRY}{uuid.uuid4().hex}"
            # one commit: written aside, then moved to where readers look
            scored.write.parquet(f"{work}/scored")
            move(spark, f"{work}/scored", f"{path}/feed={feed}/batch_id=0")
            if then:
                then(spark.read.schema(scored.schema).parquet(f"{path}/feed={feed}/batch_id=0"), feed, 0)
    delete(spark, work)
    return found


def alert_raiser(
    compliance_profiles: DataFrame,
    path: str,
    cfg: RiskConfig = DEFAULT,
    run_ts: datetime | None = None,
) -> Then:
    """What raises the alerts of each scored batch; pass it to ``score_stream`` as ``then``.

    Critical flags are told per batch. The standing alert on banks below the threshold is
    raised when its text differs from the last one raised.
    """
    spark = compliance_profiles.sparkSession
    make_folder(spark, path)
    schema = f"alert_type string, message string, severity string, generated_at_utc timestamp, {PARTITION}"

    def raise_alerts(scored: DataFrame, feed: str, batch_id: int) -> None:
        state = (
            scored.agg(
                count_where(F.col("severity") == "Critical").alias("critical_flags"),
                F.count(F.lit(1)).alias("arrived"),
            )
            .where("arrived > 0")
            .select("critical_flags", run_time(run_ts).alias("generated_at_utc"))
        )
        log = earlier(spark.read.schema(schema).parquet(path), feed, batch_id)
        last = log.where(F.col("alert_type") == STANDING).agg(
            F.max_by("message", F.struct("generated_at_utc", "batch_id")).alias("told")
        )
        raised = alerts(state, compliance_profiles, cfg)
        same = (F.col("alert_type") == STANDING) & (F.col("message") == F.col("told"))
        new = raised.join(last, same, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/feed={feed}/batch_id={batch_id}")

    return raise_alerts


def per_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    with keyed_state(stream.sparkSession):
        return _started(stream, write, checkpoint)


def _started(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Settings of the streams' state where the session has none: keys on local disk, of which each batch
#: stores the changes; no count of all keys, which would look every key up twice.
_STATE = "spark.sql.streaming.stateStore"
STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """``STATE`` for queries started inside, unless the session names a store."""
    key = f"{_STATE}.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if spark.conf.get(key, default) != default:
        yield
        return
    before = {k: spark.conf.get(k, None) for k in STATE}
    own = {k: v for k, v in STATE.items() if k == key or before[k] is None}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)
