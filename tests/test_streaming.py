import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from riskspark.operators import compliance, features, rules
from riskspark.streaming import monitoring, scoring
from tests.helpers import DAY, banks, customers, rows, sanctions, txns

TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def _tables(spark):
    c = customers(spark, (1, "High"), (2, "Low", "East"))
    b = banks(spark, (1, 0.5), (2, 0.9))
    t = txns(spark, *[(i, 1 + i % 2, 1 + i % 2, 9500 if i % 3 == 0 else 5, i % 2) for i in range(20)])
    s = sanctions(spark, (1, 1, 1))
    return c, b, t, s


def _files(spark, folder, parts):
    for part in parts:  # one file per part, in order
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _sides(c, b, t, s):
    return features.customer_signals(c, t, s), features.bank_signals(b, s)


def _scored(spark, path):
    return spark.read.parquet(str(path)).drop("feed", "batch_id")


def test_stream_scores_as_the_batch_does_and_each_id_once(spark, tmp_path):
    c, b, t, s = _tables(spark)
    sides = _sides(c, b, t, s)
    again = t.where("transaction_id < 10")  # sent a second time
    feed = _files(spark, tmp_path / "in", [t.where("transaction_id < 10"), again, t.where("transaction_id >= 10")])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    scoring.score_stream(feed, *sides, out, state).awaitTermination()
    batch = rules.score_transactions(features.transaction_flags(t, *sides))
    assert rows(_scored(spark, out)) == rows(batch)

    # new files are picked up where the stream stopped
    more = txns(spark, (100, 1, 1, 9999, 1))
    more.write.mode("append").parquet(str(tmp_path / "in"))
    scoring.score_stream(feed, *sides, out, state).awaitTermination()
    assert _scored(spark, out).count() == 21

    # another run over the same feed has its own folders and scores nothing twice
    scoring.score_stream(feed, *sides, out, str(tmp_path / "state2")).awaitTermination()
    assert _scored(spark, out).count() == 21


def test_nothing_that_arrives_is_lost(spark, tmp_path):
    """Dates in no order and a year apart, ids sent again, unknown customers and banks, no ids."""
    c, b, t, s = _tables(spark)
    sides = _sides(c, b, t, s)
    old = txns(spark, (200, 1, 1, 5, 0, DAY - timedelta(days=400)), (201, 2, 2, 5, 0, date(1999, 1, 1)))
    unknown = txns(spark, (300, 77, 1, 9500), (301, 1, 88, 5), (302, 77, 88, 5), (None, 1, 1, 5), (None, 1, 1, 5))
    future = txns(spark, (400, 1, 1, 5, 0, DAY + timedelta(days=900)), (200, 1, 1, 5, 0, DAY - timedelta(days=400)))
    parts = [t.where("transaction_id < 7"), future, old, unknown, t.where("transaction_id >= 5"), unknown]
    feed = _files(spark, tmp_path / "in", parts)
    out = str(tmp_path / "out")
    scoring.score_stream(feed, *sides, out, str(tmp_path / "state")).awaitTermination()
    scored = {r.transaction_id for r in _scored(spark, out).collect()}
    aside = spark.read.parquet(f"{out}.set_aside")
    assert scored == {*range(20), 200, 201, 400} and _scored(spark, out).count() == 23
    reasons = rows(aside.where("transaction_id is not null").select("transaction_id", "reason").distinct())
    assert reasons == [(300, "unknown_customer_id"), (301, "unknown_bank_id"), (302, "unknown_customer_id")]
    assert aside.where("reason = 'missing_transaction_id'").count() == 4
    arrived = {r.transaction_id for p in parts for r in p.where("transaction_id is not null").collect()}
    assert scored | {300, 301, 302} == arrived

    # after the next snapshot they are scored when they come again
    more = (customers(spark, (1, "High"), (2, "Low"), (77, "Low")), banks(spark, (1, 0.5), (2, 0.9), (88, 0.7)))
    unknown.write.mode("append").parquet(str(tmp_path / "in"))
    scoring.score_stream(feed, *_sides(*more, t, s), out, str(tmp_path / "state")).awaitTermination()
    assert {r.transaction_id for r in _scored(spark, out).collect()} == arrived


def test_an_id_that_comes_with_another_content_is_set_aside(spark, tmp_path):
    c, b, t, s = _tables(spark)
    first = txns(spark, (500, 1, 1, 5), (500, 1, 1, 5), (501, 1, 1, 5), (501, 2, 1, 7))
    later = txns(spark, (500, 1, 1, 5), (500, 1, 1, 6), (500, 1, 1, 6), (502, 2, 2, 5))
    feed = _files(spark, tmp_path / "in", [first, later])
    out = str(tmp_path / "out")
    scoring.score_stream(feed, *_sides(c, b, t, s), out, str(tmp_path / "state")).awaitTermination()
    columns = ["transaction_id", "customer_id", "amount"]
    scored, aside = _scored(spark, out), spark.read.parquet(f"{out}.set_aside")
    assert sorted(r.transaction_id for r in scored.collect()) == [500, 501, 502]
    assert {r.reason for r in aside.collect()} == {"duplicate_key"} and aside.count() == 2
    assert rows(scored.select(*columns).unionByName(aside.select(*columns))) == rows(first.unionByName(later).select(*columns).distinct())


def test_another_currency_is_another_content(spark, tmp_path):
    c, b, t, s = _tables(spark)
    other = t.where("transaction_id in (3, 4)").withColumn("currency", F.lit("EUR"))
    invalid = t.where("transaction_id = 5").withColumn("is_valid_bank_id", F.lit(0))
    feed = _files(spark, tmp_path / "in", [t, other, t, invalid, other])
    out = str(tmp_path / "out")
    scoring.score_stream(feed, *_sides(c, b, t, s), out, str(tmp_path / "state")).awaitTermination()
    aside = spark.read.parquet(f"{out}.set_aside")
    assert _scored(spark, out).count() == 20
    assert rows(aside.select("transaction_id", "currency", "is_valid_bank_id", "reason")) == [
        (3, "EUR", 1, "duplicate_key"), (4, "EUR", 1, "duplicate_key"), (5, "USD", 0, "duplicate_key"),
    ]


def test_no_batch_reads_what_was_scored_before(spark, tmp_path):
    """With the scores of all earlier batches unreadable, ids sent again are still known."""
    c, b, t, s = _tables(spark)
    sides, out, state = _sides(c, b, t, s), str(tmp_path / "out"), str(tmp_path / "state")
    feed = _files(spark, tmp_path / "in", [t.where("transaction_id < 10"), t.where("transaction_id < 15")])
    scoring.score_stream(feed, *sides, out, state).awaitTermination()
    for f in [*(tmp_path / "out").rglob("*.parquet"), *(tmp_path / "out.ids").rglob("*.parquet")]:
        f.write_bytes(b"")
    (tmp_path / "out.set_aside").rename(tmp_path / "elsewhere")
    t.unionByName(t.where("transaction_id = 2").withColumn("currency", F.lit("EUR"))).write.mode("append").parquet(str(tmp_path / "in"))
    scoring.score_stream(feed, *sides, out, state).awaitTermination()
    last = sorted((tmp_path / "out").glob("feed=*/batch_id=[2-9]*"))
    assert sorted(r.transaction_id for f in last for r in spark.read.parquet(str(f)).collect()) == [15, 16, 17, 18, 19]
    assert [r.transaction_id for r in spark.read.parquet(f"{out}.set_aside").collect()] == [2]


def test_what_waits_is_scored_once_its_customer_is_known(spark, tmp_path):
    c, b, t, s = _tables(spark)
    unknown = txns(spark, (300, 77, 1, 9500), (301, 1, 88, 5), (302, 77, 88, 5))
    feed = _files(spark, tmp_path / "in", [t, unknown])
    out, alerts = str(tmp_path / "out"), []

    def run(sides, state="state"):
        told = lambda scored, feed, batch_id: alerts.append(sorted(r.transaction_id for r in scored.collect()))
        scoring.score_stream(feed, *sides, out, str(tmp_path / state), then=told).awaitTermination()
        return {r.transaction_id for r in _scored(spark, out).collect()} - {*range(20)}

    assert run(_sides(c, b, t, s)) == set()
    assert scoring.waiting(spark, t.schema, out).count() == 3
    more = (customers(spark, (1, "High"), (2, "Low"), (77, "Low")), b, t, s)
    assert run(_sides(*more)) == {300} and alerts[-1] == [300]
    all_known = (more[0], banks(spark, (1, 0.5), (2, 0.9), (88, 0.7)), t, s)
    assert run(_sides(*all_known)) == {300, 301, 302} and alerts[-1] == [301, 302]
    # neither a third start nor another run over the same feed scores them again
    run(_sides(*all_known))
    run(_sides(*all_known), "state2")
    assert _scored(spark, out).count() == 23 and scoring.waiting(spark, t.schema, out).isEmpty()
    batch = rules.score_transactions(features.transaction_flags(t.unionByName(unknown), *_sides(*all_known)))
    assert rows(_scored(spark, out)) == rows(batch)


def test_alerts_come_from_what_was_scored(spark, tmp_path):
    c, b, t, s = _tables(spark)
    sides = _sides(c, b, t, s)
    feed = _files(spark, tmp_path / "in", [t.where("transaction_id < 10"), t, t.where("transaction_id >= 10")])
    out = str(tmp_path / "alerts")

    def run(profiles):
        raiser = scoring.alert_raiser(profiles, out, run_ts=TS)
        scoring.score_stream(feed, *sides, str(tmp_path / "out"), str(tmp_path / "state"), then=raiser).awaitTermination()
        return spark.read.parquet(out)

    got = run(compliance.bank_compliance_profiles(b, s))
    critical = _scored(spark, tmp_path / "out").where("severity = 'Critical'").count()
    told = got.where("alert_type = 'CRITICAL_FRAUD_FLAGS'").select(F.split("message", " ")[0].cast("int").alias("n"))
    assert critical > 0 and told.agg(F.sum("n")).first()[0] == critical
    assert got.where("alert_type = 'BANKS_BELOW_COMPLIANCE_THRESHOLD'").count() == 1

    # the standing alert is raised again once the number of banks has changed
    worse = compliance.bank_compliance_profiles(banks(spark, (1, 0.5), (2, 0.3)), s)
    for n in (500, 501):
        txns(spark, (n, 1, 1, 5)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = run(worse)
    assert got.where("alert_type = 'BANKS_BELOW_COMPLIANCE_THRESHOLD'").count() == 2


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    """The sink run again for the same batch, as after a failure, leaves the same tables."""
    c, b, t, s = _tables(spark)
    calls, real = [], scoring.per_batch

    def twice(stream, write, checkpoint):
        def both(batch, batch_id):
            write(batch, batch_id)
            write(batch, batch_id)
            calls.append(batch_id)

        return real(stream, both, checkpoint)

    scoring.per_batch = twice
    try:
        feed = _files(spark, tmp_path / "in", [t.where("transaction_id < 10"), t])
        scoring.score_stream(feed, *_sides(c, b, t, s), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    finally:
        scoring.per_batch = real
    assert calls == [0, 1] and _scored(spark, tmp_path / "out").count() == 20
    assert not (tmp_path / "out.work").exists() or not [p for p in (tmp_path / "out.work").rglob("*.parquet")]


def test_micro_batches_are_joined_adaptively(spark, tmp_path):
    c, b, t, s = _tables(spark)
    plans = []

    def write(batch, batch_id):
        stored = scoring.stored_batch(batch, str(tmp_path / f"b{batch_id}"))
        out = features.transaction_flags(stored, *_sides(c, b, t, s), how="left")
        plans.append(out._jdf.queryExecution().executedPlan().toString())

    scoring.per_batch(_files(spark, tmp_path / "in", [t]), write, str(tmp_path / "state")).awaitTermination()
    assert plans and all(p.startswith("AdaptiveSparkPlan") for p in plans)


EVENTS = "customer_id bigint, event_time timestamp, amount decimal(18,2), is_high_risk int"


def _events(spark, times):
    base = [(1 + i % 2, datetime(2024, 1, d, h, tzinfo=timezone.utc), None, i % 2) for i, (d, h) in enumerate(times)]
    return spark.createDataFrame(base, EVENTS)


def test_late_rows_within_the_bound_are_counted(spark, tmp_path):
    """Rows out of order by less than the bound reach their bucket."""
    parts = [_events(spark, x) for x in ([(1, 5), (1, 23)], [(2, 0), (1, 23)], [(2, 12), (2, 3)], [(4, 0)])]
    out = str(tmp_path / "out")
    monitoring.region_monitor_stream(
        _files(spark, tmp_path / "in", parts), customers(spark, (1, "Low"), (2, "Low", "East")), out,
        str(tmp_path / "state"), "1 day", "2 hours",
    ).awaitTermination()
    got = monitoring.region_counts(spark, out, "2 hours")
    counts = rows(got.select(F.dayofmonth("bucket_start").alias("d"), "region", "txn_count", "high_risk_txn_count"))
    assert counts == [(1, "East", 2, 2), (1, "North", 1, 0), (2, "East", 1, 1), (2, "North", 2, 0)]
    assert rows(monitoring.monitor_accounts(spark, out, "2 hours")) == [("counted", 6), ("open", 1)]


def test_every_event_is_accounted_for(spark, tmp_path):
    """Shuffled events: counted, open, late, of unknown customers or without a time, none lost."""
    r = random.Random(6)
    base = [(r.choice([1, 2, 9, None]), datetime(2024, 1, r.randint(1, 20), r.randint(0, 23), tzinfo=timezone.utc), None, 1) for _ in range(300)]
    base += [(1, None, None, 0)] * 7
    r.shuffle(base)
    parts = [spark.createDataFrame(base[k::6], EVENTS) for k in range(6)]
    out = str(tmp_path / "out")
    monitoring.region_monitor_stream(
        _files(spark, tmp_path / "in", parts), customers(spark, (1, "Low"), (2, "Low", "East")), out, str(tmp_path / "state")
    ).awaitTermination()
    accounts = dict(rows(monitoring.monitor_accounts(spark, out)))
    assert sum(accounts.values()) == len(base) and accounts["undated"] == 7 and accounts["late"] > 0
    assert accounts["unmatched"] == sum(1 for x in base if x[1] is not None and x[0] not in (1, 2))
    counted = monitoring.region_counts(spark, out).agg(F.sum("txn_count")).first()[0]
    assert counted == accounts["counted"]


def test_folded_counts_equal_those_of_all_batches(spark, tmp_path, monkeypatch):
    """Fourteen batches in no order: the same results, and never more than some tables to read."""
    r = random.Random(9)
    base = [(r.choice([1, 2, 9, None]), datetime(2024, 1, r.randint(1, 20), r.randint(0, 23), tzinfo=timezone.utc), Decimal(r.randint(1, 99)), 1) for _ in range(280)]
    base[::40] = [(1, None, None, 0)] * 7
    parts = [spark.createDataFrame(base[k::14], EVENTS) for k in range(14)]
    feed, people = _files(spark, tmp_path / "in", parts), customers(spark, (1, "Low"), (2, "Low", "East"))
    seen, real = [], monitoring.fold

    def counted(spark, path):
        seen.append(sum(len(list(f.iterdir())) for f in Path(path).iterdir() if f.name.startswith("feed=")))
        real(spark, path)

    monkeypatch.setattr(monitoring, "fold", counted)
    got = []
    for every in (0, 3):
        out = str(tmp_path / f"out{every}")
        monitoring.region_monitor_stream(feed, people, out, str(tmp_path / f"state{every}"), fold_every=every).awaitTermination()
        got.append((rows(monitoring.region_counts(spark, out)), rows(monitoring.monitor_accounts(spark, out))))
    assert got[0] == got[1] and sum(n for _, n in got[0][1]) == len(base)
    assert len(seen) == 4 and max(seen) <= 7
    # what is folded stays when it is folded again, and when nothing is new
    real(spark, out)
    real(spark, out)
    assert (rows(monitoring.region_counts(spark, out)), rows(monitoring.monitor_accounts(spark, out))) == got[1]


def test_a_feed_has_more_files_the_more_rows_it_has(spark, monkeypatch):
    from bindings import queries

    made = []
    real = queries.new_folder
    monkeypatch.setattr(queries, "new_folder", lambda *a: made.append(real(*a)) or made[-1])
    monkeypatch.setattr(queries, "FEED_ROWS", 100)
    df = spark.range(7000).selectExpr("id as event_id", "id % 5 as kind")
    assert queries._feed(spark, df, "event_id").isStreaming
    sent = spark.read.parquet(made[-1])
    assert rows(sent.select("event_id", "kind")) == rows(df)
    assert len(sent.inputFiles()) > 14


def test_rows_of_a_batch_are_told_apart_by_one_shuffle_of_them(spark):
    schema = "transaction_id long, amount double, _content long"
    batch = spark.createDataFrame([(1, 5.0, 50), (1, 4.0, 40), (2, 1.0, 10), (3, 7.0, 70), (4, 2.0, 20)], schema)
    new = spark.createDataFrame([(1,), (2,), (3,)], "transaction_id long")
    known = spark.createDataFrame([(3, 70), (3, 71)], "transaction_id long, _other long")
    told = scoring._told(batch, new, known)
    assert {(r.transaction_id, r.amount) for r in told.where("_fresh").collect()} == {(1, 4.0), (2, 1.0)}
    assert told.count() == 5
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        plan = scoring._told(batch, new, known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert plan.count("Exchange hashpartitioning") == 3  # rows, new ids, known ids


def test_state_is_looked_up_once_per_key(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    with scoring.keyed_state(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key, None) is None
