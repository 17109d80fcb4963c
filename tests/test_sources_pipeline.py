import gzip
import json
import shutil
import time
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskspark import __main__ as cli
from riskspark import schemas
from riskspark.operators.cleaning import coerce_sources
from riskspark.plans import pipeline
from riskspark.plans.workspace import DROP_SHUFFLES, materialise, shared_folder, shuffles_dropped
from riskspark.sources import readers, sinks
from riskspark.sources.readers import read_mart, read_sources, read_unreadable
from riskspark.sources.sinks import append_alerts, export_mart, with_month, write_mart
from tests.helpers import rows, txns

TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

FILES = {
    "customers_.csv": """customer_id,name,email,phone,region,risk_level
1,"Ann, Lee",a@x,1,North,High
2,"Bo ""B"" Ray",,2,East,Low
3,Cy,c@x,3,East,Wrong
""",
    "banks.csv": """bank_id,name,region,compliance_score
1,"Hill, King and Sons",West,0.55
2,Plain Bank,North,0.9
""",
    "transactions.csv": """transaction_id,customer_id,bank_id,amount,currency,date,location,is_high_risk,is_valid_bank_id
1,1,1,9500.00,USD,2024-01-05,X,True,True
2,1,1,10.00,,01/06/2024,X,False,True
2,1,1,10.00,,01/06/2024,X,False,True
3,1,2,20.00,EUR,2024-02-07,X,True,True
4,1,2,30.00,USD,2024-02-08,X,False,True
5,2,2,40.00,USD,bad,X,False,True
6,9,2,40.00,USD,2024-02-08,X,False,True
7,2,2,n/a,USD,2024-02-08,X,False,True
""",
    "sanctions.csv": """sanction_id,bank_id,customer_id,sanction_date,reason,is_valid_bank_id
1,1,1,2023-01-01,Fraud,True
2,8,1,2023-01-01,Fraud,True
""",
}


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return str(folder)


def test_csv_text_with_commas_and_quotes(spark, source):
    t = read_sources(spark, source)
    assert rows(t["banks"], "name") == [("Hill, King and Sons",), ("Plain Bank",)]
    assert ('Bo "B" Ray',) in rows(t["customers"], "name")
    assert all(d == "string" for _, d in t["transactions"].dtypes)


def test_columns_are_found_by_name(spark, source, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "banks.csv").write_text('name,extra, bank_id,region,compliance_score\n"B\nof\nC",x,1,West,0.5\nD,y,2,East,0.7\n')
    t = read_sources(spark, str(tmp_path))
    assert rows(t["banks"], "bank_id", "name", "region", "compliance_score") == [("1", "B\nof\nC", "West", "0.5"), ("2", "D", "East", "0.7")]
    (tmp_path / "banks.csv").write_text("name,bank_id,region\nB,1,West\n")
    with pytest.raises(ValueError, match="compliance_score"):
        read_sources(spark, str(tmp_path))


BROKEN = """customer_id,name,email,phone,region,risk_level
1,Ann,a@x,1,North,High
2,Bank, Inc,b@x,2,East,Low
3,Cy,c@x
4,"Di,d@x,4,East,Low
5,"E, F",e@x,5,East,Low
6,,,,,
"""


def test_records_that_do_not_fit_the_header_are_set_apart(spark, source, tmp_path):
    for name, text in (FILES | {"customers_.csv": BROKEN}).items():
        (tmp_path / name).write_text(text)
    found = read_sources(spark, str(tmp_path))["customers"]
    assert rows(found, "customer_id", "name") == [("1", "Ann"), ("5", "E, F"), ("6", None)]
    assert found.count() == 3 and found.select("region").distinct().count() == 3
    assert rows(read_unreadable(spark, str(tmp_path))) == [
        ("customers", 2, "unreadable_record", "2,Bank, Inc,b@x,2,East,Low"),
        ("customers", 3, "unreadable_record", "3,Cy,c@x"),
        ("customers", 4, "unreadable_record", '4,"Di,d@x,4,East,Low'),
    ]
    marts = pipeline.run(spark, str(tmp_path), str(tmp_path / "out"), run_ts=TS, export=False)
    told = marts["quarantine"].where("table_name = 'customers'")
    assert rows(told, "key", "reason") == [(2, "unreadable_record"), (3, "unreadable_record"), (4, "unreadable_record"), (6, "missing_name")]
    assert marts["customers"].count() == 2


def test_unknown_formats(spark, source, tmp_path):
    with pytest.raises(ValueError):
        read_sources(spark, source, "xml")
    with pytest.raises(ValueError):
        export_mart(spark.range(1), str(tmp_path / "x"), "xml")


def test_parquet_sources_give_the_same_tables(spark, source, tmp_path):
    typed = coerce_sources(read_sources(spark, source))
    for table, df in typed.items():
        df.write.parquet(str(tmp_path / f"{table}.parquet"))
    again = coerce_sources(read_sources(spark, str(tmp_path), "parquet"))
    for table in schemas.STAGING:
        assert rows(again[table]) == rows(typed[table])


def test_mart_is_replaced_and_partitioned(spark, tmp_path):
    path = str(tmp_path / "mart")
    write_mart(spark.range(5), path)
    assert write_mart(spark.range(2), path).count() == 2
    t = write_mart(with_month(txns(spark, (1, 1, 1, 5))), str(tmp_path / "t"), partition_by=["txn_month"])
    assert rows(t, "txn_month") == [("2024-01",)]
    assert (tmp_path / "t" / "txn_month=2024-01").is_dir()
    assert read_mart(spark, path).count() == 2


def test_alert_log_keeps_other_runs_and_repeats_none(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("A", "m")], "alert_type string, message string")
    append_alerts(one, path, "run-a")
    append_alerts(one, path, "run-b")
    append_alerts(one, path, "run-b")
    assert rows(spark.read.parquet(path), "run_id") == [("run-a",), ("run-b",)]
    append_alerts(one.limit(0), path, "run-b")  # repeated, and nothing is raised any more
    assert rows(spark.read.parquet(path), "run_id") == [("run-a",)]


def test_materialise_uses_the_configured_folder(spark):
    df = materialise(spark.range(3), "three")
    assert df.count() == 3
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) in df.inputFiles()[0]


def test_command_line(spark, source, tmp_path, monkeypatch, capsys):
    seen = {}

    def run(session, source_dir, out_dir, **options):
        seen.update(source=source_dir, out=out_dir, **options)
        return {"kpi_summary": session.range(1), "alerts": session.range(1)}

    monkeypatch.setattr(pipeline, "run", run)
    cli.main([source, str(tmp_path), "--format", "parquet", "--no-export"])
    assert seen == {"source": source, "out": str(tmp_path), "fmt": "parquet", "export": False}


def test_text_is_exported_as_it_is(spark, tmp_path):
    df = spark.createDataFrame([(' a "b", ', "", None)], "x string, y string, z string")
    export_mart(df, str(tmp_path / "x"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "x"))
    assert rows(back) == [(' a "b", ', None, None)]


def test_whole_run(spark, source, tmp_path):
    marts = pipeline.run(spark, source, str(tmp_path / "out"), run_ts=TS)
    assert rows(marts["transactions"], "transaction_id", "currency") == [(1, "USD"), (2, "USD"), (3, "EUR"), (4, "USD")]
    assert rows(marts["quarantine"], "table_name", "key", "reason") == [
        ("customers", 3, "bad_risk_level"),
        ("sanctions", 2, "unknown_bank_id"),
        ("transactions", 5, "missing_date"),
        ("transactions", 6, "unknown_customer_id"),
        ("transactions", 7, "missing_amount"),
    ]
    kpi = marts["kpi_summary"].first().asDict()
    assert kpi.pop("generated_at_utc") is not None
    assert kpi == {
        "data_completeness_pct": 98.39,  # one empty e-mail in 62 cells
        "data_consistency_pct": 100.0,
        "total_transactions": 4,
        "flagged_transaction_count": 4,
        "flagged_rate_pct": 100.0,
        "critical_flags": 1,
        "high_flags": 2,
        "high_risk_customer_count": 1,
        "segmentation_agreement_pct": 100.0,
        "total_sanctioned_accounts": 1,
        "avg_bank_compliance_score": 0.725,
        "compliance_gap_pct": 50.0,
        "high_risk_bank_count": 0,
        "avg_bank_risk_score": 31.0,
    }
    assert marts["data_quality_kpis"].first().duplicate_transactions_removed == 1
    assert rows(marts["duplicate_keys"]) == [("transactions", 2, 2)]
    assert {r.alert_type for r in marts["alerts"].collect()} == {"CRITICAL_FRAUD_FLAGS", "BANKS_BELOW_COMPLIANCE_THRESHOLD"}

    out = Path(tmp_path / "out")
    header = next((out / "export" / "flagged_transactions").glob("*.csv")).read_text().splitlines()[0]
    assert header.startswith("transaction_id,customer_id,customer_name")
    parts = [p.read_text() for p in (out / "export" / "disposition_template").glob("*.csv")]
    assert all(p.startswith("transaction_id,customer_id,bank_id,amount,fraud_score,severity,reviewed_by,") for p in parts)
    assert "1,1,1,9500.00,5,Critical,,,\n" in "".join(parts)
    shown = json.loads(next((out / "export" / "kpi_summary_json").glob("*.json")).read_text())
    assert shown["total_transactions"] == 4
    assert {p.name for p in (out / "views").iterdir()} == {
        "kpis", "region", "complianceRegion", "flagged", "customers", "banks", "bankCompliance", "alerts",
    }

    # the same sources again: same results, and the alert log does not grow for the same run
    again = pipeline.run(spark, source, str(tmp_path / "out"), run_ts=TS, export=False)
    assert again["kpi_summary"].drop("generated_at_utc").first().asDict() == kpi
    assert spark.read.parquet(str(out / "alerts_log")).agg(F.count("*")).first()[0] == 2


def test_quotes_of_a_source_are_counted_once_a_run(spark, source, tmp_path, monkeypatch):
    counted, count = [], readers._quotes_over_lines
    monkeypatch.setattr(readers, "_quotes_over_lines", lambda spark, path: counted.append(path) or count(spark, path))
    pipeline.run(spark, source, str(tmp_path / "out"), run_ts=TS, export=False)
    assert len(counted) == len(set(counted)) == 4


def _lines(spark, folder):
    return {p.name: sorted(r.value for r in spark.read.text(str(p)).collect()) for p in folder.iterdir()}


def test_compressed_exports_and_views_hold_the_same_text(spark, source, tmp_path, monkeypatch):
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    used = shutil.copytree(source, tmp_path / "source")
    marts = pipeline.run(spark, str(used), str(plain), run_ts=TS)
    shutil.rmtree(used)  # exports come from the stored marts
    pipeline.export_marts(marts, str(packed), compression="gzip")
    for kind in ("export", "views"):
        assert _lines(spark, packed / kind) == _lines(spark, plain / kind)
        assert all(gzip.open(p).read() for p in (packed / kind).rglob("part-*"))
    assert all(p.name.endswith(".zstd.parquet") for p in (plain / "marts").rglob("part-*"))
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 2)
    export_mart(spark.range(5).coalesce(1), str(tmp_path / "few"), compression="gzip")
    assert len(list((tmp_path / "few").glob("*.csv.gz"))) == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "few")).count() == 5


def test_compressed_sources_give_the_same_tables(spark, source, tmp_path):
    texts = FILES | {"banks.csv": 'bank_id,name,region,compliance_score\n1,"B\nof\nC",West,0.5\n2,D,East,0.7\n3,E\n', "customers_.csv": BROKEN}
    found = {}
    for kind, opened, end in (("plain", open, ""), ("packed", gzip.open, ".gz")):
        for name, text in texts.items():
            (tmp_path / kind / name).mkdir(parents=True)
            with opened(tmp_path / kind / name / f"part-0.csv{end}", "wt") as file:
                file.write(text)
        folder = str(tmp_path / kind)
        found[kind] = [rows(df) for df in (*read_sources(spark, folder).values(), read_unreadable(spark, folder))]
    assert found["packed"] == found["plain"] and len(found["plain"][-1]) == 4


def _shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in kept.mkString("\n").split("\n") if Path(f).name.startswith("shuffle_")}


def test_shuffle_files_of_a_run_go_with_its_steps(spark, source, tmp_path):
    before = _shuffle_files(spark)
    pipeline.run(spark, source, str(tmp_path / "out"), run_ts=TS, export=False)
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(DROP_SHUFFLES, None) is None


def test_what_the_session_says_of_shuffle_files_is_restored(spark):
    spark.conf.set(DROP_SHUFFLES, False)
    try:
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            1 / 0
        assert spark.conf.get(DROP_SHUFFLES) == "false"
    finally:
        spark.conf.unset(DROP_SHUFFLES)
