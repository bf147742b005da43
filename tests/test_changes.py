"""Heads without bodies, runs that break off, windows delivered again, corrected files, imports."""

from __future__ import annotations

import datetime as dt
import io
import json

import pytest
from pyspark.sql import functions as F

from meterlake.operators import journal, lake, outcome, sites
from meterlake.plans import ingest
from meterlake.sources import headscan
from meterlake.sources.lines import heads, read_lines
from meterlake.streaming import arrivals, totals
from meterlake.streaming import ingest as streaming
from test_ingest import PAIRS, landing, lake_df

DAY = "200,N1,E1,1,E1,N1,S,kWh,720,\n300,20240101,1,2,A,,,,\n"


class Counting(io.BytesIO):
    asked = 0

    def read(self, n=-1):
        self.asked += n
        return super().read(n)


def test_a_head_is_read_without_its_body():
    stream = Counting(b"short line\r\n" * 5_000_000)
    lines, has_nul = headscan.head_of(stream)
    assert lines == ["short line"] * 10 and not has_nul and stream.asked <= 2 * headscan.BLOCK
    wide = Counting(b"x" * 300_000 + b"\ny" * 12)
    assert [len(line) for line in headscan.head_of(wide)[0]] == [300_000] + [1] * 9
    for text in (b"", b"a", b"a\n", b"a\rb\r\nc\n\nd", b"\n" * 4000 + b"\0", b"\n" * 5000 + b"\0"):
        lines, has_nul = headscan.head_of(io.BytesIO(text))
        assert lines == [x.decode() for x in io.BytesIO(text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")).read().split(b"\n")[:10]][: len(lines)]
        assert has_nul == (b"\0" in text[:4096])


def test_heads_are_those_of_the_text(spark, folder):
    paths = landing(folder)
    (folder / "gone.csv").write_text("a\n")
    columns = ["file", "name", "head", "has_nul", "unreadable"]

    def of(df):
        return sorted(map(str, df.select(*columns).filter("name not like 'Bunnings%'").collect()))

    assert of(headscan.scan(spark, paths)) == of(heads(read_lines(spark, paths)))
    reader = headscan._Reader([(folder / "gone.csv").as_uri(), (folder / "never.csv").as_uri()], 1)
    assert [row for part in reader.partitions() for row in reader.read(part)][1][1:] == ([], False, True)
    assert not headscan.reachable("nosuchstore://x/y")


@pytest.mark.parametrize("lead", [11, 1000])
def test_lead_lines_lose_nothing(spark, folder, mapping, lead):
    top = "".join(f"Report line {i}\n" for i in range(lead))
    (folder / "meter.csv").write_text(top + DAY)
    (folder / "register.csv").write_text(top + "100,NEM13,202401010000,A,B\n" + ",".join(["250", "N1", "11", "1", "11", "N1", "S", "E", "1", "20240101000000", "A", "", "", "5", "20240104000000", "A", "", "", "4", "kWh", "", "", ""]) + "\n")
    (folder / "mystery.csv").write_text(top + "who,knows\n")
    done = ingest.ingest_files(spark, [str(folder)], mapping(**{"N1-E1": "p:n1"}))
    got = {r["file"].split("/")[-1]: (r["fmt"], r["status"], r["rows_written"]) for r in done.outcomes.collect()}
    assert got["meter.csv"] == ("nem", "processed", 2) and got["mystery.csv"] == (None, "parse_failed", 0)
    assert got["register.csv"][0] == "nem13"


def test_a_quoted_file_is_read_by_many_tasks(spark, folder, mapping):
    days = [f"{dt.date(2015, 1, 1) + dt.timedelta(d):%Y%m%d}" for d in range(700)]
    plain = "100,NEM12,202401010000,A,B\n" + "".join(
        f"200,N{m},E1,1,E1,N1,S,kWh,60,\n" + "".join(f"300,{day},{','.join(str((m + i) % 9) for i in range(24))},A,,,,\n" for day in days) for m in (1, 2, 3)
    )
    (folder / "plain.csv").write_text(plain)
    (folder / "quoted.csv").write_text(plain.replace("200,N", '"200",N').replace("300,2", '"300",2'))
    assert len((folder / "quoted.csv").read_bytes()) > 2 * 65536
    rows = {}
    for name in ("plain", "quoted"):
        done = ingest.ingest_files(spark, [str(folder / f"{name}.csv")], mapping(**{f"N{m}-E1": f"p:{m}" for m in (1, 2, 3)}))
        rows[name] = done.rows().select("sensorId", "ts", "val", "quality")
        if name == "quoted":
            assert done.resolved.select("split").distinct().count() > 1
    assert rows["plain"].count() == rows["quoted"].count() == 3 * 700 * 24
    assert rows["plain"].exceptAll(rows["quoted"]).isEmpty()


def test_an_accumulated_quantity_is_spread_over_its_days(spark, folder, mapping):
    record = ["250", "N1", "11", "1", "E1", "N1", "S", "E", "1", "20240101000000", "A", "", "", "5", "20240104000000", "A", "", "", "6", "kWh", "", "", ""]
    (folder / "r.csv").write_text("100,NEM13,202401010000,A,B\n" + ",".join(record) + "\n900\n")
    rows = ingest.ingest_files(spark, [str(folder / "r.csv")], mapping(**{"N1-E1": "p:n1"})).rows().collect()
    assert sorted((r["ts"], r["val"]) for r in rows) == [(dt.datetime(2024, 1, d), 2.0) for d in (1, 2, 3)]


def test_a_run_that_breaks_off_is_finished(spark, folder, mapping, monkeypatch):
    (folder / "in").mkdir()
    (folder / "in" / "a.csv").write_text("100,NEM12,202401010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,720,\n300,20240101,1,,A,,,,\n900\n")
    table, audits = str(folder / "lake"), str(folder / "audit")
    args = (spark, [str(folder / "in" / "a.csv")], mapping(**{"N1-E1": "p:n1"}), table, audits)

    def broken(*_):
        raise OSError("no room")

    with monkeypatch.context() as patch:  # between lake and audit
        patch.setattr(outcome, "write_audit", broken)
        with pytest.raises(OSError):
            ingest.run(*args, "one")
    assert spark.read.parquet(table).count() == 1 and journal.pending(spark, table) == {"one": True}
    with monkeypatch.context() as patch:  # before the marker
        patch.setattr(journal, "_mark", broken)
        with pytest.raises(OSError):
            ingest.run(*args, "two")
    assert journal.pending(spark, table) == {"two": False}  # the first was finished, the second never counted
    assert [r["batch"] for r in spark.read.text(audits).select("batch").distinct().collect()] == ["one"]
    assert journal.recover(spark, table) == {"two": False} and journal.pending(spark, table) == {}
    assert ingest.run(*args, "three").first()["status"] == "processed"
    assert spark.read.parquet(table).count() == 1
    assert {r["batch"] for r in spark.read.text(audits).select("batch").distinct().collect()} == {"one", "three"}


def test_draining_takes_as_many_runs_as_it_needs(spark, folder, mapping):
    (folder / "in").mkdir()
    for i in range(5):
        (folder / "in" / f"{i}.csv").write_text(DAY.replace("20240101", f"2024010{i + 1}"))
    (folder / "in" / "empty.csv").write_text("")
    got = ingest.drain(spark, str(folder / "in"), mapping(**{"N1-E1": "p:n1"}), str(folder / "lake"), outcomes_path=str(folder / "o"), batch_files=2)
    assert got == {"files": 5, "runs": 3, "failed": 0}
    assert spark.read.parquet(str(folder / "lake")).count() == 10 and spark.read.parquet(str(folder / "o")).count() == 5


def test_a_window_becomes_what_was_delivered(spark, folder):
    at, path = dt.datetime, str(folder / "lake")
    row = lambda s, d, v: (s, at(2024, *d), v, "kwh", None, at(2024, 5, 1))
    lake.upsert_readings(spark, path, lake_df(spark, [row("a", (1, 5), 1.0), row("a", (1, 20), 2.0), row("a", (2, 3), 3.0), row("b", (1, 20), 4.0), row("a", (3, 1), 5.0)]))
    again = lake_df(spark, [row("a", (1, 20), 7.0), row("a", (1, 21), 8.0), row("a", (5, 5), 9.0)])
    for expect in ({"inserted": 1, "replaced": 1, "withdrawn": 1}, {"inserted": 0, "replaced": 2, "withdrawn": 0}):
        assert lake.replace_window(spark, path, again, "2024-01-10", "2024-03-01") == expect

    def content():
        return sorted((r["sensorId"], r["ts"].month, r["ts"].day, r["val"]) for r in spark.read.parquet(path).collect())

    assert content() == [("a", 1, 5, 1.0), ("a", 1, 20, 7.0), ("a", 1, 21, 8.0), ("a", 3, 1, 5.0), ("b", 1, 20, 4.0)]
    sensors = spark.createDataFrame([("b",)], "sensor_id string")
    assert lake.replace_window(spark, path, again.limit(0), "2024-01-01", "2025-01-01", sensors)["withdrawn"] == 1
    assert lake.replace_window(spark, path, again.limit(0), "2024-01-01", "2025-01-01", spark.createDataFrame([("a",)], "s string"))["withdrawn"] == 4
    assert content() == []


def test_bloom_filters_tell_absent_sensors(spark, folder):
    path = str(folder / "lake")
    rows = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id") * 2).alias("sensorId"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("val"), F.lit(1).alias("ats"))
    lake.upsert_readings(spark, path, rows)
    assert scanned(spark, path, "s4001") == 0 < scanned(spark, path, "s4000")  # both are within the files' ranges


def scanned(spark, path, sensor):
    """Rows that leave the scan."""
    df = spark.read.parquet(path).filter(F.col("sensorId") == sensor)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_corrected_file_replaces_and_redelivery_does_nothing(spark, folder, mapping, monkeypatch):
    source, table = folder / "in", str(folder / "lake")
    source.mkdir()
    runs = []
    real = ingest.run
    monkeypatch.setattr(ingest, "run", lambda s, paths, *rest: (runs.append(sorted(p.split("/")[-1] for p in paths)), real(s, paths, *rest))[1])

    def drain(**known):
        arrivals.source_files(spark, str(source), mapping(**{"N1-E1": "p:n1", "N2-E1": "p:n2"}), table, str(folder / "state"), **known).awaitTermination()
        return sorted((r["sensorId"], r["val"]) for r in spark.read.parquet(table).collect())

    (source / "a.csv").write_text(DAY)
    (source / "b.csv").write_text(DAY.replace("N1,E1,1", "N2,E1,1"))
    assert drain() == [("p:n1", 1.0), ("p:n1", 2.0), ("p:n2", 1.0), ("p:n2", 2.0)]
    assert drain() == drain() and runs == [["a.csv", "b.csv"]]
    (source / "a.csv").write_text(DAY.replace(",1,2,A", ",10,20,A"))
    assert drain() == [("p:n1", 10.0), ("p:n1", 20.0), ("p:n2", 1.0), ("p:n2", 2.0)]
    assert runs == [["a.csv", "b.csv"], ["a.csv"]]


def test_lines_that_do_not_fit_are_kept_and_counted(spark, folder):
    source, table = folder / "in", str(folder / "lake")
    source.mkdir()
    head = "sensorId,ts,val,unit,its,quality\n"
    (source / "0.csv").write_text(head + "a,2024-01-01 00:00:00,1,kwh,2024-01-01 00:00:00,\na,2024-01-02 00:00:00,,kwh,2024-01-02 00:00:00,\n")
    (source / "1.csv").write_text(head + "a,2024-01-03 00:00:00,n/a,kwh,2024-01-03 00:00:00,\na,soon,3,kwh,soon,\n")
    listener = totals.BatchTotals(spark, str(folder / "totals"))
    spark.streams.addListener(listener)
    for _ in range(2):
        streaming.lake_rows(spark, str(source), table, str(folder / "cp"), max_files=5).awaitTermination()
    listener.settle(spark)
    spark.streams.removeListener(listener)
    (one,) = totals.read_totals(spark, str(folder / "totals")).collect()
    assert (one["batch_id"], one["rows"], one["rejected"], one["without_value"]) == (0, 2, 2, 1)
    assert spark.read.parquet(table).count() == 2
    assert {r["line"].split(",")[1] for r in spark.read.parquet(f"{table}_unreadable").collect()} == {"2024-01-03 00:00:00", "soon"}


def test_sites_are_imported_once(spark, folder):
    path = str(folder / "sites")
    rows = lambda *r: spark.createDataFrame(list(r), "project string, nmi string, siteIdStr string, siteName string, pos int")
    sites.import_sites(spark, path, rows(("p", "1", "S1", "One", 1), ("p", "1", "S1", "Uno", 2), ("p", "", "S", "x", 3), ("p", "2", "S2", "Two", 4)), "b1")
    incoming = rows(("p", "1", "S1", "Eins", 1), ("p", "2", "S2", "Two", 2), ("p", "3", "S3", None, 3))
    for batch, force, decided in (("b2", False, {"1": "skipped", "3": "inserted"}), ("b3", True, {"1": "replaced"})):
        for _ in range(2):
            ledger = sites.import_sites(spark, path, incoming, batch, force)
            assert {r["nmi"]: r["decision"] for r in ledger.collect()} == decided
        assert {r["siteName"] for r in spark.read.parquet(path).filter("nmi = '1'").collect()} == {"Eins" if force else "Uno"}
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(f"{path}_ledger").filter("state = 'CONFLICT'").select("stored.siteName").distinct().collect()[0][0] == "Uno"


def test_audit_documents_stop_where_rows_do_not(spark, folder, mapping):
    day = ",".join([""] * 288)
    (folder / "m.csv").write_text(f"100,NEM12,202401010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,5,\n300,20240101,{day},A,,,,\n900\n")
    done = ingest.ingest_files(spark, [str(folder / "m.csv")], mapping(**PAIRS))
    assert outcome.skipped_cells(done.resolved).count() == 288 and done.samples.count() == 100
    (doc,) = [json.loads(r["value"]) for r in done.audit().collect()]
    assert len(doc["skipped_samples"]) == 101 and doc["skipped_samples"][-1] == {"truncated": True, "total_skipped": 288}


def test_files_are_written_by_all_tasks_and_replaced(spark, folder):
    from meterlake.workload.changes import put_files

    text = spark.range(0, 40, 1, 4).select(F.concat(F.lit("a,"), "id").alias("text"))
    put_files(spark, text, str(folder / "in"), "part-1")
    put_files(spark, text, str(folder / "in"), "part-11")
    assert len(list((folder / "in").glob("part-1-*.csv"))) == 4
    put_files(spark, text.coalesce(2).select(F.replace("text", F.lit("a,"), F.lit("b,")).alias("text")), str(folder / "in"), "part-1")
    assert len(list((folder / "in").glob("part-1-*.csv"))) == 2 and len(list((folder / "in").glob("part-11-*.csv"))) == 4
    assert sorted(r["value"] for r in spark.read.text(str(folder / "in")).collect()) == sorted(f"{x},{i}" for x in "ab" for i in range(40))
