"""Files of many layouts through the whole job, and the streams."""

from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from meterlake.operators import billing, cadence, lake, outcome
from meterlake.plans import ingest, snapshot
from meterlake.sources.layouts import BILLING_FIELDS
from meterlake.sources.mapping import read_mapping, read_whitelist
from meterlake.sources.tables import manifest, read_lake
from meterlake.streaming import ingest as streaming

DEMAND = "Commodities:,E\nSites:,1\nStatus:,x\nCountry:,AU\nStart:,a\nEnd:,b\n\n\nIdentifier,ReadingDateTime,kW,kVa,Power Factor\n"


def bill(rows):
    header = ",".join(["Identifier", "Date", *[c for c, _, _ in BILLING_FIELDS], "Usage Measurement Unit", "Spend Currency"])
    text = "\r\n".join(["a:,1", "b:,2", "c:,3", "d:,4", "e:,5", "", "", header, *rows]) + "\r\n"
    return b"\xff\xfe" + text.encode("utf-16-le")


def landing(folder):
    files = {
        "nem.csv": "100,NEM12,202401010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,720,\n300,20240101,1,,A,,,,\n200,N2,X,1,X9,N1,S,kWh,720,\n300,20240101,1,2,A,,,,\n900\n",
        "envelope.csv": "100,NEM13,202401010000,A,B\n900\n",
        "usage.csv": "BuyerShortName,Identifier,Date,Start Time,Usage,Generation\nB,7,01 May 2025,00:30,1.5,\nB,7,2025-05-01,01:00,x,2\nB,7,never,01:30,1,2\n",
        "nothing.csv": "BuyerShortName,Identifier,Date,Start Time,Usage\nNo data is available,,,,\n",
        "Demand Profile 1.csv": DEMAND + "D1,01-Feb-2026 00:30:00,1.50,,0.8800\n,01-Feb-2026 01:00:00,1,1,1\nD1,1-Feb-2026 01:30:00,bad,2\n",
        "Demand_Profile_2.csv": DEMAND + "No data found\n",
        "water.csv": "Serial_No,Interval_Start,Interval_End,Consumption,Consumption Unit\n1,2024-01-01T01:00:00,2024-01-01T01:15:00,3,kL\n",
        "kwh.csv": "x\ny\nDate,Start Time,M1 kWh,M2 kWh\n2024-01-01,00:30,1,0\n2024-01-01,01:00,2,0\n",
        "RACV_Noosa_Solar 1.csv": "timestamp,p:s:1 (kW-hr),p:s:2\n31-Mar-26 8:30 AM AEST,1.5,Standby\n31-Mar-26 12:30 PM AEST,,Normal Operation\n",
        "RACV_Noosa_Solar 2.csv": "timestamp,p:s:3\n31-Mar-26 8:30 AM AEDT,1.5\n",
        "logger.csv": "g\nComX510_Green_Square,a,b,c,My Site\n-\n-\n-\n-\nLocal Time Stamp,Active energy (Wh)\n01/02/2024 00:30,1500\n",
        "RACV-Usage and Spend Report.csv": "whatever\n",
        "Meter_Data_WA (AU)_Electricity_1.csv": "Unnamed: 0,NMI,Unnamed: 2\n0,No data,\n",
        "mystery.csv": "who,knows\n1,2\n",
    }
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    (folder / "Bunnings-Usage and Spend Report.csv").write_bytes(
        bill(["B1,Mar 2026," + ",".join(["1.25"] * 23) + ",,NZD", "B1,2026," + ",".join([""] * 23) + ",,"])
    )
    return [str(folder / n) for n in [*files, "Bunnings-Usage and Spend Report.csv"]]


PAIRS = {
    "N1-E1": "p:n1",
    "Optima_7-E1": "p:u",
    "Optima_7-B1": "p:g",
    "Optima_D1-demand-kw": "p:kw",
    "Optima_D1-demand-pf": "p:pf",
    "Optima_M1-E1": "p:m1",
    "Optima_M2-E1": "p:m2",
    "GPWComX_MySite-E1": "p:cx",
    **{f"B1-{s}": f"p:b:{s}" for _, s, _ in BILLING_FIELDS},
}


def test_outcome_of_every_file(spark, folder, mapping):
    done = ingest.ingest_files(spark, landing(folder), mapping(**PAIRS))
    got = {
        r["file"].split("/")[-1].replace("%20", " "): (r["status"], r["reason"], r["rows_written"], r["unmapped_count"], r["rows_skipped"])
        for r in done.outcomes.collect()
    }
    assert got == {
        "nem.csv": ("processed", None, 1, 0, 1),
        "envelope.csv": ("processed_empty", "no_data_sentinel", 0, 0, 0),
        "usage.csv": ("processed", None, 2, 0, 3),
        "nothing.csv": ("processed_empty", "no_data_sentinel", 0, 0, 0),
        "Demand Profile 1.csv": ("processed", None, 2, 0, 2),
        "Demand_Profile_2.csv": ("processed_empty", "no_data_sentinel", 0, 0, 0),
        "water.csv": ("unmapped", None, 0, 1, 0),
        "kwh.csv": ("processed", None, 2, 0, 0),
        "RACV_Noosa_Solar 1.csv": ("processed", None, 3, 0, 0),
        "RACV_Noosa_Solar 2.csv": ("parse_failed", "parser_error", 0, 0, 0),
        "logger.csv": ("processed", None, 1, 0, 0),
        "RACV-Usage and Spend Report.csv": ("processed_external", "external_archive", 0, 0, 0),
        "Meter_Data_WA (AU)_Electricity_1.csv": ("processed_empty", "no_data_sentinel", 0, 0, 0),
        "mystery.csv": ("parse_failed", "parser_error", 0, 0, 0),
        "Bunnings-Usage and Spend Report.csv": ("processed", None, 23, 0, 1),
    }
    assert outcome.violations(done.outcomes).count() == 0
    values = {(r["sensorId"], r["ts"], r["val"], r["unit"]) for r in done.rows().collect()}
    assert ("p:cx", dt.datetime(2024, 2, 1, 0, 30), 1.5, "kwh") in values
    assert ("p:s:2", dt.datetime(2026, 3, 31, 12, 30), 4.0, "mode") in values
    assert ("p:b:billing-total-spend", dt.datetime(2026, 3, 1), 1.25, "nzd") in values
    assert ("p:pf", dt.datetime(2026, 2, 1, 0, 30), 0.88, None) in values
    audits = {r["audit_name"]: json.loads(r["value"]) for r in done.audit().collect()}
    assert audits["water.csv.skipped.json"]["unmapped_identifiers"] == [["nem12_nmi", "Envizi_1-E1"]]
    assert audits["nem.csv.skipped.json"]["unsupported_suffixes"] == ["X9"]


def test_run_writes_lake_and_snapshot(spark, folder, mapping):
    base = folder / "out"
    folder_in = folder / "in"
    folder_in.mkdir()
    table = f"{base}/lake"
    ingest.run(spark, landing(folder_in), mapping(**PAIRS), table, f"{base}/audit")
    (stats,) = snapshot.run(spark, table, mapping(**PAIRS), f"{base}/report").collect()
    assert tuple(stats) == (1, 1, 1)
    (line,) = spark.read.option("header", True).csv(f"{base}/report").collect()
    assert (line["nmi"], line["month"], line["currency"], line["total_spend"]) == ("B1", "2026-03-01", "NZD", "1.25")
    with pytest.raises(billing.EmptySnapshot):
        snapshot.run(spark, table, mapping(**PAIRS), f"{base}/report", "2030-01-01")
    assert spark.read.csv(f"{base}/report").count() > 0
    assert read_lake(spark, table, start="2026-03-01").filter(F.col("ts") < "2026-03-01").count() == 0


def lake_df(spark, rows):
    return spark.createDataFrame(rows, "sensorId string, ts timestamp_ntz, val double, unit string, quality string, ats timestamp_ntz")


def test_upsert_is_idempotent_and_delete_empties_partitions(spark, folder):
    at = dt.datetime
    path = str(folder / "lake")
    first = lake_df(spark, [("a", at(2024, 1, 1, 0, 7), 1.0, "kwh", None, at(2024, 5, 1)), ("a", at(2024, 1, 1, 0, 7), 2.0, "kwh", None, at(2024, 5, 2)), ("b", at(2023, 3, 1), 3.0, "kwh", None, at(2024, 5, 1))])
    lake.upsert_readings(spark, path, first)
    second = lake_df(spark, [("a", at(2024, 1, 1, 0, 30), 5.0, "kwh", "A", at(2024, 6, 1)), ("b", at(2023, 3, 1), 4.0, "kwh", None, at(2024, 6, 1))])
    for _ in range(2):
        lake.upsert_readings(spark, path, second)

    def content():
        return sorted((r["sensorId"], r["ts"], r["val"]) for r in spark.read.parquet(path).collect())

    assert content() == [("a", at(2024, 1, 1, 0, 7), 2.0), ("a", at(2024, 1, 1, 0, 30), 5.0), ("b", at(2023, 3, 1), 4.0)]
    sensors = spark.createDataFrame([("a",)], "sensor_id string")
    assert cadence.purge(spark, path, sensors, [2024])["deleted"] == 0
    assert cadence.purge(spark, path, sensors, [2024], dry_run=False)["deleted"] == 1
    assert content() == [("a", at(2024, 1, 1, 0, 30), 5.0), ("b", at(2023, 3, 1), 4.0)]
    lake.delete(spark, path, spark.read.parquet(path).filter("sensorId = 'b'"))
    assert content() == [("a", at(2024, 1, 1, 0, 30), 5.0)]
    lake.export_per_sensor(spark.read.parquet(path), str(folder / "per"))
    assert [p.name for p in (folder / "per").glob("sensorId=*")] == ["sensorId=a"]


def test_stream_reads_each_file_once_and_archives(spark, folder):
    source, table, done = folder / "in", folder / "lake", folder / "done"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.csv").write_text(f"sensorId,ts,val,unit,its,quality\ns{i},2024-01-0{i + 1} 00:00:00,{i},kwh,2024-01-0{i + 1} 00:00:00,\n")

    def drain():
        query = streaming.lake_rows(spark, str(source), str(table), str(folder / "cp"), max_files=2, archive=str(done))
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert drain() == 3
    (source / "late.csv").write_text("sensorId,ts,val,unit,its,quality\ns0,2024-01-01 00:00:00,9,kwh,2024-01-01 00:00:00,\n")
    drain()
    assert {(r["sensorId"], r["val"], r["quality"]) for r in spark.read.parquet(str(table)).collect()} == {("s0", 9.0, None), ("s1", 1.0, None), ("s2", 2.0, None)}
    assert any(done.rglob("*.csv"))


def test_small_sources(spark, folder):
    (folder / "map.json").write_text(json.dumps({"N1-E1": "p:a", "B-billing-total-spend": "p:b"}))
    rows = read_mapping(spark, str(folder / "map.json")).collect()
    assert {(r["lookup_key"], r["sensor_id"]) for r in rows} == {("N1-E1", "p:a"), ("B-billing-total-spend", "p:b")}
    (folder / "w.txt").write_text("# comment\n p:a \n\np:b\n")
    assert read_whitelist(spark, str(folder / "w.txt")).count() == 2
    (folder / "e.txt").write_text("# nothing\n")
    with pytest.raises(ValueError):
        read_whitelist(spark, str(folder / "e.txt"))
    assert manifest(spark, str(folder)).count() == 3


def test_vendor_file_that_looks_like_meter_data(spark, folder, mapping):
    """Serial numbers 100, 200, 250 and 300 in the first column, and meter data without an envelope."""
    for serial in (100, 200, 250, 300, 201):
        (folder / f"w{serial}.csv").write_text(f"Serial_No,Date_Time,kL\n{serial},2024-01-01T01:00:00,3\n{serial},2024-01-01T02:00:00,4\n")
    (folder / "bare.csv").write_text("200,N1,E1,1,E1,N1,S,kWh,720,\n300,20240101,1,2,A,,,,\n")
    done = ingest.ingest_files(spark, [str(p) for p in folder.glob("*.csv")], mapping(**{"N1-E1": "p:n1"}))
    got = {r["file"].split("/")[-1]: (r["status"], r["rows_skipped"], r["unmapped_count"]) for r in done.outcomes.collect()}
    like = got.pop("w201.csv")
    assert like[0] == "unmapped"
    assert got == {"bare.csv": ("processed", 0, 0), **{f"w{n}.csv": like for n in (100, 200, 250, 300)}}


def test_archives_are_whole_or_failed(spark, folder, mapping):
    text = "100,NEM12,202401010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,30,\n" + "".join(
        f"300,{dt.date(2015, 1, 1) + dt.timedelta(d):%Y%m%d},{','.join(str((d * 48 + i) % 977 / 8) for i in range(48))},A,,,,\n" for d in range(1500)
    )
    with zipfile.ZipFile(folder / "good.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", text)
    with zipfile.ZipFile(folder / "two.zip", "w") as z:
        z.writestr("a.csv", text)
        z.writestr("b.csv", text)
    good = (folder / "good.zip").read_bytes()
    late = bytearray(good)
    late[len(good) * 3 // 4] ^= 0xFF  # inside the compressed data
    (folder / "late.zip").write_bytes(bytes(late))
    flags = bytearray(good)
    flags[6] |= 1  # says that the member is encrypted, in both of its headers
    flags[good.rindex(b"PK\x01\x02") + 8] |= 1
    (folder / "locked.zip").write_bytes(bytes(flags))
    (folder / "cut.zip").write_bytes(good[: len(good) // 2])
    done = ingest.ingest_files(spark, [str(p) for p in folder.glob("*.zip")], mapping(**{"N1-E1": "p:n1"}))
    got = {r["file"].split("/")[-1]: (r["status"], r["rows_written"]) for r in done.outcomes.collect()}
    failed = ("parse_failed", 0)
    assert got == {"good.zip": ("processed", 72000), "two.zip": failed, "late.zip": failed, "locked.zip": failed, "cut.zip": failed}
    assert done.rows().count() == 72000


def test_rows_without_a_key_are_set_aside(spark, folder):
    at, path = dt.datetime, str(folder / "lake")
    for value in (1.0, 2.0):
        batch = lake_df(spark, [("a", None, value, "kwh", None, at(2024, 5, 1)), ("a", at(2024, 1, 1), value, "kwh", None, at(2024, 5, 1)), (None, at(2024, 1, 1), value, "kwh", None, at(2024, 5, 1))])
        for _ in range(2):
            assert lake.upsert_readings(spark, path, batch) == 1
    assert [(r["sensorId"], r["val"]) for r in spark.read.parquet(path).collect()] == [("a", 2.0)]
    assert sorted(r["val"] for r in spark.read.parquet(f"{path}_rejected").collect()) == [1.0, 1.0, 2.0, 2.0]
    assert lake.delete(spark, path, lake.with_partitions(lake_df(spark, [("a", None, 1.0, "kwh", None, None)]))) == 0


def test_plain_table(spark, folder):
    path = str(folder / "sites")
    for rows, count in (([("p", "s1", 1), ("p", "s2", 1)], 2), ([("p", "s2", 2), ("q", "s1", 3)], 2), ([], 0)):
        sites = spark.createDataFrame(rows, "project string, site string, v int")
        assert lake.upsert(spark, path, sites, keys=["project", "site"], partitions=[], order=["v"]) == count
    assert sorted(map(tuple, spark.read.parquet(path).select("project", "site", "v").collect())) == [("p", "s1", 1), ("p", "s2", 2), ("q", "s1", 3)]
    lake.delete(spark, path, spark.createDataFrame([("p", "s1")], "project string, site string"), keys=["project", "site"], partitions=[])
    assert spark.read.parquet(path).count() == 2
