"""Meter-data files, against hand-worked rows and a plain reader of our own."""

from __future__ import annotations

import datetime as dt
import io
import random
import zipfile

from pyspark.sql import functions as F

from meterlake.operators import series
from meterlake.sources import nem12, nem13
from meterlake.sources.lines import heads, numbered, read_lines, read_zipped_lines
from meterlake.workload import meter_files

KEYS = ["nmi", "suffix", "t_start", "val", "quality", "event_code", "event_desc"]


def rows(df):
    return sorted((tuple(r) for r in df.filter(F.col("t_start").isNotNull()).select(*KEYS).collect()), key=repr)


def plain_reader(text: str):
    """Second opinion: a loop over the lines of one file."""
    out, ctx, day, skipping = [], None, None, False
    for line in text.lstrip("\ufeff").split("\n"):
        cell = line.rstrip("\r").split(",")
        kind = cell[0]
        if kind == "200":
            day = None
            try:
                ctx = (cell[1], cell[4], int(cell[8]))
            except (IndexError, ValueError):
                ctx = None
        elif kind == "300":
            day = None
            if ctx is None:
                continue
            n = 1440 // ctx[2]
            try:
                start = dt.datetime.strptime(cell[1], "%Y%m%d")
            except ValueError:
                continue
            if len(cell) < n + 3:
                continue
            day = []
            for i in range(n):
                value = float(cell[2 + i]) if cell[2 + i].strip() else None
                more = (cell[n + 2 :] + ["", ""])[:3]
                day.append([ctx[0], ctx[1], start + dt.timedelta(minutes=ctx[2] * i), value, *more])
            out += day
        elif kind == "400" and day is not None:
            try:
                first, last = int(cell[1]), int(cell[2])
            except (IndexError, ValueError):
                continue
            if 1 <= first <= last <= len(day):
                for slot in day[first - 1 : last]:
                    slot[4:7] = (cell[3:] + ["", "", ""])[:3]
        elif kind == "900":
            ctx, day = None, None
    return sorted((tuple(r) for r in out), key=repr)


def day(date, n, quality="A", values=None):
    values = values or [str(i % 7) for i in range(n)]
    return ",".join(["300", date, *values, quality, "", "", "20240301120000", ""])


AWKWARD = "\n".join(
    [
        "\ufeff100,NEM12,202401010000,A,B",
        "300,20240101,1,2,A",
        "200,NMI0000001,E1,1,E1,N1,S1,kWh,30,",
        day("20240101", 48),
        "400,1,10,S14,32,est",
        "400,5,6,E52,,later",
        "400,0,3,X,,",
        "400,40,49,X,,",
        "",
        day("20240102", 40),
        "400,1,2,X,,",
        day("20241399", 48),
        day("20240103", 48, "V", [""] * 48),
        "500,O,S1,20240103000000,1.5",
        "200,NMI0000001,E1,1,Q1,N1,S1,kVArh,15,",
        day("20240101", 96, "A"),
        "900",
        day("20240104", 96),
        "100,NEM12,202401010000,A,B",
        "200,BROKEN",
        day("20240101", 48),
        "200,NMI0000002,E1,1,E1,N1,S2,kWh,5,",
        day("20240101", 288),
        "400,288,288,N,,",
    ]
)


def test_both_readers_agree_with_a_plain_loop(spark, folder):
    (folder / "a.csv").write_text(AWKWARD)
    (folder / "b.csv").write_bytes(AWKWARD.replace("\n", "\r\n").replace("NMI", "CRLF").encode())
    want = sorted(plain_reader(AWKWARD) + plain_reader(AWKWARD.replace("NMI", "CRLF")), key=repr)
    assert len(want) == 2 * (48 * 2 + 96 + 288)
    assert rows(nem12.read_nem12(spark, str(folder))) == want
    assert rows(nem12.parse_lines(read_lines(spark, str(folder)))) == want


def test_rejected_days_are_counted_not_lost(spark, folder):
    (folder / "a.csv").write_text(AWKWARD)
    bad = nem12.read_nem12(spark, str(folder)).filter(F.col("t_start").isNull())
    got = {r["skip_reason"]: r["count"] for r in bad.groupBy("skip_reason").count().collect()}
    # the third without a meter comes after a 900
    assert got == {"row_anchor_failure": 3, "row_shape_mismatch": 1, "unparseable_timestamp": 1}
    by_line = nem12.parse_lines(read_lines(spark, str(folder / "a.csv"))).filter(F.col("t_start").isNull())
    assert got == {r["skip_reason"]: r["count"] for r in by_line.groupBy("skip_reason").count().collect()}
    assert nem12.strict(nem12.read_nem12(spark, str(folder))).count() == 0


def test_context_and_events_cross_splits(spark, folder):
    """A file many splits long: context and 400 records are carried over boundaries."""
    rng = random.Random(7)
    lines = ["100,NEM12,202401010000,A,B"]
    for meter in range(6):
        lines.append(f"200,NMI{meter},E1,1,E1,N1,S,kWh,30,")
        for d in range(1, 29):
            lines.append(day(f"202402{d:02d}", 48, values=[f"{rng.random():.4f}" for _ in range(48)]))
            for _ in range(rng.choice([0, 0, 3, 40])):
                first = rng.randint(1, 48)
                lines.append(f"400,{first},{rng.randint(first, 48)},E{rng.randint(1, 99)},{rng.randint(1, 9)},x")
    text = "\n".join([*lines, "900", ""])
    (folder / "big.csv").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines_df = read_lines(spark, str(folder))
        assert lines_df.select("split").distinct().count() > 20
        want = plain_reader(text)
        assert rows(nem12.parse_lines(lines_df)) == want
        assert rows(nem12.read_nem12(spark, str(folder))) == want
        order = [r["line"] for r in numbered(lines_df).orderBy("line_no").select("line").collect()]
        assert order == text.split("\n")[:-1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_zipped_files(spark, folder):
    def archive(name, members):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for member, text in members.items():
                z.writestr(member, text)
        (folder / name).write_bytes(buf.getvalue())

    archive("one.zip", {"a.csv": AWKWARD})
    archive("two.zip", {"a.csv": AWKWARD, "b.csv": AWKWARD})
    (folder / "plain.zip").write_text(AWKWARD.replace("NMI", "TXT"))
    (folder / "broken.zip").write_bytes(b"PK\x03\x04nonsense")
    lines = read_zipped_lines(spark, str(folder), chunk=5)
    want = sorted(plain_reader(AWKWARD) + plain_reader(AWKWARD.replace("NMI", "TXT")), key=repr)
    assert rows(nem12.parse_lines(lines)) == want
    broken = {r["name"] for r in heads(lines).filter("unreadable").collect()}
    assert broken == {"two.zip", "broken.zip"}


def test_nem13(spark, folder):
    (folder / "n.csv").write_text(
        "100,NEM13,202401010000,A,B\n"
        "250,1234567890,1,1,E1,N1,METER1,E,6342.8,20031005093055,A,,,7654.9,20040107100333,E64,77,,1312.1,kWh,,,\n"
        "550,N,,A,\n900\n"
    )
    lines = read_lines(spark, str(folder))
    (r,) = nem13.parse_lines(lines).collect()
    assert (r["nmi"], r["val"], r["val_start"], r["val_end"], r["quality"]) == ("1234567890", 1312.1, 6342.8, 7654.9, "E64")
    assert (r["t_start"], r["t_end"]) == (dt.datetime(2003, 10, 5, 9, 30, 55), dt.datetime(2004, 1, 7, 10, 3, 33))
    pieces = series.split_days(nem13.parse_lines(lines)).collect()
    assert len(pieces) == 95 and abs(sum(p["val"] for p in pieces) - 1312.1) < 1e-6
    (head,) = nem13.file_headers(heads(lines)).collect()
    assert (head["version_header"], head["from_participant"]) == ("NEM13", "A")
    (transaction,) = nem13.transactions(lines).collect()
    assert (transaction["record"], transaction["previous_trans_code"], transaction["current_trans_code"]) == (550, "N", "A")


def test_energy_survives_a_new_grid(spark):
    base = dt.datetime(2024, 1, 1)
    data = [
        ("f", "N", "E1", base + dt.timedelta(minutes=5 * i), base + dt.timedelta(minutes=5 * i + 5), float(i % 5), "kWh", "S", "A", "", "")
        for i in range(600)
    ]
    ddl = "file string, nmi string, suffix string, t_start timestamp_ntz, t_end timestamp_ntz, val double, uom string, serno string, quality string, event_code string, event_desc string"
    df = spark.createDataFrame(data, ddl)
    total = sum(r[5] for r in data)
    for minutes in (1, 5, 15, 30, 60, 120):
        out = series.regrid(df, minutes)
        assert abs(out.agg(F.sum("val")).first()[0] - total) < 1e-6
        assert out.count() == 3000 // minutes


QUOTED = """100,NEM12,202401010000,A,B
200,N1,E1,1,E1,,S1,kWh,30,
300,20240101,{v},A,,,20240102000000,
"200","N2","E1","1","E1",,"S2","kWh","30",
"300",20240101,{v},A,,,20240102000000,
 300,20240102,{v},V,,,20240103000000,
 400,1,10,F14,76,
900
300,20240103,{v},A,,,20240104000000,
200,N3,E1,1,E1,,S3,kWh,30,
300,20240101,{v},A,,,20240102000000,
900
"""


def test_quoted_and_indented_records_keep_their_meter(spark, folder):
    """Both readers, every slot and marker row."""
    text = QUOTED.replace("{v}", ",".join(str(i / 10) for i in range(48)))
    (folder / "quoted.csv").write_text(text)
    columns = [*KEYS, "skip_reason"]
    every = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    by_block = every(nem12.read_nem12(spark, str(folder / "quoted.csv")))
    assert by_block == every(nem12.parse_lines(read_lines(spark, str(folder / "quoted.csv"))))
    count = lambda nmi: sum(r[0] == nmi and r[2] is not None for r in by_block)
    assert (count("N1"), count("N2"), count("N3")) == (48, 96, 48)


def test_last_entry_of_a_repeated_key_counts(spark, folder):
    from meterlake.sources.mapping import read_mapping

    (folder / "map.json").write_text('{"a": "s1", "b": "s2", "a": "s3"}')
    assert {(r.lookup_key, r.sensor_id) for r in read_mapping(spark, str(folder / "map.json")).collect()} == {("a", "s3"), ("b", "s2")}


def test_stamps_do_not_depend_on_the_session_zone(spark):
    from meterlake.functions.stamps import ISO_PATTERNS, billing_month, parse_any

    frame = spark.createDataFrame([("2024-10-06 02:30", "Mar 2026"), (" 1969-12-31 23:59:59 ", "x")], "s string, m string")
    for zone in ("Australia/Sydney", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = frame.select(parse_any(F.col("s"), ISO_PATTERNS).alias("s"), billing_month(F.col("m")).alias("m")).collect()
        assert [tuple(r) for r in got] == [(dt.datetime(2024, 10, 6, 2, 30), dt.datetime(2026, 3, 1)), (dt.datetime(1969, 12, 31, 23, 59, 59), None)]


def test_a_replayed_batch_replaces_its_audit_documents(spark, folder):
    from meterlake.operators.outcome import write_audit

    documents = spark.createDataFrame([("{}",), ("[]",)], "value string")
    for batch in ("1", "2", "1"):
        write_audit(documents, str(folder / "audit"), batch)
    assert spark.read.text(str(folder / "audit")).count() == 4


def test_the_frame_holds_every_interval_with_its_event(spark, folder):
    """Empty intervals are rows too; of overlapping 400 records the later one counts."""
    at = dt.datetime(2024, 1, 5)
    events = [  # channel E1 of a meter with 30 minutes, then one day of its B1
        (5, at.replace(minute=10), 2, "error", 1.5),
        (10, at.replace(minute=40), 2, "signup", 2.5),
        (15, at.replace(hour=23, minute=45), 2, "error", None),
        (20, at.replace(hour=12), 2, "click", 7.0),
        (6, at + dt.timedelta(days=1), 2, "click", 3.0),
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(events, schema).write.parquet(str(folder / "events.parquet"))
    frame = meter_files.reading_frame(spark, str(folder))
    assert frame.columns == ["nmi", "suffix", "serno", "t_start", "t_end", "value", "quality", "evt_code", "evt_desc"]
    values = {("E1", 0): 1.5, ("E1", 1): 2.5, ("E1", 24): 7.0, ("B1", 0): 3.0}
    error, estimate = ("E52", "89", "Metering, suspect"), ("S14", "32", "Estimate")
    marks = {("E1", 0): error, ("E1", 47): error} | {("E1", slot): estimate for slot in (1, 2, 3)}
    half = dt.timedelta(minutes=30)
    want = []
    for suffix, start in (("E1", at), ("B1", at + dt.timedelta(days=1))):
        for slot in range(48):
            begin, key = start + slot * half, (suffix, slot)
            want.append(("NMI2", suffix, "SER2", begin, begin + half, values.get(key), *marks.get(key, ("A", "", ""))))
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(want, key=repr)
