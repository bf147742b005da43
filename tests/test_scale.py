"""Plans that must not turn with the size of their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterlake.operators import billing
from meterlake.sources.mapping import billing_reverse


def plan_of(df):
    """The plan that was run, after adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "300000")
    yield
    spark.conf.set(key, before)


def bills(spark, meters, months):
    """A lake and a map that look small until they are made: every row becomes many."""
    fields = F.explode(F.array(*[F.lit(f"billing-{m.replace('_', '-')}") for m in billing.METRICS])).alias("s")
    base = spark.range(meters).select("id", fields)
    sensor = F.concat(F.lit("p:"), "id", F.lit(":"), "s")
    mapping = base.select(F.concat(F.lit("N"), "id", F.lit("-"), "s").alias("lookup_key"), sensor.alias("sensor_id"))
    when = F.explode(F.expr(f"sequence(TIMESTAMP_NTZ'2025-01-01', TIMESTAMP_NTZ'2025-01-01' + INTERVAL '{months - 1}' MONTH, INTERVAL '1' MONTH)")).alias("ts")
    lake = base.select("id", "s", when).select(sensor.alias("sensorId"), "ts", F.col("id").cast("double").alias("val"), F.lit("aud").alias("unit"))
    return lake, mapping


def test_a_lake_that_looks_small_is_not_broadcast(spark, threshold):
    lake, mapping = bills(spark, 1000, 6)
    rows = billing.billing_rows(lake, billing_reverse(mapping))
    kept = rows.groupBy("month").count().collect()
    assert [r["count"] for r in kept] == [1000 * 23] * 6
    rows.collect()
    assert "BroadcastHashJoin" not in plan_of(rows).split("Initial Plan")[0]


def test_map_is_dealt_out_before_it_is_sorted(spark):
    _, mapping = bills(spark, 10, 1)
    plan = plan_of(billing_reverse(mapping))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_max") < plan.index("Exchange hashpartitioning")


def test_of_two_sensors_of_a_field_the_later_value_counts(spark):
    mapping = spark.createDataFrame([("N1-billing-total-usage", "p:a"), ("N1-billing-total_usage", "p:b")], "lookup_key string, sensor_id string")
    lake = spark.sql("""SELECT * FROM VALUES ('p:a', TIMESTAMP_NTZ'2025-02-01', 1.0D, 'kwh'), ('p:b', TIMESTAMP_NTZ'2025-02-01', 2.0D, 'kwh'),
      ('p:b', TIMESTAMP_NTZ'2024-02-01', 9.0D, 'kwh') AS t(sensorId, ts, val, unit)""")
    assert [tuple(r) for r in billing.billing_rows(lake, billing_reverse(mapping)).collect()] == [("N1", "2025-02-01", "total_usage", 2.0, "kwh")]


def test_sensors_are_looked_up_before_days_are_spread(spark, threshold):
    from meterlake.operators import resolve
    from meterlake.sources import nem12

    values = ",".join(str(i) for i in range(48))
    text = ["100,NEM12,202402010000,A,B", f"300,20240101,{values},A,,,,"]  # a day without a meter
    for nmi in ("N1", "N2", "p:direct"):
        text += [f"200,{nmi},E1,1,E1,N1,S,kWh,30,", f"300,20240101,{values},A,,,,", f"300,20240102,{','.join([''] * 48)},A,,,,"]
    lines = spark.createDataFrame([("f.csv", 0, i, x) for i, x in enumerate(text)], "file string, split long, pos long, line string")
    mapping = spark.createDataFrame([("N1-E1", "p:n1")], "lookup_key string, sensor_id string")
    early, late = nem12.parse_lines(lines, mapping), resolve.resolve(nem12.parse_lines(lines), mapping)
    assert early.columns == late.columns
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("_mapped")


def test_batches_of_a_drain_are_merged_once(spark, tmp_path, monkeypatch):
    import os

    from meterlake.operators import lake
    from meterlake.streaming import ingest as streaming

    source, table = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    for i in range(4):
        file = source / f"{i}.csv"
        file.write_text(f"sensorId,ts,val,unit,its,quality\na,2024-01-01 00:00:00,{i},kwh,2024-01-01 00:00:00,\ns{i},2024-02-01 00:00:00,1,kwh,2024-02-01 00:00:00,\n,2024-02-01 00:00:00,{i},kwh,2024-02-01 00:00:00,\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    merges, plain = [], lake.upsert
    monkeypatch.setattr(lake, "upsert", lambda *a, **k: merges.append(1) or plain(*a, **k))

    def drain():
        return streaming.lake_rows(spark, str(source), table, str(tmp_path / "cp"), max_files=1)

    settle = lake.settle
    monkeypatch.setattr(lake, "settle", lambda *a: 0)  # a drain that breaks off before its merge
    drain()
    assert not merges
    monkeypatch.setattr(lake, "settle", settle)
    drain()  # finds no file, and finishes the other
    assert len(merges) == 1
    rows = {(r["sensorId"], r["val"]) for r in spark.read.parquet(table).collect()}
    assert rows == {("a", 3.0), ("s0", 1.0), ("s1", 1.0), ("s2", 1.0), ("s3", 1.0)}
    assert spark.read.parquet(f"{table}_rejected").count() == 4
    assert drain().recentProgress is not None and len(merges) == 1 and not os.path.exists(f"{table}_pending")


def test_empty_cells_are_counted_or_left_out(spark):
    from meterlake.operators import outcome
    from meterlake.schemas import COUNTED, FILLED
    from meterlake.sources import nem12

    rows = [",1,, ,x,", "1,2,3,4,5,6", ",,,,,", "7,,,,,", ",,,,,8"]
    text = ["100,NEM12,202402010000,A,B", "300,20240101,1,2,A"]  # a day without a meter
    for suffix in ("E1", "X9"):
        text += [f"200,N1,E1,1,{suffix},N1,S,kWh,240,", *[f"300,2024010{i + 1},{r},A,,,," for i, r in enumerate(rows)], "300,20240109,1,A"]
    lines = spark.createDataFrame([("f.csv", 0, i, x) for i, x in enumerate(text)], "file string, split long, pos long, line string")
    each, counted = nem12.parse_lines(lines), nem12.parse_lines(lines, blanks=COUNTED)
    assert each.count() == 63 == counted.agg(F.sum("cells")).first()[0] and counted.count() < 40
    reach = [F.min("t_start"), F.max("t_end"), F.count("val")]
    by = ["file", "suffix", "column", F.to_date("t_start"), "skip_reason"]
    want = sorted(map(str, each.groupBy(*by).agg(F.count("*").alias("n"), *reach).collect()))
    assert sorted(map(str, counted.groupBy(*by).agg(F.sum("cells").alias("n"), *reach).collect())) == want
    filled = nem12.parse_lines(lines, blanks=FILLED)
    usable = F.col("val").isNotNull()
    assert sorted(map(str, filled.filter(usable).collect())) == sorted(map(str, each.filter(usable).collect()))
    assert filled.filter("trim(raw_val) = ''").count() == 2  # a blank is a text
    none = F.lit(None).cast("string")
    resolve = lambda r: outcome.file_counts(r.withColumn("sensor_id", none)).drop("file").collect()
    assert resolve(each) == resolve(counted)


@pytest.mark.parametrize("limit", [1, 5, 7, 100])
def test_samples_need_few_records(spark, mapping, limit):
    from meterlake.operators import outcome
    from meterlake.schemas import COUNTED
    from meterlake.sources import classify

    text = ["200,N1,E1,1,E1,N1,S,kWh,240,", *[f"300,202401{i:02d},1,,x,,5,6,A,,,," for i in range(1, 29)]]
    lines = spark.createDataFrame([(f, 0, i, x) for f in "ab" for i, x in enumerate(text)], "file string, split long, pos long, line string")
    records = classify.nem_records("nem", lines, mapping(**{"N1-E1": "p:1"}))
    few = outcome.sampled(records, classify.nem_readings("nem", records, COUNTED), limit)
    assert few.count() <= 2 * limit
    taken = lambda r: sorted(map(str, outcome.skip_samples(classify.nem_readings("nem", r), limit).collect()))
    assert taken(few) == taken(records)


def test_days_are_made_once_for_themselves_and_their_context(spark, threshold):
    from meterlake.workload import accounting, meter_files

    for query in (meter_files.nem12_event_overlay, accounting.run_metrics):
        df = query(spark, "/root/testdata/sf0.001")
        df.collect()
        assert "ReusedExchange" in plan_of(df).split("Initial Plan")[0]


def test_meter_records_are_not_spread_before_they_are_written(spark, tmp_path, mapping, monkeypatch):
    from meterlake.plans import ingest

    record = ["250", "N1", "11", "1", "E1", "N1", "S", "E", "1", "20240101000000", "A", "", "", "5", "20240104000000", "A", "", "", "6", "kWh", "", "", ""]
    (tmp_path / "r.csv").write_text("100,NEM13,202401010000,A,B\n" + ",".join(record) + "\n900\n")
    day = ",".join(["", "4", *[""] * 46])
    (tmp_path / "m.csv").write_text(f"100,NEM12,202401010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,30,\n300,20240101,{day},A,,,,\n900\n")
    written, plain = {}, ingest.staged
    monkeypatch.setattr(ingest, "staged", lambda df, name: written.setdefault(name, []).append(plain(df, name)) or written[name][-1])
    done = ingest.ingest_files(spark, [str(tmp_path)], mapping(**{"N1-E1": "p:n1"}))
    assert sorted(df.count() for df in written["records"]) == [1, 1]
    assert done.resolved.count() == 51 and done.rows().count() == 4 and done.samples.count() == 47
    got = {r["file"].split("/")[-1]: (r["candidate_row_count"], r["rows_written"], r["rows_skipped"]) for r in done.outcomes.collect()}
    assert got == {"r.csv": (3, 3, 0), "m.csv": (1, 1, 47)}


def test_heads_do_not_move_the_lines_of_a_file(spark):
    from meterlake.sources.lines import heads

    many = [("a", 0, i, "x" * (i % 3)) for i in range(3000)] + [("b", 0, 7 * i << 20, "y") for i in range(12)] + [("b", 1, 3, "late")]
    nul = lambda f, at, n, wide: [(f, 0, i, "\x00" if i == at else "z" * wide) for i in range(n)]
    late = nul("in", 2047, 4000, 1) + nul("out", 2048, 4000, 1) + nul("small", 1100, 1201, 0)
    lost = [("lost", 0, 0, None), *[("gap", 0, i, None if i == 4999 else "") for i in range(6000)]]
    rows = [*many, *late, *lost, ("one", 0, 5, "\x00")]
    got = heads(spark.createDataFrame(rows[::-1], "file string, split long, pos long, line string"))
    found = {r["file"]: r for r in got.collect()}
    for name, row in found.items():
        first = sorted((p, x) for f, s, p, x in rows if f == name and s == 0)[:10] if name != "lost" else [(0, None)]
        assert [*zip(row["head_pos"], row["head"], strict=True)] == first
    assert {f for f, r in found.items() if r["has_nul"]} == {"in", "small", "one"}
    assert {f for f, r in found.items() if r["unreadable"]} == {"lost"}
    assert len(found) == 8
    plain = heads(spark.range(40000).select(F.lit("f").alias("file"), F.lit(0).cast("long").alias("split"), F.col("id").alias("pos"), F.lit("x").alias("line")))
    assert "scalar-subquery" in plain._jdf.queryExecution().optimizedPlan().toString() and plain.first()["head_pos"] == list(range(10))


def test_pieces_of_a_reading_add_up(spark):
    from meterlake.operators import series

    df = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 10:00:00.5', TIMESTAMP_NTZ'2024-01-04 02:00:00.25', 64.0D),
      (TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-03', 4.0D), (TIMESTAMP_NTZ'2024-01-01 05:00:00', TIMESTAMP_NTZ'2024-01-02 05:00:00', 3.0D) AS t(t_start, t_end, val)""")
    got = sorted((str(r["t_start"]), r["val"]) for r in series.split_days(df).collect())
    assert got == [("2024-01-01 00:00:00", 2.0), ("2024-01-01 05:00:00", 3.0), ("2024-01-01 10:00:00.500000", 14.0), ("2024-01-02 00:00:00", 2.0), ("2024-01-02 00:00:00", 24.0), ("2024-01-03 00:00:00", 24.0), ("2024-01-04 00:00:00", 2.0)]
    assert sorted(r[0] for r in df.select(series.pieces()).collect()) == [1, 2, 4]


def test_a_run_goes_over_its_cells_twice(spark, tmp_path, mapping, monkeypatch):
    """Once for the counts and once for the rows; what nobody asks for is not planned."""
    from meterlake.plans import ingest
    from meterlake.sources import nem12

    values = ",".join(["", "7", *[""] * 46])
    (tmp_path / "a.csv").write_text(f"100,NEM12,202402010000,A,B\n200,N1,E1,1,E1,N1,S,kWh,30,\n300,20240101,{values},A,,,,\n200,N2,E1,1,E1,N1,S,kWh,30,\n300,20240101,{values},A,,,,\n900\n")
    (tmp_path / "empty.csv").write_text("100,NEM12,202402010000,A,B\n900\n")
    asked, plain = [], nem12.expand_days
    monkeypatch.setattr(nem12, "expand_days", lambda days, *a, **k: asked.append(a) or plain(days, *a, **k))
    outcomes = ingest.run(spark, [str(tmp_path / n) for n in ("a.csv", "empty.csv")], mapping(**{"N1-E1": "p:1"}), str(tmp_path / "lake"))
    got = {r["file"].split("/")[-1]: (r["status"], r["rows_written"], r["unmapped_count"], r["rows_skipped"]) for r in outcomes.collect()}
    assert got == {"a.csv": ("processed", 1, 1, 94), "empty.csv": ("processed_empty", 0, 0, 0)}
    assert [r["sensorId"] for r in spark.read.parquet(str(tmp_path / "lake")).collect()] == ["p:1"]
    assert asked == [("counted",), ("filled",)]


def test_no_python_worker_for_an_empty_table(spark):
    from meterlake.plans import ingest

    for empty in (ingest._nothing(spark), ingest._no_lines(spark)):
        assert "ExistingRDD" not in plan_of(empty) and empty.count() == 0
