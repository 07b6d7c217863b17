import csv
import datetime as dt
import json
import threading
import time

import pytest
from conftest import frame
from test_layers import SAMPLE

from shelfmark.clock import RunClock
from shelfmark.operators.checks import not_null, unique
from shelfmark.plans import analytics, gold, reports, warehouse
from shelfmark.schemas import ENTITIES, GOLD, LEDGER_TABLE, MANIFEST_TABLE, RAW, SILVER
from shelfmark.sources import landing, weather
from shelfmark.sources.lake import Lake
from shelfmark.streaming import incremental
from shelfmark.streaming.incremental import land_new_files


def write_csv(path, columns, rows):
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, columns)
        out.writeheader()
        out.writerows(rows)


def write_all(folder, **more):
    for name, entity in ENTITIES.items():
        rows = [SAMPLE[name], *more.get(name, [])]
        write_csv(folder / entity.file, list(entity.columns) + ["Batch_ID", "Source_File"], [{**r, "Batch_ID": "old", "Source_File": "old"} for r in rows])


@pytest.fixture
def lake(spark, tmp_path, request):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"t{abs(hash(request.node.name)) % 10**8}_")


def test_full_refresh(lake, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    write_all(
        files,
        pos_transactions_lines=[{**SAMPLE["pos_transactions_lines"], "Transaction_Line_ID": "l2", "Quantity": "nan"}],
        erp_products=[{**SAMPLE["erp_products"], "Product_SKU": "p2"}],
    )
    clock = RunClock.on("2025-01-01")
    loaded = warehouse.run(lake, str(files), clock)
    assert loaded == {e.file: True for e in ENTITIES.values()}

    raw = lake.read(RAW, "pos_transactions_lines").orderBy("Raw_ID").collect()
    assert [r["Quantity"] for r in raw] == ["2", None]
    assert raw[0]["Source_File"] == "pos_transactions_lines.csv" and raw[0]["Batch_ID"].startswith("pos_transactions_lines_2025")
    manifest = landing.manifest_status(lake.read(RAW, MANIFEST_TABLE)).collect()
    assert len(manifest) == 8 and {r["Load_Status"] for r in manifest} == {"COMPLETED"}
    assert {r["Entity_Name"]: r["Row_Count"] for r in manifest}["products"] == 2

    fact = lake.read(GOLD, "fact_sales").collect()
    assert [(r["Transaction_Line_ID"], r["Sales_Month"]) for r in fact] == [("L1", 202401)]
    assert lake.count(GOLD, "dim_product") == 2
    assert {r["Product_Key"] for r in lake.read(GOLD, "dim_product").collect()} == {1, 2}
    assert lake.read(GOLD, "agg_sales_monthly").count() == 4
    assert lake.read(SILVER, "erp_stores_clean").first()["Created_TS"] == clock.run_ts
    assert warehouse.check_all(lake).filter("Failures > 0").collect() == []

    # the same day again gives the same tables, also over the older build
    before = {t: sorted(map(str, lake.read(GOLD, t).collect())) for t in ("dim_product", "fact_sales", "agg_sales_daily")}
    warehouse.run(lake, str(files), clock)
    for table, rows in before.items():
        assert sorted(map(str, lake.read(GOLD, table).collect())) == rows


def test_append_continues_ids_and_reports_failures(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    path = str(tmp_path / entity.file)
    write_csv(path, entity.columns, [SAMPLE["erp_stores"]] * 3)
    lake.create_layers()
    first, second = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    assert landing.load_file(lake, path, entity, first) and landing.load_file(lake, path, entity, second)
    ids = [r["Raw_ID"] for r in lake.read(RAW, entity.table).collect()]
    assert len(set(ids)) == 6
    assert not landing.load_file(lake, str(tmp_path / "none.csv"), entity, dt.datetime(2025, 1, 3))
    states = {r["Batch_ID"]: r["Load_Status"] for r in landing.manifest_status(lake.read(RAW, MANIFEST_TABLE)).collect()}
    assert states == {
        "erp_stores_20250101_000000": "COMPLETED", "erp_stores_20250102_000000": "COMPLETED", "erp_stores_20250103_000000": "FAILED",
    }
    assert landing.load_file(lake, path, entity, second, truncate=True) and lake.count(RAW, entity.table) == 3
    assert landing.load_file(lake, path, entity, first) and lake.count(RAW, entity.table) == 6
    assert lake.query(f"SELECT count(*) FROM {lake.name(RAW, entity.table)}").first()[0] == 6


def test_a_failed_build_keeps_the_old_table(lake, spark):
    lake.create_layers()
    lake.refresh(GOLD, "t", spark.range(3))
    broken = spark.range(3).selectExpr("CAST(raise_error('stop') AS INT) AS id")
    with pytest.raises(Exception):
        lake.refresh(GOLD, "t", broken)
    assert lake.count(GOLD, "t") == 3


def test_weather_file_may_name_the_store(lake, tmp_path, spark):
    entity = ENTITIES["api_weather"]
    path = str(tmp_path / entity.file)
    row = {"Weather_Date": "2024-01-01", "Store_ID": "S1", "Temperature_C": "None", "Precipitation_mm": "1", "Weather_Condition": "Clear"}
    write_csv(path, list(row), [row])
    raw = landing.to_raw(landing.read_csv_text(spark, path, entity), entity, "b", dt.datetime(2025, 1, 1))
    got = raw.first()
    assert (got["Retail_Location_ID"], got["Temperature_C"], got["Source_File"]) == ("S1", None, entity.file)
    with pytest.raises(KeyError):
        landing.entity_for("other.csv")


def test_payloads_to_weather_file(spark, tmp_path):
    payload = {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_mean": [20.5, None], "precipitation_sum": [0.0, 1.5], "weathercode": [95, 7]}}
    days = weather.daily_rows(frame(spark, "Store_ID string, payload string", ("S1", json.dumps(payload))))
    rows = weather.raw_weather(days, "b", "api_weather.csv")
    assert [tuple(r)[:5] for r in rows.orderBy("Weather_Date").collect()] == [
        ("2024-01-01", "S1", 20.5, 0.0, "Thunderstorm"), ("2024-01-02", "S1", None, 1.5, "Unknown"),
    ]
    assert tuple(weather.load_profile(days).first()) == (2, "2024-01-01", "2024-01-02", 1, 1)
    weather.write_csv(rows, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_new_files_only(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    folder = tmp_path / "drop"
    folder.mkdir()
    lake.create_layers()
    for day, expected in ((1, 2), (2, 4)):
        write_csv(folder / f"{day}.csv", entity.columns, [SAMPLE["erp_stores"]] * 2)
        land_new_files(lake, str(folder), entity, str(tmp_path / "check"), dt.datetime(2025, 1, day))
        assert lake.count(RAW, entity.table) == expected
    assert lake.read(RAW, entity.table).select("Batch_ID").distinct().count() == 2
    assert lake.read(RAW, entity.table).select("Raw_ID").distinct().count() == 4


def test_reports_on_empty_and_mismatched_tables(spark):
    staged = {"a": frame(spark, "DQ_Is_Valid int", (1,), (0,)), "b": frame(spark, "DQ_Is_Valid int", (1,)).filter("false")}
    raw = {"a": spark.range(2), "b": spark.range(1)}
    counts = reports.reconciliation(raw, staged)
    got = {r["Table_Name"]: tuple(r)[1:] for r in counts.collect()}
    assert got["a"][:4] == (2, 2, "MATCH", 1) and float(got["a"][4]) == 50.0
    assert got["b"][:4] == (1, 0, "MISMATCH", 0) and got["b"][4] is None
    assert [r[0] for r in reports.empty_tables(counts).collect()] == ["b"]
    assert [tuple(r) for r in reports.mismatched_tables(counts).collect()] == [("b", 1, 0)]
    assert reports.quality_status(counts).first()["Status"] == "NEEDS ATTENTION"
    for valid, status in ((95, "EXCELLENT"), (85, "GOOD"), (84, "NEEDS ATTENTION")):
        one = frame(spark, "Table_Name string, Raw_Count long, Staging_Count long, Valid_Count long", ("x", 100, 100, valid))
        assert reports.quality_status(one).first()["Status"] == status


def test_samples(raw):
    sky = raw("api_weather", [SAMPLE["api_weather"], {**SAMPLE["api_weather"], "Temperature_C": None}])
    assert reports.missing_temperature_sample(sky).count() == 1
    assert reports.dirty_header_sample(raw("pos_transactions_header", [SAMPLE["pos_transactions_header"]] * 7)).count() == 5


def test_quoted_csv_text(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    path = str(tmp_path / entity.file)
    rows = [
        {**SAMPLE["erp_stores"], "Store_ID": "S1", "Store_Name": 'The "Big" one, north', "City": "two\nlines"},
        {**SAMPLE["erp_stores"], "Store_ID": "S2", "Store_Manager": "NA", "Region": "n/a", "City": "null"},
    ]
    write_csv(path, list(entity.columns)[::-1], rows)
    lake.create_layers()
    assert landing.load_file(lake, path, entity, dt.datetime(2025, 1, 1))
    got = {r["Store_ID"]: r for r in lake.read(RAW, entity.table).collect()}
    assert got["S1"]["Store_Name"] == 'The "Big" one, north' and got["S1"]["City"] == "two\nlines"
    assert got["S2"]["Store_Manager"] is None and got["S2"]["Region"] is None and got["S2"]["City"] is None


def test_a_broken_record_fails_the_load_with_its_whole_error(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    path = tmp_path / entity.file
    path.write_text(",".join(entity.columns) + "\na,b\n")
    lake.create_layers()
    assert not landing.load_file(lake, str(path), entity, dt.datetime(2025, 1, 1))
    errors = [r["Error_Message"] for r in lake.read(RAW, MANIFEST_TABLE).collect() if r["Error_Message"]]
    assert len(errors) == 1 and len(errors[0].split("\n")) > 1


def test_nothing_is_published_after_a_failed_load(lake, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    write_all(files)
    warehouse.run(lake, str(files), RunClock.on("2025-01-01"))
    before = sorted(map(str, lake.read(GOLD, "fact_sales").collect()))
    report = {(r["Table_Name"], r["Check_Name"]): r["Failures"] for r in lake.read(GOLD, "quality_report").collect()}
    assert report["fact_sales", "least_rows"] == 1 and len(report) > 50
    write_all(files, pos_transactions_lines=[{**SAMPLE["pos_transactions_lines"], "Transaction_Line_ID": "l9"}])
    (files / "pos_transactions_header.csv").write_text("broken\n1\n")
    with pytest.raises(warehouse.LoadFailed) as failure:
        warehouse.run(lake, str(files), RunClock.on("2025-01-02"))
    assert failure.value.loaded["pos_transactions_header.csv"] is False and failure.value.loaded["erp_stores.csv"]
    assert sorted(map(str, lake.read(GOLD, "fact_sales").collect())) == before


def test_streamed_files_keep_their_name_and_have_a_manifest(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    folder = tmp_path / "drop"
    folder.mkdir()
    lake.create_layers()
    write_csv(folder / "a.csv", entity.columns, [SAMPLE["erp_stores"]] * 2)
    land_new_files(lake, str(folder), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 1))
    assert [r["Source_File"] for r in lake.read(RAW, entity.table).collect()] == ["a.csv"] * 2
    assert [(r["Row_Count"], r["Load_Status"]) for r in lake.read(RAW, MANIFEST_TABLE).collect()] == [(2, "COMPLETED")]
    # the same batch again, as after a failure before its commit
    land_new_files(lake, str(folder), entity, str(tmp_path / "another"), dt.datetime(2025, 1, 2))
    assert lake.count(RAW, entity.table) == 2
    # columns in another order fail instead of being read wrongly
    write_csv(folder / "b.csv", list(entity.columns)[::-1], [SAMPLE["erp_stores"]])
    with pytest.raises(Exception):
        land_new_files(lake, str(folder), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 3))
    assert lake.count(RAW, entity.table) == 2


def test_streams_of_other_folders_and_checkpoints_lose_no_file(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    lake.create_layers()
    for i, (folder, name) in enumerate([("one", "a.csv"), ("two", "a.csv"), ("two", "b.csv")]):
        (tmp_path / folder).mkdir(exist_ok=True)
        write_csv(tmp_path / folder / name, entity.columns, [SAMPLE["erp_stores"]] * (i + 2))
        # a checkpoint of its own each time: every stream starts at its first batch
        land_new_files(lake, str(tmp_path / folder), entity, str(tmp_path / f"check{i}"), dt.datetime(2025, 1, 1 + i))
    raw = lake.read(RAW, entity.table).collect()
    assert sorted(r["Source_File"] for r in raw) == ["a.csv"] * 5 + ["b.csv"] * 4
    assert len({r["Raw_ID"] for r in raw}) == 9
    rows = {r["Batch_ID"]: r["Row_Count"] for r in lake.read(RAW, MANIFEST_TABLE).collect()}
    assert sorted(rows.values()) == [2, 3, 4]


# --- many files and large ones ---


def part_files(folder, entity, parts, rows, **more):
    folder.mkdir()
    for i in range(parts):
        write_csv(folder / f"part {i:05}.csv", entity.columns, [{**SAMPLE[entity.table], "Store_ID": f"S{i}-{j}", **more.get(str(i), {})} for j in range(rows)])


def test_a_folder_of_parts_is_read_by_as_many_tasks(lake, spark, tmp_path):
    entity = ENTITIES["erp_stores"]
    part_files(tmp_path / "parts", entity, 20, 3)
    spark.conf.set("spark.sql.files.openCostInBytes", "200m")
    try:
        df = landing.read_csv_text(spark, str(tmp_path / "parts"), entity)
        assert df.rdd.getNumPartitions() == 20
        assert "multiLine" not in df._jdf.queryExecution().toString() and landing.files_with_open_quotes(spark, str(tmp_path / "parts")) == []
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # the same rows as one file, by folder or by pattern
    write_csv(tmp_path / "one.csv", entity.columns, [{**SAMPLE["erp_stores"], "Store_ID": f"S{i}-{j}"} for i in range(20) for j in range(3)])
    whole = sorted(map(str, landing.read_csv_text(spark, str(tmp_path / "one.csv"), entity).select(*entity.columns).collect()))
    for path in ("parts", "parts/part*.csv"):
        assert sorted(map(str, landing.read_csv_text(spark, str(tmp_path / path), entity).select(*entity.columns).collect())) == whole
    lake.create_layers()
    assert landing.load_all(lake, "", dt.datetime(2025, 1, 1), files={entity.file: str(tmp_path / "parts")}) == {entity.file: True}
    raw = lake.read(RAW, entity.table).collect()
    assert len(raw) == len({r["Raw_ID"] for r in raw}) == 60
    assert {r["Source_File"] for r in raw} == {f"part {i:05}.csv" for i in range(20)}


def test_a_large_file_is_split_and_its_ids_follow_its_order(lake, spark, tmp_path):
    entity = ENTITIES["erp_stores"]
    write_csv(tmp_path / "one.csv", entity.columns, [{**SAMPLE["erp_stores"], "Store_ID": str(i)} for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        raw = landing.to_raw(landing.read_csv_text(spark, str(tmp_path / "one.csv"), entity), entity, "b", dt.datetime(2025, 1, 1), load=3)
        assert raw.rdd.getNumPartitions() > 5
        assert [int(r["Store_ID"]) for r in raw.orderBy("Raw_ID").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("most", [1000, 1])
def test_line_breaks_in_quotes_are_read_whole(spark, tmp_path, most):
    entity = ENTITIES["erp_stores"]
    part_files(tmp_path / "parts", entity, 6, 2, **{"2": {"City": 'two\nlines, "quoted"'}, "4": {"City": "three\n\nlines"}, "5": {"City": 'in "quotes"'}})
    broken = landing.files_with_open_quotes(spark, str(tmp_path / "parts"), most)
    assert broken is None if most == 1 else sorted(b[-9:-4] for b in broken) == ["00002", "00004"]
    got = landing.read_csv_text(spark, str(tmp_path / "parts"), entity, most=most).collect()
    assert len(got) == 12
    cities = {r["Source_File"][5:10]: r["City"] for r in got}
    assert (cities["00002"], cities["00004"], cities["00005"]) == ('two\nlines, "quoted"', "three\n\nlines", 'in "quotes"')


def test_a_part_with_other_columns_fails(lake, tmp_path):
    entity = ENTITIES["erp_stores"]
    part_files(tmp_path / "parts", entity, 2, 1)
    write_csv(tmp_path / "parts" / "x.csv", list(entity.columns)[::-1], [SAMPLE["erp_stores"]])
    lake.create_layers()
    assert not landing.load_file(lake, str(tmp_path / "parts"), entity, dt.datetime(2025, 1, 1))


def test_ids_grow_over_many_loads(lake, spark, tmp_path):
    entity = ENTITIES["erp_stores"]
    write_csv(tmp_path / "a.csv", entity.columns, [SAMPLE["erp_stores"]] * 2)
    lake.create_layers()
    day = dt.datetime(2025, 1, 1)
    assert landing.load_file(lake, str(tmp_path / "a.csv"), entity, day)
    # 9,999 loads later, in the same second: the later row still wins
    lake.append(RAW, MANIFEST_TABLE, landing.manifest_row(spark, entity, "b", 0, day, day, "COMPLETED", None, 9_999))
    write_csv(tmp_path / "a.csv", entity.columns, [{**SAMPLE["erp_stores"], "Store_Name": "new"}])
    assert landing.load_file(lake, str(tmp_path / "a.csv"), entity, day)
    raw = lake.read(RAW, entity.table).orderBy("Raw_ID").collect()
    assert [r["Raw_ID"] >> landing.PLACE_BITS for r in raw] == [1, 1, 10_000] and raw[-1]["Store_Name"] == "new"
    from shelfmark.operators.dedupe import keep_latest
    from shelfmark.plans.silver import NEWEST

    assert keep_latest(lake.read(RAW, entity.table), ["Store_ID"], NEWEST).first()["Store_Name"] == "new"
    # loads of one second are told apart
    done = [r for r in landing.manifest_status(lake.read(RAW, MANIFEST_TABLE)).collect() if r["Batch_ID"] == "erp_stores_20250101_000000"]
    assert sorted((r["Load_Number"], r["Row_Count"], r["Load_Status"]) for r in done) == [(1, 2, "COMPLETED"), (10_000, 1, "COMPLETED")]
    stored = lake.read(RAW, MANIFEST_TABLE).where("Load_Status = 'COMPLETED'").collect()
    assert all(r["Duration_Seconds"] >= 0 and r["Created_TS"] for r in stored)
    with pytest.raises(OverflowError):
        landing.row_id(landing.MOST_LOADS, 1)


def test_a_repeat_after_a_failure_stores_nothing_twice(lake, spark, tmp_path, monkeypatch):
    entity = ENTITIES["erp_stores"]
    part_files(tmp_path / "drop", entity, 5, 2)
    lake.create_layers()
    enter, fails = incremental._enter, []

    def broken(own, files, entity, load, status, day):
        if status == "COMPLETED" and not fails:
            fails.append(1)
            raise RuntimeError("stopped between the rows and the ledger")
        enter(own, files, entity, load, status, day)

    monkeypatch.setattr(incremental, "_enter", broken)
    with pytest.raises(Exception):
        land_new_files(lake, str(tmp_path / "drop"), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 1))
    spark.catalog.refreshTable(lake.name(RAW, entity.table))
    assert lake.count(RAW, entity.table) == 10
    # the same batch again, then a new file, then all again with another checkpoint
    land_new_files(lake, str(tmp_path / "drop"), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 1))
    write_csv(tmp_path / "drop" / "z.csv", entity.columns, [SAMPLE["erp_stores"]] * 3)
    land_new_files(lake, str(tmp_path / "drop"), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 2))
    land_new_files(lake, str(tmp_path / "drop"), entity, str(tmp_path / "other"), dt.datetime(2025, 1, 3))
    raw = lake.read(RAW, entity.table).collect()
    assert len(raw) == len({r["Raw_ID"] for r in raw}) == 13
    ledger = lake.read(RAW, LEDGER_TABLE).where("Load_Status = 'COMPLETED'").collect()
    assert sorted(r["Row_Count"] for r in ledger) == [2] * 5 + [3] and len({r["Batch_ID"] for r in ledger}) == 6


def test_landing_sends_no_row_per_file_to_the_driver(lake, tmp_path, monkeypatch):
    entity = ENTITIES["erp_stores"]
    part_files(tmp_path / "drop", entity, 60, 1)
    lake.create_layers()
    frame_class, sent = type(lake.spark.range(1)), []
    collect = frame_class.collect
    monkeypatch.setattr(frame_class, "collect", lambda df: sent.append(collect(df)) or sent[-1])
    land_new_files(lake, str(tmp_path / "drop"), entity, str(tmp_path / "check"), dt.datetime(2025, 1, 1))
    assert max(map(len, sent), default=0) <= 1
    monkeypatch.undo()
    assert lake.count(RAW, entity.table) == 60 and lake.read(RAW, MANIFEST_TABLE).count() == 60


# --- stored tables ---


def test_readers_never_fail_during_a_refresh(lake, spark):
    lake.create_layers()
    for options in ({"partition_by": ["m"]}, {"bucket_by": (3, "id")}, {}):
        name = f"t{len(options)}{''.join(options)}"
        lake.refresh(GOLD, name, spark.range(40).selectExpr("id", "id % 4 AS m"), **options)
        stop, seen, failed = threading.Event(), [], []

        def read(name=name, stop=stop, seen=seen, failed=failed):
            while not stop.is_set():
                try:
                    seen.append(lake.read(GOLD, name).count())
                except Exception as problem:
                    failed.append(problem)

        reader = threading.Thread(target=read)
        reader.start()
        for build in range(1, 5):
            lake.refresh(GOLD, name, spark.range(40 + build).selectExpr("id", "id % 4 AS m"), **options)
        stop.set()
        reader.join()
        assert not failed and set(seen) <= set(range(40, 45)) and lake.count(GOLD, name) == 44


def test_a_refreshed_view_is_changed_in_place(lake, spark):
    lake.create_layers()
    made = []
    for build, columns in enumerate((["id", "m"], ["id", "m"], ["id", "m", "n"])):
        rows = spark.range(4 + build).selectExpr("id", "id % 2 AS m", "id AS n").select(*columns)
        assert sorted(lake.refresh(GOLD, "kept", rows, ["m"]).columns) == columns and lake.count(GOLD, "kept") == 4 + build
        name = spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier("kept", spark._jvm.scala.Option.apply(lake.database(GOLD)))
        made.append(spark._jsparkSession.sessionState().catalog().getTableMetadata(name).createTime())
        time.sleep(0.01)
    # a view that is dropped and made anew is missing in between
    assert len(set(made)) == 1


def test_old_builds_go_by_retention(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "keep_", keep=2)
    lake.create_layers()
    for i in range(4):
        lake.refresh(GOLD, "plain", spark.range(i + 1))
        lake.refresh(GOLD, "parted", spark.range(i + 1).selectExpr("id", "id % 2 AS m"), partition_by=["m"])
    for table in ("plain", "parted"):
        assert len(list((tmp_path / "lake" / "gold" / table).iterdir())) == 2 and lake.count(GOLD, table) == 4
    assert len(lake._builds(GOLD, "parted")) == 2
    with pytest.raises(ValueError):
        Lake(spark, str(tmp_path), keep=0)


def test_replaced_partitions_leave_the_others_alone(lake, spark):
    lake.create_layers()
    lake.refresh(GOLD, "t", spark.range(12).selectExpr("id", "CAST(id % 4 AS INT) AS m"), partition_by=["m"])
    files = {r["m"]: r["f"] for r in lake.read(GOLD, "t").selectExpr("m", "input_file_name() AS f").collect()}
    lake.replace_partitions(GOLD, "t", spark.range(100, 103).selectExpr("id", "CAST(IF(id = 102, 9, 1) AS INT) AS m"), "m", [1, 2, 9])
    got = lake.read(GOLD, "t").selectExpr("id", "m", "input_file_name() AS f").collect()
    assert sorted((r["m"], r["id"]) for r in got) == [(0, 0), (0, 4), (0, 8), (1, 100), (1, 101), (3, 3), (3, 7), (3, 11), (9, 102)]
    assert all(r["f"] == files[r["m"]] for r in got if r["m"] in (0, 3))


def test_enforced_tables(lake, spark):
    lake.create_layers()
    rules = [*not_null("a"), unique("k")]
    df = frame(spark, "k int, a string, n int", (1, "x", 1), (1, "y", 2), (2, None, 3), (2, "z", 4))
    kept = lake.enforce(SILVER, "t", df, rules, ["n"])
    assert kept.columns == df.columns and sorted(r["n"] for r in kept.collect()) == [1, 4]
    assert {r["n"]: r["Violated_Rules"] for r in lake.read(SILVER, "t_quarantine").collect()} == {2: ["unique(k)"], 3: ["not_null(a)"]}
    lake.enforce(SILVER, "t", df.filter("n = 1"), rules, ["n"])
    assert lake.count(SILVER, "t") == 1 and lake.count(SILVER, "t_quarantine") == 0
    lake.enforce(SILVER, "t", df.limit(0), rules, ["n"])
    assert lake.count(SILVER, "t") == lake.count(SILVER, "t_quarantine") == 0


def test_months_of_a_new_load_alone_are_rebuilt(lake, spark, tmp_path):
    header, line = SAMPLE["pos_transactions_header"], SAMPLE["pos_transactions_lines"]

    def sold(n, month, quantity):
        day = f"2024-{month:02}-05"
        head = {**header, "Transaction_ID": f"t{n}", "Transaction_Date": day, "Transaction_TS": f"{day} 10:00:00"}
        return head, {**line, "Transaction_ID": f"t{n}", "Transaction_Line_ID": f"l{n}", "Quantity": str(quantity)}

    def load(folder, sales):
        folder.mkdir()
        write_all(folder, pos_transactions_header=[h for h, _ in sales], pos_transactions_lines=[x for _, x in sales])

    load(tmp_path / "one", [sold(n, 1 + n % 5, 1) for n in range(2, 12)])
    first, second = RunClock.on("2025-01-01"), RunClock.on("2025-01-02")
    warehouse.run(lake, str(tmp_path / "one"), first, truncate=False)
    keys = {r["Product_SKU"]: r["Product_Key"] for r in lake.read(GOLD, "dim_product").collect()}
    tables = ("fact_sales", "agg_sales_daily", "agg_sales_monthly", "agg_product_performance")

    def folders(table):
        found = lake.read(GOLD, table).selectExpr("Sales_Month", "input_file_name() AS f").collect()
        return {r["Sales_Month"]: r["f"].rsplit("/", 1)[0] for r in found}

    before = {t: folders(t) for t in tables}
    # one sale moves from February to July, one is new in March; the sample's own row comes again as it was
    (tmp_path / "two").mkdir()
    moved, added = sold(6, 7, 2), sold(50, 3, 4)
    for name, rows in (("pos_transactions_header", [moved[0], added[0]]), ("pos_transactions_lines", [moved[1], added[1]])):
        write_csv(tmp_path / "two" / f"{name}.csv", ENTITIES[name].columns, rows)
        assert landing.load_file(lake, str(tmp_path / "two" / f"{name}.csv"), ENTITIES[name], second.run_ts)
    warehouse.stage_all(lake, second)
    warehouse.refine_all(lake, second)
    batches = [landing.batch_id(e.source, e.entity, second.run_ts) for e in (ENTITIES[t] for t in warehouse.BUCKETED)]
    assert warehouse.publish_loads(lake, batches, second) == [202402, 202403, 202407]

    def content(table):
        return sorted(map(str, lake.read(GOLD, table).drop("Created_TS", "Updated_TS").collect()))

    partly = {t: content(t) for t in tables}
    for table in tables:
        now = folders(table)
        assert {m for m in now if now[m] != before[table].get(m)} == {202402, 202403, 202407}
    assert warehouse.publish_loads(lake, ["none"], second) == []
    warehouse.publish_all(lake, second)
    warehouse.aggregate_all(lake, second)
    assert {t: content(t) for t in tables} == partly
    assert {r["Product_SKU"]: r["Product_Key"] for r in lake.read(GOLD, "dim_product").collect()} == keys


def test_stored_headers_and_lines_meet_without_a_shuffle(lake, spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    write_all(files)
    clock = RunClock.on("2025-01-01")
    warehouse.run(lake, str(files), clock)
    headers, lines = (lake.read(SILVER, warehouse.silver_name(t)) for t in warehouse.BUCKETED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (gold.fact_sales(lines, headers, clock), analytics.header_against_lines(headers, lines)):
            assert df.count() == 1
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
