from __future__ import annotations

import gzip
import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterline import workspace
from meterline.plans import loads
from meterline.schemas import GREEN_TRIPS, HIGH_VOLUME_TRIPS, PRODUCTS_DOCUMENT, YELLOW_TRIPS, YELLOW_TRIPS_2024
from meterline.sources import connectors, files, layout
from meterline.workspace import built_once, new_dir, shared_dir

HEADER = "hvfhs_license_num,dispatching_base_num,pickup_datetime,dropoff_datetime,PULocationID,DOLocationID,SR_Flag"
LINE = "HV0003,B02682,2021-01-01 00:33:44,2021-01-01 00:49:07,230,166,"


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_stored_inputs_follow_their_files(spark, tmp_path):
    source, built = str(tmp_path / "source"), []

    def build():
        built.append(new_dir(spark, "copy"))
        spark.read.parquet(source).write.parquet(built[-1])
        return built[-1]

    spark.range(3).write.parquet(source)
    assert built_once(spark, ("test",), [source], build) == built_once(spark, ("test",), [source], build)
    spark.range(5).write.mode("overwrite").parquet(source)
    assert spark.read.parquet(built_once(spark, ("test",), [source], build)).count() == 5 and len(built) == 2


def test_release_deletes_what_was_stored(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_STORED", [])
    monkeypatch.setattr(workspace, "_BUILT", {})
    assert workspace.materialize(spark.range(3), "kept").count() == 3
    (path,) = [Path(path) for _, path in workspace._STORED]
    assert path.exists()
    workspace.release(spark)
    assert not path.exists() and workspace._STORED == []


@pytest.mark.parametrize("name", ["ctas_copy", "append_years", "elt_month_green"])
def test_queries_leave_no_table_behind(spark, name):
    from __spark_entry__ import queries

    before = {table.name for table in spark.catalog.listTables()}
    assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert {table.name for table in spark.catalog.listTables()} == before


def test_rows_of_gzip_files_are_spread(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write(HEADER + "\n" + "\n".join([LINE] * 5000) + "\n")
    read = files.read_csv(spark, str(tmp_path / "a.csv.gz"), HIGH_VOLUME_TRIPS)
    assert read.rdd.getNumPartitions() == 1
    plan = files.spread(read)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan and files.spread(read).count() == 5000


def test_csv_untyped_typed_and_gzip(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{LINE}\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(f"{HEADER}\n{LINE}\n{LINE}\n")
    untyped = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert {t for _, t in untyped.dtypes} == {"string"}
    typed = files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv.gz")], HIGH_VOLUME_TRIPS)
    assert typed.count() == 3
    assert typed.first().pickup_datetime == datetime(2021, 1, 1, 0, 33, 44) and typed.first().SR_Flag is None
    assert dict((f.name, f.dataType.simpleString()) for f in files.inferred_schema(spark, str(tmp_path / "a.csv"), 1.0))["PULocationID"] == "int"


def test_csv_ignores_columns_past_the_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,x,9\n2,y,8\nbad,z,7\n")
    from pyspark.sql.types import StructType

    schema = StructType().add("a", "integer").add("b", "string")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path), schema).collect()] == [(1, "x"), (2, "y"), (None, "z")]


def test_products_from_whole_and_from_line_documents(spark, tmp_path):
    document = {"products": [{"brand": "A", "price": 1.5, "stock": 3}, {"brand": None, "price": 2}], "total": 2}
    (tmp_path / "whole.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "lines.json").write_text(json.dumps(document) + "\n" + json.dumps(document) + "\n")
    whole = files.read_products(spark, str(tmp_path / "whole.json"), PRODUCTS_DOCUMENT, multi_line=True)
    assert [tuple(r) for r in whole.collect()] == [("A", 1.5), (None, 2.0)]
    assert files.read_products(spark, str(tmp_path / "lines.json"), PRODUCTS_DOCUMENT).count() == 4


def monthly_tree(root):
    columns = ",".join(YELLOW_TRIPS.fieldNames())
    for kind, year, month, count in (("yellow", 2020, 1, 1), ("yellow", 2020, 2, 2), ("yellow", 2021, 1, 4), ("green", 2020, 1, 8)):
        folder = root / kind / str(year) / f"{month:02d}"
        folder.mkdir(parents=True)
        line = f"1,{year}-{month:02d}-05 10:00:00,{year}-{month:02d}-05 10:10:00,1,2.5,1,N,7,8,1,10.0,0,0,0,0,0.3,10.3,0"
        (folder / f"{kind}_tripdata_{year}-{month:02d}.csv").write_text("\n".join([columns, *[line] * count]) + "\n")
    (root / "yellow" / "2020" / "01" / "notes.csv").write_text("a\n1\n")
    return f"{root}/*/*/*"


def test_monthly_files_by_type_year_and_month(spark, tmp_path):
    root = monthly_tree(tmp_path)

    def count(**choice):
        return files.read_monthly(spark, root, YELLOW_TRIPS, **choice).count()

    assert count() == 15 and count(taxi_type="yellow") == 7 and count(taxi_type="yellow", years=[2020]) == 3
    assert count(years=[2020, 2021], months=[1]) == 13
    got = files.read_monthly(spark, root, YELLOW_TRIPS, "yellow", [2020], [2]).first()
    assert (got.source_file, got.taxi_type, got.year, got.month) == ("yellow_tripdata_2020-02.csv", "yellow", 2020, 2)


def test_provenance(spark, tmp_path):
    monthly_tree(tmp_path)
    row = files.with_provenance(files.read_csv(spark, str(tmp_path / "green" / "2020" / "01"), YELLOW_TRIPS)).first()
    assert row.source_file == "green_tripdata_2020-01.csv" and row.ingestion_timestamp is not None


def test_ingest_replaces_only_the_months_it_finds(spark, tmp_path):
    root, lake = monthly_tree(tmp_path / "raw"), str(tmp_path / "lake")
    loads.ingest_months(spark, root, lake, YELLOW_TRIPS, "yellow")
    lake_df = loads.ingest_months(spark, root, lake, YELLOW_TRIPS, "yellow", years=[2020])
    got = {(r.year, r.month): r["count"] for r in lake_df.groupBy("year", "month").count().collect()}
    assert got == {(2020, 1): 1, (2020, 2): 2, (2021, 1): 4}


@pytest.mark.parametrize("warehouse, unit", [(False, "month"), (False, "day"), (True, "day")])
def test_monthly_load_is_idempotent(spark, tmp_path, warehouse, unit):
    from meterline.schemas import LANDING_YELLOW

    root, table = monthly_tree(tmp_path), f"landing_{warehouse}_{unit}".lower()
    for months in ([1], [1], [2], [1, 2]):
        loads.load_month(
            spark, table, files.monthly_glob(root, "yellow", [2020], months), LANDING_YELLOW,
            "tpep_pickup_datetime", "tpep_dropoff_datetime", warehouse, unit=unit,
        )
    loaded = spark.table(table)
    assert loaded.columns[:2] == ["unique_row_id", "filename"] and loaded.count() == 3
    assert loads.loaded_rows_like(loaded, r"yellow_tripdata_2020-\d{2}\.csv").first().n_rows == 3
    assert loaded.filter(F.col("filename").like("yellow_tripdata_2020-02%")).count() == 2
    assert dict(loaded.dtypes)["unique_row_id"] == ("binary" if warehouse else "string")
    assert loaded.columns[-1] == "pickup_period"
    assert {r.pickup_period.day for r in loaded.collect()} == ({1} if unit == "month" else {5})


def test_a_stray_date_reads_only_its_own_partition(spark, tmp_path):
    from meterline.operators import tables

    rows = spark.range(400).selectExpr("CAST(id AS STRING) AS k", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS d")
    tables.create_table(spark, "by_day", rows.schema, ["d"])
    tables.append_rows(rows, "by_day", ["d"])
    source = spark.sql("SELECT '0' AS k, DATE '2020-01-01' AS d UNION ALL SELECT 'new', DATE '2020-12-30'")
    tables.merge_into_table(spark, "by_day", source, "k", "d", ["d"])
    assert spark.table("by_day").count() == 401
    dates = [r.d for r in source.select("d").collect()]
    touched = spark.table("by_day").filter(F.col("d").isin(*dates))
    assert len({path.split("/d=")[1][:10] for path in touched.inputFiles()}) == 2
    tables.drop_table(spark, "by_day")


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    layout.write_parquet(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        layout.write_parquet(df, path)
    layout.write_parquet(df, path, "ignore")
    layout.write_parquet(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    layout.write_parquet(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 3


def test_file_counts(spark, tmp_path):
    df = spark.range(10_000)
    layout.write_in_files(df, str(tmp_path / "many"), 24)
    layout.write_single_file(df, str(tmp_path / "one"))
    sizes = layout.file_sizes(spark, str(tmp_path / "many")).first()
    on_disk = [f.stat().st_size for f in (tmp_path / "many").glob("*.parquet")]
    assert sizes.files == 24 and sizes.avg_megabytes == pytest.approx(sum(on_disk) / 24 / 2**20)
    assert layout.file_sizes(spark, str(tmp_path / "one")).first().files == 1


def test_external_view_and_listing(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    sibling = spark.newSession()
    files.external_view(sibling, "outside", str(tmp_path / "t"))
    assert sibling.sql("SELECT count(*) FROM outside").first()[0] == 5
    assert [tuple(r) for r in files.table_list(sibling, ["outside"]).collect()] == [("outside", 5)]
    assert files.table_list(sibling, ["no such table"]).collect() == []


def test_column_summary(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(files.column_summary(df), "column_name", "non_null_rows", "data_type") == [("a", 2, "int"), ("b", 1, "string")]


def test_declared_schemas():
    assert len(GREEN_TRIPS) == 20 and len(YELLOW_TRIPS) == 18 and len(YELLOW_TRIPS_2024) == 19
    assert YELLOW_TRIPS["payment_type"].dataType.simpleString() == "bigint"
    assert GREEN_TRIPS["payment_type"].dataType.simpleString() == "int"


def test_connector_options():
    options = connectors.kafka_options("broker:9092", "green-trips", "latest", 500)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"
    assert connectors.object_store_settings("gs", "/keys/a.json")["spark.hadoop.google.cloud.auth.service.account.json.keyfile"] == "/keys/a.json"


def stages_of(spark, group, run):
    """Number of stages of each job that ``run`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    return [len(tracker.getJobInfo(job).stageIds) for job in sorted(tracker.getJobIdsForGroup(group))]


def test_monthly_files_are_compressed_and_shuffled_before_columns_are_derived(spark):
    from meterline.registry import scans

    sf = "/root/testdata/sf0.001"
    parts = list(Path(scans.monthly_csv(spark, sf, "green").removeprefix("file:")).glob("file=green_tripdata_*.csv/part-*"))
    assert parts and all(part.name.endswith(".csv.gz") for part in parts)
    plan = scans.landing_rows(spark, sf, "green", by="date_trunc('MONTH', pickup_datetime)")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert "total_amount" in above and not any(name in below for name in ("total_amount", "fare_amount", "dropoff_datetime", "mta_tax"))


def test_monthly_files_go_to_the_lake_without_a_shuffle(spark, tmp_path):
    root, lake = monthly_tree(tmp_path / "raw"), str(tmp_path / "lake")
    assert set(stages_of(spark, "ingest", lambda: loads.ingest_months(spark, root, lake, YELLOW_TRIPS, "yellow"))) == {1}
    assert spark.read.parquet(lake).count() == 7


def test_a_monthly_load_shuffles_no_rows_and_compresses_its_tables(spark, tmp_path, monkeypatch):
    from meterline.operators import tables
    from meterline.schemas import LANDING_YELLOW

    root, balanced, append = monthly_tree(tmp_path / "raw"), [], tables.append_rows
    monkeypatch.setattr(tables, "append_rows", lambda df, name, by=(): (balanced.append(list(by)), append(df, name, by)))
    for unit in ("month", "day"):
        loads.load_month(
            spark, f"landed_{unit}", files.monthly_glob(root, "yellow"), LANDING_YELLOW,
            "tpep_pickup_datetime", "tpep_dropoff_datetime", path=str(tmp_path / unit), unit=unit)
        assert spark.table(f"landed_{unit}").count() == 7
        tables.drop_table(spark, f"landed_{unit}")
        assert {path.name.split(".", 1)[1] for path in (tmp_path / unit).glob("pickup_period=*/part-*")} == {"c000.zstd.parquet"}
    assert balanced == [[], ["pickup_period"]]


def test_the_task_of_a_file_reads_no_shuffled_rows(spark, tmp_path):
    for files_wanted, rows in ((3, 10_000), (4, 1)):
        path = str(tmp_path / f"in-{files_wanted}")
        df = spark.range(rows).selectExpr("id", "id AS _file", "CAST(id AS STRING) AS text")
        assert stages_of(spark, f"in-files-{files_wanted}", lambda: layout.write_in_files(df, path, files_wanted))[-1] == 1
        stored = spark.read.parquet(path)
        assert stored.columns == ["id", "_file", "text"] and sorted(r.id for r in stored.collect()) == list(range(rows))
        counts = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert len(counts) == min(files_wanted, rows) and max(counts) - min(counts) <= rows / 50


def test_messages_are_compressed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    from meterline.streaming import messages

    monkeypatch.setattr(messages, "MESSAGES_PER_FILE", 30)
    messages.write_message_files(spark.range(0, 100, 1, 1).selectExpr("CAST(id AS STRING) AS value"), str(tmp_path / "m"))
    parts = list((tmp_path / "m").glob("part-*"))
    assert len(parts) == 4 and all(part.name.endswith(".txt.gz") for part in parts)
    assert sorted(int(r.value) for r in spark.read.text(str(tmp_path / "m")).collect()) == list(range(100))
