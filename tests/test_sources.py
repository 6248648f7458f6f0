from unittest.mock import MagicMock

import pytest
from helpers import USUAL, bag, column, flat_rows, moment
from pyspark.errors import AnalysisException

from flakeform import FLAT_SCHEMA, healthcare, normalize
from flakeform.plans.job import migrate, normalize_csv
from flakeform.sources import staging
from flakeform.sources.csv import read_csv, write_csv
from flakeform.sources.jdbc import Database, Slices, append_table, key_bounds, key_ranges, read_table
from flakeform.sources.files import exists
from flakeform.sources.staging import scratch, stage
from flakeform.sources.tables import export_tables, load_tables, preview, read_parquet, write_parquet

STAR = healthcare()


def text_of(folder):
    return "".join(sorted(part.read_text() for part in folder.glob("part-*.csv")))


def test_csv_text_format(spark, tmp_path):
    rows = [(moment("2024-09-03 12:06:24.738999"), "Brown, Warren and Sons", None, 5)]
    df = spark.createDataFrame(rows, "t timestamp, name string, void string, n int")
    df = df.selectExpr("t", "name", "void", "cast(n as decimal(10,2)) n", "timestamp_ntz'2024-01-02 03:04:05' p")
    write_csv(df, str(tmp_path / "a"), single_file=True, time_zone="America/New_York")
    assert text_of(tmp_path / "a") == (
        "t,name,void,n,p\n"
        '2024-09-03T08:06:24.738-04:00,"Brown, Warren and Sons",,5.00,2024-01-02T03:04:05.000\n'
    )


def test_csv_single_sorted_file_replaces_the_old_one(spark, tmp_path):
    path = str(tmp_path / "a")
    write_csv(spark.range(3).toDF("k"), path)
    write_csv(spark.range(50).toDF("k").repartition(8), path, single_file=True, order_by="k")
    assert text_of(tmp_path / "a") == "k\n" + "".join(f"{i}\n" for i in range(50))


def test_csv_schema_applies_by_name(spark, tmp_path):
    source = tmp_path / "flat.csv"
    source.write_text('zip,days,when,extra\n02134,30.0,2024-01-02 03:04:05,x\n,soon,never,y\n"",7,,z\n')
    schema = "when timestamp_ntz, days int, zip string"
    empty = spark.createDataFrame([], schema)
    found = read_csv(spark, str(source), empty.schema)
    assert found.dtypes == empty.dtypes
    assert bag(found.select("zip", "days", "when")) == {
        ("02134", 30, moment("2024-01-02 03:04:05")): 1,
        (None, None, None): 1,
        (None, 7, None): 1,
    }


def test_csv_inference_loses_the_leading_zero(spark, tmp_path):
    source = tmp_path / "flat.csv"
    source.write_text("zip,name\n02134,a\n10001,\n")
    assert bag(read_csv(spark, str(source))) == {(2134, "a"): 1, (10001, None): 1}


def test_csv_files_must_agree_on_their_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip,name\n02134,a\n")
    (tmp_path / "b.csv").write_text("name,zip\nb,10001\n")
    schema = spark.createDataFrame([], "name string, zip string").schema
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), schema).collect()


def test_csv_keeps_spaces_unless_asked_and_line_breaks_on_request(spark, tmp_path):
    df = spark.createDataFrame([("  x ", 'two\nlines, "quoted"'), ("y", None)], "a string, b string")
    write_csv(df, str(tmp_path / "kept"))
    assert bag(read_csv(spark, str(tmp_path / "kept"), df.schema, multiline=True)) == bag(df)
    write_csv(df.select("a"), str(tmp_path / "cut"), trim=True)
    assert bag(read_csv(spark, str(tmp_path / "cut"), df.select("a").schema)) == {("x",): 1, ("y",): 1}


def test_missing_csv_is_reported(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_csv_job_equals_in_memory_tables(spark, tmp_path):
    flat = flat_rows(
        spark,
        {"visit_datetime": "2024-05-05 10:00:00", "patient_id": "p2", "lab_order_id": "l1", "lab_result_value": 9.5},
        {"visit_datetime": "2020-05-05 10:00:00", "room_number": 7},
    )
    path = str(tmp_path / "flat")
    write_csv(flat.select(*reversed(FLAT_SCHEMA.names)), path)
    from_csv = normalize_csv(spark, path, STAR)
    for name, df in normalize(flat, STAR).items():
        assert bag(from_csv[name]) == bag(df), name
    assert column(from_csv["DimPatient"], "patient_zip") == [USUAL["patient_zip"]] * 2


def test_stage_reads_back_the_same_rows_under_the_shared_folder(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, n int")
    staged = staging.stage(df, "small")
    assert bag(staged) == bag(df)
    assert staged.dtypes == df.dtypes
    shared = staging.shared_dir(spark).removeprefix("file:")
    assert all(shared in name for name in staged.inputFiles())


def test_cluster_without_shared_folder_is_refused():
    spark = MagicMock()
    spark.conf.get.return_value = None
    spark.sparkContext.getCheckpointDir.return_value = None
    spark.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(spark)
    spark.conf.get.return_value = "hdfs:///shared/"
    assert staging.shared_dir(spark) == "hdfs:///shared"


def test_tables_load_parents_first_and_read_back(spark, tmp_path):
    tables = normalize(flat_rows(spark, {}, {"patient_id": "p2"}), STAR)
    seen = []
    load_tables(tables, STAR, lambda df, name: seen.append(name))
    assert seen == STAR.load_order()
    write_parquet(tables, STAR, str(tmp_path))
    for name, df in read_parquet(spark, STAR, str(tmp_path)).items():
        assert bag(df) == bag(tables[name])


def test_migrate_hands_over_staged_rows(spark):
    tables = normalize(flat_rows(spark, {}), STAR)
    loaded = {}
    migrate(tables, STAR, lambda df, name: loaded.update({name: df}))
    assert list(loaded) == STAR.load_order()
    assert all(df.inputFiles() for df in loaded.values())


def test_export_writes_every_table_and_returns_previews(spark, tmp_path):
    tables = normalize(flat_rows(spark, *[{"billing_id": f"b{i:02d}"} for i in range(30)]), STAR)
    previews = export_tables(tables.get, STAR, str(tmp_path), single_file=True, ordered=True)
    assert set(previews) == set(tables)
    assert previews["DimBilling"].count() == 20
    lines = text_of(tmp_path / "DimBilling").splitlines()
    assert [line.split(",")[0] for line in lines] == ["billing_id", *[f"b{i:02d}" for i in range(30)]]


def test_preview(spark):
    assert preview(spark.range(50)).count() == 20
    assert preview(spark.range(50), 3).count() == 3


DATABASE = Database("jdbc:some://host/db", "org.some.Driver", "me", "secret", {"fetchsize": "1000"})


def test_jdbc_options_hide_nothing_but_the_printed_password():
    assert DATABASE.options() == {
        "url": "jdbc:some://host/db",
        "driver": "org.some.Driver",
        "user": "me",
        "password": "secret",
        "fetchsize": "1000",
    }
    assert "secret" not in repr(DATABASE)
    assert Database("u", "d").options() == {"url": "u", "driver": "d"}


def test_jdbc_scan_is_sliced_on_request():
    spark = MagicMock()
    read_table(spark, DATABASE, "FacVisit", Slices("n", "0", "99", 8))
    spark.read.format.assert_called_with("jdbc")
    options = spark.read.format.return_value.options.call_args.kwargs
    assert options == {
        **DATABASE.options(),
        "dbtable": "FacVisit",
        "partitionColumn": "n",
        "lowerBound": "0",
        "upperBound": "99",
        "numPartitions": "8",
    }


def test_jdbc_scan_by_conditions():
    spark = MagicMock()
    conditions = key_ranges("visit_id", ["8"])
    read_table(spark, DATABASE, "FacVisit", conditions)
    login = {name: value for name, value in DATABASE.options().items() if name != "url"}
    spark.read.jdbc.assert_called_with(DATABASE.url, "FacVisit", predicates=conditions, properties=login)


@pytest.mark.parametrize("bounds", [[], ["m"], ["8", "c", "4", "c"], ["it's", ""]])
def test_key_ranges_meet_every_row_once(spark, bounds):
    keys = ["", "0a", "4", "7f", "8", "c0", "it", "it's", "m", "zz", None]
    df = spark.createDataFrame([(key,) for key in keys], "k string")
    parts = [column(df.filter(condition), "k") for condition in key_ranges("k", bounds)]
    assert sorted(key or "-" for part in parts for key in part) == sorted(key or "-" for key in keys)


def test_jdbc_append_caps_connections():
    df = MagicMock()
    append_table(df, DATABASE, "FacVisit")
    df.write.format.assert_called_with("jdbc")
    options = df.write.format.return_value.options
    assert options.call_args.kwargs == {**DATABASE.options(), "dbtable": "FacVisit", "numPartitions": "4"}
    options.return_value.mode.assert_called_with("append")


def test_bounds_give_slices_of_equal_size(spark):
    keys = spark.createDataFrame([(f"k{i * 7919 % 1000:03}",) for i in range(1000)] + [(None,)] * 5 + [("k500",)] * 30, "k string")
    bounds = key_bounds(keys.repartition(4), "k", 8)
    conditions = key_ranges("k", bounds)
    sizes = [keys.filter(condition).count() for condition in conditions]
    assert len(sizes) == 8 and sum(sizes) == keys.count() and max(sizes) <= 2 * keys.count() / 8
    assert key_bounds(keys.limit(0), "k", 8) == [] and len(key_bounds(keys.filter("k = 'k500'"), "k", 4)) == 1


def test_scratch_removes_what_was_staged_in_it(spark):
    kept = stage(spark.range(3), "kept")
    with scratch(spark):
        outer = stage(spark.range(4), "outer")
        with scratch(spark):
            inner = stage(spark.range(5), "inner")
            assert inner.count() == 5
        with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FileNotFound"):
            inner.collect()
        assert outer.count() == 4
    assert kept.count() == 3 and not exists(spark, outer.inputFiles()[0].rsplit("/", 1)[0])
