"""What steps leave on the disk, and tables made part by part."""

import time

import pytest
from helpers import bag, flat_rows
from pyspark.sql import functions as F

from flakeform import healthcare
from flakeform.operators.constraints import constraint_report
from flakeform.operators.lookup import lookups
from flakeform.plans.batches import Batches
from flakeform.plans.normalize import HASH, normalize
from flakeform.plans.onepass import normalize_once
from flakeform.sources.csv import read_csv, write_csv
from flakeform.sources.files import exists
from flakeform.sources.staging import discard, in_part, new_folder, parts_for, parts_of, stage, stage_parts
from flakeform.sources.stored import StoredTable
from workload.queries import QUERIES
from workload.visits import visit_parts, visits

STAR = healthcare()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left_behind(spark, action, seconds=10):
    """Shuffle files that an action leaves; Spark deletes them in the background."""
    before = shuffle_files(spark)
    kept = action()  # a table that is alive cannot be collected as garbage
    until = time.monotonic() + seconds
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert kept is not None
    return left


def grouped(spark):
    return spark.range(2000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))


def test_writes_leave_no_shuffle_behind(spark, tmp_path):
    df = grouped(spark)
    assert not left_behind(spark, lambda: (df, stage(df, "grouped")))
    assert not left_behind(spark, lambda: (df, write_csv(df, str(tmp_path / "csv"))))
    table = StoredTable(spark, new_folder(spark, "stored"), "k", 2)
    assert not left_behind(spark, lambda: (df, table.replace(df)))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_parts_hold_every_row_once(spark):
    rows = [(i % 7 or None, f"v{i // 2}") for i in range(60)]
    df = stage(spark.createDataFrame(rows, "k int, v string"), "rows")
    parts = [df.filter(in_part(["k"], part, 3)) for part in range(3)]
    staged = stage_parts(parts, "parts")
    assert bag(staged) == bag(df) and staged.schema == df.schema
    assert [bag(part) for part in parts_of(staged)] == [bag(part) for part in parts]
    keys = [{row["k"] for row in part.collect()} for part in parts]
    assert sum(map(len, keys)) == 7  # equal keys, nulls too, are in one part
    folders = {name.rsplit("/", 1)[0] for name in staged.inputFiles()}
    assert parts_of(df)[0] is df and len(folders) == 3
    discard(staged)
    discard(df.limit(3))
    assert not any(exists(spark, path) for path in folders) and df.count() == 60


def test_parts_follow_the_size_of_the_chosen_columns(spark):
    df = stage(spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")), "wide")
    assert parts_for(spark.createDataFrame([(1,)], "a int"), 1) == 1
    assert parts_for(df) == 1 < parts_for(df.select("id"), 10_000) < parts_for(df, 10_000)


def write_tables(spark, folder, ids):
    """Tables of invented lines and orders, some repeated, some without a key or a partner."""
    orders = [(i, i % 3, "O", 10.0 * i, "1-URGENT") for i in [*ids, *ids[:2]]] + [(None, 1, "F", 1.0, "5-LOW")]
    lines = [(i, n % 2, 0, n, 5.0, 7.0, "N", "O") for i in [*ids, 99, None] for n in (1, 1, 2)]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
        .withColumn("o_orderdate", F.expr("timestamp_ntz'2000-01-01 00:00:00'")),
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string")
        .withColumn("l_shipdate", F.expr("timestamp_ntz'1999-01-01 00:00:00'")),
        "customer": spark.createDataFrame([(i, f"C#{i}", 1, 5.5, "BUILDING") for i in range(3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": spark.createDataFrame([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string"),
        "part": spark.createDataFrame([(i, f"p{i}", "Brand#3", "PROMO", 7, 9.5) for i in range(2)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": spark.createDataFrame([(0, "S", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def small(spark, tmp_path):
    return write_tables(spark, tmp_path, list(range(12)))


def test_visits_in_parts_are_all_visits(spark, small, monkeypatch):
    monkeypatch.setattr("workload.visits.parts_for", lambda *_: 3)
    parts = visit_parts(spark, small)
    assert len(parts) == 3 and sum((bag(part) for part in parts), bag(parts[0].limit(0))) == bag(visits(spark, small))


@pytest.mark.parametrize("name", ["fact_lookup_nullsafe_shuffled", "csv_types", "normalize_roundtrip_sequence"])
def test_queries_in_parts_equal_those_in_one(spark, small, monkeypatch, name):
    whole = bag(QUERIES[name](spark, small))
    monkeypatch.setattr("workload.visits.parts_for", lambda *_: 2)
    assert bag(QUERIES[name](spark, small)) == whole and sum(whole.values()) > 9


def test_appended_csv_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "csv")
    for start in (0, 5):
        write_csv(spark.range(start, start + 5), path, compression="gzip", append=True)
    assert bag(read_csv(spark, path, spark.range(1).schema)) == bag(spark.range(10))


def test_lookups_leave_no_shuffle_and_no_dimension_behind(spark, monkeypatch):
    monkeypatch.setattr("flakeform.operators.lookup.PART_BYTES", 600)
    rows = stage(spark.createDataFrame([(i, i % 9 or None, f"k{i % 5}") for i in range(80)], "n long, a int, b string"), "rows")
    one = stage(spark.createDataFrame([(i, f"one{i}") for i in range(8)], "a int, one string"), "one")
    two = stage(spark.createDataFrame([("k1", "two"), ("k2", None)], "b string, two string"), "two")
    want = bag(rows.join(one, "a", "left").join(two, "b", "left").select("n", "a", "b", "one", "two"))
    dims = [(one, "a", ["one"]), (two, "b", ["two"])]
    found = []
    assert not left_behind(spark, lambda: found.append(lookups(rows, "n", dims, broadcast_bytes=0, used_up=True)) or found)
    assert bag(found[0]) == want
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FileNotFound"):
        one.collect()


def test_a_counted_batch_keeps_no_changes(spark):
    folder = new_folder(spark, "batches")
    batches = Batches(spark, STAR, folder, HASH, buckets=2, checks=True)
    for number, ids in enumerate([(0, 1), (1, 2), (0, 1)]):  # the last repeats the first
        flat = flat_rows(spark, *[{"visit_id": f"v{i}", "patient_id": f"p{i}", "billing_id": f"b{i}"} for i in ids])
        batches.load(flat, str(number % 2))
        assert not exists(spark, f"{folder}/changes/{number % 2}/rows")
    every = [{"visit_id": f"v{i}", "patient_id": f"p{i}", "billing_id": f"b{i}"} for i in (0, 1, 1, 2)]
    tables = {**normalize(flat_rows(spark, *every), STAR)}
    assert bag(batches.report()) == bag(constraint_report(tables, STAR)) == bag(constraint_report(tables, STAR, stepwise=True))


def test_one_pass_in_parts_equals_one(spark):
    rows = [{"patient_id": f"p{i % 3}" if i else None, "billing_id": f"b{i}", "visit_datetime": "2021-01-01"} for i in range(9)]
    flat = flat_rows(spark, *rows, {"visit_id": "v0", "lab_order_id": "l"}, {"visit_id": "v0", "lab_order_id": "l"})
    one = normalize_once(flat.repartition(2), STAR, new_folder(spark, "one"))
    found = []
    parted = lambda: found.append(normalize_once(flat.repartition(3), STAR, new_folder(spark, "parts"), parts=3)) or found
    assert not left_behind(spark, parted)
    for name, df in one.items():
        assert bag(found[0][name]) == bag(df), name


def test_stepwise_reports_leave_no_shuffle_behind(spark):
    tables = normalize(stage(flat_rows(spark, {}, {"patient_id": None}, {"billing_id": "b2"}), "flat"), STAR)
    whole = constraint_report(tables, STAR)
    found = []
    assert not left_behind(spark, lambda: found.append(constraint_report(tables, STAR, stepwise=True)) or found)
    assert bag(found[0]) == bag(whole)
