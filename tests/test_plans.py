"""Physical plans: what is shuffled, read and pushed down."""

import re

import pytest
from pyspark.sql import functions as F

from flakeform import healthcare
from flakeform.operators.constraints import constraint_report, orphans
from flakeform.operators.lookup import lookup
from flakeform.operators.profile import global_length, overlong_samples
from flakeform.operators.status import entity_status
from flakeform.plans.normalize import fact_with_hashes, natural_dim, normalize, surrogate_dim
from flakeform.plans.specs import NaturalDim
from flakeform.sources.staging import stage
from workload.visits import visits

STAR = healthcare()
SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"^\W*Exchange (?:hash|range|Single)", plan_of(df), re.MULTILINE))


def read_columns(df):
    return {name for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df)) for name in schema.split(",")}


@pytest.fixture(scope="module")
def flat(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield stage(visits(spark, SF_DIR), "visits")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_hash_fact_is_one_pruned_scan(flat):
    fact = fact_with_hashes(flat, STAR)
    assert "Exchange" not in plan_of(fact)
    assert "Join" not in plan_of(fact)
    read = {name.split(":")[0] for name in read_columns(fact)}
    assert len(read) == 19
    assert not any(name.startswith("patient_") for name in read - {"patient_id"})


@pytest.mark.parametrize("spec", STAR.dims, ids=lambda spec: spec.name)
def test_every_dimension_is_one_shuffle_over_its_own_columns(flat, spec):
    dim = natural_dim(flat, spec) if isinstance(spec, NaturalDim) else surrogate_dim(flat, spec)
    assert shuffles(dim) == 1
    helpers = {"visit_datetime", "visit_id"} if isinstance(spec, NaturalDim) else set()
    read = {name.split(":")[0] for name in read_columns(dim)}
    assert read == {field.name for field in spec.fields} | helpers


def test_coded_diagnoses_are_filtered_in_the_scan(flat):
    plan = plan_of(surrogate_dim(flat, STAR.table("DimPrimaryDiagnosis")))
    assert "PushedFilters: [IsNotNull(primary_diagnosis_code)]" in plan


def test_status_is_combined_before_its_only_shuffle(flat):
    status = entity_status(flat, "patient_id", "visit_datetime", "status")
    assert shuffles(status) == 1
    assert "partial_max" in plan_of(status)


def test_profile_shuffles_one_row_per_partition(flat):
    assert shuffles(global_length(flat)) == 1
    assert "SinglePartition" in plan_of(global_length(flat))


def test_samples_of_all_columns_take_one_scan_and_are_limited_before_the_shuffle(flat):
    samples = overlong_samples(flat.select("visit_id", "visit_type"), "visit_id", limit=3)
    plan = plan_of(samples)
    assert plan.count("FileScan") == 1 and shuffles(samples) == 1
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_shuffled_lookup_is_a_merge_join(conf, flat):
    conf(autoBroadcastJoinThreshold="-1")
    spec = STAR.table("DimProvider")
    dim = stage(surrogate_dim(flat, spec), "provider")
    plan = plan_of(lookup(flat, dim, spec.natural_key, ["provider_id"], broadcast_bytes=0))
    assert plan.count("SortMergeJoin") == 1 and "ShuffledHashJoin" not in plan


def test_reference_check_shuffles_each_side_once(conf, flat):
    conf(autoBroadcastJoinThreshold="-1")
    lost = orphans(flat, "patient_id", flat.filter(F.col("patient_id") > "5"), "patient_id")
    assert shuffles(lost) == 2


def test_report_shuffles_all_keys_once(flat):
    tables = normalize(flat, STAR)
    report = constraint_report(tables, STAR)
    assert shuffles(report) == sum(map(shuffles, tables.values())) + 2
