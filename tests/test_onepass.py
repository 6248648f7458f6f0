import re
from dataclasses import replace

import pytest
from helpers import bag, flat_rows
from test_plans import STAR, plan_of, shuffles

from flakeform.plans.normalize import normalize
from flakeform.plans.onepass import normalize_once, tagged_rows
from flakeform.plans.specs import Snowflake
from flakeform.sources.staging import new_folder, stage

VISITS = [
    {"visit_datetime": "2021-01-01", "patient_zip": None},
    {"visit_datetime": "2021-01-01", "patient_zip": "9", "visit_id": "v0", "prescription_id": "r"},
    {"visit_datetime": "2021-01-01", "patient_zip": "1", "visit_id": "v0", "prescription_drug_name": "only a name"},
    {"visit_datetime": None, "patient_id": "p1", "primary_diagnosis_code": None, "doctor_name": None},
    {"visit_datetime": "2023-01-01", "patient_id": None, "insurance_id": None, "billing_id": None},
    {"visit_datetime": None, "patient_id": None, "patient_gender": "X", "room_number": None},
]


@pytest.mark.parametrize("null_safe", [False, True])
def test_equals_a_scan_for_each_table(spark, null_safe):
    flat = flat_rows(spark, *VISITS, *VISITS[:2]).repartition(3)
    once = normalize_once(flat, STAR, new_folder(spark, "once"), null_safe)
    want = normalize(flat, STAR, null_safe=null_safe)
    assert list(once) == list(want)
    for name, df in want.items():
        assert once[name].columns == df.columns and bag(once[name]) == bag(df), name


def test_no_rows(spark):
    flat = flat_rows(spark, *VISITS).limit(0)
    once = normalize_once(flat, STAR, new_folder(spark, "once"))
    assert {name: df.count() for name, df in once.items()} == dict.fromkeys(once, 0)


def test_one_scan_one_shuffle(spark):
    flat = stage(flat_rows(spark, *VISITS), "flat")
    rows = tagged_rows(flat, STAR)
    plan = plan_of(rows)
    assert len(re.findall("FileScan", plan)) == 1 and shuffles(rows) == 1
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_each_table_reads_its_own_folder(spark):
    flat = flat_rows(spark, *VISITS)
    once = normalize_once(flat, STAR, new_folder(spark, "once"))
    plan = plan_of(once["DimBilling"])
    assert "PartitionFilters: [isnotnull(_table" in plan and "patient_zip" not in plan


def test_only_keyed_rows_and_facts_are_sorted_by_a_number_first(spark):
    rows = tagged_rows(stage(flat_rows(spark, *VISITS), "flat"), STAR)
    dims = ["DimPatient", "DimInsurance", "DimBilling", "DimPrescription"]
    assert {row["_table"] for row in rows.collect()} == {*dims, "FacVisit"}  # surrogate dimensions follow from the facts
    assert set(re.findall(r"\bSort \[(\w+)#", plan_of(rows))) == {"_hash"}
    assert dict(rows.dtypes)["_parts"].startswith("struct<doctor_name") and "_tie" not in rows.columns


def test_without_surrogate_dimensions(spark):
    billing = replace(STAR.table("DimBilling"), foreign_keys=())
    star = Snowflake((billing,), replace(STAR.fact, columns=("visit_id", "billing_id"), foreign_keys=()))
    flat = flat_rows(spark, *VISITS)
    once = normalize_once(flat, star, new_folder(spark, "once"))
    for name, df in normalize(flat, star).items():
        assert bag(once[name]) == bag(df), name
