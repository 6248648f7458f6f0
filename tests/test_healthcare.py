import re
from datetime import date
from decimal import Decimal

import pytest
from helpers import bag, column, flat_rows

from flakeform import FLAT_SCHEMA, healthcare, normalize
from flakeform.plans.normalize import HASH, SEQUENCE, surrogate_dim

STAR = healthcare()


def test_flat_schema_and_table_columns(spark):
    assert len(FLAT_SCHEMA) == len(set(FLAT_SCHEMA.names)) == 47
    tables = normalize(flat_rows(spark, {}), STAR)
    assert len(tables) == 11
    used = {name for df in tables.values() for name in df.columns}
    assert set(FLAT_SCHEMA.names) <= used
    for spec in STAR.tables:
        assert tables[spec.name].columns[0] == spec.primary_key


def test_hash_mode_runs_nothing(spark):
    flat = flat_rows(spark, {})
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    normalize(flat, STAR)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


def test_unknown_key_mode_is_refused(spark):
    with pytest.raises(ValueError, match="keys must be"):
        normalize(flat_rows(spark, {}), STAR, "random")


@pytest.mark.parametrize(
    ("visits", "status"),
    [
        (["2021-12-31 23:59:59"], "inactive"),
        (["2022-01-01 00:00:00"], "active"),
        (["2020-05-05 08:00:00", "2022-03-03 09:00:00", None], "active"),
        ([None, None], "active"),
    ],
)
def test_patient_status(spark, visits, status):
    flat = flat_rows(spark, *[{"visit_datetime": visit} for visit in visits])
    assert column(normalize(flat, STAR)["DimPatient"], "patient_status") == [status]


def test_patient_without_id_is_inactive_and_cutoff_can_move(spark):
    flat = flat_rows(spark, {"patient_id": None, "visit_datetime": "2025-01-01"}, {"visit_datetime": "2025-01-01"})
    status = {row["patient_id"]: row["patient_status"] for row in normalize(flat, STAR)["DimPatient"].collect()}
    assert status == {None: "inactive", "p1": "active"}
    later = normalize(flat, healthcare(status_cutoff="2025-01-01"))["DimPatient"]
    assert set(column(later, "patient_status")) == {"inactive"}


def test_one_row_per_key_is_the_latest_visit(spark):
    flat = flat_rows(
        spark,
        {"visit_datetime": "2020-01-01", "patient_city": "old"},
        {"visit_datetime": "2022-01-01", "patient_city": "new"},
        {"visit_datetime": None, "patient_city": "undated"},
    )
    assert column(normalize(flat, STAR)["DimPatient"], "patient_city") == ["new"]


def test_billing_casts(spark):
    flat = flat_rows(
        spark, {"billing_total_charge": Decimal("12.50"), "billing_date": date(2024, 2, 29), "billing_id": "b"}
    )
    dirty = flat.withColumns(
        {name: flat[name].cast("string") for name in ("billing_total_charge", "billing_amount_paid", "billing_date")}
    ).fillna({"billing_amount_paid": "free"})
    row = normalize(dirty, STAR)["DimBilling"].first()
    assert (row["billing_total_charge"], row["billing_date"]) == (Decimal("12.50"), date(2024, 2, 29))
    assert row["billing_amount_paid"] is None


def test_optional_groups_leave_no_empty_row(spark):
    flat = flat_rows(
        spark,
        {},
        {"prescription_id": "r1", "prescription_drug_name": "x"},
        {"lab_order_id": None, "lab_name": "partial"},
    )
    tables = normalize(flat, STAR)
    assert column(tables["DimPrescription"], "prescription_id") == ["r1"]
    assert bag(tables["DimLabOrder"].select("lab_order_id", "lab_name")) == {(None, "partial"): 1}
    assert normalize(flat_rows(spark, {}), STAR)["DimLabOrder"].count() == 0


# What the ids must start with, by department and title, or be, by clinic and room.
PROVIDER_PREFIXES = {
    ("Architect", "DO"): "ADO",
    ("Health service manager", "DO"): "HSMDO",
    ("Commercial art gallery manager", "DO"): "GDO",
    ("  Health  service manager", "PA"): "HSMPA",
    (None, "MD"): None,
}
LOCATIONS = {
    ("Brown, Warren and Williams", 101): "BWAW101",
    ("Mitchell-Ferrell", 104): "M104",
    ("A B C D E", 7): "D7",
    ("Oak", None): None,
}


def test_provider_ids(spark):
    doctors = [{"doctor_department": department, "doctor_title": title} for department, title in PROVIDER_PREFIXES]
    dim = surrogate_dim(flat_rows(spark, *doctors, *doctors), STAR.table("DimProvider"), SEQUENCE)
    ids = {(row["doctor_department"], row["doctor_title"]): row["provider_id"] for row in dim.collect()}
    assert len(ids) == len(PROVIDER_PREFIXES)
    # One doctor's name: titles decide the order, then departments, nulls first.
    order = sorted(PROVIDER_PREFIXES, key=lambda d: (d[1] is not None, d[1] or "", d[0] is not None, d[0] or ""))
    want = {doctor: PROVIDER_PREFIXES[doctor] and f"{PROVIDER_PREFIXES[doctor]}{number:06}" for number, doctor in enumerate(order)}
    assert ids == want


def test_location_ids(spark):
    rooms = [{"clinic_name": clinic, "room_number": room} for clinic, room in LOCATIONS]
    tables = normalize(flat_rows(spark, *rooms), STAR, SEQUENCE)
    found = {(row["clinic_name"], row["room_number"]): row["location_id"] for row in tables["DimLocation"].collect()}
    assert found == LOCATIONS
    used = {row["visit_id"]: row["location_id"] for row in tables["FacVisit"].collect()}
    assert used == {f"v{place}": location for place, location in enumerate(LOCATIONS.values())}


def test_thresholds_can_move(spark):
    star = healthcare(provider_threshold=2, location_threshold=5)
    flat = flat_rows(spark, {"doctor_department": "Health service manager", "clinic_name": "A B C D E"})
    ids = {
        name: column(surrogate_dim(flat, star.table(name), SEQUENCE), star.table(name).primary_key)
        for name in ("DimProvider", "DimLocation")
    }
    assert ids == {"DimProvider": ["SMD000000"], "DimLocation": ["ABCDE101"]}


def test_diagnosis_and_treatment_ids(spark):
    flat = flat_rows(
        spark,
        {"primary_diagnosis_code": "Da", "primary_diagnosis_desc": "x" * 35},
        {"primary_diagnosis_code": "Db", "primary_diagnosis_desc": None, "treatment_code": None},
        {"primary_diagnosis_code": None, "primary_diagnosis_desc": "lost"},
    )
    tables = normalize(flat, STAR, SEQUENCE)
    assert sorted(column(tables["DimPrimaryDiagnosis"], "primary_diagnosis_id")) == ["Da350", "Db01"]
    assert {row["treatment_id"] for row in tables["DimTreatment"].collect()} == {None, "T11"}
    plain = {row["visit_id"]: row for row in tables["FacVisit"].collect()}
    assert [plain[f"v{i}"]["primary_diagnosis_id"] for i in range(3)] == ["Da350", None, None]
    safe = normalize(flat, STAR, SEQUENCE, null_safe=True)["FacVisit"].collect()
    found = {row["visit_id"]: row["primary_diagnosis_id"] for row in safe}
    assert found == {"v0": "Da350", "v1": "Db01", "v2": None}


def test_hash_ids_resolve_and_absent_codes_stay_null(spark):
    flat = flat_rows(
        spark,
        {"primary_diagnosis_desc": None},
        {"primary_diagnosis_code": None},
        {"treatment_code": None},
    )
    tables = normalize(flat, STAR, HASH, null_safe=True)
    for spec in STAR.surrogate_dims:
        ids = set(column(tables[spec.name], spec.primary_key))
        assert all(re.fullmatch("[0-9a-f]{32}", value) for value in ids)
        used = set(column(tables["FacVisit"], spec.primary_key)) - {None}
        assert used == ids
    missing = [row for row in tables["FacVisit"].collect() if row["primary_diagnosis_id"] is None]
    assert [row["visit_id"] for row in missing] == ["v1"]


@pytest.mark.parametrize("null_safe", [False, True])
def test_both_kinds_of_keys_are_null_in_the_same_rows(spark, null_safe):
    parts = [name for spec in STAR.surrogate_dims for name in spec.natural_key]
    flat = flat_rows(spark, {}, *[{name: None} for name in parts])
    found = []
    for keys in (HASH, SEQUENCE):
        fact = normalize(flat, STAR, keys, null_safe)["FacVisit"]
        # A readable id is null where a part of its prefix is, whatever else is asked for.
        names = [spec.primary_key for spec in STAR.surrogate_dims if not null_safe or "diagnosis" in spec.primary_key]
        found.append(bag(fact.select("visit_id", *[fact[name].isNull() for name in names])))
    assert found[0] == found[1]


@pytest.mark.parametrize("keys", [HASH, SEQUENCE])
def test_fact_keeps_every_row_even_copies(spark, keys):
    flat = flat_rows(spark, *[{"visit_id": "same"}] * 3, {"doctor_name": "Other"}, {"clinic_name": None})
    assert normalize(flat, STAR, keys)["FacVisit"].count() == 5


@pytest.mark.parametrize("keys", [HASH, SEQUENCE])
def test_result_does_not_depend_on_partitions(spark, conf, keys):
    rows = [
        {
            "patient_id": f"p{i % 7}",
            "visit_datetime": f"202{i % 3}-01-01",
            "patient_city": f"city {i}",
            "doctor_name": f"Dr. {i % 5}",
            "doctor_department": "Health" + " care" * (i % 4),
            "insurance_id": f"i{i % 11}",
            "prescription_id": f"r{i % 4}" if i % 3 else None,
            "prescription_dosage": f"{i}mg" if i % 3 else None,
        }
        for i in range(60)
    ]
    flat = flat_rows(spark, *rows)
    expected = None
    for partitions, adaptive, spread in (("1", "true", 1), ("3", "false", 3), ("200", "true", 9)):
        conf(shuffle__partitions=partitions, adaptive__enabled=adaptive)
        tables = normalize(flat.repartition(spread), STAR, keys, broadcast_bytes=0 if spread == 3 else 1 << 26)
        found = {name: bag(df) for name, df in tables.items()}
        expected = expected or found
        assert found == expected
