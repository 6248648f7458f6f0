"""Small flat inputs for tests, all values invented."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flakeform import FLAT_SCHEMA

USUAL = {
    "visit_type": "Checkup",
    "patient_first_name": "Ada",
    "patient_last_name": "Quill",
    "patient_gender": "F",
    "patient_zip": "02134",
    "insurance_id": "i1",
    "insurance_payer_name": "Payer",
    "billing_id": "b1",
    "doctor_name": "Dr. Moss",
    "doctor_title": "MD",
    "doctor_department": "Health service manager",
    "clinic_name": "Oak, Elm and Ash",
    "room_number": 101,
    "primary_diagnosis_code": "D1",
    "primary_diagnosis_desc": "Seems tired.",
    "secondary_diagnosis_code": "D2",
    "secondary_diagnosis_desc": "Seems awake.",
    "treatment_code": "T1",
    "treatment_desc": "Rest",
}


def moment(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def flat_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """A flat table: each row gives what differs from the usual visit."""
    data = []
    for number, row in enumerate(rows):
        full = {**USUAL, "visit_id": f"v{number}", "patient_id": "p1", **row}
        if isinstance(full.get("visit_datetime"), str):
            full["visit_datetime"] = moment(full["visit_datetime"])
        data.append(tuple(full.get(name) for name in FLAT_SCHEMA.names))
    return spark.createDataFrame(data, FLAT_SCHEMA)


def bag(df: DataFrame) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.collect()]
