"""The healthcare snowflake: ten dimensions around one fact, from a 47-column flat visit table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from flakeform.functions.text import initials, reduced_code, text_length
from flakeform.operators.status import DEFAULT_CUTOFF
from flakeform.plans.specs import (
    Fact,
    Field,
    ForeignKey,
    KeyRule,
    NaturalDim,
    Snowflake,
    StatusRule,
    SurrogateDim,
)

# The flat input's 47 columns by the table that takes them over, key first where
# the input brings one; all are text unless typed below.
FLAT_GROUPS = {
    "visit": (
        "visit_id",
        "visit_datetime",
        "visit_type",
    ),
    "patient": (
        "patient_id",
        "patient_first_name",
        "patient_last_name",
        "patient_date_of_birth",
        "patient_gender",
        "patient_address_line1",
        "patient_address_line2",
        "patient_city",
        "patient_state",
        "patient_zip",
        "patient_phone",
        "patient_email",
    ),
    "insurance": (
        "insurance_id",
        "insurance_payer_name",
        "insurance_policy_number",
        "insurance_group_number",
        "insurance_plan_type",
    ),
    "billing": (
        "billing_id",
        "billing_total_charge",
        "billing_amount_paid",
        "billing_date",
        "billing_payment_status",
    ),
    "provider": (
        "doctor_name",
        "doctor_title",
        "doctor_department",
    ),
    "location": (
        "clinic_name",
        "room_number",
    ),
    "primary_diagnosis": (
        "primary_diagnosis_code",
        "primary_diagnosis_desc",
    ),
    "secondary_diagnosis": (
        "secondary_diagnosis_code",
        "secondary_diagnosis_desc",
    ),
    "treatment": (
        "treatment_code",
        "treatment_desc",
    ),
    "prescription": (
        "prescription_id",
        "prescription_drug_name",
        "prescription_dosage",
        "prescription_frequency",
        "prescription_duration_days",
    ),
    "lab_order": (
        "lab_order_id",
        "lab_test_code",
        "lab_name",
        "lab_result_value",
        "lab_result_units",
        "lab_result_date",
    ),
}
FLAT_TYPES = {
    "visit_datetime": TimestampType(),
    "patient_date_of_birth": DateType(),
    "billing_total_charge": DecimalType(10, 2),
    "billing_amount_paid": DecimalType(10, 2),
    "billing_date": DateType(),
    "room_number": IntegerType(),
    "prescription_duration_days": IntegerType(),
    "lab_result_value": DoubleType(),
    "lab_result_date": TimestampType(),
}

# Casts applied while normalizing, whatever type the input arrives with.
CASTS = {
    "patient_date_of_birth": "date",
    "patient_zip": "string",
    "billing_total_charge": "decimal(10,2)",
    "billing_amount_paid": "decimal(10,2)",
    "billing_date": "date",
    "prescription_duration_days": "int",
}

FLAT_SCHEMA = StructType(
    [
        StructField(name, FLAT_TYPES.get(name, StringType()))
        for group in FLAT_GROUPS.values()
        for name in group
    ]
)

# How long an initials code may be before it shrinks to one character.
PROVIDER_CODE_THRESHOLD = 3
LOCATION_CODE_THRESHOLD = 4
PROVIDER_SEQUENCE_WIDTH = 6


def _fields(*groups: str, key: tuple[str, ...] = ()) -> tuple[Field, ...]:
    """Fields for columns in order: those of ``key`` first, then the groups' others."""
    names = [*key, *[name for group in groups for name in FLAT_GROUPS[group] if name not in key]]
    return tuple(Field(name, CASTS.get(name)) for name in names)


def provider_prefix(threshold: int = PROVIDER_CODE_THRESHOLD) -> Column:
    code = reduced_code(initials(F.col("doctor_department")), threshold)
    return F.concat(code, F.col("doctor_title"))


def location_prefix(threshold: int = LOCATION_CODE_THRESHOLD) -> Column:
    code = reduced_code(initials(F.col("clinic_name")), threshold)
    return F.concat(code, F.col("room_number").cast("string"))


def diagnosis_prefix(code: str, description: str) -> Column:
    return F.concat(F.col(code), text_length(F.col(description)).cast("string"))


def healthcare(
    status_cutoff: str = DEFAULT_CUTOFF,
    provider_threshold: int = PROVIDER_CODE_THRESHOLD,
    location_threshold: int = LOCATION_CODE_THRESHOLD,
    unique_locations: bool = False,
) -> Snowflake:
    """``unique_locations`` tells readable location ids apart that clinics with equal initials and room share."""
    latest = {"recency": "visit_datetime", "tie_breaker": "visit_id"}
    dims = (
        NaturalDim(
            name="DimPatient",
            primary_key="patient_id",
            fields=_fields("patient"),
            status=StatusRule("patient_status", status_cutoff),
            one_char_text=True,
            **latest,
        ),
        NaturalDim(
            name="DimInsurance",
            primary_key="insurance_id",
            fields=_fields("insurance", key=("insurance_id", "patient_id")),
            foreign_keys=(ForeignKey("patient_id", "DimPatient", "patient_id"),),
            **latest,
        ),
        NaturalDim(
            name="DimBilling",
            primary_key="billing_id",
            fields=_fields("billing", key=("billing_id", "insurance_id")),
            foreign_keys=(ForeignKey("insurance_id", "DimInsurance", "insurance_id"),),
            **latest,
        ),
        SurrogateDim(
            name="DimProvider",
            primary_key="provider_id",
            fields=_fields("provider"),
            key=KeyRule(lambda: provider_prefix(provider_threshold), pad=PROVIDER_SEQUENCE_WIDTH),
        ),
        SurrogateDim(
            name="DimLocation",
            primary_key="location_id",
            fields=_fields("location"),
            key=KeyRule(lambda: location_prefix(location_threshold), numbered=False, unique=unique_locations),
        ),
        # Only coded diagnoses get a row.
        SurrogateDim(
            name="DimPrimaryDiagnosis",
            primary_key="primary_diagnosis_id",
            fields=_fields("primary_diagnosis"),
            key=KeyRule(lambda: diagnosis_prefix("primary_diagnosis_code", "primary_diagnosis_desc")),
            required=("primary_diagnosis_code",),
        ),
        SurrogateDim(
            name="DimSecondaryDiagnosis",
            primary_key="secondary_diagnosis_id",
            fields=_fields("secondary_diagnosis"),
            key=KeyRule(lambda: diagnosis_prefix("secondary_diagnosis_code", "secondary_diagnosis_desc")),
            required=("secondary_diagnosis_code",),
        ),
        SurrogateDim(
            name="DimTreatment",
            primary_key="treatment_id",
            fields=_fields("treatment"),
            key=KeyRule(lambda: F.col("treatment_code")),
        ),
        NaturalDim(
            name="DimPrescription",
            primary_key="prescription_id",
            fields=_fields("prescription"),
            drop_empty=True,
            **latest,
        ),
        NaturalDim(
            name="DimLabOrder",
            primary_key="lab_order_id",
            fields=_fields("lab_order"),
            drop_empty=True,
            **latest,
        ),
    )
    fact = Fact(
        name="FacVisit",
        primary_key="visit_id",
        fields=_fields(
            key=(
                "visit_id",
                "patient_id",
                "insurance_id",
                "billing_id",
                "prescription_id",
                "lab_order_id",
                "visit_datetime",
                "visit_type",
            )
        ),
        foreign_keys=(
            ForeignKey("patient_id", "DimPatient", "patient_id"),
            ForeignKey("insurance_id", "DimInsurance", "insurance_id"),
            ForeignKey("billing_id", "DimBilling", "billing_id"),
            ForeignKey("provider_id", "DimProvider", "provider_id"),
            ForeignKey("location_id", "DimLocation", "location_id"),
            ForeignKey("primary_diagnosis_id", "DimPrimaryDiagnosis", "primary_diagnosis_id"),
            ForeignKey("secondary_diagnosis_id", "DimSecondaryDiagnosis", "secondary_diagnosis_id"),
            ForeignKey("treatment_id", "DimTreatment", "treatment_id"),
            ForeignKey("prescription_id", "DimPrescription", "prescription_id"),
            ForeignKey("lab_order_id", "DimLabOrder", "lab_order_id"),
        ),
        columns=(
            "visit_id",
            "patient_id",
            "insurance_id",
            "billing_id",
            "provider_id",
            "location_id",
            "primary_diagnosis_id",
            "secondary_diagnosis_id",
            "treatment_id",
            "prescription_id",
            "lab_order_id",
            "visit_datetime",
            "visit_type",
        ),
    )
    return Snowflake(dims, fact)
