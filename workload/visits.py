"""A 47-column flat visit table derived from the driver's star schema, one row per order line.

The column rules are portable SQL expressions: Spark builds the flat table from them, and the
checking SQL starts from the same text, so both sides normalize the same input. Missing values
(the driver's tables have none) follow from attribute values: whole groups are absent for some
flags, single parts of a natural key for others, and some patients lack an id or any visit date.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.sources.staging import in_part, parts_for, stage_parts

COLUMNS = {
    "visit_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
    " || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)",
    "visit_datetime": "CASE WHEN c_acctbal >= -900 AND o_orderpriority <> '4-NOT SPECIFIED' THEN l_shipdate END",
    "visit_type": "o_orderpriority",
    "patient_id": "CASE WHEN c_acctbal <= 9900 THEN CAST(c_custkey AS STRING) END",
    "patient_first_name": "split_part(c_name, '#', 1)",
    "patient_last_name": "split_part(c_name, '#', 2)",
    "patient_date_of_birth": "CAST(DATE '1950-01-01' + CAST(floor(c_acctbal) AS INT) AS STRING)",
    "patient_gender": "substring(c_mktsegment, 1, 1)",
    "patient_address_line1": "c_name || ' ' || c_mktsegment",
    "patient_address_line2": "CASE WHEN c_nationkey >= 5 THEN n_name END",
    "patient_city": "n_name",
    "patient_state": "r_name",
    "patient_zip": "lpad(CAST(c_custkey AS STRING), 5, '0')",
    "patient_phone": "CAST(c_nationkey AS STRING) || '-' || lpad(CAST(c_custkey AS STRING), 7, '0')",
    "patient_email": "replace(lower(c_name), '#', '.') || '@example.org'",
    "insurance_id": "'I' || CAST(o_orderkey AS STRING)",
    "insurance_payer_name": "s_name",
    "insurance_policy_number": "'P' || CAST(l_partkey AS STRING)",
    "insurance_group_number": "'G' || c_mktsegment",
    "insurance_plan_type": "l_returnflag",
    "billing_id": "'B' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "billing_total_charge": "l_extendedprice",
    "billing_amount_paid": "o_totalprice",
    "billing_date": "l_shipdate",
    "billing_payment_status": "CASE l_linestatus WHEN 'O' THEN 'Pending' ELSE 'Paid' END",
    "doctor_name": "s_name",
    "doctor_title": "CASE l_returnflag WHEN 'A' THEN 'MD' WHEN 'N' THEN 'NP' ELSE 'PA' END",
    "doctor_department": "CASE WHEN p_size > 25 THEN p_type || ' care and support' ELSE p_type || ' care' END",
    "clinic_name": "CASE p_type WHEN 'PROMO' THEN p_name || ' Family Health Center' ELSE p_name END",
    "room_number": "CASE WHEN p_brand <> 'Brand#9' THEN 100 + p_size END",
    "primary_diagnosis_code": "CASE WHEN o_orderstatus <> 'P' THEN 'D' || substring(p_type, 1, 3) END",
    "primary_diagnosis_desc": "CASE WHEN p_size >= 5 THEN p_name END",
    "secondary_diagnosis_code": "CASE WHEN l_returnflag <> 'N' THEN replace(p_brand, 'Brand#', 'S') END",
    "secondary_diagnosis_desc": "CASE WHEN p_size <= 45 THEN p_type || ' ' || p_name END",
    "treatment_code": "CASE WHEN c_mktsegment <> 'BUILDING' OR p_type <> 'SMALL'"
    " THEN 'T' || l_returnflag || l_linestatus END",
    "treatment_desc": "CASE WHEN p_type <> 'LARGE' THEN 'Treatment ' || p_type END",
    "prescription_id": "CASE WHEN l_returnflag <> 'N' AND p_size <> 50"
    " THEN 'RX' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END",
    "prescription_drug_name": "CASE WHEN l_returnflag <> 'N' THEN p_name END",
    "prescription_dosage": "CASE WHEN l_returnflag <> 'N' THEN CAST(p_size AS STRING) || 'mg' END",
    "prescription_frequency": "CASE WHEN l_returnflag <> 'N' THEN"
    " CASE l_linestatus WHEN 'O' THEN 'Once daily' ELSE 'Twice daily' END END",
    "prescription_duration_days": "CASE WHEN l_returnflag <> 'N' THEN l_quantity END",
    "lab_order_id": "CASE WHEN l_linestatus = 'O' THEN"
    " 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END",
    "lab_test_code": "CASE WHEN l_linestatus = 'O' THEN p_brand END",
    "lab_name": "CASE WHEN l_linestatus = 'O' THEN p_type || ' panel' END",
    "lab_result_value": "CASE WHEN l_linestatus = 'O' THEN p_retailprice END",
    "lab_result_units": "CASE WHEN l_linestatus = 'O' THEN 'mg/dL' END",
    "lab_result_date": "CASE WHEN l_linestatus = 'O' THEN l_shipdate END",
}

# Dirt for a CSV of visits: column, condition and the text that stands for the value there.
DIRT = {
    "visit_datetime": ("visit_type = '1-URGENT'", "'soon'"),
    "patient_date_of_birth": ("patient_gender = 'B'", "'31/12/1999'"),
    "billing_total_charge": ("insurance_plan_type = 'N'", "'123456789012.00'"),
    "billing_amount_paid": ("insurance_plan_type = 'R'", "'paid ' || CAST(billing_amount_paid AS STRING)"),
    "room_number": ("room_number > 120", "'Room ' || CAST(room_number AS STRING)"),
    "prescription_duration_days": ("prescription_duration_days > 40", "'weeks'"),
    "lab_result_value": ("lab_test_code = 'Brand#3'", "'pending'"),
}

# Tables in join order after lineitem: column prefix, join condition, table needed before.
JOINS = {
    "orders": ("o_", "l_orderkey = o_orderkey", None),
    "customer": ("c_", "o_custkey = c_custkey", "orders"),
    "nation": ("n_", "c_nationkey = n_nationkey", "customer"),
    "region": ("r_", "n_regionkey = r_regionkey", "nation"),
    "part": ("p_", "l_partkey = p_partkey", None),
    "supplier": ("s_", "l_suppkey = s_suppkey", None),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visits(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, part: int = 0, parts: int = 1) -> DataFrame:
    """The flat table, or some of its columns, joining only the tables these draw on; one of ``parts``, by order, if asked.

    Every line has exactly one order, part and supplier and every order one customer, so leaving
    out an unused join keeps the rows the same. Orders grow with the lines and are never broadcast:
    both sides are shuffled by order, which also spreads a file that one task would read alone, and
    Spark splits the partition of an order with very many lines.
    """
    chosen = {name: COLUMNS[name] for name in (COLUMNS if columns is None else columns)}
    needed = {
        name
        for name, (prefix, _, _) in JOINS.items()
        for rule in chosen.values()
        if re.search(rf"\b{prefix}[a-z]", rule)
    }
    for name in reversed(JOINS):
        before = JOINS[name][2]
        if name in needed and before:
            needed.add(before)
    lines = table(spark, sf_dir, "lineitem")
    flat = lines.filter(in_part(["l_orderkey"], part, parts))
    for name, (_, condition, _) in JOINS.items():
        if name in needed:
            other = table(spark, sf_dir, name)
            if name == "orders" and other.schema["o_orderkey"].dataType == lines.schema["l_orderkey"].dataType:
                other = other.filter(in_part(["o_orderkey"], part, parts))
            flat = flat.join(other.hint("merge") if name == "orders" else other, F.expr(condition))
    return flat.select(*[F.expr(rule).alias(name) for name, rule in chosen.items()])


def visit_parts(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> list[DataFrame]:
    """The flat table in as many parts as its lines are worth, so that not all joins' shuffles stand on the disk at once."""
    parts = parts_for(table(spark, sf_dir, "lineitem"))
    chosen = None if columns is None else list(columns)
    return [visits(spark, sf_dir, chosen, part, parts) for part in range(parts)]


def staged_visits(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    return stage_parts(visit_parts(spark, sf_dir, columns), "visits")


def dirty(flat: DataFrame) -> DataFrame:
    """Visits as text, with the dirt."""
    soiled = {name: f"CASE WHEN {where} THEN {text} ELSE CAST({name} AS STRING) END" for name, (where, text) in DIRT.items()}
    return flat.select(*[F.expr(soiled.get(name, name)).alias(name) for name in flat.columns])


def visits_sql() -> str:
    """The same flat table as a SQL query."""
    columns = ",\n  ".join(f"{rule} AS {name}" for name, rule in COLUMNS.items())
    joins = "\n".join(f"JOIN {name} ON {condition}" for name, (_, condition, _) in JOINS.items())
    return f"SELECT\n  {columns}\nFROM lineitem\n{joins}"
