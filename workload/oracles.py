"""The same results in plain SQL, written for an engine that knows nothing of the operators."""

from __future__ import annotations

from collections.abc import Callable

from workload.queries import CUTOFF, DIM_QUERIES, EVENT_CUTOFF, SECOND_BATCH
from workload.visits import COLUMNS, DIRT, visits_sql

ID_OF = {
    "DimPatient": "patient_id",
    "DimInsurance": "insurance_id",
    "DimBilling": "billing_id",
    "DimProvider": "provider_id",
    "DimLocation": "location_id",
    "DimPrimaryDiagnosis": "primary_diagnosis_id",
    "DimSecondaryDiagnosis": "secondary_diagnosis_id",
    "DimTreatment": "treatment_id",
    "DimPrescription": "prescription_id",
    "DimLabOrder": "lab_order_id",
    "FacVisit": "visit_id",
}

# Natural keys of the dimensions that get a surrogate id, and the columns that must be present.
NATURAL = {
    "DimProvider": ["doctor_name", "doctor_title", "doctor_department"],
    "DimLocation": ["clinic_name", "room_number"],
    "DimPrimaryDiagnosis": ["primary_diagnosis_code", "primary_diagnosis_desc"],
    "DimSecondaryDiagnosis": ["secondary_diagnosis_code", "secondary_diagnosis_desc"],
    "DimTreatment": ["treatment_code", "treatment_desc"],
}
REQUIRED = {
    "DimPrimaryDiagnosis": "primary_diagnosis_code",
    "DimSecondaryDiagnosis": "secondary_diagnosis_code",
}

BUCKET = (
    "CASE WHEN {n} IS NULL THEN 50 WHEN {n} <= 50 THEN 50 WHEN {n} <= 100 THEN 100 WHEN {n} <= 255 THEN 255"
    " WHEN {n} <= 500 THEN 500 WHEN {n} <= 1000 THEN 1000 WHEN {n} <= 2000 THEN 2000 WHEN {n} <= 4000 THEN 4000"
    " WHEN {n} <= 8000 THEN 8000 ELSE CAST(({n} // 1000 + 1) * 1000 AS INTEGER) END"
)


def _status(last: str) -> str:
    return f"CASE WHEN CAST({last} AS DATE) <= DATE '{CUTOFF}' THEN 'inactive' ELSE 'active' END"


def _natural(columns: dict[str, str], key: str, drop_empty: bool = False) -> str:
    """Latest row per key; ``columns`` maps output names to expressions over the flat table."""
    ties = [name for name in columns if name != key]
    ordering = ", ".join(
        [
            "visit_datetime DESC NULLS LAST",
            "visit_id ASC NULLS FIRST",
            *[f"{columns[name]} ASC NULLS FIRST" for name in ties],
        ]
    )
    chosen = ", ".join(f"{rule} AS {name}" for name, rule in columns.items())
    present = " OR ".join(f"{rule} IS NOT NULL" for rule in columns.values()) if drop_empty else "TRUE"
    return (
        f"SELECT {chosen} FROM visits WHERE {present}"
        f" QUALIFY row_number() OVER (PARTITION BY {columns[key]} ORDER BY {ordering}) = 1"
    )


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


PATIENT = {
    **_same("patient_id", "patient_first_name", "patient_last_name"),
    "patient_date_of_birth": "CAST(patient_date_of_birth AS DATE)",
    **_same(
        "patient_gender",
        "patient_address_line1",
        "patient_address_line2",
        "patient_city",
        "patient_state",
        "patient_zip",
        "patient_phone",
        "patient_email",
    ),
}
INSURANCE = _same(
    "insurance_id",
    "patient_id",
    "insurance_payer_name",
    "insurance_policy_number",
    "insurance_group_number",
    "insurance_plan_type",
)
BILLING = {
    **_same("billing_id", "insurance_id"),
    "billing_total_charge": "CAST(billing_total_charge AS DECIMAL(10,2))",
    "billing_amount_paid": "CAST(billing_amount_paid AS DECIMAL(10,2))",
    "billing_date": "CAST(billing_date AS DATE)",
    "billing_payment_status": "billing_payment_status",
}
PRESCRIPTION = {
    **_same("prescription_id", "prescription_drug_name", "prescription_dosage", "prescription_frequency"),
    "prescription_duration_days": "CAST(prescription_duration_days AS INTEGER)",
}
LAB_ORDER = _same(
    "lab_order_id", "lab_test_code", "lab_name", "lab_result_value", "lab_result_units", "lab_result_date"
)


def _patient() -> str:
    """Status by its own aggregation, joined on: the long way round."""
    base = _natural(PATIENT, "patient_id")
    return (
        f"SELECT b.*, coalesce(s.status, 'inactive') AS patient_status FROM ({base}) b LEFT JOIN"
        f" (SELECT patient_id AS pid, {_status('max(visit_datetime)')} AS status FROM visits GROUP BY patient_id) s"
        " ON b.patient_id = s.pid"
    )


def _initials(text: str) -> str:
    words = f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')"
    return f"upper(array_to_string(list_transform({words}, lambda w: substring(w, 1, 1)), ''))"


def _reduced(code: str, threshold: int) -> str:
    return f"CASE WHEN length({code}) > {threshold} THEN substring({code}, {threshold}, 1) ELSE {code} END"


def _distinct(table: str) -> str:
    needed = f" WHERE {REQUIRED[table]} IS NOT NULL" if table in REQUIRED else ""
    return f"SELECT DISTINCT {', '.join(NATURAL[table])} FROM visits{needed}"


def _in_order(table: str) -> str:
    return ", ".join(f"{key} ASC NULLS FIRST" for key in NATURAL[table])


def _readable(table: str, number: str, threshold: int = 3) -> str:
    """Readable surrogate id with a sequence number."""
    seq = f"CAST({number} AS VARCHAR)"
    if table == "DimProvider":
        code = _reduced(_initials("doctor_department"), threshold)
        return f"({code}) || doctor_title || lpad({seq}, 6, '0')"
    if table == "DimLocation":
        return f"({_reduced(_initials('clinic_name'), 4)}) || CAST(room_number AS VARCHAR)"
    if table == "DimTreatment":
        return f"treatment_code || {seq}"
    code, desc = NATURAL[table]
    return f"{code} || CAST(coalesce(length({desc}), 0) AS VARCHAR) || {seq}"


def _numbered(table: str, threshold: int = 3) -> str:
    """Readable surrogate ids; sequence numbers by one global sort."""
    surrogate = _readable(table, f"(row_number() OVER (ORDER BY {_in_order(table)}) - 1)", threshold)
    return f"SELECT {surrogate} AS {ID_OF[table]}, {', '.join(NATURAL[table])} FROM ({_distinct(table)})"


def _numbered_in_batches(table: str) -> str:
    """Keys of the first batch in order, then the second batch's new ones in order."""
    keys = ", ".join(NATURAL[table])
    needed = f" AND {REQUIRED[table]} IS NOT NULL" if table in REQUIRED else ""
    early = f"SELECT DISTINCT {keys} FROM visits WHERE billing_date < DATE '{SECOND_BATCH}'{needed}"
    late = f"SELECT DISTINCT {keys} FROM visits WHERE NOT billing_date < DATE '{SECOND_BATCH}'{needed} EXCEPT {early}"
    place = f"row_number() OVER (ORDER BY {_in_order(table)}) - 1"
    both = (
        f"SELECT {keys}, {place} AS number, TRUE AS known FROM ({early}) UNION ALL"
        f" SELECT {keys}, {place} + (SELECT count(*) FROM ({early})), FALSE FROM ({late})"
    )
    return f"SELECT {_readable(table, 'number')} AS {ID_OF[table]}, known, {keys} FROM ({both})"


def _batch_keys() -> str:
    rows = []
    for table in [table for table in NATURAL if table != "DimLocation"]:
        parts = [*NATURAL[table], *["CAST(NULL AS VARCHAR)"] * (3 - len(NATURAL[table]))]
        columns = ", ".join(f"{part} AS part{i}" for i, part in enumerate(parts))
        rows.append(
            f"SELECT '{table}' AS \"table\", {ID_OF[table]} AS id, CASE WHEN known THEN {ID_OF[table]} END AS first_id,"
            f" {columns} FROM ({_numbered_in_batches(table)})"
        )
    return _with_visits(" UNION ALL ".join(rows))


def _hash(table: str) -> str:
    parts = [
        f"coalesce(CAST(strlen(CAST({key} AS VARCHAR)) AS VARCHAR) || ':' || CAST({key} AS VARCHAR), '-')"
        for key in NATURAL[table]
    ]
    return f"md5({' || '.join(parts)})"


def _hashed(table: str) -> str:
    return f"SELECT {_hash(table)} AS {ID_OF[table]}, {', '.join(NATURAL[table])} FROM ({_distinct(table)})"


FACT_IDS = [name for table, name in ID_OF.items() if table != "FacVisit"]


def _fact(ids: dict[str, str], source: str) -> str:
    chosen = ", ".join(f"{ids.get(name, 'v.' + name)} AS {name}" for name in FACT_IDS)
    return f"SELECT v.visit_id, {chosen}, v.visit_datetime, v.visit_type FROM {source}"


def _fact_hashed(null_safe: bool = False) -> str:
    ids = {}
    for table, keys in NATURAL.items():
        needed = [key for key in keys if not null_safe or key == REQUIRED.get(table)]
        present = " AND ".join(f"{key} IS NOT NULL" for key in needed)
        ids[ID_OF[table]] = f"CASE WHEN {present} THEN {_hash(table)} END" if needed else _hash(table)
    return _fact(ids, "visits v")


def _fact_joined(equal: str, numbered: Callable[[str], str] = _numbered) -> str:
    joins, ids = ["visits v"], {}
    for table, keys in NATURAL.items():
        on = " AND ".join(f"v.{key} {equal} {table}.{key}" for key in keys)
        joins.append(f"LEFT JOIN ({numbered(table)}) {table} ON {on}")
        ids[ID_OF[table]] = f"{table}.{ID_OF[table]}"
    return _fact(ids, " ".join(joins))


def _natural_dims() -> dict[str, str]:
    return {
        "DimPatient": _patient(),
        "DimInsurance": _natural(INSURANCE, "insurance_id"),
        "DimBilling": _natural(BILLING, "billing_id"),
        "DimPrescription": _natural(PRESCRIPTION, "prescription_id", drop_empty=True),
        "DimLabOrder": _natural(LAB_ORDER, "lab_order_id", drop_empty=True),
    }


def _with_visits(sql: str, **tables: str) -> str:
    ctes = "".join(f",\n{name} AS ({query})" for name, query in tables.items())
    return f"WITH visits AS ({visits_sql()}){ctes}\n{sql}"


def _all_tables() -> dict[str, str]:
    return {
        **_natural_dims(),
        **{table: _hashed(table) for table in NATURAL},
        "FacVisit": _fact_hashed(),
    }


# Spark and SQL types of every output column, in order.
TEXT = "string"
TYPES = {
    "DimPatient": [(name, "date" if name == "patient_date_of_birth" else TEXT) for name in PATIENT]
    + [("patient_status", TEXT)],
    "DimInsurance": [(name, TEXT) for name in INSURANCE],
    "DimBilling": [
        ("billing_id", TEXT),
        ("insurance_id", TEXT),
        ("billing_total_charge", "decimal(10,2)"),
        ("billing_amount_paid", "decimal(10,2)"),
        ("billing_date", "date"),
        ("billing_payment_status", TEXT),
    ],
    **{
        table: [(ID_OF[table], TEXT), *[(key, "int" if key == "room_number" else TEXT) for key in keys]]
        for table, keys in NATURAL.items()
    },
    "DimPrescription": [
        (name, "int" if name == "prescription_duration_days" else TEXT) for name in PRESCRIPTION
    ],
    "DimLabOrder": [
        (name, {"lab_result_value": "double", "lab_result_date": "timestamp_ntz"}.get(name, TEXT))
        for name in LAB_ORDER
    ],
    "FacVisit": [
        ("visit_id", TEXT),
        *[(name, TEXT) for name in FACT_IDS],
        ("visit_datetime", "timestamp_ntz"),
        ("visit_type", TEXT),
    ],
}
SQL_TYPES = {
    "int": "INT",
    "date": "DATE",
    "decimal(10,2)": "DECIMAL(10,2)",
    "timestamp_ntz": "TIMESTAMP(6)",
    "double": "VARCHAR(255)",
}
FLAT_TEXT = [
    name
    for name in dict.fromkeys(
        name for columns in TYPES.values() for name, kind in columns if kind == TEXT
    )
    if name not in ("patient_status", *[ID_OF[table] for table in NATURAL])
] + ["patient_date_of_birth"]


def _global_max() -> str:
    return "greatest(" + ", ".join(f"coalesce(max(length({name})), 0)" for name in FLAT_TEXT) + ")"


def _types() -> str:
    rows = []
    for table, columns in TYPES.items():
        for position, (name, kind) in enumerate(columns):
            longest = f"(SELECT max(length({name})) FROM {table})" if kind == TEXT else "NULL"
            if kind != TEXT:
                sql_type = f"'{SQL_TYPES[kind]}'"
            else:
                sql_type = "'VARCHAR(' || (SELECT size FROM shared) || ')'"
                if table == "DimPatient":
                    sql_type = f"CASE WHEN {longest} = 1 THEN 'CHAR(1)' ELSE {sql_type} END"
            rows.append(
                f"SELECT '{table}' AS \"table\", {position} AS position, '{name}' AS \"column\","
                f" '{kind}' AS spark_type, CAST({longest} AS INTEGER) AS max_length, {sql_type} AS sql_type"
            )
    size = f"SELECT {BUCKET.format(n='n')} AS size FROM (SELECT {_global_max()} AS n FROM visits)"
    return _with_visits(" UNION ALL ".join(rows), **_all_tables(), shared=size)


def _lengths(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST(coalesce(max(length({name})), 0) AS INTEGER) AS max_length,"
        f" {BUCKET.format(n=f'coalesce(max(length({name})), 0)')} AS varchar_length FROM {table}"
        for name in columns
    )


EDGES = [
    ("DimInsurance", "patient_id", "DimPatient"),
    ("DimBilling", "insurance_id", "DimInsurance"),
    *[("FacVisit", key, table) for table, key in ID_OF.items() if table != "FacVisit"],
]


def _constraints() -> str:
    checks = []
    for table, key in ID_OF.items():
        checks.append((table, "unique", key, f"SELECT count({key}) - count(DISTINCT {key}) FROM {table}"))
        checks.append((table, "not null", key, f"SELECT count(*) FROM {table} WHERE {key} IS NULL"))
    for table, key, parent in EDGES:
        missing = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{ID_OF[parent]} = c.{key})"
        found = f"SELECT count(*) FROM {table} c WHERE c.{key} IS NOT NULL AND {missing}"
        checks.append((table, f"references {parent}", key, found))
    rows = [
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, '{key}' AS \"column\","
        f" CAST(({found}) AS BIGINT) AS violations"
        for table, rule, key, found in checks
    ]
    return _with_visits(" UNION ALL ".join(rows), **_all_tables())


# Parents before children, and otherwise in the order in which the schema lists the tables.
LOADED = [
    "DimPatient",
    "DimProvider",
    "DimLocation",
    "DimPrimaryDiagnosis",
    "DimSecondaryDiagnosis",
    "DimTreatment",
    "DimPrescription",
    "DimLabOrder",
    "DimInsurance",
    "DimBilling",
    "FacVisit",
]


def _row_text(table: str) -> str:
    texts = [
        f"coalesce(CAST({f'CAST({name} AS DECIMAL(18,2))' if kind == 'double' else name} AS VARCHAR), '-')"
        for name, kind in TYPES[table]
    ]
    return f"concat_ws('|', {', '.join(texts)})"


def _loaded() -> str:
    rows = [
        f"SELECT {position} AS position, '{table}' AS \"table\", count(*) AS rows,"
        f" CAST(sum(CAST('0x' || substring(md5({_row_text(table)}), 1, 12) AS BIGINT)) AS VARCHAR) AS digest FROM {table}"
        for position, table in enumerate(LOADED)
    ]
    return _with_visits(" UNION ALL ".join(rows), **_all_tables())


def _dim_hash_keys() -> str:
    parts = max(len(keys) for keys in NATURAL.values())
    rows = []
    for table, keys in NATURAL.items():
        columns = [f"CAST({name} AS VARCHAR) AS part{i}" for i, name in enumerate(keys)]
        columns += [f"CAST(NULL AS VARCHAR) AS part{i}" for i in range(len(keys), parts)]
        rows.append(
            f"SELECT '{table}' AS \"table\", {ID_OF[table]} AS id, {', '.join(columns)} FROM ({_hashed(table)})"
        )
    return _with_visits(" UNION ALL ".join(rows))


def _unique_locations() -> str:
    prefix = _readable("DimLocation", "0")
    order = f"row_number() OVER (PARTITION BY prefix ORDER BY {_in_order('DimLocation')})"
    return (
        "SELECT CASE WHEN prefix IS NOT NULL AND count(*) OVER (PARTITION BY prefix) > 1"
        f" THEN prefix || '-' || CAST({order} AS VARCHAR) ELSE prefix END AS location_id, clinic_name, room_number"
        f" FROM (SELECT {prefix} AS prefix, clinic_name, room_number FROM ({_distinct('DimLocation')}))"
    )


MOMENTS = ["visit_datetime", "billing_date", "lab_result_date"]
FORMS = {
    "integer": "^[+-]?(0|[1-9][0-9]*)$",
    "decimal": "^[+-]?(0|[1-9][0-9]*)\\.[0-9]+$",
    "double": "^[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?[eE][+-]?[0-9]{1,3}$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,6})?$",
    "timestamp": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})$",
}


def _csv_types() -> str:
    """Kinds of all values as a CSV spells them, counted from one long table of texts."""
    cells = []
    for position, name in enumerate(COLUMNS):
        text = f"strftime({name}, '%Y-%m-%dT%H:%M:%S.%g')" if name in MOMENTS else f"CAST({name} AS VARCHAR)"
        cells.append(f"{{'position': {position}, 'column': '{name}', 'v': {text}}}")
    kinds = " ".join(f"WHEN regexp_matches(v, '{form}') THEN '{kind}'" for kind, form in FORMS.items())
    least = ", ".join(f"min(v) FILTER (kind = '{kind}') AS {kind}" for kind in [*FORMS, "text"])
    return _with_visits(
        "SELECT position, \"column\", CASE WHEN \"text\" IS NOT NULL OR (numbers > 0 AND moments > 0) THEN 'string'"
        " WHEN \"double\" IS NOT NULL OR whole + fraction > 38 THEN 'double'"
        " WHEN \"decimal\" IS NOT NULL OR whole > 18 THEN 'decimal(' || (whole + fraction) || ',' || fraction || ')'"
        " WHEN whole > 9 THEN 'bigint' WHEN numbers > 0 THEN 'int'"
        " WHEN \"timestamp\" IS NOT NULL THEN 'timestamp' WHEN timestamp_ntz IS NOT NULL THEN 'timestamp_ntz'"
        " WHEN \"date\" IS NOT NULL THEN 'date' ELSE 'string' END AS type, \"values\","
        ' "integer", "decimal", "double", "date", timestamp_ntz, "timestamp", "text" FROM found',
        cells=f"SELECT unnest([{', '.join(cells)}]) AS c FROM visits",
        kinds=f"SELECT c.position AS position, c.\"column\" AS \"column\", c.v AS v, CASE WHEN c.v IS NULL THEN NULL {kinds.replace('(v,', '(c.v,')} ELSE 'text' END AS kind FROM cells",
        found=f"SELECT position, \"column\", count(v) AS \"values\", {least},"
        " coalesce(max(length(regexp_extract(v, '^[+-]?([0-9]+)', 1))) FILTER (kind IN ('integer', 'decimal')), 0) AS whole,"
        " coalesce(max(length(regexp_extract(v, '\\.([0-9]+)$', 1))) FILTER (kind = 'decimal'), 0) AS fraction,"
        " count(*) FILTER (kind IN ('integer', 'decimal', 'double')) AS numbers,"
        " count(*) FILTER (kind IN ('date', 'timestamp_ntz', 'timestamp')) AS moments FROM kinds GROUP BY ALL",
    )


# The typed columns of the flat input, in its order.
FLAT_TYPES = {
    "visit_datetime": "timestamp",
    "patient_date_of_birth": "date",
    "billing_total_charge": "decimal(10,2)",
    "billing_amount_paid": "decimal(10,2)",
    "billing_date": "date",
    "room_number": "int",
    "prescription_duration_days": "int",
    "lab_result_value": "double",
    "lab_result_date": "timestamp",
}


def _losses() -> str:
    rows = []
    for name, kind in FLAT_TYPES.items():
        where, text = DIRT.get(name, ("FALSE", "''"))
        rows.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS type,"
            f" count(CASE WHEN {where} THEN {text} ELSE CAST({name} AS VARCHAR) END) AS given,"
            f" count(CASE WHEN {where} THEN {text} END) AS lost FROM visits"
        )
    return _with_visits(" UNION ALL ".join(rows))


def _flat_again(readable: bool, unique: bool = False) -> str:
    """The flat rows with what normalizing changes: entities as last seen, no description where the code is missing.

    A readable treatment id without a code is null, so there its description is lost as well; readable location ids
    collide and are left out unless they are unique, and are null without a room.
    """
    chosen, joins = ["v.visit_id", "v.visit_type"], []
    needs = {**REQUIRED, "DimTreatment": "treatment_code", "DimLocation": "room_number"} if readable else REQUIRED
    for table, query in {**_natural_dims(), **NATURAL}.items():
        key = ID_OF[table]
        if table in NATURAL:
            if not readable or unique or table != "DimLocation":
                needed = f"v.{needs[table]} IS NOT NULL" if table in needs else "TRUE"
                chosen += [f"CASE WHEN {needed} THEN v.{name} END AS {name}" for name in NATURAL[table]]
            continue
        joins.append(f"LEFT JOIN ({query}) {table} ON v.{key} = {table}.{key}")
        chosen += [f"{table}.{name}" for name, _ in TYPES[table] if name not in ID_OF.values()]
    return _with_visits(f"SELECT {', '.join(chosen)} FROM visits v {' '.join(joins)}")


def _dims() -> dict[str, str]:
    natural = _natural_dims()
    return {
        query: _with_visits(natural[table] if table in natural else _numbered(table))
        for query, table in DIM_QUERIES.items()
    }


def oracles() -> dict[str, str]:
    last_order = "max(o_orderdate)"
    return {
        "entity_status": f"SELECT o_custkey, {last_order} AS last_o_orderdate, {_status(last_order)} AS status"
        " FROM orders GROUP BY o_custkey",
        "entity_status_by_event": "SELECT user_id, max(ts) AS last_ts,"
        f" CASE WHEN CAST(max(ts) AS DATE) <= DATE '{EVENT_CUTOFF}' THEN 'inactive' ELSE 'active' END AS status"
        " FROM events GROUP BY user_id",
        "entity_status_defaults": "WITH e AS (SELECT c_name, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS custkey"
        " FROM customer), s AS (SELECT o_custkey,"
        f" {_status('''max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END)''')} AS status FROM orders"
        " WHERE o_custkey % 3 <> 0 GROUP BY o_custkey)"
        " SELECT c_name, custkey, coalesce(status, 'inactive') AS status FROM e LEFT JOIN s ON custkey = o_custkey",
        "cutoff_filter_ts": f"SELECT * FROM events WHERE ts <= TIMESTAMP '{EVENT_CUTOFF} 00:00:00'",
        "cutoff_filter_day": f"SELECT * FROM events WHERE CAST(ts AS DATE) <= DATE '{EVENT_CUTOFF}'",
        **_dims(),
        "not_null_filter": _with_visits(
            "SELECT visit_id, primary_diagnosis_code, primary_diagnosis_desc FROM visits"
            " WHERE primary_diagnosis_code IS NOT NULL"
        ),
        "drop_empty_rows": _with_visits(
            f"SELECT {', '.join(PRESCRIPTION)} FROM visits"
            f" WHERE NOT ({' AND '.join(f'{name} IS NULL' for name in PRESCRIPTION)})"
        ),
        "lenient_casts": "SELECT CAST(o_orderdate AS DATE) AS o_orderdate,"
        " CAST(o_totalprice AS DECIMAL(10,2)) AS o_totalprice, TRY_CAST(o_orderpriority AS INTEGER)"
        " AS o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderkey AS INTEGER) AS o_orderkey"
        " FROM orders",
        "short_codes": _with_visits(
            f"SELECT visit_id, {_reduced(_initials('clinic_name'), 4)} AS clinic_code,"
            f" {_reduced(_initials('doctor_department'), 3)} AS department_code FROM visits"
        ),
        "length_buckets": "SELECT doc_id, CAST(length(text) AS INTEGER) AS length,"
        f" {BUCKET.format(n='length(text)')} AS size FROM documents",
        "length_buckets_own_sizes": "SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 50 WHEN length(text) <= 200 THEN 200"
        " WHEN length(text) <= 2000 THEN 2000 WHEN length(text) <= 20000 THEN 20000"
        " ELSE (length(text) // 1000 + 1) * 1000 END AS INTEGER) AS size FROM documents",
        "provider_own_threshold": _with_visits(_numbered("DimProvider", 1)),
        "timestamp_text": "SELECT CAST(event_id AS VARCHAR) AS event_id,"
        " strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+02:00' AS ts FROM events",
        "sequence_numbers": "SELECT o_orderdate, o_orderkey,"
        " row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders",
        "dim_hash_keys": _dim_hash_keys(),
        "fact_hash_fk": _with_visits(_fact_hashed()),
        "fact_hash_fk_nullsafe": _with_visits(_fact_hashed(null_safe=True)),
        "fact_lookup": _with_visits(_fact_joined("=")),
        "fact_lookup_nullsafe": _with_visits(_fact_joined("IS NOT DISTINCT FROM")),
        "fact_lookup_shuffled": _with_visits(_fact_joined("=")),
        "fact_lookup_nullsafe_shuffled": _with_visits(_fact_joined("IS NOT DISTINCT FROM")),
        "length_profile": _lengths("documents", ["text", "lang", "source"]),
        "global_length": _with_visits(
            f"SELECT CAST(n AS INTEGER) AS max_length, {BUCKET.format(n='n')} AS varchar_length"
            f" FROM (SELECT {_global_max()} AS n FROM visits)"
        ),
        "column_length": "SELECT CAST(max(length(html)) AS INTEGER) AS max_length,"
        f" {BUCKET.format(n='max(length(html))')} AS varchar_length FROM pages",
        "char1_columns": _with_visits(
            f'SELECT "column" FROM ({_lengths("visits", FLAT_TEXT)}) WHERE max_length = 1'
        ),
        "overlong_columns": f"SELECT * FROM ({_lengths('pages', ['url', 'html'])}) WHERE max_length > 255",
        "overlong_samples": " UNION ALL ".join(
            f"SELECT * FROM (SELECT doc_id AS row_key, '{name}' AS \"column\", {name} AS value,"
            f" CAST(row_number() OVER (ORDER BY doc_id, {name}) AS INTEGER) AS rank"
            f" FROM documents WHERE length({name}) > 255) WHERE rank <= 5"
            for name in ("text", "lang", "source")
        ),
        "type_recommendation": _types(),
        "distinct_values": _with_visits("SELECT DISTINCT patient_state FROM visits"),
        "distinct_initials": _with_visits(
            f"SELECT DISTINCT doctor_department, {_initials('doctor_department')} AS code FROM visits"
        ),
        "pk_violations": _with_visits(
            "SELECT billing_id, count(*) AS rows FROM visits WHERE billing_id IS NOT NULL GROUP BY billing_id HAVING count(*) > 1"
        ),
        "pk_violations_location": _with_visits(
            f"SELECT location_id, count(*) AS rows FROM ({_numbered('DimLocation')})"
            " WHERE location_id IS NOT NULL GROUP BY location_id HAVING count(*) > 1"
        ),
        "dim_location_unique": _with_visits(_unique_locations()),
        "pk_violations_location_unique": _with_visits(
            f"SELECT location_id, count(*) AS rows FROM ({_unique_locations()})"
            " WHERE location_id IS NOT NULL GROUP BY location_id HAVING count(*) > 1"
        ),
        "pk_nulls": _with_visits(f"SELECT * FROM ({_numbered('DimLocation')}) WHERE location_id IS NULL"),
        "fk_violations": _with_visits(
            "SELECT insurance_id, count(*) AS rows FROM visits v WHERE insurance_id IS NOT NULL AND NOT EXISTS"
            " (SELECT 1 FROM i WHERE i.insurance_id = v.insurance_id) GROUP BY insurance_id",
            i=f"SELECT * FROM ({_natural(INSURANCE, 'insurance_id')}) WHERE insurance_plan_type <> 'A'",
        ),
        "constraint_report": _constraints(),
        "csv_roundtrip": "SELECT * FROM orders",
        "csv_infer_roundtrip": _with_visits(
            "SELECT * REPLACE (CAST(patient_id AS INTEGER) AS patient_id,"
            " CAST(patient_date_of_birth AS DATE) AS patient_date_of_birth) FROM visits"
        ),
        "csv_types": _csv_types(),
        "cast_losses": _losses(),
        "csv_to_fact": _with_visits(_fact_hashed()),
        "load_and_read_back": _loaded(),
        "export_and_read_back": _loaded(),
        "one_pass_load": _loaded(),
        "batch_keys": _batch_keys(),
        "batch_fact": _with_visits(
            _fact_joined("=", lambda table: _numbered(table) if table == "DimLocation" else _numbered_in_batches(table))
        ),
        "batch_load_and_read_back": _loaded(),
        "batch_constraint_report": _constraints(),
        "export_billing": _with_visits(
            "SELECT billing_id, insurance_id, CAST(billing_total_charge AS VARCHAR) AS billing_total_charge,"
            " CAST(billing_amount_paid AS VARCHAR) AS billing_amount_paid,"
            " CAST(billing_date AS VARCHAR) AS billing_date, billing_payment_status"
            f" FROM ({_natural(BILLING, 'billing_id')})"
        ),
        "key_slices": _with_visits(
            "SELECT CAST(slice AS INTEGER) AS slice, count(*) AS rows, min(visit_id) AS first_key, max(visit_id) AS last_key"
            " FROM (SELECT visit_id, (SELECT count(*) FROM range(1, 16) b(k) WHERE (k * n) // 16 <= place) AS slice FROM placed)"
            " GROUP BY slice",
            placed="SELECT visit_id, row_number() OVER (ORDER BY visit_id) - 1 AS place, count(*) OVER () AS n FROM visits",
        ),
        "preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 20",
        "normalize_roundtrip": _flat_again(readable=False),
        "normalize_roundtrip_sequence": _flat_again(readable=True),
        "normalize_roundtrip_unique": _flat_again(readable=True, unique=True),
    }
