"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.functions import initials, length_bucket, padded_sequence, reduced_code, text_length
from flakeform.operators import clean, constraints, profile, status
from flakeform.operators.lookup import lookups
from flakeform.operators.losses import CastLosses
from flakeform.operators.registry import KeyRegistry
from flakeform.operators.sequence import dense_sequence
from flakeform.plans.batches import Batches
from flakeform.plans.healthcare import healthcare
from flakeform.plans.job import migrate, normalize_csv
from flakeform.plans.normalize import (
    HASH,
    SEQUENCE,
    fact_with_hashes,
    fact_with_lookups,
    natural_dim,
    normalize,
    surrogate_dim,
    surrogate_rows,
)
from flakeform.plans.onepass import normalize_once
from flakeform.plans.specs import Field, NaturalDim, Snowflake, TableSpec
from flakeform.sources.csv import read_csv, read_inferred, write_csv
from flakeform.sources.jdbc import key_bounds, key_ranges
from flakeform.sources.staging import CODEC, discard, new_folder, parts_for, parts_of, releasing, stage, stage_parts
from flakeform.sources.tables import export_tables, preview, read_parquet
from workload.visits import dirty, staged_visits, table, visit_parts, visits

# The driver's dates run from 1995 to 2001, so this cutoff splits them.
CUTOFF = "2000-12-31"
EVENT_CUTOFF = "2024-01-10"
# Visits before this day are the first of two batches.
SECOND_BATCH = "1998-01-01"
OWN_SIZES = (200, 2000, 20000)
# Rows in one part of a compressed CSV, which one task reads.
CSV_PART_ROWS = 150_000
CSV_CODEC = "gzip"
# Stored bytes of the visits that one pass for all tables shuffles; its shuffle is some eight times as large.
ONE_PASS_BYTES = 1024 * 1024 * 1024
STAR = healthcare(status_cutoff=CUTOFF)
UNIQUE_STAR = healthcare(status_cutoff=CUTOFF, unique_locations=True)

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spec: TableSpec) -> list[str]:
    """Flat columns that a dimension reads."""
    helpers = [spec.recency, spec.tie_breaker] if isinstance(spec, NaturalDim) else []
    return list(dict.fromkeys([*[field.name for field in spec.fields], *helpers]))


def _dim(name: str, keys: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = STAR.table(name)
    flat = visits(spark, sf_dir, _inputs(spec))
    return natural_dim(flat, spec) if isinstance(spec, NaturalDim) else surrogate_dim(flat, spec, keys)


def _fact_inputs() -> list[str]:
    own = [field.name for field in STAR.fact.fields]
    return [*own, *[name for dim in STAR.surrogate_dims for name in dim.natural_key]]


def entity_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.entity_status(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "status", CUTOFF)


def entity_status_by_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.entity_status(table(spark, sf_dir, "events"), "user_id", "ts", "status", EVENT_CUTOFF)


def entity_status_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, some without an id or any order, and orders, some without a date or a customer."""
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey"))
    entities = table(spark, sf_dir, "customer").select("c_name", known.alias("custkey"))
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    owner = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(owner.alias("custkey"), dated.alias("ordered"))
    statuses = status.entity_status(orders, "custkey", "ordered", "status", CUTOFF)
    return status.attach_status(entities, stage(statuses, "statuses"), "custkey", "status")


def cutoff_filter_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.up_to_midnight(table(spark, sf_dir, "events"), "ts", EVENT_CUTOFF)


def cutoff_filter_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(clean.on_or_before(F.col("ts"), EVENT_CUTOFF))


def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    diagnosis = visits(spark, sf_dir, ["visit_id", *STAR.table("DimPrimaryDiagnosis").natural_key])
    return clean.require(diagnosis, ["primary_diagnosis_code"])


def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [field.name for field in STAR.table("DimPrescription").fields]
    return clean.drop_empty_rows(visits(spark, sf_dir, fields))


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, decimals, whole numbers and text out of the columns' own types; a brand is no number."""
    fields = [
        Field("o_orderdate", "date"),
        Field("o_totalprice", "decimal(10,2)"),
        Field("o_orderpriority", "int"),
        Field("o_custkey", "string"),
        Field("o_orderkey", "int"),
    ]
    return clean.project(table(spark, sf_dir, "orders"), fields)


def short_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = visits(spark, sf_dir, ["clinic_name", "doctor_department", "visit_id"])
    return flat.select(
        "visit_id",
        reduced_code(initials(F.col("clinic_name")), 4).alias("clinic_code"),
        reduced_code(initials(F.col("doctor_department")), 3).alias("department_code"),
    )


def length_buckets_own_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = text_length(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", length_bucket(length, OWN_SIZES).alias("size"))


def provider_own_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = healthcare(provider_threshold=1).table("DimProvider")
    return surrogate_dim(visits(spark, sf_dir, _inputs(spec)), spec, SEQUENCE)


def timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as a CSV writes them in a fixed zone, read back as plain text."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    path = new_folder(spark, "events-csv")
    write_csv(events, path, time_zone="+02:00")
    return spark.read.csv(path, header=True)


def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every whole text and the size that holds it."""
    length = text_length(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", length.alias("length"), length_bucket(length).alias("size")
    )


def sequence_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders numbered by date and key."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return dense_sequence(orders, ["o_orderdate", "o_orderkey"], "seq")


def dim_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every surrogate dimension's ids with all parts of the natural key, as text."""
    longest = max(len(spec.natural_key) for spec in STAR.surrogate_dims)
    parts = []
    flat = stage(visits(spark, sf_dir, [name for spec in STAR.surrogate_dims for name in spec.natural_key]), "visits")
    for spec in STAR.surrogate_dims:
        columns = [F.col(name).cast("string") for name in spec.natural_key]
        columns += [F.lit(None).cast("string")] * (longest - len(columns))
        parts.append(
            surrogate_dim(flat, spec).select(
                F.lit(spec.name).alias("table"),
                F.col(spec.primary_key).alias("id"),
                *[column.alias(f"part{i}") for i, column in enumerate(columns)],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _fact_hash_fk(spark: SparkSession, sf_dir: str, **options: bool) -> DataFrame:
    return fact_with_hashes(visits(spark, sf_dir, _fact_inputs()), STAR, **options)


def _fact_lookup(
    spark: SparkSession,
    sf_dir: str,
    **options: bool | int,
) -> DataFrame:
    flat = staged_visits(spark, sf_dir, _fact_inputs())
    dims = {spec.name: surrogate_dim(flat, spec, SEQUENCE) for spec in STAR.surrogate_dims}
    return stage_parts((fact_with_lookups(part, STAR, dims, **options) for part in parts_of(flat)), "fact")


def length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_report(table(spark, sf_dir, "documents"))


def global_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.global_length(visits(spark, sf_dir))


def column_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_length(table(spark, sf_dir, "pages"), "html")


def char1_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.single_char_columns(visits(spark, sf_dir))


def overlong_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overlong_columns(table(spark, sf_dir, "pages"))


def overlong_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overlong_samples(table(spark, sf_dir, "documents"), "doc_id")


def type_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of surrogate dimensions are those of their rows before deduplication."""
    flat = staged_visits(spark, sf_dir)
    one_char = [spec.name for spec in STAR.tables if spec.one_char_text]
    rows = {spec.name: surrogate_rows(flat, spec) for spec in STAR.surrogate_dims}
    return profile.type_recommendation({**normalize(flat, STAR), **rows}, flat, one_char, stepwise=True)


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(visits(spark, sf_dir, ["patient_state"]), "patient_state")


def distinct_initials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_initials(visits(spark, sf_dir, ["doctor_department"]), "doctor_department")


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(visits(spark, sf_dir, ["billing_id"]), "billing_id")


def pk_violations_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable location ids collide where clinics share initials and room."""
    return constraints.duplicate_keys(_dim("DimLocation", SEQUENCE, spark, sf_dir), "location_id")


def dim_location_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location ids with the order of those that clinics share."""
    spec = UNIQUE_STAR.table("DimLocation")
    return surrogate_dim(visits(spark, sf_dir, _inputs(spec)), spec, SEQUENCE)


def pk_violations_location_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.duplicate_keys(dim_location_unique(spark, sf_dir), "location_id")


def pk_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.null_keys(_dim("DimLocation", SEQUENCE, spark, sf_dir), "location_id")


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insurance references against the insurances that are not of plan 'A'."""
    insurance = _dim("DimInsurance", HASH, spark, sf_dir).filter(F.col("insurance_plan_type") != "A")
    fact = visits(spark, sf_dir, ["insurance_id"])
    return constraints.orphans(fact, "insurance_id", insurance, "insurance_id")


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = normalize(staged_visits(spark, sf_dir), STAR)
    dims = {spec.name: stage(tables[spec.name].select(*constraints.key_columns(STAR, spec)), spec.name) for spec in STAR.dims}
    return constraints.constraint_report({**tables, **dims}, STAR, stepwise=True)


def _csv_copy(parts: list[DataFrame], label: str) -> str:
    """The rows as CSV, compressed: the text of the visits is many times as large as the tables they come from."""
    path = new_folder(parts[0].sparkSession, label)
    for df in parts:
        write_csv(df, path, compression=CSV_CODEC, part_rows=CSV_PART_ROWS, append=True)
    return path


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return read_csv(spark, _csv_copy([orders], "orders-csv"), orders.schema)


def csv_infer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns typed by their text alone: codes with leading zeros stay text, fractions compare as doubles."""
    flat, _ = read_inferred(spark, _csv_copy(visit_parts(spark, sf_dir), "visits-csv"))
    return flat.select(*[F.col(c).cast("double") if kind.startswith("decimal") else F.col(c) for c, kind in flat.dtypes])


def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type of every column of the visits, told from their text, with a value of each kind found."""
    return read_inferred(spark, _csv_copy(visit_parts(spark, sf_dir), "visits-csv"))[1]


def cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a dirty CSV that its schema cannot hold, counted while the rows are staged."""
    losses = CastLosses()
    normalize_csv(spark, _csv_copy([dirty(flat) for flat in visit_parts(spark, sf_dir)], "dirty-csv"), STAR, losses=losses)
    return losses.report(spark)


def csv_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's first half: flat CSV in, normalized fact out."""
    parts = visit_parts(spark, sf_dir)
    return normalize_csv(spark, _csv_copy(parts, "visits-csv"), STAR, schema=parts[0].schema)["FacVisit"]


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table and a sum over them of 48 bits of the MD5 of all columns' text."""
    found = []
    for position, (name, df) in enumerate(tables.items()):
        plain = [F.col(c).cast("decimal(18,2)") if kind == "double" else F.col(c) for c, kind in df.dtypes]
        text = F.concat_ws("|", *[F.coalesce(value.cast("string"), F.lit("-")) for value in plain])
        bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
        halves = df.select(F.shiftright(bits, 24).alias("high"), bits.bitwiseAND(F.lit((1 << 24) - 1)).alias("low"))
        measured = halves.agg(F.count(F.lit(1)).alias("rows"), F.sum("high").alias("high"), F.sum("low").alias("low"))
        digest = F.col("high").cast("decimal(20,0)") * F.lit(1 << 24) + F.col("low")  # halves' sums stay far below a long's end
        found.append(
            measured.select(
                F.lit(position).alias("position"), F.lit(name).alias("table"), "rows", digest.cast("string").alias("digest")
            )
        )
    return reduce(DataFrame.unionByName, found)


def load_and_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables loaded in dependency order and read back: rows and digest of the contents per table."""
    flat = staged_visits(spark, sf_dir)
    folder = new_folder(spark, "loaded")

    def sink(df: DataFrame, name: str) -> None:
        with releasing(spark):
            df.write.option("compression", CODEC).parquet(f"{folder}/{name}")

    migrate(normalize(flat, STAR), STAR, sink, staged=False)
    return _digests(read_parquet(spark, STAR, folder))


def export_and_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables exported as CSV and read back by their types: rows and digest of the contents per table."""
    tables = normalize(staged_visits(spark, sf_dir), STAR)
    folder = new_folder(spark, "exported")
    export_tables(tables.__getitem__, STAR, folder, compression=CSV_CODEC, part_rows=CSV_PART_ROWS)
    return _digests({name: read_csv(spark, f"{folder}/{name}", df.schema) for name, df in tables.items()})


def export_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The billing table loaded, exported as CSV in key order, and read back as plain text."""
    spec = STAR.table("DimBilling")
    billing = stage(_dim(spec.name, HASH, spark, sf_dir), "loaded")
    path = new_folder(spark, "billing-csv")
    write_csv(billing, path, order_by=spec.primary_key)
    return spark.read.csv(path, header=True)


def key_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions that read a table back in 16 slices, tried on its rows: size, first and last key of each."""
    keys = visits(spark, sf_dir, ["visit_id"])
    conditions = key_ranges("visit_id", key_bounds(keys, "visit_id", 16))
    met = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(place)) for place, rule in enumerate(conditions)]))
    sliced = keys.withColumn("slice", F.explode(met))
    return sliced.groupBy("slice").agg(
        F.count(F.lit(1)).alias("rows"), F.min("visit_id").alias("first_key"), F.max("visit_id").alias("last_key")
    )


def preview_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "customer").orderBy("c_custkey"))


def _roundtrip(keys: str, spark: SparkSession, sf_dir: str, star: Snowflake = STAR) -> DataFrame:
    """Normalize, then put the flat rows together again from the fact and its dimensions.

    Readable location ids collide unless made unique; where they do, a visit cannot tell its clinic by them.
    """
    flat = staged_visits(spark, sf_dir)
    tables = normalize(flat, star, keys, null_safe=True)
    fact = tables["FacVisit"]
    wanted = {
        spec.name: [name for name in tables[spec.name].columns if name not in fact.columns]
        for spec in star.dims
        if keys == HASH or star is UNIQUE_STAR or spec.name != "DimLocation"
    }
    rows = stage(fact.withColumn("_row", F.monotonically_increasing_id()), "fact")
    discard(fact)
    dims = [(stage(tables[name], name), star.table(name).primary_key, columns) for name, columns in wanted.items()]
    discard(flat)
    whole = lookups(rows, "_row", dims, used_up=True)
    return whole.select("visit_id", "visit_type", *[name for columns in wanted.values() for name in columns])


def one_pass_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables from one pass over the joined visits, a pass per part where they are many: rows and digest of the contents per table."""
    flat = staged_visits(spark, sf_dir)
    return _digests(normalize_once(flat, STAR, new_folder(spark, "one-pass"), parts=parts_for(flat, ONE_PASS_BYTES)))


def _two_batches(flat: DataFrame) -> list[DataFrame]:
    early = F.col("billing_date") < F.lit(SECOND_BATCH).cast("date")
    return [flat.filter(early), flat.filter(~early)]


def batch_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered ids of every surrogate dimension after two batches, and the id after the first where the key was known."""
    specs = [spec for spec in STAR.surrogate_dims if spec.key.numbered]
    longest = max(len(spec.natural_key) for spec in specs)
    flat = stage(visits(spark, sf_dir, ["billing_date", *[name for spec in specs for name in spec.natural_key]]), "visits")
    found = []
    for spec in specs:
        registry = KeyRegistry(spark, new_folder(spark, spec.name), spec.natural_key)
        one, two = [registry.register(clean.require(rows, spec.required)) for rows in _two_batches(flat)]
        surrogate = F.concat(spec.key.prefix(), padded_sequence(F.col("number"), spec.key.pad))
        parts = [F.col(name).alias(f"part{i}") for i, name in enumerate(spec.natural_key)]
        parts += [F.lit(None).cast("string").alias(f"part{i}") for i in range(len(spec.natural_key), longest)]
        before = one.select(surrogate.alias("first_id"), "number")
        both = two.select(surrogate.alias("id"), "number", *parts).join(before, "number", "left")
        found.append(both.select(F.lit(spec.name).alias("table"), "id", "first_id", *[f"part{i}" for i in range(longest)]))
    return reduce(DataFrame.unionByName, found)


def _loaded_in_batches(spark: SparkSession, sf_dir: str, keys: str, checks: bool = False) -> Batches:
    batches = Batches(spark, STAR, new_folder(spark, "batches"), keys, checks=checks)
    for number, rows in enumerate(_two_batches(staged_visits(spark, sf_dir)), 1):
        batches.load(rows, str(number))
    return batches


def batch_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of two batches, with ids numbered batch by batch."""
    return _loaded_in_batches(spark, sf_dir, SEQUENCE).table(STAR.fact.name)


def batch_load_and_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables loaded in two batches: rows and digest of the contents per table, as after one load of everything."""
    return _digests(_loaded_in_batches(spark, sf_dir, HASH).tables())


def batch_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole schema's constraints after two batches, from stored key counts."""
    return _loaded_in_batches(spark, sf_dir, HASH, checks=True).report()


DIM_QUERIES = {
    "dim_patient": "DimPatient",
    "dim_insurance": "DimInsurance",
    "dim_billing": "DimBilling",
    "dim_provider": "DimProvider",
    "dim_location": "DimLocation",
    "dim_primary_diagnosis": "DimPrimaryDiagnosis",
    "dim_secondary_diagnosis": "DimSecondaryDiagnosis",
    "dim_treatment": "DimTreatment",
    "dim_prescription": "DimPrescription",
    "dim_lab_order": "DimLabOrder",
}

QUERIES: dict[str, Query] = {
    "entity_status": entity_status,
    "entity_status_by_event": entity_status_by_event,
    "entity_status_defaults": entity_status_defaults,
    "cutoff_filter_ts": cutoff_filter_ts,
    "cutoff_filter_day": cutoff_filter_day,
    **{query: partial(_dim, name, SEQUENCE) for query, name in DIM_QUERIES.items()},
    "not_null_filter": not_null_filter,
    "drop_empty_rows": drop_empty_rows,
    "lenient_casts": lenient_casts,
    "short_codes": short_codes,
    "length_buckets": length_buckets,
    "length_buckets_own_sizes": length_buckets_own_sizes,
    "provider_own_threshold": provider_own_threshold,
    "timestamp_text": timestamp_text,
    "sequence_numbers": sequence_numbers,
    "dim_hash_keys": dim_hash_keys,
    "fact_hash_fk": _fact_hash_fk,
    "fact_hash_fk_nullsafe": partial(_fact_hash_fk, null_safe=True),
    "fact_lookup": _fact_lookup,
    "fact_lookup_nullsafe": partial(_fact_lookup, null_safe=True),
    "fact_lookup_shuffled": partial(_fact_lookup, broadcast_bytes=0),
    "fact_lookup_nullsafe_shuffled": partial(_fact_lookup, null_safe=True, broadcast_bytes=0),
    "length_profile": length_profile,
    "global_length": global_length,
    "column_length": column_length,
    "char1_columns": char1_columns,
    "overlong_columns": overlong_columns,
    "overlong_samples": overlong_samples,
    "type_recommendation": type_recommendation,
    "distinct_values": distinct_values,
    "distinct_initials": distinct_initials,
    "pk_violations": pk_violations,
    "pk_violations_location": pk_violations_location,
    "dim_location_unique": dim_location_unique,
    "pk_violations_location_unique": pk_violations_location_unique,
    "pk_nulls": pk_nulls,
    "fk_violations": fk_violations,
    "constraint_report": constraint_report,
    "csv_roundtrip": csv_roundtrip,
    "csv_infer_roundtrip": csv_infer_roundtrip,
    "csv_types": csv_types,
    "cast_losses": cast_losses,
    "csv_to_fact": csv_to_fact,
    "load_and_read_back": load_and_read_back,
    "export_and_read_back": export_and_read_back,
    "one_pass_load": one_pass_load,
    "batch_keys": batch_keys,
    "batch_fact": batch_fact,
    "batch_load_and_read_back": batch_load_and_read_back,
    "batch_constraint_report": batch_constraint_report,
    "export_billing": export_billing,
    "key_slices": key_slices,
    "preview": preview_customers,
    "normalize_roundtrip": partial(_roundtrip, HASH),
    "normalize_roundtrip_sequence": partial(_roundtrip, SEQUENCE),
    "normalize_roundtrip_unique": partial(_roundtrip, SEQUENCE, star=UNIQUE_STAR),
}
