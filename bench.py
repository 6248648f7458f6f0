"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query is planned, run and
written to Spark's ``noop`` sink, which computes all rows and columns. One earlier pass over
the smallest data loads classes and compiles hot code.

Rounds over the headline queries are repeated, three at most, as long as they fit into ``BENCH_SECONDS``; a query's best counts.
``compare`` has the whole job staged once with hash keys against the shape of a plain script: the CSV scanned again for every
table with inferred types, readable ids, and lookup joins for the fact. ``BENCH_COMPARE=0`` leaves it out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from flakeform.plans.job import normalize_csv  # noqa: E402
from flakeform.plans.normalize import SEQUENCE, normalize  # noqa: E402
from flakeform.sources.csv import read_csv, write_csv  # noqa: E402
from flakeform.sources.staging import new_folder, scratch  # noqa: E402
from workload.queries import QUERIES, STAR  # noqa: E402
from workload.visits import visits  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
ROUNDS, SECONDS = 3, float(os.environ.get("BENCH_SECONDS", "420"))
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = str(Path(SF_DIR).parent / "sf0.001")
HEADLINE = [
    "entity_status",
    "dim_patient",
    "dim_insurance",
    "dim_billing",
    "dim_provider",
    "dim_location",
    "dim_prescription",
    "dim_lab_order",
    "dim_hash_keys",
    "fact_hash_fk",
    "fact_lookup",
    "fact_lookup_shuffled",
    "global_length",
    "length_profile",
    "overlong_samples",
    "type_recommendation",
    "pk_violations",
    "fk_violations",
    "constraint_report",
    "csv_to_fact",
    "load_and_read_back",
    "normalize_roundtrip",
]
# Later queries, timed once and not part of the total, which stays comparable.
MORE = ["one_pass_load", "batch_load_and_read_back", "csv_types", "cast_losses"]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("flakeform-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def compared(spark: SparkSession) -> dict[str, float]:
    """All eleven tables from one CSV: staged once with hash keys, against rescans with lookups."""
    path = new_folder(spark, "bench-csv")
    flat = visits(spark, SF_DIR)
    write_csv(flat, path)

    def staged() -> None:
        for df in normalize_csv(spark, path, STAR, schema=flat.schema).values():
            consume(df)

    def rescanned() -> None:
        for df in normalize(read_csv(spark, path), STAR, SEQUENCE).values():
            consume(df)

    return {
        name: min(timed(action) for _ in range(2))
        for name, action in (("job_staged_hash", staged), ("job_rescan_lookup", rescanned))
    }


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        consume(QUERIES[name](spark, WARM_DIR))
    seconds: dict[str, float] = {}
    began, rounds = time.perf_counter(), 0
    while rounds < ROUNDS and (time.perf_counter() - began) * (rounds + 1) <= SECONDS * max(1, rounds):
        for name in HEADLINE:
            with scratch(spark):
                took = timed(lambda name=name: consume(QUERIES[name](spark, SF_DIR)))
            seconds[name] = min(took, seconds.get(name, took))
        rounds += 1
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rounds": rounds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    result["more"] = {name: timed(lambda name=name: consume(QUERIES[name](spark, SF_DIR))) for name in MORE}
    if os.environ.get("BENCH_COMPARE") != "0":
        result["compare"] = compared(spark)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
