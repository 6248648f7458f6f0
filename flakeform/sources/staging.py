"""Shared scratch tables that outlive any single executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.sources.files import remove

# Codec of intermediate and stored tables: a third smaller than Spark's default.
CODEC = "zstd"
# Stored bytes of the rows that are worked on at once where a table is made part by part.
PART_BYTES = 256 * 1024 * 1024
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
# Folders of the staged tables that are in use.
_folders: WeakKeyDictionary[DataFrame, list[str]] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder, or what ``spark.checkpoint.dir`` names.

    Where that is unset, a ``local[*]`` session gets a temporary folder of its own; a cluster
    session fails, since a folder on one machine would be invisible to the others.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="flakeform-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh, unused folder under the shared one."""
    path = f"{shared_dir(spark)}/flakeform/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every intermediate table that was staged in it.

    What the block returns must have been written or collected by then: a DataFrame that still reads staged rows loses them.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every query that ends in the block, at its end.

    Otherwise they stay until the driver happens to collect its garbage, and add up over the steps of a job. Only for actions
    whose DataFrame is not run a second time, as writes are. Before Spark 4.1 this changes nothing.
    """
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once as Parquet and read them back.

    Cuts the lineage, survives lost executors, keeps column pruning and filter pushdown for
    every later read, and pins whatever the plan could evaluate differently a second time.
    """
    return stage_parts([df], label)


def stage_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """Stage tables of one schema, at least one, as one table, each in a folder of its own.

    They are written one after another: what one part shuffles is deleted before the next begins, so that the disk holds the
    rows and one part's shuffle.
    """
    folders: list[str] = []
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        folders.append(new_folder(spark, label))
        with releasing(spark):
            df.write.option("compression", CODEC).parquet(folders[-1])
    staged = spark.read.schema(schema).parquet(*folders)
    _folders[staged] = folders
    return staged


def parts_of(staged: DataFrame) -> list[DataFrame]:
    """The parts that a table was staged in; any other table is one part."""
    folders = _folders.get(staged, [])
    if len(folders) < 2:
        return [staged]
    return [staged.sparkSession.read.schema(staged.schema).parquet(path) for path in folders]


def discard(staged: DataFrame) -> None:
    """Remove a staged table that nothing will read again; any other table is left alone."""
    for path in _folders.pop(staged, []):
        remove(staged.sparkSession, path)


def parts_for(stored: DataFrame, part_bytes: int | None = None) -> int:
    """Parts to work on a stored table in, by the size of its files and the columns chosen; one for a table without files."""
    if not stored.inputFiles():
        return 1  # Spark takes rows of unknown size for endless
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // (part_bytes or PART_BYTES)))


def in_part(columns: Sequence[str], part: int, parts: int) -> Column:
    """True for the rows of a part: equal values are in one. The hash is not the one that Spark shuffles by."""
    return F.lit(True) if parts == 1 else F.pmod(F.xxhash64(*columns), F.lit(parts)) == part
