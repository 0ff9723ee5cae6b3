"""Helpers shared by the operators: scratch tables, code versions of SQL idioms, Arrow batches."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch.  Texts may be long, so batches are kept short.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one is made only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lookback-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table of the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read of that table, not a new run of its plan.
    ``drop_scratch`` removes the tables that a session has written.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/lookback-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the tables that ``written`` has made in this application (call it when results are saved)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark).rstrip('/')}/lookback-llm/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application (no installation on executors is needed)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    at = os.path.join(tempfile.mkdtemp(prefix="lookback-code-"), "lookback-code.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(at)  # Spark's own file server hands it to the executors
    _shipped.add(app)


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches at BATCH_ROWS rows and BATCH_BYTES, so that long texts don't fill a worker."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


_kept: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What the worker keeps from task to task of one operator (``owner``), until it gets a task of another."""
    return _kept.setdefault(owner, {})


def drop_others(owner: str | None) -> None:
    """Forget what the worker keeps for others than ``owner``."""
    for name, held in _kept.items():
        if name != owner:
            held.clear()


def tidy(fn: Callable, owner: str | None = None) -> Callable:
    """A ``mapInArrow`` function that hands its worker's free memory back when its task ends.

    Workers live on between tasks, and several of them share an executor's memory; what one keeps for another operator
    than ``owner`` goes as the task starts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(owner)
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            import ctypes

            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return run


#: Rows and bytes of a batch that ``gathered`` hands on.
OUT_ROWS, OUT_BYTES = 20_000, 4 << 20


def gathered(fn: Callable) -> Callable:
    """A ``mapInArrow`` function whose small batches are handed on together, at most OUT_ROWS rows or OUT_BYTES bytes.

    A function may then yield a batch for each text without holding those of its whole input batch.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for b in fn(batches):
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            size += b.nbytes
            if rows >= OUT_ROWS or size >= OUT_BYTES:
                yield pa.concat_batches(held)
                held, rows, size = [], 0, 0
        if held:
            yield pa.concat_batches(held)

    return run


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str, owner: str | None = None) -> DataFrame:
    """``mapInArrow`` with a function from column lists to column lists of the same or another length."""
    ship_code(df.sparkSession)
    short_batches(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(tidy(run, owner), schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, made: tuple[str, ...]) -> DataFrame:
    """``df`` without columns that have the name of one that an operator makes (in any case)."""
    low = {m.lower() for m in made}
    return df.select(*[df[c] for c in df.columns if c.lower() not in low])
