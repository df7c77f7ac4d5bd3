"""Small pieces that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.session import scratch_path

#: The characters of ``[\x20\x09-\x0D]``; ``bytes.split()`` cuts at exactly these.
WHITE = b" \t\n\x0b\x0c\r"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage with a copy that outlives any executor; narrow tables only.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of one Arrow batch between Spark and a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the session's Arrow batches by bytes: rows are texts of any length, and a
    batch of 10,000 of them would be held several times in the JVM and in the worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


#: What a worker keeps for its next task, by stage and name.
_KEPT: dict[tuple[int | None, str], object] = {}


def _forget_other_stages() -> int | None:
    context = TaskContext.get()
    stage = context.stageId() if context else None
    for key in [k for k in _KEPT if k[0] != stage]:
        del _KEPT[key]
    return stage


def kept(name: str, make: Callable[[], object]):
    """``make()``, kept by the worker for further tasks of the same stage and dropped in the next one that is ``given_back``."""
    key = (_forget_other_stages(), name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def given_back(task: Callable) -> Callable:
    """``task`` over Arrow batches, which returns its freed memory to the system at its end.

    Workers are used again by later stages, and what one stage keeps in them adds to the next one's.
    """
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch], *rest, **options) -> Iterator[pa.RecordBatch]:
        _forget_other_stages()
        yield from task(batches, *rest, **options)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)
    return run


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a flat DDL string, for batches made inside tasks."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def power_of_two(n: float, least: int, most: int) -> int:
    """The smallest power of two that is at least ``n``, within [least, most]."""
    size = least
    while size < n and size < most:
        size *= 2
    return size
