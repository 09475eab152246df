"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from functools import wraps
from inspect import isgeneratorfunction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmill.sinks.files import Files
from lossmill.sinks.scratch import scratch_path

# The letters that the contracts fold, and their lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

BROADCAST_BYTES = 32 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


class Scratch:
    """The tables that ``stored`` writes inside of a ``with`` block, to be dropped later."""

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        self._token = _scratch.set(self)
        return self

    def __exit__(self, *_) -> None:
        _scratch.reset(self._token)

    def drop(self, spark: SparkSession, in_use: Iterable[str] = ()) -> None:
        """Delete the tables but those that files of ``in_use`` lie in."""
        in_use = list(in_use)
        files = Files(spark)
        for path in self.paths:
            if not any(f"{path}/" in name for name in in_use):
                files.delete(path)
        self.paths = []


def stored(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back; ``options`` are the
    writer's.

    It cuts lineage: a lost executor costs the running stage, not what came before. Numbers that
    depend on how rows lay in partitions are fixed by it as well.
    """
    path = scratch_path(df.sparkSession, label)
    if (scratch := _scratch.get()) is not None:
        scratch.paths.append(path)
    df.write.option("compression", "zstd").options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores, so that no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches(items: list, weight, limit: int) -> Iterator[list]:
    """Cut a list into runs whose weights sum to ``limit`` at most; a heavier item stands alone."""
    run: list = []
    total = 0
    for item in items:
        size = weight(item)
        if run and total + size > limit:
            yield run
            run, total = [], 0
        run.append(item)
        total += size
    if run:
        yield run


def give_back() -> None:
    """Return what Python and Arrow have freed to the system, which they would keep for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
        trim(0)


def giving_back(work: Callable) -> Callable:
    """``work`` on batches, with ``give_back`` at the end of each call, of a generator at its end.

    The Python worker that ran a task lives on and shares its executor's memory with others.
    """
    if isgeneratorfunction(work):

        @wraps(work)
        def run(*args):
            yield from work(*args)
            give_back()

    else:

        @wraps(work)
        def run(*args):
            try:
                return work(*args)
            finally:
                give_back()

    return run


def broadcast_if_small(
    df: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Mark a stored table for broadcast if its rows, of ``row_bytes`` each, are within ``limit``.

    The bytes are summed up first; beyond the limit, or where broadcasts are switched off, Spark
    joins by shuffle.
    """
    if df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return df
    each = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = df.agg(F.sum(each.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= limit else df
