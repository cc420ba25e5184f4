"""What several operators share: tables, stored intermediate results, ASCII lower case."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.sources.tables import free_shuffles, shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the folder the cluster shares, and read back.

    This cuts the lineage: a lost executor costs no recomputation before this
    point, and planning knows the real size of the result.  The shuffles before
    this point are let go.
    """
    free_shuffles(df.sparkSession)
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark's batches may take 64 MB, which the executor and each of its Python workers hold more than once.
BATCH_BYTES = "2m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Batches of bounded bytes to Python workers, unless the session names a size of its own.

    Spark reads the setting when a frame is run, so it stays for the session.  Rows do not depend on it.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def _give_back() -> None:
    """Return to the system what Arrow's pool and the C library's heap hold of freed memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError, TypeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def memory_returned(made: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function for batches, followed by a return of freed memory: a waiting worker then holds little."""

    def run(batches: Iterator) -> Iterator:
        yield from made(batches)
        _give_back()

    return run


def kept_by_worker(owner: str) -> dict:
    """What a Python worker keeps from task to task, such as vocabularies it has read.

    It is let go as soon as the worker gets a task of another owner, and its
    memory returned, so stages that follow each other do not add up.
    """
    name = "kept by the worker"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if held.get("owner") != owner:
        held.clear()
        held["owner"] = owner
        _give_back()
    return held.setdefault("values", {})


class Recent:
    """Values by key that are expensive to make: a bounded number, those used last.

    ``now`` has at most ``limit`` keys and those of one call.  When it is full it
    becomes what was kept before; a key that is asked for again comes back from
    there, the others go.  Keys longer than ``longest`` are forgotten after the
    call, so the bytes held are bounded as well.
    """

    def __init__(self, limit: int, longest: int) -> None:
        self.now: dict = {}
        self._before: dict = {}
        self._limit, self._longest = limit, longest

    def missing(self, keys: set) -> set:
        """The keys whose values must be made; the others are in ``now`` until the next call."""
        if len(self.now) > self._limit:
            self.now, self._before = {}, self.now
        new = keys.difference(self.now)
        if self._before and new:
            back = new.intersection(self._before)
            self.now.update([(key, self._before[key]) for key in back])
            new -= back
        return new

    def forget_long(self, keys: set) -> None:
        """Let go what was made for one call only."""
        for key in keys:
            if len(key) > self._longest:
                self.now.pop(key, None)


def byte_lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for null."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, count) of the slices of a batch: of bounded bytes, one text at least."""
    ends = np.cumsum(byte_lengths(texts))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, before + most_bytes, "right")), start + 1)
        yield start, end - start
        start = end


@contextlib.contextmanager
def no_cycle_search() -> Iterator[None]:
    """Make millions of small objects without the interpreter searching them for cycles."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()
