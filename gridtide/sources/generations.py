"""Tables whose columns have been renamed over time: several generations of files read as one frame.

Files of a generation lie below ``schema_version=<n>``, partitioned as ever.  A
generation says how its columns were called in the one before; the chain of
these leads from a declared name back to the name any older file has for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.schemas import conform
from gridtide.sources.tables import append_partitioned, on_days

VERSION = "schema_version"


@dataclass(frozen=True)
class Generation:
    """A version of a table's files, and the former name of each column it renamed."""

    version: int
    renamed: Mapping[str, str] = field(default_factory=dict)


def names_in(version: int, generations: Sequence[Generation], names: Iterable[str]) -> dict[str, str]:
    """What each name of the newest generation is called in the files of a version.

    Generations may swap names or take up one that an older column had: each
    step looks up what one step before was called, and nothing else.
    """
    later = sorted((g for g in generations if g.version > version), key=lambda g: -g.version)
    found = {}
    for name in names:
        found[name] = reduce(lambda known, g: g.renamed.get(known, known), later, name)
    return found


def generation_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSION}={version}"


def append_generation(df: DataFrame, path: str, version: int, by: Sequence[str]) -> None:
    """Append rows that have the names of a version to its files."""
    append_partitioned(df, generation_path(path, version), by)


def read_generations(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    generations: Sequence[Generation],
    days: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """The rows of all generations with the declared columns, pruned to days.

    Each generation is one scan with the types its own files have, so a column
    may have changed its type as well; a column it did not have yet is null, one
    that was dropped since is not read.  A generation without files is left out.
    """
    frames = []
    for generation in generations:
        try:
            files = spark.read.parquet(generation_path(path, generation.version))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        known = names_in(generation.version, generations, schema.names)
        there = [F.col(f"`{old}`").alias(name) for name, old in known.items() if old in files.columns]
        rows = files.select(*there)
        frames.append(conform(rows if days is None else on_days(rows, days), schema))
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], schema))
