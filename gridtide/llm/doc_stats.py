"""Counts over whole texts that quality rules are made of."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import kept_by_worker

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = bytes(range(ord("0"), ord("9") + 1))
WINDOW = 3

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capitals",
    "n_digits",
    "n_marks",
    "n_distinct_words",
)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window found twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered += at + WINDOW - max(at, end)
            end = at + WINDOW
    return covered


def counts(text: str | None) -> tuple[int, ...]:
    """The numbers of ``COUNTS``; words are what stands between ASCII white space."""
    data = (text or "").encode()
    words = data.split()
    spaces = len(data) - len(data.translate(None, SPACES))
    code_points = len(text or "")
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    return (
        len(words),
        code_points - spaces,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, CAPITALS)),
        len(data) - len(data.translate(None, DIGITS)),
        data.count(b"!"),
        len(set(words)),
    )


def _counted(keep_text: bool):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker("doc stats")  # lets go what other stages have kept
        for batch in batches:
            rows = [counts(text.as_py()) for text in batch.column("text")]
            counted = list(zip(*rows)) or [()] * len(COUNTS)
            names, columns = list(batch.schema.names), list(batch.columns)
            if not keep_text:
                columns.pop(names.index("text"))
                names.remove("text")
            columns += [pa.array(column, pa.int64()) for column in counted]
            yield pa.RecordBatch.from_arrays(columns, [*names, *COUNTS])

    return made


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns of each document and its counts; a null text counts as empty.

    Kept columns named like a count are replaced by it.
    """
    kept = [name for name in keep if name not in (*COUNTS, "text")]
    rows = docs.select(*kept, F.col("text").cast("string"))
    fields = [f for f in rows.schema if f.name != "text" or "text" in keep]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    schema += [f"{name} long" for name in COUNTS]
    return rows.mapInArrow(_counted("text" in keep), ", ".join(schema))
