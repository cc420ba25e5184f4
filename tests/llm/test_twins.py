"""Registered training-data queries against their SQL twins, and what the entry registers."""

from __future__ import annotations

import comparing
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gridtide.llm import oracle
from gridtide.llm.queries import QUERIES


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names and set(oracle.SQL) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "quality_classifier",
        "near_duplicates",
        "packing",
    ]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_rows(name, spark, sf_dir):
    connection = comparing.connect(sf_dir)
    assert comparing.differences(QUERIES[name](spark, sf_dir), connection, oracle.SQL[name]) == ""
