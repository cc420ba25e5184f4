"""Documents to tables through the command line."""

from __future__ import annotations

import sys

import pytest

from gridtide import __main__ as command
from gridtide.plans import rebuild
from gridtide.sources import documents
from test_documents import market, point, series


@pytest.fixture
def run(monkeypatch):
    def call(*arguments):
        monkeypatch.setattr(sys, "argv", ["gridtide", *map(str, arguments)])
        command.main()

    return call


def test_land_ingest_rebuild(spark, tmp_path, run, capsys):
    request = {
        "ingested_at": "2026-04-22T10:00:00Z",
        "dataset": "actual_total_load",
        "country_code": "PL",
        "country": "Poland",
        "area_code": "10Y",
        "area_name": "PL",
        "request_period_start": "202604220900",
        "request_period_end": "202604221000",
    }
    folder = tmp_path / "documents"
    for name in documents.REQUEST_COLUMNS:
        folder = folder / f"{name}={request[name].replace(':', '%3A')}"
    folder.mkdir(parents=True)
    (folder / "a.xml").write_text(market(series(point(1, 5) + point(3, 7))))
    (folder / "b.xml").write_text("cut")

    read = documents.read_documents(spark, str(tmp_path / "documents"))
    assert {r.ingested_at for r in read.collect()} == {"2026-04-22T10:00:00Z"}
    landing, clean = tmp_path / "landing", tmp_path / "clean"
    run("land", "--documents", tmp_path / "documents", "--landing", landing)
    run("ingest", "--feed", "market", "--landing", landing, "--clean", clean,
        "--checkpoint", tmp_path / "checkpoint")
    assert "actual_total_load\t3\t1\t0\t2\t" in capsys.readouterr().out
    run("compact", "--feed", "market", "--clean", clean)
    assert "batches replaced\t0" in capsys.readouterr().out
    run("rebuild", "--feed", "market", "--clean", clean, "--tables", tmp_path / "tables",
        "--first", "2026-04-22", "--last", "2026-04-23")
    assert "fact_load\t2" in capsys.readouterr().out
    load = rebuild.open_tables(spark, str(tmp_path / "tables"))["fact_load"].collect()
    assert sorted((r.event_date.day, r.quantity_mw) for r in load) == [(22, 5.0), (23, 7.0)]
