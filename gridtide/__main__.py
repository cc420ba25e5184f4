"""Run the batch and file-stream jobs from a command line.

    python -m gridtide land     --documents IN --landing OUT
    python -m gridtide ingest   --feed market|weather --landing IN --clean OUT --checkpoint DIR
                                [--tables DIR]
    python -m gridtide compact  --feed market|weather --clean TABLE
    python -m gridtide rebuild  --feed market|weather --clean IN --tables OUT
                                [--first YYYY-MM-DD] [--last YYYY-MM-DD]

Use ``spark-submit`` with the same arguments on a cluster; the session comes
from its configuration.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridtide.plans.rebuild import yesterday
from gridtide.sources.batches import BATCH
from gridtide.sources.documents import market_records, read_documents
from gridtide.sources.json_lines import FILES_PER_BATCH, write_lines
from gridtide.sources.tables import days_between
from gridtide.streaming.counts import read_counts
from gridtide.streaming.ingest import MARKET, WEATHER, compact_clean, start_ingest

FEEDS = {"market": MARKET, "weather": WEATHER}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gridtide")
    jobs = parser.add_subparsers(dest="job", required=True)
    land = jobs.add_parser("land", help="market documents to landed JSON lines")
    land.add_argument("--documents", required=True)
    land.add_argument("--landing", required=True)
    ingest = jobs.add_parser("ingest", help="newly landed files to cleaned tables")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    compact = jobs.add_parser("compact", help="batches of a cleaned table to one, latest row per key")
    rebuild = jobs.add_parser("rebuild", help="cleaned tables to analysis tables")
    rebuild.add_argument("--first", type=date.fromisoformat)
    rebuild.add_argument("--last", type=date.fromisoformat)
    for job in (ingest, compact, rebuild):
        job.add_argument("--feed", choices=FEEDS, required=True)
        job.add_argument("--clean", required=True)
    ingest.add_argument("--tables")
    rebuild.add_argument("--tables", required=True)
    return parser.parse_args()


def main() -> None:
    given = _arguments()
    spark = SparkSession.builder.appName(f"gridtide-{given.job}").getOrCreate()
    if given.job == "land":
        write_lines(market_records(read_documents(spark, given.documents)), given.landing)
    elif given.job == "ingest":
        query = start_ingest(
            spark,
            FEEDS[given.feed],
            given.landing,
            given.clean,
            given.checkpoint,
            given.tables,
            files_per_batch=given.files_per_batch,
        )
        query.awaitTermination()
        own = read_counts(spark, given.clean).where(F.col(BATCH).startswith(str(query.id)))
        for row in own.orderBy(BATCH, "dataset").collect():
            print(*row.asDict().values(), sep="\t")
    elif given.job == "compact":
        replaced = compact_clean(spark, FEEDS[given.feed], given.clean)
        print(f"batches replaced\t{len(replaced)}")
    else:
        first = given.first or given.last or yesterday()
        days = days_between(spark, first, given.last or first)
        counts = FEEDS[given.feed].rebuild(spark, given.clean, given.tables, days)
        for name, rows in counts.items():
            print(f"{name}\t{rows}")


if __name__ == "__main__":
    main()
