"""The scheduled jobs as a script:

    spark-submit burnlens/jobs.py daily --csv DIR [--root DIR] [--name NAME] [--as-of YYYY-MM-DD]
    spark-submit burnlens/jobs.py weekly [--root DIR] [--name NAME] [--as-of YYYY-MM-DD]
    spark-submit burnlens/jobs.py backfill [--root DIR] [--name NAME] [--as-of YYYY-MM-DD] [--days N]

``daily`` loads the CSV files and brings all models up to date; ``weekly``
rebuilds the cohort and creative models; ``backfill`` replaces the cohorts installed
in the last days. Tables are in the databases NAME_raw and NAME_models of the session's
catalogue, their files under ``--root`` (default: the warehouse). A daily run goes on from the one before if the
catalogue still knows its tables, so scheduled runs need a catalogue that outlives them.

Prints the rows of each model and the seconds it took. Exit status 1 when a
data test failed or a table had too many bad lines (the tables are then left as they were).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from burnlens.functions import constants as K
from burnlens.plans import refresh
from burnlens.sources import files, tables


def main(args: list[str], spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="burnlens.jobs")
    p.add_argument("job", choices=("daily", "weekly", "backfill"))
    p.add_argument("--csv", help="folder with a folder of CSV files for each raw table (daily)")
    p.add_argument("--root", help="folder of the tables' files (when the databases are created)")
    p.add_argument("--name", default="burnlens", help="prefix of the databases")
    p.add_argument("--max-bad-share", type=float, default=refresh.MAX_BAD_SHARE, help="share of bad lines in a table that refuses the load")
    p.add_argument("--days", type=int, default=K.BACKFILL_DAYS, help="days of a backfill")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="run date (default: the current date)")
    p.add_argument("--on-failure", choices=("raise", "publish"), default="raise")
    a = p.parse_args(args)
    if a.job == "daily" and not a.csv:
        p.error("daily needs --csv")
    spark = spark or SparkSession.builder.appName(f"burnlens-{a.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if a.job == "daily":
            loaded, summary = refresh.run_daily(spark, a.csv, a.name, a.as_of, a.on_failure, a.root, a.max_bad_share)
            for r in loaded.collect():
                print(f"loaded {r['table_name']}: {r['row_count']} rows" + (f", {r['rejected']} lines rejected" if r["rejected"] else ""))
        elif a.job == "weekly":
            summary = refresh.run_weekly(spark, a.name, a.as_of, a.on_failure, a.root)
        else:
            summary = refresh.run_backfill(spark, a.name, a.as_of or dt.date.today(), a.days, a.root)
    except refresh.DataTestFailure as e:
        print(f"data tests failed: {e}", file=sys.stderr)
        return 1
    except files.TooManyBadLines as e:
        print(f"load refused: {e}", file=sys.stderr)
        return 1
    for r in summary.collect():
        print(f"{r['model']}: {r['row_count']}")
    if a.job != "backfill":
        for r in tables.read(spark, f"{a.name}_models.run_seconds").collect():  # a row a model
            print(f"seconds {r['model']}: {r['seconds']}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
