"""Month-end job entry point (``spark-submit -m``-style or ``python -m loanlens``).

    python -m loanlens --book /shared/loanbook --as-of 2018-07-01 --out /shared/reports

The book folder holds one Parquet folder per source table (see
``loanlens.sources.schemas``).  Outputs are partitioned by reporting month;
re-running a month replaces only that month.
"""

from __future__ import annotations

import argparse
from datetime import date

from loanlens.functions.windows import ReportingWindow
from loanlens.plans.month_end import run_month_end
from loanlens.session import build_session
from loanlens.sources.book import read_book


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="loanlens")
    p.add_argument("--book", required=True, help="folder with one Parquet folder per source table")
    p.add_argument("--as-of", required=True, type=date.fromisoformat)
    p.add_argument("--out", required=True, help="output folder (shared storage)")
    p.add_argument("--cohort-table", default="loanlens_cohort")
    p.add_argument("--cohort-version", type=int, choices=(1, 2), default=2)
    p.add_argument("--window", nargs=2, type=date.fromisoformat, metavar=("FROM", "TO"),
                   help="dates, both included, for which the decision reports are replayed")
    p.add_argument("--loan-ids", nargs="+", type=int, help="loans of the per-loan report on the whole book")
    p.add_argument("--null-safe-least", action="store_true",
                   help="per-loan sums also take payments due in the window and unpaid")
    p.add_argument("--as-it-stood", action="store_true", help="leave out what happened after the as-of date")
    p.add_argument("--local", action="store_true", help="small-machine settings instead of cluster sizing")
    args = p.parse_args(argv)
    spark = build_session(app_name="loanlens-month-end", cluster=not args.local)
    paths = run_month_end(
        spark, read_book(spark, args.book), args.as_of,
        cohort_table=args.cohort_table, out_root=args.out, cohort_version=args.cohort_version,
        window=ReportingWindow(*args.window) if args.window else None,
        as_it_stood=args.as_it_stood, loan_ids=args.loan_ids, null_safe_least=args.null_safe_least,
    )
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
