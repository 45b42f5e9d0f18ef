"""Full load from the command line: python -m gridmart SOURCE_FOLDER WAREHOUSE_FOLDER"""

import argparse

from .plans import quality
from .plans.warehouse import load
from .schemas import LOAD_ORDER
from .session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source", help="folder with the source files")
    parser.add_argument("warehouse", help="folder for the tables, shared by all executors")
    parser.add_argument("--status", action="store_true", help="load the status table too")
    parser.add_argument("--multiline", action="store_true", help="allow line breaks inside quotes")
    args = parser.parse_args()
    spark = build_session("gridmart-load")
    run = load(spark, args.source, args.warehouse, args.status, args.multiline)
    star = run.star()
    names = [spec.name for spec in LOAD_ORDER]
    for report in (run.observed_report(), run.issue_report(*names), quality.integrity_report(star)):
        report.show(100, truncate=False)


if __name__ == "__main__":
    main()
