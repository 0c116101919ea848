"""One pipeline run from the command line.

    spark-submit brassledger/job.py --raw s3a://b/raw --lake s3a://b/lake [--export s3a://b/out --role BANK_ANALYST]

The only place that reads the clock.  Exits with an error when the gate blocks the run.
"""

from __future__ import annotations

import argparse
import datetime as dt

from brassledger.operators.governance import ANALYST
from brassledger.operators.quality import status_line
from brassledger.plans.marts import marts_as
from brassledger.plans.run import Lake, RawZone, Settings, publish
from brassledger.session import session
from brassledger.sources import files


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="folder with transactions/, accounts/, customers/, branches/")
    parser.add_argument("--lake", required=True, help="folder that receives curated/, quarantine/, dq-results/")
    parser.add_argument("--max-quarantine-rate", type=float, default=0.05)
    parser.add_argument("--export", help="folder that receives the ten marts as CSV after the run")
    parser.add_argument("--role", default=ANALYST, help="whose view of the marts is exported")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, help="processing time, UTC; default: now")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    spark = session("brassledger")
    lake = Lake(spark, args.lake)
    publish(RawZone.read(spark, args.raw), Settings(args.as_of or now, args.max_quarantine_rate), lake)
    if args.export:
        files.export_all(marts_as(lake.snapshot(), args.role), args.export)
    print(status_line(lake.summary()).first()["message"])


if __name__ == "__main__":
    main()
