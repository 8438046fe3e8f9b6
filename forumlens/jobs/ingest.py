"""Filter a raw archive to the allowed communities and columns.

    spark-submit forumlens/jobs/ingest.py SOURCE TARGET
"""

from __future__ import annotations

import argparse

from forumlens import vocab
from forumlens.session import build_session
from forumlens.sources.ingest import ingest


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--communities", nargs="*", default=vocab.INGEST_COMMUNITIES)
    parser.add_argument("--by-month", action="store_true")
    args = parser.parse_args()
    written = ingest(build_session("forumlens-ingest"), args.source, args.target, args.communities, args.by_month)
    for kind, rows in written.items():
        print(f"{kind}: {rows} rows")


if __name__ == "__main__":
    main()
