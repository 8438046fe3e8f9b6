"""Take in the files that are new since the last run: filtered posts and hourly counts.

    spark-submit forumlens/jobs/stream.py SOURCE TARGET CHECKPOINT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from forumlens import vocab
from forumlens.session import build_session
from forumlens.sources import readers
from forumlens.streaming import posts as streams


def run(spark: SparkSession, source: str, target: str, checkpoint: str, communities: list[str] | None = None) -> None:
    """Filter the new files of `source/{comments,submissions}` into `target`, and add their counts to `target/hourly_*`."""
    communities = communities or list(vocab.INGEST_COMMUNITIES)
    queries = streams.ingest_new(spark, source, target, checkpoint, communities)
    for kind, schema in streams.RAW.items():
        posts = readers.prepare_raw(streams.read_new(spark, f"{source}/{kind}", schema), ["subreddit", "score", "created_utc"], communities)
        named = posts.selectExpr("*", f"'{kind.removesuffix('s')}' AS data_type")
        queries.append(streams.write_hourly_counts(named, f"{target}/hourly_{kind}", f"{checkpoint}/hourly_{kind}"))
    for query in queries:
        query.awaitTermination()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("checkpoint")
    parser.add_argument("--communities", nargs="*", default=None)
    args = parser.parse_args()
    run(build_session("forumlens-stream"), args.source, args.target, args.checkpoint, args.communities)


if __name__ == "__main__":
    main()
