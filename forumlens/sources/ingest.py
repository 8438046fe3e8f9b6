"""Ingest: scan both record kinds, keep the allowed communities, project, date, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import schemas, vocab
from forumlens.sources.readers import prepare_raw, read_parquet

KINDS = {"comments": schemas.COMMENT_COLUMNS, "submissions": schemas.SUBMISSION_COLUMNS}


def filtered(df: DataFrame, kind: str, communities: Sequence[str] = tuple(vocab.INGEST_COMMUNITIES)) -> DataFrame:
    return prepare_raw(df, KINDS[kind], communities)


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    communities: Sequence[str] = tuple(vocab.INGEST_COMMUNITIES),
    partition_by_month: bool = False,
) -> dict[str, int]:
    """Filter `source/{comments,submissions}` into `target`; returns the rows written per kind.

    One pass per kind; the row counts come from the footers of the written files.
    """
    written = {}
    for kind in KINDS:
        out = filtered(read_parquet(spark, f"{source}/{kind}"), kind, communities)
        if partition_by_month:
            out = out.withColumn("year_month", F.date_format("date", "yyyy-MM"))
        writer = out.write.mode("overwrite")
        if partition_by_month:
            writer = writer.partitionBy("year_month")
        writer.parquet(f"{target}/{kind}")
        written[kind] = read_parquet(spark, f"{target}/{kind}").count()
    return written
