"""Result sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.session import stage


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV directory with a header. Rows keep their partitions: a hot community is written by many
    tasks, each adding a file to its folder."""
    writer = vectors_to_text(df).write.mode("overwrite").option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def vectors_to_text(df: DataFrame) -> DataFrame:
    """ML vectors as JSON arrays, since CSV holds no vectors."""
    columns = [
        F.to_json(vector_to_array(F.col(f.name))).alias(f.name)
        if isinstance(f.dataType, VectorUDT)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


def _single(df: DataFrame, path: str, max_rows: int, write: Callable[[DataFrame, str], None]) -> None:
    """Write a small result as one file. The table is staged once and counted from the file footers, so a
    table that is too large is refused before anything is written and its input runs once."""
    rows = stage(df)
    if rows.count() > max_rows:
        raise ValueError(f"result exceeds {max_rows} rows; write it as a directory of files")
    write(rows.coalesce(1), path)


def write_single_csv(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    _single(df, path, max_rows, write_csv)


def write_single_parquet(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    _single(df, path, max_rows, write_parquet)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def metric_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str = "metric string, value double"
) -> DataFrame:
    """A result table from a few driver-side values."""
    return spark.createDataFrame(list(rows), schema)


def first_rows(df: DataFrame, n: int, order: Sequence[str] = ("id",)) -> DataFrame:
    """The first `n` rows in a fixed order, for an export."""
    return df.orderBy(*order).limit(n)
