"""Reading forum tables, word lists, surveys and CSV results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens import schemas
from forumlens.functions.scores import unit_hash
from forumlens.functions.time import created_date


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan one table directory. `yyyy=`/`mm=` folders below it become partition columns, so a filter
    on them prunes folders instead of needing one read per month."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Scan an explicit list of Parquet files as one table."""
    if not paths:
        raise ValueError("no paths given")
    return spark.read.parquet(*paths)


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Scan the first path that can be read; raise when none can."""
    errors = []
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            errors.append(f"{path}: {error.getCondition()}")
    raise FileNotFoundError("no readable path: " + "; ".join(errors))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Scan a CSV directory with a header; the schema is given, never inferred."""
    return spark.read.csv(path, header=True, schema=schema)


def clean_word_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct words of a word list: trimmed, lower case, without blank and `;` comment lines."""
    word = F.lower(F.regexp_replace(F.col(column), r"^\s+|\s+$", ""))
    return (
        lines.select(word.alias("word"))
        .where((F.col("word") != "") & ~F.col("word").startswith(";"))
        .distinct()
    )


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return clean_word_list(spark.read.text(path))


def word_list_values(words: DataFrame, limit: int = 50_000) -> list[str]:
    """Words as a Python list, for use as literals. A longer list is refused: join it instead."""
    rows = words.select("word").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"word list exceeds {limit} words; join it as a table instead")
    return sorted(r["word"] for r in rows)


def clean_survey(sheet: DataFrame, benefit: Column, percentage: Column) -> DataFrame:
    """`(benefit, percentage)` rows whose percentage is a number; the rest are titles and notes."""
    return sheet.select(
        benefit.cast("string").alias("benefit"),
        percentage.try_cast("double").alias("percentage"),
    ).dropna()


def read_survey(spark: SparkSession, path: str, skip_rows: int = 5) -> DataFrame:
    """Survey sheet exported as one small CSV file: skip the title rows, keep columns 2 and 3."""
    lines = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.split("value", r"\r?\n")).alias("row", "line")
    )
    cells = lines.where(F.col("row") >= skip_rows).select(
        F.from_csv("line", "c0 string, c1 string, c2 string").alias("cell")
    )
    return clean_survey(cells, F.col("cell.c1"), F.col("cell.c2"))


def unify(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Both record kinds by column name, with `data_type`; columns of the other kind are NULL."""
    return comments.withColumn("data_type", F.lit("comment")).unionByName(
        submissions.withColumn("data_type", F.lit("submission")), allowMissingColumns=True
    )


def stack(*parts: DataFrame) -> DataFrame:
    """Positional union of equal projections."""
    first, *rest = parts
    for part in rest:
        first = first.union(part)
    return first


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def allow_communities(df: DataFrame, communities: Sequence[str], column: str = "subreddit") -> DataFrame:
    return df.where(F.col(column).isin(*communities))


def prepare_raw(df: DataFrame, columns: Sequence[str], communities: Sequence[str]) -> DataFrame:
    """Allow-list, project, add the calendar date."""
    kept = select_present(allow_communities(df, communities), columns)
    return kept.withColumn("date", created_date()) if "created_utc" in kept.columns else kept


def sample_posts(df: DataFrame, fraction: float, seed: int = 42, key: str = "id") -> DataFrame:
    """Bernoulli sample by a hash of the key: the same rows on every run and every cluster."""
    return df.where(unit_hash(F.col(key), seed) < fraction)


def cap_documents(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Reproducible sample of exactly `n` rows (fewer when the table is smaller)."""
    return df.orderBy(unit_hash(F.col(key), seed), *sorted(df.columns)).limit(n)


def profile_table(df: DataFrame, interesting: Sequence[str] = tuple(schemas.INTERESTING_COLUMNS)) -> DataFrame:
    """One row per column: position, name, type, whether it is of interest, rows and non-NULL rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*[F.count(F.col(f"`{f.name}`")) for f in df.schema.fields]).alias("non_null"),
    )
    fields = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.lit(f.name in interesting).alias("interesting"),
            )
            for f in df.schema.fields
        ]
    )
    return counts.select(
        "n_rows", F.posexplode(F.arrays_zip(fields.alias("field"), F.col("non_null"))).alias("position", "c")
    ).select(
        "position", "c.field.column_name", "c.field.column_type", "c.field.interesting", "n_rows",
        F.col("c.non_null").alias("non_null"),
    )
