"""Daily trip summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_trips(trips: DataFrame, year: int | None = 2021) -> DataFrame:
    """Trips per day of one year: count, mean distance, highest tax, 95th fare percentile, lowest tip,
    mean passengers rounded up; newest day first.

    The year is a range on the raw timestamp, so it reaches the Parquet scan as a pushed filter.
    """
    pickup = F.col("tpep_pickup_datetime")
    if year is not None:
        start = F.lit(f"{year:04d}-01-01 00:00:00").cast(trips.schema["tpep_pickup_datetime"].dataType)
        end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast(trips.schema["tpep_pickup_datetime"].dataType)
        trips = trips.where((pickup >= start) & (pickup < end))
    return (
        trips.groupBy(
            F.year(pickup).alias("dt_year"), F.month(pickup).alias("dt_month"), F.dayofmonth(pickup).alias("dt_day")
        )
        .agg(
            F.count(F.lit(1)).alias("num_trips"),
            F.avg("trip_distance").alias("mean_trip_distance"),
            F.max("mta_tax").alias("max_mta_tax"),
            F.percentile_approx("fare_amount", 0.95).alias("q95_fare_amount"),
            F.min("tip_amount").alias("min_tip_amount"),
            F.ceil(F.avg("passenger_count")).alias("mean_passenger_count"),
        )
        .orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day"))
    )
