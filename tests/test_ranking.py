"""Row numbers and running totals over a whole table's order, against sorting in Python."""

import random

from pyspark.sql import functions as F

from forumlens.operators.ranking import number_rows, running_sums


def test_number_rows_matches_sorting(spark):
    rng = random.Random(1)
    rows = [(k, rng.randint(0, 5), None if k % 9 == 0 else k % 4) for k in range(3000)] + [(None, 3, 3)] * 500
    df = spark.createDataFrame(rows, "id long, score long, part long").repartition(5)
    got = number_rows(df, F.desc("score"), F.col("id").asc_nulls_last()).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert sorted(r["rank"] for r in got) == list(range(1, len(rows) + 1))
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [r[:2] for r in want]
    assert got[0].__fields__ == ["id", "score", "part", "rank"]
    assert number_rows(df.where("id < 0"), F.col("id")).count() == 0


def test_running_sums_match_python(spark):
    rng = random.Random(2)
    rows = [(k, rng.randint(-5, 5), rng.random()) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, v long, w double").repartition(7)
    got = running_sums(df, [F.desc("k")], {"v_upto": "v", "w_upto": "w"}).collect()
    v = w = 0
    want = {}
    for k, dv, dw in sorted(rows, reverse=True):
        v, w = v + dv, w + dw
        want[k] = (v, w)
    assert all(r.v_upto == want[r.k][0] and abs(r.w_upto - want[r.k][1]) < 1e-9 for r in got) and len(got) == len(rows)
    assert running_sums(df.where("k < 0"), [F.col("k")], {"s": "v"}).count() == 0
