"""Times in questions are rounded as Python and SQL round them."""

import random

from pyspark.sql import functions as F

from corvox.operators import chains


def test_seconds(spark):
    draw = random.Random(3)
    times = [0.0, 14.25, 14.75, 14.35, 0.25, 0.05, 0.15, 12345.65, 1e6 + 0.25] + [k * 0.5 + n * 0.05 for k in range(200) for n in range(12)] + [draw.random() * 10 ** draw.randrange(6) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in times], "t double").select("t", chains._seconds(F.col("t")).alias("said")).collect()
    assert [(r["t"], r["said"]) for r in rows] == [(t, f"{t:.1f}") for t in times]
