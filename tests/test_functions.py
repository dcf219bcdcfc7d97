import hashlib

import numpy as np
from pyspark.sql import functions as F

from loanlens.functions.columns import THRESHOLD_GRID, md5_bucket, round_ratio, threshold_bucket


def test_md5_bucket_matches_python(spark):
    ids = [str(i) for i in range(0, 3000, 7)] + ["abc", "request-42"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = dict(df.select("id", md5_bucket(F.col("id")).alias("b")).collect())
    for i in ids:
        assert got[i] == int(hashlib.md5(i.encode()).hexdigest(), 16) % 100


def test_threshold_bucket_equals_sum_of_comparisons(spark):
    rng = np.random.default_rng(0)
    ps = sorted(set([round(float(x), 4) for x in rng.random(3000)] + THRESHOLD_GRID + [0.0, 1.0, 0.05, 0.94]))
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = dict(df.select("p", threshold_bucket(F.col("p")).alias("b")).collect())
    for p in ps:
        assert got[p] == sum(p >= t for t in THRESHOLD_GRID), p


def test_round_ratio_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 160), (3, 800), (2, 3), (0, 0), (5, 10)], "a long, b long")
    got = [r[0] for r in df.select(round_ratio(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [0.125, 0.0063, 0.0038, 0.6667, 0.0, 0.5]
