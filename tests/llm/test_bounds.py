"""Bounds and draws that have to hold for every row."""

from pyspark.sql import functions as F

from icufeat.llm import jaccard


def needed(n, m, percent):
    return -(-percent * (n + m) // (100 + percent)) - -(-percent * max(n, m) // 100) + 1


def test_least_shared_of_a_range(spark):
    """Rounding makes it fall below both ends in between: 18 against 18 to 20 shares 2 at the ends, 1 at 19."""
    rows = [(n, low, high) for n in (*range(1, 90), 150, 333) for low in range(-(-n * 3 // 4), n * 4 // 3 + 1, 2) for high in range(low, n * 4 // 3 + 1, 3)] + [(18, 18, 20), (24, 22, 27)]
    for percent in (80, 85):
        got = spark.createDataFrame(rows, "n BIGINT, low BIGINT, high BIGINT").withColumn("k", jaccard.least_shared_within(F.col("n"), F.col("low"), F.col("high"), percent))
        wrong = [tuple(r) for r in got.collect() if r.k != min(needed(r.n, m, percent) for m in range(r.low, r.high + 1))]
        assert wrong == []
    assert got.filter("n = 18 AND low = 18 AND high = 20").first().k == 1
