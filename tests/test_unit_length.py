"""Vectors are brought to length 1 in time that grows with their length, not with its square."""

import math
import time

from pyspark.sql import functions as F

from caseflow.operators import searchdocs as SD


def test_unit_length_of_any_vector(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, []), (4, None), (5, [2.0])], "i int, v array<float>")
    have = {r.i: r.u for r in df.select("i", SD.unit_length(F.col("v")).alias("u")).collect()}
    assert have == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: [], 4: None, 5: [1.0]}


def test_the_length_is_summed_once(spark):
    def seconds(n: int) -> float:
        rows = spark.range(64_000 // n, numPartitions=1).select(F.transform(
            F.sequence(F.lit(1), F.lit(n)), lambda i: i.cast("float")).alias("v"))
        begun = time.time()
        total = rows.select(SD.unit_length(F.col("v")).alias("u")).select(F.explode("u").alias("x")) \
            .agg(F.sum(F.col("x") * F.col("x"))).first()[0]
        assert math.isclose(total, 64_000 // n, rel_tol=1e-6)
        return time.time() - begun

    seconds(64)
    assert seconds(16_000) < 20 * seconds(64) + 5
