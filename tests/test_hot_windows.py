"""Hot-key windows on enough rows that range sampling does not see them all."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimforge.operators.windows import rank_within, running_total

N = 400_000


@pytest.fixture(scope="module")
def skewed(spark):
    i = F.col("id")
    return spark.range(N).select(
        F.when(i % 3 == 0, "hot").when(i % 3 == 1, None).otherwise(F.concat(F.lit("k"), (i % 997).cast("string"))).alias("k"),
        (F.xxhash64("id") % 50_000).alias("o"),
        F.when(i % 5 == 0, None).otherwise(i % 11).alias("v"),
        F.when(i % 7 == 0, None).otherwise((i % 13).cast("decimal(9,2)")).alias("d"),
        F.sha2(i.cast("string"), 256).alias("payload"))


def differences(got, want, columns):
    a, b = got.select(*columns), want.select(*columns)
    return a.exceptAll(b).count() + b.exceptAll(a).count()


@pytest.mark.parametrize("value,columns,chunks", [
    ("v", ["k", "o", "s"], 8), ("v", ["k", "o", "v", "d", "payload", "s"], None), ("d", ["s"], 8), ("d", ["k", "payload", "s"], None)])
def test_running_total_equals_plain_window(skewed, value, columns, chunks):
    want = skewed.withColumn("s", F.sum(value).over(Window.partitionBy("k").orderBy("o")))
    got = running_total(skewed, key="k", order="o", value=value, out="s", hot_rows=1000, chunks=chunks)
    assert got.schema["s"].dataType == want.schema["s"].dataType
    assert differences(got, want, columns) == 0


def test_sum_is_null_until_the_first_value(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").alias("o"),
                                    F.when(F.col("id") > 15_000, F.col("id")).alias("v"))
    want = df.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy("o")))
    assert differences(running_total(df, key="k", order="o", value="v", out="s", hot_rows=100, chunks=6), want,
                       ["k", "o", "s"]) == 0


@pytest.mark.parametrize("kind,order,columns", [
    ("rank", ["v"], ["k", "v", "r"]), ("rank", ["v", "o"], ["k", "payload", "r"]),
    ("row_number", ["o", "payload"], ["r", "k", "payload"])])
def test_ranks_equal_plain_window(skewed, kind, order, columns):
    fn = {"rank": F.rank, "row_number": F.row_number}[kind]
    want = skewed.withColumn("r", fn().over(Window.partitionBy("k").orderBy(*order)))
    got = rank_within(skewed, key="k", order=[F.col(c) for c in order], out="r", kind=kind, hot_rows=1000)
    assert differences(got, want, columns) == 0
