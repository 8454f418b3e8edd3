"""Numbered rows, strides and systematic samples over Parquet tables of several partitions and row widths."""

import pytest
from folioforge.operators import sampling
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    rows = spark.range(0, 30_000, numPartitions=7).select((F.col("id") * 7919 % 30_000).alias("page"), (F.col("id") % 11).alias("kind"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 6).alias("text"))
    rows.write.parquet(path)
    return path


@pytest.mark.parametrize("partitions", [4, 16, 64])
def test_numbers_every_row(spark, wide, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = sampling.numbered(spark.read.parquet(wide), ["page"])
        ends = got.agg(F.count(F.lit(1)), F.count_distinct("_i"), F.min("_i"), F.max("_i"), F.count_if(F.col("_i") == F.col("page"))).first()
        assert tuple(ends) == (30_000, 30_000, 0, 29_999, 30_000)
        assert sampling.even_stride(spark.read.parquet(wide), ["page"], 1000).count() == 1000
        assert sampling.systematic(spark.read.parquet(wide), ["page"], 700).count() == 700
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_two_keys_nulls_and_ties(spark):
    rows = [(k % 3 if k % 7 else None, k % 5, k) for k in range(500)]
    got = sampling.numbered(spark.createDataFrame(rows, "a int, b int, c int").repartition(5), ["a", "b"]).collect()
    assert sorted(r["_i"] for r in got) == list(range(500))
    key = lambda r: (r["a"] is not None, r["a"] or 0, r["b"])
    assert [key(r) for r in sorted(got, key=lambda r: r["_i"])] == sorted(map(key, got))


def test_empty(spark):
    empty = spark.createDataFrame([], "a int")
    assert sampling.numbered(empty, ["a"]).count() == sampling.even_stride(empty, ["a"], 5).count() == 0
