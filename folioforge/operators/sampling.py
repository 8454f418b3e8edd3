"""Systematic and even-stride samples, page selections, splits, todo lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: ranges that an order is cut into, and rows of the sample that the cuts are taken from
RANGES, CUT_SAMPLE = 64, 4096


def ranged(df: DataFrame, order: list[str], name: str = "_p") -> DataFrame:
    """``df`` with the number of its range of the given order, from 0.

    The cuts are literals, from a sample of at most ``CUT_SAMPLE`` rows with the least hashes, so the number is a column of
    the row alone: every branch of a plan that computes it gets the same one, however a shuffle is planned.
    """
    key = F.struct(*order)
    some = df.select(key.alias("_key")).orderBy(F.xxhash64("_key")).limit(CUT_SAMPLE).collect()
    keys = df.sparkSession.createDataFrame(some, df.select(key.alias("_key")).schema) if some else None
    if keys is None:
        return df.withColumn(name, F.lit(0))
    every = max(1, len(some) // RANGES)
    w = Window.partitionBy(F.lit(1)).orderBy("_key")  # over the sample
    cuts = keys.withColumn("_k", F.row_number().over(w)).where(F.col("_k") % every == 0)
    cuts = F.broadcast(cuts.agg(F.array_sort(F.collect_set("_key")).alias("_cuts")))  # one row of at most RANGES + 1 keys
    return df.crossJoin(cuts).withColumn(name, F.size(F.filter("_cuts", lambda c: c <= key))).drop("_cuts")


def numbered(df: DataFrame, order: list[str], name: str = "_i") -> DataFrame:
    """Rows with a running number from 0 in the given order, without one task seeing all rows: each range of the
    order is numbered by itself, then moved by the counts of the ranges before. Rows of equal keys are in one range."""
    parts = ranged(df, order)
    counts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).drop("_n")  # a row a range
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return parts.withColumn("_k", inside).join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_k")).drop("_p", "_k", "_before")


def systematic(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Every max(1, len // n)-th row, the first n of them."""
    step = df.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / n)).alias("_step"))
    return numbered(df, order).crossJoin(F.broadcast(step)).where((F.col("_i") % F.col("_step") == 0) & (F.col("_i") < F.col("_step") * n)).drop("_i", "_step")


def even_stride(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows int(i * len / n) for i under n; all rows if there are no more than n."""
    size = df.agg(F.count(F.lit(1)).alias("_len"))
    want = F.when(F.col("_len") <= n, F.lit(True)).otherwise(
        F.floor(F.ceil(F.col("_i") * n / F.col("_len")) * F.col("_len") / n) == F.col("_i")
    )
    return numbered(df, order).crossJoin(F.broadcast(size)).where(want).drop("_i", "_len")


def select_pages(df: DataFrame, pages: list[int] | None = None, limit: int | None = None, page: str = "page") -> DataFrame:
    """An explicit list, else the first ``limit``, else all; a filter that reaches the scan."""
    if pages is not None:
        return df.where(F.col(page).isin(*pages))
    return df.where(F.col(page) < limit) if limit is not None else df


def seeded_split(df: DataFrame, key: str, n_eval: int, seed: int = 0) -> DataFrame:
    """``split``: eval for the ``n_eval`` least hashes of key and seed, else train."""
    h = F.xxhash64(F.lit(seed), F.col(key))
    cut = df.select(h.alias("_h"), F.col(key).alias("_key")).orderBy("_h", "_key").limit(n_eval).agg(F.max(F.struct("_h", "_key")).alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("split", F.when(F.struct(h.alias("_h"), F.col(key).alias("_key")) <= F.col("_cut"), "eval").otherwise("train")).drop("_cut")


def todo(every: DataFrame, done: DataFrame, keys: list[str], size: Column | None = None) -> DataFrame:
    """What is not done; an output of size 0 is not done."""
    return every.join(done.where(size > 0) if size is not None else done, keys, "left_anti")


def latest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert: rows of ``new`` replace those of ``old``; among equals the last value by its columns stays."""
    names = old.columns
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("_v"), *[F.desc(c) for c in names if c not in keys])
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_v")


def trainable_pairs(columns: DataFrame, minimum: int = 80) -> DataFrame:
    """Silver pairs: column texts of ``minimum`` characters, with the manifest's constant columns."""
    fixed = {"status": "silver", "source": "text layer", "license": "unknown", "verified": "no", "language": "sv", "notes": "", "content_bearing": "yes"}
    return columns.where(F.char_length("text") >= minimum).withColumns({k: F.lit(v) for k, v in fixed.items()})


def silver_pairs(columns: DataFrame, crops: DataFrame, minimum: int = 80) -> DataFrame:
    """Crops (page, region, content) with the text layer's reading of them (columns: page, region, text) as rows of the gold manifest, and the crop itself."""
    both = trainable_pairs(columns, minimum).join(crops, ["page", "region"])
    name = F.format_string("crops/%s_%s.jpg", F.col("page").cast("string"), "region")
    return both.select(
        F.col("page").cast("string").alias("page_id"), name.alias("image_path"), F.col("text").alias("reference"), F.col("region").alias("stratum"), F.lit("cer").alias("metric"),
        name.alias("gold_path"), "status", "source", "license", "verified", "language", "region", "notes", "content_bearing", "content",
    )
