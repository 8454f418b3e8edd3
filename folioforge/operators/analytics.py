"""Grouped, ranked and percentile analytics over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (10, 25, 50, 75, 90, 95, 99)


def profile_groups(df: DataFrame, group: str, value: str, mode_of: str, top: int) -> DataFrame:
    """The largest groups with count, mean value, and the most frequent ``mode_of`` with its count (least on ties)."""
    pairs = df.where(F.col(group).isNotNull()).groupBy(group, mode_of).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"), F.count(value).alias("_k"))
    best = F.min(F.when(F.col(mode_of).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(mode_of).alias("m"))))
    got = pairs.groupBy(group).agg(F.sum("_n").alias("n"), F.try_divide(F.sum("_s"), F.sum("_k")).alias("avg_value"), best["m"].alias("mode"), (-best["n"]).alias("mode_n"))
    return got.orderBy(F.desc("n"), group).limit(top)


def best_paid(df: DataFrame, group: str, value: str, top: int = 10, minimum: int = 5) -> DataFrame:
    got = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("avg_value")).where(F.col("n") >= minimum)
    return got.orderBy(F.desc("avg_value"), group).limit(top)


def distribution(df: DataFrame, value: str, exact: bool = True) -> DataFrame:
    """Coverage, mean, least, largest, and percentiles, all of one aggregate. Exact ones hold a count for each distinct value;
    ``exact=False`` for sketches with bounded memory."""
    shares_ = [q / 100 for q in PERCENTILES]
    p = F.percentile(value, F.array(*map(F.lit, shares_))) if exact else F.percentile_approx(value, shares_, 100_000)
    got = df.agg(F.avg(F.col(value).isNotNull().cast("int")).alias("coverage"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), p.alias("_p"))
    return got.select("coverage", "mean", "least", "most", *[F.get("_p", F.lit(k)).alias(f"p{q}") for k, q in enumerate(PERCENTILES)])


def median_ratios(df: DataFrame, value: str, name: str = "ratio", exact: bool = True) -> DataFrame:
    """``df`` with each value over the median of all; null where there is no value or the median is 0."""
    middle = df.agg((F.percentile(value, F.lit(0.5)) if exact else F.percentile_approx(value, 0.5, 100_000)).alias("_median"))
    return df.crossJoin(F.broadcast(middle)).withColumn(name, F.try_divide(F.col(value), F.col("_median"))).drop("_median")  # one row


def shares(df: DataFrame, label: Column, name: str = "class") -> DataFrame:
    got = df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return got.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def income_class(value: Column, bounds=(9_000, 15_000, 25_000), names=("low", "middle", "upper", "high")) -> Column:
    out = F.when(value.isNull(), None)
    for bound, name in zip(bounds, names, strict=False):
        out = out.when(value < bound, name)
    return out.otherwise(names[-1])


def marked_gender(title: Column, markers: list[str]) -> Column:
    return F.when(F.coalesce(title, F.lit("")) == "", "unknown").when(F.regexp_like(F.lower(title), F.lit("|".join(markers))), "female").otherwise("unmarked")


def completeness(df: DataFrame, columns: list[str], distinct: list[str] = (), exact: bool = True) -> DataFrame:
    filled = lambda c: F.avg((F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int")).alias(f"{c}_rate")
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(F.count(F.lit(1)).alias("n"), *[filled(c) for c in columns], *[count(c).alias(f"{c}_distinct") for c in distinct])


def extrapolate(df: DataFrame, page: str, total_pages: int) -> DataFrame:
    """Records expected on ``total_pages`` pages at the sample's mean per page."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(page).alias("pages")).withColumn("expected", F.col("n") / F.col("pages") * total_pages)
