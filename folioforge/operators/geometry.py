"""Positioned words to columns, lines, line tags and page quality."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import patterns as P
from folioforge.functions import text as X

CANDIDATES = 41


def tag_line(line: Column, max_size: Column, body_size: Column) -> Column:
    """blank, ditto, entry, ad or other; a body size of 0 switches the font rule off."""
    s = X.strip(F.coalesce(line, F.lit("")))
    digits = F.regexp_like(s, F.lit(P.THREE_DIGITS))
    big = (F.coalesce(body_size, F.lit(0.0)) > 0) & (max_size > body_size * P.BIG_FONT)
    ditto = F.regexp_like(s, F.lit(P.LEADING_DASH)) & (s.contains(",") | digits)
    entry = s.contains(",") & F.regexp_like(s, F.lit(P.INCOME_IN_LINE)) & F.regexp_like(s, F.lit(P.LETTER))
    ad = big | F.regexp_like(s, F.lit(P.AD_TOKENS)) | ((F.char_length(s) <= P.SHORT_LINE) & ~digits)
    return (
        F.when(s == "", "blank").when(ditto, "ditto").when(entry & ~F.coalesce(big, F.lit(False)), "entry").when(F.coalesce(ad, F.lit(False)), "ad").otherwise("other")
    )


def is_body(n_entry: Column, n_lines: Column) -> Column:
    return (n_entry >= P.BODY_MIN_ENTRIES) & (n_entry >= n_lines * P.BODY_MIN_RATIO)


def is_trainable(body: Column, gutter_conf: Column, n_entry: Column, n_ad: Column, entry_ratio: Column) -> Column:
    t = P.TRAINABLE
    return body & (gutter_conf >= t["gutter_conf"]) & (n_entry >= t["n_entry"]) & (n_ad <= t["n_ad"]) & (entry_ratio >= t["entry_ratio"])


def income_kind(line: Column, tag: Column) -> Column:
    """clean, dirty or null; of entries only."""
    return F.when(tag == "entry", F.when(F.regexp_like(line, F.lit(P.CLEAN_INCOME)), "clean").when(F.regexp_like(line, F.lit(P.DIRTY_INCOME)), "dirty"))


def gutters(pages: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """Split place and confidence of each page (keys, width), from words (keys, x0, x1).

    Each word adds 1 from the first to the last candidate that lies inside it; a running sum over the
    candidates of a page gives their counts. So a word makes two rows, however many candidates it
    straddles, and no page is paired with all its words.
    """
    width = pages.select(*keys, F.col("width").cast("double").alias("width"))
    x = lambda k: F.col("width") * 0.3 + (F.col("width") * 0.7 - F.col("width") * 0.3) * k / 40
    low, step = x(F.lit(0)), (F.col("width") * 0.7 - F.col("width") * 0.3) / 40
    # first candidate right of x0 and last one left of x1: near the quotient, then exactly by the candidates themselves
    near = lambda v: F.greatest(F.lit(-2.0), F.least(F.lit(CANDIDATES + 1.0), F.floor((v - low) / step)))
    at = near(F.col("x0"))
    first = F.when(x(at - 1) > F.col("x0"), at - 1).when(x(at) > F.col("x0"), at).when(x(at + 1) > F.col("x0"), at + 1).otherwise(at + 2)
    end = near(F.col("x1"))
    last = F.when(x(end + 1) < F.col("x1"), end + 1).when(x(end) < F.col("x1"), end).when(x(end - 1) < F.col("x1"), end - 1).otherwise(end - 2)
    inside = words.join(width, keys).select(
        *keys, F.greatest(F.lit(0), first.cast("int")).alias("_k0"), F.least(F.lit(CANDIDATES - 1), last.cast("int")).alias("_k1")
    ).where("_k0 <= _k1")
    edges = inside.select(*keys, F.explode(F.array(F.struct(F.col("_k0").alias("k"), F.lit(1).alias("d")), F.struct((F.col("_k1") + 1).alias("k"), F.lit(-1).alias("d")))).alias("e"))
    steps = edges.groupBy(*keys, F.col("e.k").alias("k")).agg(F.sum("e.d").alias("d"))
    per_page = steps.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "d"))).alias("_d"))
    n_words = words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_words"))
    got = width.join(n_words, keys, "left").join(per_page, keys, "left")
    change = lambda k: F.coalesce(F.try_element_at(F.col("_d"), k), F.lit(0))
    run = F.aggregate(
        F.sequence(F.lit(0), F.lit(CANDIDATES - 1)),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.array().cast("array<bigint>").alias("out")),
        lambda a, k: F.struct((a["n"] + change(k)).alias("n"), F.array_append(a["out"], a["n"] + change(k)).alias("out")),
        lambda a: a["out"],
    )
    got = got.withColumn("_c", run)
    ranked = F.transform("_c", lambda c, k: F.struct(c.alias("c"), F.abs(x(k) - F.col("width") / 2).alias("far"), k.alias("k"), x(k).alias("x")))
    best = F.array_min(ranked)
    middle = F.get(F.array_sort("_c"), F.lit(CANDIDATES // 2))
    conf = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - best["c"] / F.when(middle == 0, 1).otherwise(middle)))
    some = F.coalesce("n_words", F.lit(0)) > 0
    return got.select(
        *keys,
        F.when(some, best["x"]).otherwise(F.col("width") / 2).alias("split_x"),
        F.when(some, F.round(conf, 3)).otherwise(0.0).alias("gutter_conf"),
        F.coalesce("n_words", F.lit(0)).alias("n_words"),
    )


def side(x0: Column, x1: Column, split_x: Column) -> Column:
    return F.when((x0 + x1) / 2 < split_x, "colL").otherwise("colR")


def cluster_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of words (keys, x0, y0, x1, y1, t): keys, line_no, text, y0, y1.

    A word joins the line while its top is within the tolerance of a centre that moves half way to each
    word; so lines are a fold over the words of one column of one page, which is what one group holds.
    """
    ordered = F.array_sort(F.collect_list(F.struct("y0", "x0", "y1", "x1", "t")))
    tall = F.percentile(F.when(F.col("y1") > F.col("y0"), F.col("y1") - F.col("y0")), F.lit(0.5))
    col = words.groupBy(*keys).agg(ordered.alias("_w"), (F.coalesce(tall * 0.6, F.lit(6.0))).alias("_tol"))
    start = F.struct(F.lit(-1).alias("line"), F.lit(None).cast("double").alias("c"), F.array().cast("array<int>").alias("of"))

    def add(a, w):
        same = F.coalesce(F.abs(w["y0"] - a["c"]) <= F.col("_tol"), F.lit(False))
        line = F.when(same, a["line"]).otherwise(a["line"] + 1)
        return F.struct(line.alias("line"), F.when(same, (a["c"] + w["y0"]) / 2).otherwise(w["y0"].cast("double")).alias("c"), F.array_append(a["of"], line).alias("of"))

    col = col.withColumn("_of", F.aggregate("_w", start, add, lambda a: a["of"]))
    each = col.select(*keys, F.explode(F.arrays_zip(F.col("_w").alias("w"), F.col("_of").alias("line_no"))).alias("e"))
    in_line = F.array_sort(F.collect_list(F.struct(F.col("e.w.x0").alias("x0"), F.col("e.w.y0").alias("y0"), F.col("e.w.t").alias("t"))))
    return (
        each.groupBy(*keys, F.col("e.line_no").alias("line_no"))
        .agg(in_line.alias("_l"), F.min("e.w.y0").alias("y0"), F.max("e.w.y1").alias("y1"))
        .withColumn("text", F.array_join(F.transform("_l", lambda w: w["t"]), " "))
        .drop("_l")
    )


def body_sizes(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Median font size of each page."""
    return spans.where("size > 0").groupBy(*keys).agg(F.percentile("size", F.lit(0.5)).alias("body_size"))


def line_sizes(lines: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """``lines`` (keys, y0, y1, ...) with body_size and max_size: the largest font of the page's spans that overlap in height."""
    with_body = lines.join(body_sizes(spans, keys), keys, "left").fillna(0.0, ["body_size"]).withColumn("_id", F.monotonically_increasing_id())
    s = spans.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("y0").alias("_y0"), F.col("y1").alias("_y1"), F.col("size").alias("_size"))
    on = [with_body[k] == s[f"_s_{k}"] for k in keys]
    overlap = ~((s["_y1"] < with_body["y0"]) | (s["_y0"] > with_body["y1"]))
    condition = overlap
    for c in on:
        condition = condition & c
    joined = with_body.join(s, condition, "left")
    return joined.groupBy(*with_body.columns).agg(F.coalesce(F.max("_size"), F.first("body_size")).alias("max_size")).drop("_id")


def split_pages(pages: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Page records (keys, rect, words, spans) -> gutters, and tagged lines (keys, region, line_no, text, tag, ...)."""
    keys = keys or ["volume", "page"]
    words = pages.select(*keys, F.explode("words").alias("w")).select(*keys, "w.*")
    spans = pages.select(*keys, F.explode("spans").alias("s")).select(*keys, "s.*")
    gutter = gutters(pages.select(*keys, F.get("rect", F.lit(0)).alias("width")), words, keys)
    sided = words.join(gutter.select(*keys, "split_x"), keys).withColumn("region", side(F.col("x0"), F.col("x1"), F.col("split_x")))
    lines = line_sizes(cluster_lines(sided, [*keys, "region"]), spans, keys)
    return gutter, lines.withColumn("tag", tag_line(F.col("text"), F.col("max_size"), F.col("body_size")))


def page_stats(gutter: DataFrame, lines: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["volume", "page"]
    kind = income_kind(F.col("text"), F.col("tag"))
    surname = F.when(F.col("tag") == "entry", F.nullif(F.regexp_extract("text", P.SURNAME_AT_START, 1), F.lit("")))
    counts = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("tag").isin("entry", "ditto")).alias("n_entry"),
        F.count_if(F.col("tag") == "ad").alias("n_ad"),
        F.count_if(kind == "clean").alias("income_clean"),
        F.count_if(kind == "dirty").alias("income_dirty"),
        F.array_sort(F.collect_list(F.when(surname.isNotNull(), F.struct("region", "line_no", surname.alias("surname"))))).alias("_s"),
    )
    got = gutter.join(counts, keys, "left").fillna(0, ["n_lines", "n_entry", "n_ad", "income_clean", "income_dirty"])
    ratio = F.coalesce(F.try_divide(F.col("n_entry"), F.col("n_lines")), F.lit(0.0))
    return got.withColumns(
        {"entry_ratio": F.round(ratio, 3), "is_body": is_body(F.col("n_entry"), F.col("n_lines")).cast("int"), "surnames": F.transform("_s", lambda x: x["surname"])}
    ).drop("_s", "split_x")


def body_lines(lines: DataFrame, stats: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Entries and dittos of body pages."""
    keys = keys or ["volume", "page"]
    return lines.join(stats.where("is_body = 1").select(*keys), keys, "left_semi").where(F.col("tag").isin("entry", "ditto"))


def volume_summary(stats: DataFrame, volume: str = "volume") -> DataFrame:
    """Over body pages only; 0 where there are none."""
    body = stats.where("is_body = 1")
    lines = F.greatest(F.sum("n_lines"), F.lit(1))
    incomes = F.sum("income_clean") + F.sum("income_dirty")
    summary = body.groupBy(volume).agg(
        F.count(F.lit(1)).alias("body_pages"),
        F.avg("gutter_conf").alias("mean_gutter_conf"),
        F.avg((F.col("gutter_conf") >= 0.5).cast("int")).alias("gutter_ok_rate"),
        F.sum("n_entry").alias("entries"),
        (F.sum("n_entry") / F.count(F.lit(1))).alias("entries_per_page"),
        (F.sum("n_ad") / lines).alias("ad_rate"),
        F.coalesce(F.try_divide(F.sum("income_clean"), incomes), F.lit(0.0)).alias("clean_rate"),
    )
    names = body.select(volume, "page", F.posexplode("surnames").alias("k", "surname"))
    from folioforge.operators.records import monotonicity

    mono = monotonicity(names, "surname", [volume], ["page", "k"]).where("n_names >= 2").select(volume, "monotonicity")
    totals = stats.groupBy(volume).agg(F.count(F.lit(1)).alias("pages"))
    return totals.join(summary, volume, "left").join(mono, volume, "left").fillna(0)


def assign_regions(lines: DataFrame, regions: DataFrame, keys: list[str]) -> DataFrame:
    """Lines (keys, line_id, cx, cy) with the smallest region (keys, position, label, x0, y0, x1, y1) that holds their centre."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    r = regions.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "position", "label", "x0", "y0", "x1", "y1", area.alias("_area"))
    on = (F.col("cx") >= F.col("x0")) & (F.col("cx") <= F.col("x1")) & (F.col("cy") >= F.col("y0")) & (F.col("cy") <= F.col("y1"))
    for k in keys:
        on = on & (lines[k] == r[f"_r_{k}"])
    best = F.min(F.when(F.col("_area").isNotNull(), F.struct("_area", "position", "label"))).alias("_b")
    return lines.join(r, on, "left").groupBy(*lines.columns).agg(best).select(*lines.columns, F.col("_b.position").alias("region_position"), F.col("_b.label").alias("region_label"))


def layout_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Reading order of layout lines: regions by position, nulls last, then rows of ten units, then x."""
    w = Window.partitionBy(*keys).orderBy(F.coalesce("region_position", F.lit(9999)), F.bround(F.col("y0") / 10), "x0")
    return df.withColumn("reading_no", F.row_number().over(w))


def top_text(spans: DataFrame, heights: DataFrame, keys: list[str]) -> DataFrame:
    """Text of the spans in the top band of each page (keys, height), in x order."""
    top = spans.join(heights, keys).where(F.col("y0") < F.col("height") * P.CITY_BAND)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("x0", "t"))), lambda x: x["t"])
    return top.groupBy(*keys).agg(F.array_join(parts, " ").alias("top_text"))


class LineClusters:
    """Table function: words of one column, as arrays, to its lines. SQL: LATERAL cluster_lines(tops, lefts, heights, texts)."""

    def eval(self, tops, lefts, heights, texts):
        words = sorted(zip(tops, lefts, texts, strict=True), key=lambda w: (w[0], w[1]))
        tall = pd.Series([h for h in heights if h > 0], dtype=float)
        tolerance = tall.median() * 0.6 if len(tall) else 6.0
        line, centre = [], None
        number = 0
        for top, left, text in words:
            if centre is not None and abs(top - centre) > tolerance:
                yield number, " ".join(t for _, t in sorted(line))
                line, centre, number = [], None, number + 1
            centre = top if centre is None else (centre + top) / 2
            line.append((left, text))
        if line:
            yield number, " ".join(t for _, t in sorted(line))


def register_functions(spark) -> None:
    """Make ``cluster_lines`` a SQL table function of the session."""
    spark.udtf.register("cluster_lines", F.udtf(LineClusters, returnType="line_no int, text string"))


_NUMBERS = ("x0", "y0", "x1", "y1")
_BOX = [T.StructField(c, T.DoubleType()) for c in _NUMBERS]
WORD = T.StructType([*_BOX, T.StructField("t", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("b", "l", "wn")]])
SPAN = T.StructType([*_BOX, T.StructField("size", T.DoubleType()), T.StructField("t", T.StringType())])
PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("volume", T.StringType()),
        T.StructField("rect", T.ArrayType(T.DoubleType())),
        T.StructField("words", T.ArrayType(WORD)),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)
