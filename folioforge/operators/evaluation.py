"""Reads against references: punctuation fidelity, error rates, leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import patterns as P
from folioforge.functions import similarity as S
from folioforge.functions import text as X

METRICS = ("cer", "comma_f1", "comma_recall", "dash_recall", "digit_recall", "field_count_ratio")


def _count(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern))


def score(ref: Column, hyp: Column, nfkc_first: bool = True) -> dict[str, Column]:
    """Metric columns of a reference and a hypothesis."""
    form = (lambda t: X.nfkc(F.coalesce(t, F.lit("")))) if nfkc_first else (lambda t: F.coalesce(t, F.lit("")))
    r, h = form(ref), form(hyp)
    rc, hc = _count(r, ","), _count(h, ",")
    rd, hd = _count(r, f"[{P.DASHES}]"), _count(h, f"[{P.DASHES}]")
    rg, hg = _count(r, "[0-9]"), _count(h, "[0-9]")
    both = F.least(rc, hc)
    # the i-th line that is not blank against the i-th of the hypothesis; lines without commas do not count
    commas = lambda t: F.transform(X.lines(t), lambda x: _count(x, ","))
    pairs = F.filter(F.arrays_zip(commas(r).alias("r"), commas(h).alias("h")), lambda p: p["r"] > 0)
    ratio = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.least(p["r"], F.coalesce(p["h"], F.lit(0))) / p["r"])
    return {
        "comma_recall": S.safe_div(both, rc),
        "comma_precision": S.safe_div(both, hc),
        "comma_f1": S.safe_div(both * 2, rc + hc),
        "dash_recall": S.safe_div(F.least(rd, hd), rd),
        "digit_recall": S.safe_div(F.least(rg, hg), rg),
        "field_count_ratio": F.when(F.size(pairs) == 0, 1.0).otherwise(F.try_divide(ratio, F.size(pairs))),
        "cer": S.cer(ref, hyp, nfkc_first),
        "ref_commas": rc,
        "hyp_commas": hc,
    }


def composite(cer: Column, comma_f1: Column, field_count_ratio: Column) -> Column:
    w = P.SCORE_WEIGHTS
    return (1 - cer) * w["cer"] + comma_f1 * w["comma_f1"] + field_count_ratio * w["field_count_ratio"]


def leaderboard(reads: DataFrame, references: DataFrame, ids: DataFrame, keys: list[str] | None = None, minimum: int = P.MIN_REFERENCE) -> DataFrame:
    """Engines by mean score. reads (page_id, engine, text), references (year, page_id, reference), ids (year, page_id)."""
    keys = keys or ["year", "page_id"]
    refs = references.join(ids, keys).where(F.char_length(X.strip(F.col("reference"))) >= minimum)
    both = reads.join(refs, "page_id").withColumn("text", X.clean_markup(F.col("text")))
    got = both.select("engine", *[c.alias(k) for k, c in score(F.col("reference"), F.col("text")).items()])
    mean = got.groupBy("engine").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 4).alias(m) for m in METRICS])
    mean = mean.withColumn("score", F.round(composite(F.col("cer"), F.col("comma_f1"), F.col("field_count_ratio")), 4))
    return mean.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "engine")))


def correction_verdict(scored: DataFrame) -> DataFrame:
    """Mean error rate by tag (before, after), their difference, and whether it helps (below -0.01)."""
    mean = scored.groupBy().pivot("tag", ["before", "after"]).agg(F.avg("cer"))
    return mean.withColumn("change", F.col("after") - F.col("before")).withColumn("helps", F.col("change") < -0.01)


def training_cer(ref: Column, hyp: Column) -> Column:
    r, h = X.nfc_collapsed(ref), X.nfc_collapsed(hyp)
    return F.when(r == "", F.when(h == "", 0.0).otherwise(1.0)).otherwise(S.long_distance(r, h) / F.greatest(F.char_length(r), F.lit(1)))
