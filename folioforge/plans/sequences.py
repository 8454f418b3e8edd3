"""Queries of inherently sequential or numeric operators, which SQL cannot express; brute force in tests/test_sequences.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import similarity as S
from folioforge.functions import text as X
from folioforge.operators import images, models, sampling
from folioforge.plans.documents import document_lines, hyp_ref, micro, table


def matcher_ratios(spark, sf):
    h = hyp_ref(spark, sf)
    return h.select("doc_id", "line_no", micro(S.matcher_ratio(F.col("ref"), F.col("hyp"))).alias("ratio"))


def corrected_lines(spark, sf):
    """Lines through a stand-in model that changes letters and digits; protected data must come out as it was."""
    lines = document_lines(spark, sf).select("page", "line_no", "text")
    fixed = models.correct_texts(lines, lambda: lambda t: t.replace("th", "dh").translate({48 + d: 57 - d for d in range(10)}))
    return fixed.select("page", "line_no", F.md5("corrected").alias("corrected"))


def image_splits(spark, sf):
    """Pages drawn from the numbers of suppliers: a header bar and two columns of bars."""
    import numpy as np

    pages = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("page"), F.col("s_suppkey").cast("string").cast("binary").alias("content"))
    # a small file is one partition, and a page takes some hundredths of a second; without a number, adaptive execution would make few large tasks of these short rows
    pages = pages.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page")

    def decode(raw):
        k = int(raw)
        img = np.full((500, 400), 235, dtype=np.uint8)
        img[36:44, 40:360] = 30
        for y in range(100 + k % 5, 480, 12):
            img[y : y + 5, 20 : 185 - k % 7] = 30
            img[y : y + 5, 215 + k % 9 : 380] = 30
        return img

    got = images.split_pages(pages, decode, method="otsu")
    return got.select("page", "header_status", "gutter_conf", "split_x", "faded_flag")


def drawn_sample(spark, sf):
    return sampling.seeded_split(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 25, seed=3).where("split = 'eval'").select("c_custkey")


QUERIES = {
    f.__name__: f
    for f in (matcher_ratios, corrected_lines, image_splits, drawn_sample)
}
