"""Region texts to pages, page tables and the master document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as X

REGIONS = ("header", "colL", "colR")


def fused_pages(lines: DataFrame, reads: DataFrame, anchor: str, others: list[str]) -> DataFrame:
    """Page reads (page, header, colL, colR as struct<text, confidence>): anchored lines where the anchor read the
    region, else the first other engine that did, with no confidence."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "text"))), lambda x: x["text"]), "\n")
    mine = lines.groupBy("page", "region").agg(text.alias("_t"), F.round(F.avg("agreement"), 4).alias("_c"))
    rank = F.array_position(F.array(*[F.lit(o) for o in others]), F.col("engine"))
    other = reads.where(F.col("engine").isin(*others) & F.regexp_like("text", F.lit(r"\S"))).groupBy("page", "region").agg(F.min(F.struct(rank.alias("k"), "text"))["text"].alias("_o"))
    both = mine.join(other, ["page", "region"], "full")
    value = F.struct(F.coalesce("_t", "_o", F.lit("")).alias("text"), F.when(F.col("_t").isNotNull(), F.col("_c")).alias("confidence"))
    wide = both.groupBy("page").pivot("region", list(REGIONS)).agg(F.first(value))
    return wide.select("page", *[F.coalesce(F.col(r), F.struct(F.lit("").alias("text"), F.lit(None).cast("double").alias("confidence"))).alias(r) for r in REGIONS])


def page_records(pages: DataFrame) -> DataFrame:
    """ssa_id, page_number, header, columns, page_confidence, n_chars, of (page, header, colL, colR and perhaps page_number)."""
    found = X.page_number(F.col("header.text"))
    recovered = F.struct(F.coalesce(found, F.lit("")).alias("text"), F.lit(None).cast("double").alias("confidence"), F.when(found.isNull(), "none").otherwise("recovered_from_header").alias("source"))
    number: Column = recovered
    if "page_number" in pages.columns:
        given = F.struct(F.col("page_number.text").alias("text"), F.col("page_number.confidence").alias("confidence"), F.lit(None).cast("string").alias("source"))
        number = F.when(F.col("page_number").isNotNull(), given).otherwise(recovered)
    known = F.filter(F.array(*[F.col(f"{r}.confidence") for r in REGIONS]), lambda c: c.isNotNull())
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, c: a + c), F.size(known))
    return pages.select(
        F.col("page").cast("string").alias("ssa_id"), number.alias("page_number"), "header", F.struct("colL", "colR").alias("columns"),
        F.round(mean, 4).alias("page_confidence"), (F.char_length("colL.text") + F.char_length("colR.text")).alias("n_chars"),
    )


def render_pages(records: DataFrame) -> DataFrame:
    conf = lambda c: F.when(c.isNull(), "").otherwise(F.format_string(" (confidence %.4f)", c))
    head = F.format_string("## %s", F.col("ssa_id"))
    number = F.when(F.col("page_number.text") != "", F.concat(F.lit("Page "), F.col("page_number.text")))
    part = lambda name, v: F.concat(F.lit(f"### {name}"), conf(v["confidence"]), F.lit("\n"), v["text"])
    body = F.concat_ws("\n\n", head, number, part("header", F.col("header")), part("left column", F.col("columns.colL")), part("right column", F.col("columns.colR")))
    return records.select("ssa_id", body.alias("markdown"))


def page_index(records: DataFrame) -> DataFrame:
    return records.select("ssa_id", F.col("page_number.text").alias("page_number"), F.col("header.text").alias("header"), F.col("header.confidence").alias("header_conf"), "page_confidence")


def coverage(reads: DataFrame) -> DataFrame:
    """Reads and characters of each engine and region; regions that a second engine corroborates are counted beside."""
    several = reads.groupBy("page", "region").agg((F.count_if(F.regexp_like("text", F.lit(r"\S"))) >= 2).alias("_c"))
    return reads.join(several, ["page", "region"]).groupBy("engine").agg(
        F.count(F.lit(1)).alias("reads"), F.sum(F.char_length("text")).alias("chars"), F.count_if("_c").alias("corroborated")
    )


def read_manifest(reads: DataFrame) -> DataFrame:
    return reads.select("page", "region", "text_path", F.char_length("text").alias("n_chars"), X.read_line_count(F.col("text")).alias("n_lines"))


def grouped_layout_text(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Text of layout lines by region, each under a separator line, those of no region last."""
    label = F.when(F.col("region_position").isNull(), F.lit("===== [no region] =====")).otherwise(F.format_string("===== [region %d] %s =====", "region_position", "region_label"))
    inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("reading_no", "text"))), lambda x: x["text"]), "\n")
    block = lines.withColumn("_label", label).groupBy(*keys, F.coalesce("region_position", F.lit(9999)).alias("_p"), "_label").agg(inside.alias("_t"))
    all_ = F.array_sort(F.collect_list(F.struct("_p", F.concat_ws("\n", "_label", "_t").alias("t"))))
    return block.groupBy(*keys).agg(F.array_join(F.transform(all_, lambda x: x["t"]), "\n\n").alias("text"))
