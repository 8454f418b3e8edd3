"""Whole volume runs: text layer to records, crops to pages, reads to agreement, reads to a leaderboard.

Every step writes its tables under ``out``; a later step reads them back, so a step that fails is run again alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import assembly, consensus, evaluation, geometry, images, models, records
from folioforge.sources import readers, sinks

KEYS = ["volume", "page"]


def run_volume(spark: SparkSession, registry: str, volume_id: str, source: str, out: str, **options) -> dict:
    """The run of a registry volume, by its kind: its QA row (text layer) or its failure count (images)."""
    row = readers.volume(spark, registry, volume_id)
    if readers.route(row) == "text_layer":
        return run_text_layer(spark, row, source, out, **options)
    return run_images(spark, source, out, **options)


def run_text_layer(spark: SparkSession, row: dict, source: str, out: str, open_pages: Callable | None = None, dialect: str = "1912") -> dict:
    """PDF text layer -> page records -> lines and quality -> records of body pages with their city -> QA."""
    layer = readers.text_layer(spark, source, open_pages).drop("path").withColumns({"volume": F.lit(row["volume_id"]), "year": F.lit(row["year"])})
    sinks.write_pages(layer, f"{out}/pages")
    pages = readers.pages(spark, f"{out}/pages")
    gutter, lines = geometry.split_pages(pages)
    lines.write.mode("overwrite").parquet(f"{out}/lines")
    lines = spark.read.parquet(f"{out}/lines")
    stats = geometry.page_stats(gutter, lines)
    stats.write.mode("overwrite").parquet(f"{out}/page_quality")
    stats = spark.read.parquet(f"{out}/page_quality")
    sinks.write_csv(stats.drop("surnames"), f"{out}/page_quality_csv", KEYS)
    sinks.write_summary(geometry.volume_summary(stats), f"{out}/quality_summary")
    body = stats.where("is_body = 1").select(*KEYS)
    spans = pages.select(*KEYS, F.explode("spans").alias("s")).select(*KEYS, "s.*")
    tops = geometry.top_text(spans, pages.select(*KEYS, F.get("rect", F.lit(1)).alias("height")), KEYS)
    cities = records.carry_city(body.join(tops, KEYS, "left").select(*KEYS, records.city_of_page(F.col("top_text")).alias("city")))
    kept = geometry.body_lines(lines, stats).withColumn("text", X.nfkc(F.col("text")))
    parsed = records.parse_records(merged_columns(kept, dialect), dialect).join(cities, KEYS)
    numbered = records.with_record_ids(parsed.withColumn("year", F.lit(row["year"])), f"K{row['year']}")
    qa = records.record_qa(numbered)
    sinks.write_records(numbered, qa, f"{out}/records")
    first = qa.limit(1).collect()
    return first[0].asDict() if first else {}


def merged_columns(lines: DataFrame, dialect: str) -> DataFrame:
    """Lines of columns (volume, page, region, line_no, text) with slipped incomes and broken words joined."""
    keys = [*KEYS, "region"]
    if dialect == "1936":
        return records.merge_lines_1936(lines, keys=keys)
    column = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    return lines.groupBy(*keys).agg(column.alias("_l")).select(*keys, F.posexplode(records.merge_bumps_1912(F.col("_l"))).alias("line_no", "text"))


def run_images(spark: SparkSession, source: str, out: str, decode: Callable, encode: Callable | None = None, engines: list[str] = (), loaders: dict | None = None) -> dict:
    """Page images -> geometry, quality and crops -> engine reads; pages already split are left alone."""
    done = sinks.current(spark, f"{out}/split")
    todo = readers.images(spark, source)
    if done is not None:
        todo = todo.join(done.where("error IS NULL").select("page"), "page", "left_anti")
    sinks.upsert(images.split_pages(todo, decode, encode), f"{out}/split", ["page"])
    split = sinks.current(spark, f"{out}/split")
    failed = sinks.failures(split)
    sinks.write_csv(failed, f"{out}/crop_failures")
    crops = split.select("page", F.explode(F.create_map(F.lit("header"), "header", F.lit("colL"), "colL", F.lit("colR"), "colR")).alias("region", "content")).where("content IS NOT NULL")
    reads = models.run_engines(crops, list(engines), loaders)
    reads.write.mode("overwrite").parquet(f"{out}/reads")
    return {"pages": split.count(), "failures": failed.count()}


def assemble(reads: DataFrame, anchor: str, others: list[str], out: str) -> DataFrame:
    """Reads of regions -> corroborated lines, flagged lines, page documents; and, of the anchor's reads, records of 1936."""
    spark = reads.sparkSession
    consensus.anchored_agreement(reads, anchor).write.mode("overwrite").parquet(f"{out}/anchored")
    lines = spark.read.parquet(f"{out}/anchored")
    sinks.write_flagged(consensus.flagged(lines), f"{out}/flagged")
    assembly.page_records(assembly.fused_pages(lines, reads, anchor, others)).write.mode("overwrite").parquet(f"{out}/page_records")
    pages = spark.read.parquet(f"{out}/page_records")
    sinks.write_page_documents(pages, f"{out}/documents")
    columns = reads.where((F.col("engine") == anchor) & F.col("region").isin("colL", "colR"))
    raw = columns.select(F.lit("1936").alias("volume"), "page", "region", F.posexplode(X.lines(X.nfkc(F.col("text")))).alias("line_no", "text"))
    parsed = records.with_record_ids(records.parse_records(merged_columns(raw, "1936"), "1936"), "K1936")
    sinks.write_records(parsed, records.record_qa(parsed), f"{out}/records")
    return pages


def agreement(reads: DataFrame, out: str) -> str:
    """Reads -> region and line agreement, pairwise distances, and the report's markdown."""
    spark = reads.sparkSession
    regions, groups = consensus.analyze_regions(reads)
    groups.write.mode("overwrite").parquet(f"{out}/groups")
    regions.write.mode("overwrite").parquet(f"{out}/regions")
    groups, regions = spark.read.parquet(f"{out}/groups"), spark.read.parquet(f"{out}/regions")
    full = reads.withColumn("text", X.compare_form(F.array_join(X.engine_lines(X.nfkc(F.col("text")), F.col("engine")), " ")))
    cer = consensus.pairwise_cer(full)
    sinks.write_agreement(regions, groups, cer, out)
    report = sinks.agreement_report(
        consensus.report_totals(regions, groups), consensus.engine_centrality(cer), consensus.worst_regions(regions), consensus.samples(groups), consensus.samples(groups, high=True)
    )
    spark.createDataFrame([(report,)], "markdown string").coalesce(1).write.mode("overwrite").text(f"{out}/report")
    return report


def bakeoff(reads: DataFrame, references: DataFrame, ids: DataFrame, out: str) -> str:
    board = evaluation.leaderboard(reads, references, ids)
    board.write.mode("overwrite").parquet(f"{out}/leaderboard")
    board = reads.sparkSession.read.parquet(f"{out}/leaderboard")
    sinks.write_csv(board, f"{out}/leaderboard_csv", ["rank"])
    return sinks.leaderboard_markdown(board)
