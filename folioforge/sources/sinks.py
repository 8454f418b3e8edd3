"""Writers. Tables are Parquet partitioned by volume; CSV, JSON and markdown are exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import assembly, sampling


def write_pages(pages: DataFrame, path: str, fmt: str = "json") -> None:
    """Page records, one folder for each volume."""
    pages.write.mode("overwrite").partitionBy("volume").format(fmt).save(path)


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """CSV with a header, quotes doubled as ``csv_table`` reads them; nested columns as JSON. Sorted within and across files if ``order`` is given."""
    flat = df.select(*[F.to_json(c).alias(c) if k.startswith(("array", "map", "struct")) else F.col(c) for c, k in df.dtypes])
    (flat.orderBy(*order) if order else flat).write.mode("overwrite").options(
        header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Few rows (a summary) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_records(records: DataFrame, qa: DataFrame, path: str, volume: str = "volume") -> None:
    """Records as Parquet and CSV, and their quality figures."""
    records.write.mode("overwrite").partitionBy(volume).parquet(f"{path}/records")
    write_csv(records, f"{path}/records_csv", [volume, "record_id"])
    write_summary(qa, f"{path}/qa")


def pairwise_matrix(cer: DataFrame, value: str = "mean_cer") -> DataFrame:
    """Engines by engines; pairs without a shared region are null."""
    return cer.groupBy("a").pivot("b").agg(F.first(value)).withColumnRenamed("a", "engine")


def write_agreement(regions: DataFrame, groups: DataFrame, cer: DataFrame, path: str) -> None:
    scores = regions.withColumn("mean_agreement", F.col("region_mean_sim")).withColumn("n_low_conf", F.col("n_low_conf_lines"))
    write_csv(scores, f"{path}/agreement_scores", ["page", "region"])
    lines = groups.select(
        "page", "region", F.col("slot").alias("line_idx"), "n_engines_on_line", F.round("mean_sim", 4).alias("agreement_mean_sim"), "band",
        F.substring("representative", 1, 300).alias("representative"), "engines",
    )
    write_csv(lines, f"{path}/agreement_lines", ["page", "region", "line_idx"])
    write_csv(pairwise_matrix(cer), f"{path}/pairwise_cer", ["engine"])
    write_csv(pairwise_matrix(cer, "n_shared"), f"{path}/pairwise_counts", ["engine"])


def agreement_report(totals: DataFrame, centrality: DataFrame, worst: DataFrame, low: DataFrame, high: DataFrame) -> str:
    """Markdown of a few tables, all their rows: totals, a row an engine, and the samples that the caller has chosen."""

    def rows(df, columns):
        body = [f"| {' | '.join(_shown(r[c]) for c in columns)} |" for r in df.select(*columns).toLocalIterator()]
        return "\n".join([f"| {' | '.join(columns)} |", "|" + "---|" * len(columns), *body])

    return "\n\n".join(
        [
            "# Agreement of reads", rows(totals, totals.columns), "## Engines by mean distance to the others", rows(centrality, ["rank", "engine", "mean_cer"]),
            "## Regions with the least similarity", rows(worst, ["page", "region", "n_engines", "region_mean_sim", "n_low_conf_lines"]),
            "## Disagreements", rows(low, ["page", "region", "slot", "mean_sim", "representative"]), "## Agreements", rows(high, ["page", "region", "slot", "mean_sim", "representative"]),
        ]
    )


def _shown(v) -> str:
    return "n/a" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)[:90].replace("|", "\\|")


def leaderboard_markdown(board: DataFrame) -> str:
    columns = ["rank", "engine", "n", "score", "cer", "comma_f1", "comma_recall", "dash_recall", "digit_recall", "field_count_ratio"]
    rows = board.orderBy("rank").select(*columns).toLocalIterator()
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *["| " + " | ".join(_shown(v) for v in r) + " |" for r in rows]])


def write_page_documents(records: DataFrame, path: str) -> None:
    """Page JSON, markdown in page order, and the page index."""
    records.write.mode("overwrite").json(f"{path}/pages")
    assembly.render_pages(records).orderBy("ssa_id").select("markdown").write.mode("overwrite").option("lineSep", "\n\n").text(f"{path}/master")
    write_csv(assembly.page_index(records), f"{path}/page_index", ["ssa_id"])


def write_flagged(lines: DataFrame, path: str) -> None:
    write_csv(lines.select("page", "region", "line_idx", "agreement", F.col("n_corrob").alias("n_votes"), "text"), path, ["page", "region", "line_idx"])


def upsert(new: DataFrame, path: str, keys: list[str]) -> None:
    """Rows of ``new`` replace those of the Parquet table at ``path`` that have the same key.

    The new version is written beside the old one and named by a pointer row only when it is whole, so readers and
    runs that are repeated never see half a table. A table has one writer at a time: a writer that finds, when its version is
    whole, that another one has moved the pointer since it began, leaves the pointer alone and says so.
    """
    import uuid

    spark = new.sparkSession
    before = _pointed(spark, path)
    old = current(spark, path, new.schema)
    both = sampling.latest(old, new, keys) if old is not None else sampling.latest(new.limit(0), new, keys)
    version = uuid.uuid4().hex
    both.write.mode("errorifexists").parquet(f"{path}/v-{version}")
    if _pointed(spark, path) != before:
        raise RuntimeError(f"another writer has replaced {path} since; run this one again")
    spark.createDataFrame([(version,)], "version string").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/pointer")


def _pointed(spark, path: str) -> str | None:
    """The version that the pointer names; None if there is none."""
    from pyspark.errors import AnalysisException

    try:
        last = spark.read.schema("version string, at timestamp").parquet(f"{path}/pointer").orderBy(F.desc("at")).limit(1).collect()
    except AnalysisException:
        return None
    return last[0]["version"] if last else None


def current(spark, path: str, schema=None) -> DataFrame | None:
    """The table that ``upsert`` wrote last; None if there is none."""
    version = _pointed(spark, path)
    if version is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/v-{version}")


def failures(split: DataFrame) -> DataFrame:
    """Crop failures of all pages: poor gutter, no header, or an error; each once, in order."""
    reason = F.when(F.col("error").isNotNull(), "exception").when(F.col("gutter_conf") == "poor", "gutter_poor").when(~F.col("has_header"), "no_header")
    return split.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("page", F.lit("crop").alias("stage"), "reason", F.coalesce("error", F.lit("")).alias("detail")).distinct().orderBy("page", "reason")


def write_images(df: DataFrame, name: str, content: str, folder: str) -> None:
    """Bytes of ``content`` as files ``folder/name``; the folder may be a path or an address of a store that pyarrow knows. Every
    file is written whole under another name first."""

    def put(rows) -> None:
        import uuid

        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        for r in rows:
            target = f"{root.rstrip('/')}/{r[name]}"
            where.create_dir(target.rpartition("/")[0], recursive=True)
            part = f"{target}.{uuid.uuid4().hex}"
            with where.open_output_stream(part) as f:
                f.write(bytes(r[content]))
            where.move(part, target)

    df.select(name, content).foreachPartition(put)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Crops as files and their manifest as CSV, of ``sampling.silver_pairs``."""
    write_images(pairs, "image_path", "content", path)
    write_csv(pairs.drop("content"), f"{path}/manifest", ["page_id", "region"])
