"""Readers. Every schema is declared; order is a column, never the order of files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import patterns as P
from folioforge.functions import text as X
from folioforge.operators.geometry import PAGE, SPAN, WORD

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


VOLUME = _schema(volume_id=_S, year=_I, kind=_S, source_pdf=_S, image_dir=_S, n_pages=_I, city_scope=_S, source=_S, status=_S)
PAGE_QUALITY = _schema(page=_I, n_words=_I, gutter_conf=_D, n_lines=_I, n_entry=_I, entry_ratio=_D, n_ad=_I, income_clean=_I, income_dirty=_I, is_body=_I)
EVAL_MANIFEST = _schema(page_id=_S, image_path=_S, reference=_S, stratum=_S, metric=_S)
GOLD_MANIFEST = T.StructType(
    [*EVAL_MANIFEST, *_schema(gold_path=_S, status=_S, source=_S, license=_S, verified=_S, language=_S, region=_S, notes=_S, content_bearing=_S)]
)


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a registry file {"volumes": [...]}."""
    schema = T.StructType([T.StructField("volumes", T.ArrayType(VOLUME))])
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("volumes").alias("v")).select("v.*")


def volume(spark: SparkSession, path: str, volume_id: str) -> dict:
    """The one row of ``volume_id``; an unknown id is an error."""
    rows = volumes(spark, path).where(F.col("volume_id") == volume_id).limit(2).collect()
    if len(rows) != 1:
        raise KeyError(f"volume {volume_id!r} is in the registry {len(rows)} times")
    return rows[0].asDict()


def route(row: dict) -> str:
    """Which path a volume takes: its text layer or its images."""
    ways = {"ocr_pdf": "text_layer", "image_scans": "images"}
    if row["kind"] not in ways:
        raise ValueError(f"unknown kind {row['kind']!r}")
    return ways[row["kind"]]


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Page records (words and spans with places)."""
    return spark.read.schema(PAGE).json(path)


def text_layer(spark: SparkSession, path: str, open_pages: Callable[[bytes], Iterator[dict]] | None = None) -> DataFrame:
    """Page records of PDF files. ``open_pages`` gives for a file's bytes one dict for each page: page, rect, words, blocks.

    Without one, PyMuPDF is used if it is installed. Blank words are dropped; places have one decimal.
    """
    reader = open_pages or _pymupdf_pages
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")
    schema = T.StructType(
        [T.StructField("path", _S), T.StructField("page", _I), T.StructField("rect", T.ArrayType(_D)), T.StructField("words", T.ArrayType(WORD)), T.StructField("spans", T.ArrayType(SPAN))]
    )

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = [(file, p["page"], list(map(float, p["rect"])), words_of(p["words"]), spans_of(p["blocks"])) for p in reader(content)]
                yield pd.DataFrame(rows, columns=schema.names)

    return files.mapInPandas(run, schema)


def words_of(raw: list[tuple]) -> list[dict]:
    """(x0, y0, x1, y1, text, block, line, number) tuples as words."""
    names = ("x0", "y0", "x1", "y1", "t", "b", "l", "wn")
    return [dict(zip(names, (*(round(float(v), 1) for v in w[:4]), *w[4:]), strict=True)) for w in raw if str(w[4]).strip()]


def spans_of(blocks: list[dict]) -> list[dict]:
    """Text blocks (type 0) -> lines -> spans, flattened; blank text is dropped."""
    flat = (s for b in blocks if b.get("type", 0) == 0 for ln in b.get("lines", []) for s in ln.get("spans", []))
    return [
        dict(zip(("x0", "y0", "x1", "y1"), (round(float(v), 1) for v in s["bbox"]), strict=True)) | {"size": round(float(s["size"]), 1), "t": s["text"]}
        for s in flat
        if s["text"].strip()
    ]


def _pymupdf_pages(content: bytes) -> Iterator[dict]:
    try:
        import fitz
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs PyMuPDF, or an open_pages function") from missing
    with fitz.open(stream=content, filetype="pdf") as doc:
        for k, page in enumerate(doc):
            yield {"page": k, "rect": [page.rect.width, page.rect.height], "words": page.get_text("words"), "blocks": page.get_text("dict")["blocks"]}


def page_images(spark: SparkSession, path: str, render: Callable[[bytes, float], Iterator[tuple[int, bytes]]], dpi: int = 150) -> DataFrame:
    """(path, page, image) of PDF files, rendered at dpi / 72 by an injected function."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([(file, k, image) for k, image in render(content, dpi / 72)], columns=["path", "page", "image"])

    return files.mapInPandas(run, "path string, page int, image binary")


def images(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """(page, path, content) of an image folder; the page is the file's stem."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return df.select(_stem(F.col("path")).alias("page"), "path", "content")


def _stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def _texts(spark: SparkSession, path: str, names: str = "*.txt") -> DataFrame:
    """(path, dir, stem, text) of text files; bytes that are no UTF-8 become replacement characters."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    return df.select("path", F.get(parts, F.size(parts) - 2).alias("dir"), _stem(F.col("path")).alias("stem"), _decode(F.col("content")).alias("text"))


def _texts_if_there(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return _texts(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, dir string, stem string, text string")


@F.pandas_udf(T.StringType())
def _decode_loose(content):
    return content.map(lambda b: bytes(b).decode("utf-8", "replace"))


def _decode(content: Column) -> Column:
    strict = F.try_validate_utf8(content.cast("string"))
    return F.when(strict.isNotNull(), strict).otherwise(_decode_loose(content))


def discover_reads(spark: SparkSession, by_engine: str | None, whole_pages: str | None) -> DataFrame:
    """(page, region, engine, text) of both layouts: <engine>/<page>_<region>.txt, which wins, and <page>_<engine>.txt."""
    found = []
    if by_engine:
        t = _texts(spark, by_engine)
        region = F.regexp_extract("stem", P.REGION_SUFFIX, 2)
        page = F.when(region != "", F.regexp_extract("stem", P.REGION_SUFFIX, 1)).otherwise(F.col("stem"))
        found.append(t.select(page.alias("page"), region.alias("region"), X.canonical_engine(F.col("dir")).alias("engine"), "text", F.lit(0).alias("_p"), "path"))
    if whole_pages:
        t = _texts(spark, whole_pages).where(F.regexp_like("stem", F.lit(P.WHOLE_PAGE_STEM)))
        engine = X.canonical_engine(F.regexp_extract("stem", P.WHOLE_PAGE_STEM, 2))
        found.append(t.select(F.regexp_extract("stem", P.WHOLE_PAGE_STEM, 1).alias("page"), F.lit("").alias("region"), engine.alias("engine"), "text", F.lit(1).alias("_p"), "path"))
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return first_by(both.where(F.col("engine").isNotNull()), ["page", "region", "engine"], ["_p", "path"]).drop("_p", "path")


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def region_reads(spark: SparkSession, root: str, page: str, region: str, engines: list[str] | None = None) -> DataFrame:
    """(engine, text) of one region: <engine>/<page>_<region>.txt, else the first flat <page>_<engine>*.txt. Only files of the page are opened."""
    t = _texts(spark, root, re.sub(r"([*?\[\]{}\\])", r"\\\1", page) + "_*.txt")
    nested = t.where(F.col("stem") == f"{page}_{region}").select(F.col("dir").alias("engine"), "text", F.lit(0).alias("_p"), "path")
    flat = t.where(F.startswith("stem", F.lit(f"{page}_"))).select(F.regexp_extract("stem", rf"^\Q{page}\E_([^_]*)", 1).alias("engine"), "text", F.lit(1).alias("_p"), "path")
    both = nested.unionByName(flat.where(F.col("engine") != region))
    if engines is not None:
        both = both.where(F.col("engine").isin(*engines))
    return first_by(both, ["engine"], ["_p", "path"]).drop("_p", "path")


def engine_read(reads: DataFrame, engine: str, wanted: DataFrame) -> DataFrame:
    """(page, region, text) of ``wanted`` (page, region); a missing read is empty."""
    own = reads.where(F.col("engine") == engine).select("page", "region", "text")
    return wanted.join(own, ["page", "region"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def voter_reads(first: DataFrame, second: DataFrame, wanted: DataFrame) -> DataFrame:
    """(engine, page_id, text) from the first place that has the read, cleaned."""
    keys = ["engine", "page_id"]
    a, b = first.select(*keys, F.col("text").alias("_a")), second.select(*keys, F.col("text").alias("_b"))
    return wanted.join(a, keys, "left").join(b, keys, "left").select(*keys, X.clean_markup(F.coalesce("_a", "_b")).alias("text"))


def eval_reads(spark: SparkSession, root: str) -> DataFrame:
    """(engine, page_id, text): _vlm/<page_id>__<model>.txt, and <engine>/<page_id>.txt of folders without a leading underscore, which win."""
    t = _texts(spark, root)
    vlm = _texts_if_there(spark, f"{root}/_vlm").where(F.contains("stem", F.lit("__")))  # hidden from a scan of the root
    a = vlm.select(F.expr("substring(stem, instr(stem, '__') + 2)").alias("engine"), F.expr("substring(stem, 1, instr(stem, '__') - 1)").alias("page_id"), "text", F.lit(1).alias("_p"), "path")
    b = t.where(~F.startswith("dir", F.lit("_"))).select(F.col("dir").alias("engine"), F.col("stem").alias("page_id"), "text", F.lit(0).alias("_p"), "path")
    return first_by(a.unionByName(b), ["engine", "page_id"], ["_p", F.desc("path")]).drop("_p", "path")


def references(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """(year, page_id, reference) of <year>/<page_id>.txt; empty if absent."""
    t = _texts(spark, root).select(F.col("dir").alias("year"), F.col("stem").alias("page_id"), F.col("text").alias("reference"))
    return ids.join(t, ["year", "page_id"], "left").withColumn("reference", F.coalesce("reference", F.lit("")))


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def gold_pairs(manifests: list[DataFrame], existing: DataFrame, limit_chars: int = 1200, minimum: int = 80) -> DataFrame:
    """Rows of several gold manifests whose image exists (image_path) and whose reference is long enough, cut to ``limit_chars``."""
    both = manifests[0]
    for m in manifests[1:]:
        both = both.unionByName(m)
    kept = both.where(F.char_length("reference") >= minimum).join(existing.select("image_path").distinct(), "image_path", "left_semi")
    return kept.withColumn("reference", F.substring("reference", 1, limit_chars))


def page_ids(stems: DataFrame, stem: str = "stem", limit: int | None = None) -> DataFrame:
    """Distinct page ids (stems without their last part), in order."""
    ids = stems.select(X.stem_page(F.col(stem)).alias("page")).distinct().orderBy("page")
    return ids.limit(limit) if limit is not None else ids


def region_inputs(files: DataFrame, stem: str = "stem") -> DataFrame:
    """(page, region) of crops in the order colL, colR, header."""
    region = X.stem_region(F.col(stem))
    order = F.array_position(F.array(F.lit("colL"), F.lit("colR"), F.lit("header")), region)
    got = files.select(X.stem_page(F.col(stem)).alias("page"), region.alias("region"), order.alias("region_ord"))
    return got.where("region_ord > 0").orderBy("region_ord", "page")


def prompts(spark: SparkSession, path: str) -> dict[str, str]:
    """Prompt texts by file stem. They are configuration, which the driver holds whole."""
    return {r["stem"]: r["text"] for r in _texts(spark, path).collect()}
