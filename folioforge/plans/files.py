"""Queries that write files made from the tables, read them back and answer from what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import assembly, images
from folioforge.plans.documents import micro, table
from folioforge.sources import readers, sinks


def scratch(spark) -> str:
    """A new folder that the driver and all executors share; on one machine without such a setting, one of its temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        root = f"file://{tempfile.gettempdir()}"
    return f"{root.rstrip('/')}/folioforge-files-{uuid.uuid4().hex}"


def put(df, name, content) -> str:
    """The folder with a file for each row."""
    folder = scratch(df.sparkSession)
    sinks.write_images(df.select(name.alias("name"), content.cast("binary").alias("content")), "name", "content", folder)
    return folder


def key():
    return F.col("s_suppkey")


def registry(spark, sf) -> str:
    v = table(spark, sf, "supplier").select(
        F.concat_ws("_", F.lit("v"), "s_suppkey", F.lit(1900) + key() % 37).alias("volume_id"), (F.lit(1900) + key() % 37).alias("year"),
        F.when(key() % 3 == 0, "ocr_pdf").otherwise("image_scans").alias("kind"), F.col("s_name").alias("source_pdf"), (key() % 500).alias("n_pages"), F.lit("ok").alias("status"),
    )
    whole = v.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("volumes"))).alias("t"))  # a registry is one small file
    return put(whole, F.lit("volumes.json"), F.col("t"))


def registry_volumes(spark, sf):
    got = readers.volumes(spark, registry(spark, sf))
    return got.select("volume_id", F.col("year").cast("long").alias("year"), "kind", "source_pdf", "image_dir", F.col("n_pages").cast("long").alias("n_pages"), "status")


def volume_routes(spark, sf):
    """Which way each volume of the registry takes, looked up one by one as a run does."""
    path = registry(spark, sf)
    rows = [r.asDict() for r in readers.volumes(spark, path).collect()]
    one = readers.volume(spark, path, rows[0]["volume_id"]) if rows else None
    assert one is None or one == rows[0]
    return spark.createDataFrame([(r["volume_id"], readers.route(r)) for r in rows], "volume_id string, route string")


def page_files(spark, sf):
    """Page records as JSON, a folder for each volume, and the words that are read back."""
    li = table(spark, sf, "lineitem")
    number = lambda c: F.col(c).cast("double")
    word = F.struct(
        number("l_linenumber").alias("x0"), number("l_quantity").alias("y0"), (number("l_linenumber") + 0.5).alias("x1"), (number("l_quantity") + 6).alias("y1"),
        F.col("l_partkey").cast("string").alias("t"), F.lit(0).alias("b"), F.lit(0).alias("l"), F.col("l_linenumber").cast("int").alias("wn"),
    )
    pages = li.groupBy(F.expr("int(l_orderkey div 20)").alias("page")).agg(F.collect_list(word).alias("words"))
    pages = pages.select("page", F.lit(1912).alias("year"), F.concat(F.lit("v"), F.col("page") % 5).alias("volume"), F.array(F.lit(60.0), F.lit(80.0)).alias("rect"), "words", F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double,size:double,t:string>>").alias("spans"))
    path = scratch(spark)
    sinks.write_pages(pages, path)
    got = readers.pages(spark, path).select("page", "volume", F.explode("words").alias("w"))
    return got.groupBy("page", "volume").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w.y1").cast("long")).alias("bottoms"), F.max("w.t").alias("last"), F.sum("w.wn").alias("numbers"))


def _pages_of(content: bytes):
    """A stand-in for a PDF reader: each file holds a number and has that number modulo 3 pages, and one more."""
    k = int(content)
    for page in range(k % 3 + 1):
        yield {
            "page": page, "rect": [100, 200],
            "words": [(1.04, 2.0, 3.0, 4.0, f"w{k}", 0, 0, 0), (5, 6, 7, 8, "  ", 0, 0, 1)],
            "blocks": [{"type": 0, "lines": [{"spans": [{"bbox": (1, 2, 3, 4), "size": 9.04, "text": f"s{k}"}, {"bbox": (1, 2, 3, 4), "size": 9, "text": " "}]}]}, {"type": 1}],
        }


def pdfs(spark, sf) -> str:
    return put(table(spark, sf, "supplier"), F.format_string("file_%d.pdf", key()), key().cast("string"))


def text_layers(spark, sf):
    got = readers.text_layer(spark, pdfs(spark, sf), _pages_of)
    return got.select(
        readers._stem(F.col("path")).alias("file"), F.col("page").cast("long").alias("page"), F.size("words").cast("long").alias("n_words"), F.get("words.t", F.lit(0)).alias("word"),
        F.round(F.get("words.x0", F.lit(0)) * 10).cast("long").alias("x0"), F.size("spans").cast("long").alias("n_spans"), F.round(F.get("spans.size", F.lit(0)) * 10).cast("long").alias("size"),
    )


def rendered_pages(spark, sf):
    def render(content, scale):
        for k in range(int(content) % 2 + 1):
            yield k, f"{int(content)}:{k}:{scale:.4f}".encode()

    got = readers.page_images(spark, pdfs(spark, sf), render, dpi=144)
    return got.select(readers._stem(F.col("path")).alias("file"), F.col("page").cast("long").alias("page"), F.md5("image").alias("image"))


def image_files(spark, sf):
    """Scans of a folder: only files of the pattern, the page being the file's name."""
    s = table(spark, sf, "supplier")
    folder = put(s, F.concat(F.lit("page."), key(), F.when(key() % 4 == 0, ".png").otherwise(".jpg")), F.col("s_name"))
    return readers.images(spark, folder).select("page", F.md5("content").alias("content"))


def csv_round_trip(spark, sf):
    """A table with quotes, commas and line ends in a field, and an array, as CSV and back."""
    c = table(spark, sf, "customer")
    note = F.concat(F.lit('say "'), F.col("c_name"), F.lit('",\n'), F.col("c_mktsegment"))
    path = scratch(spark)
    sinks.write_csv(c.select("c_custkey", note.alias("note"), F.array("c_nationkey", F.lit(1)).alias("pair"), F.lit("").alias("nothing")), path, ["c_custkey"])
    schema = readers._schema(c_custkey=readers._S, note=readers._S, pair=readers._S, nothing=readers._S)
    got = readers.csv_table(spark, path, schema)
    return got.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.md5("note").alias("note"), "pair", F.coalesce("nothing", F.lit("")).alias("nothing"))


def read_files(spark, sf) -> tuple[str, str]:
    """Reads in both layouts: of three folders one is no engine, and every fourth page has a whole-page read as well."""
    s = table(spark, sf, "supplier")
    folder = F.element_at(F.array(*map(F.lit, ("surya_text", "PaddleOCR", "quality"))), (key() % 3 + 1).cast("int"))
    nested = put(s, F.concat(folder, F.lit("/SSA_"), key(), F.when(key() % 2 == 0, "_colL").otherwise(""), F.lit(".txt")), F.concat(F.lit("é nested "), F.col("s_name")))
    flat = put(s.where("s_suppkey % 4 < 2"), F.concat(F.lit("SSA_"), key(), F.when(key() % 4 == 0, "_surya").otherwise("_paddle"), F.lit(".txt")), F.concat(F.lit("flat "), F.col("s_name")))
    return nested, flat


def discovered_reads(spark, sf):
    return readers.discover_reads(spark, *read_files(spark, sf)).select("page", "region", "engine", "text")


def chosen_region(spark, sf):
    """All engines' reads of one region (a lookup by page)."""
    nested, _ = read_files(spark, sf)
    return readers.region_reads(spark, nested, "SSA_4", "colL").select("engine", "text")


def engine_texts(spark, sf):
    """One engine's read of every page and region that is wanted; a missing one is empty."""
    s = table(spark, sf, "supplier").select(key().alias("page"), F.lit("colL").alias("region"), F.when(key() % 3 == 0, "surya").otherwise("paddle").alias("engine"), F.col("s_name").alias("text"))
    return readers.engine_read(s, "surya", s.select("page", "region")).select("page", "text")


def eval_read_files(spark, sf):
    """Reads of the evaluation folder: those under an engine's name win over those beside them."""
    s = table(spark, sf, "supplier")
    vlm = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("_vlm/p"), key(), F.lit("__dots.txt")).alias("n"), F.concat(F.lit("vlm "), F.col("s_name")).alias("t"))
    own = s.where("s_suppkey % 3 = 0").select(F.concat(F.lit("dots/p"), key(), F.lit(".txt")).alias("n"), F.concat(F.lit("own "), F.col("s_name")).alias("t"))
    return readers.eval_reads(spark, put(vlm.unionByName(own), F.col("n"), F.col("t"))).select("engine", "page_id", "text")


def reference_files(spark, sf):
    s = table(spark, sf, "supplier")
    folder = put(s.where("s_suppkey % 3 > 0"), F.concat(F.lit(1900) + key() % 2, F.lit("/p"), key(), F.lit(".txt")), F.col("s_name"))
    ids = s.select((F.lit(1900) + key() % 2).cast("string").alias("year"), F.concat(F.lit("p"), key()).alias("page_id"))
    return readers.references(spark, folder, ids).select("year", "page_id", "reference")


def gold_rows(spark, sf):
    """Pairs of two gold manifests: the image exists and the reference has the least length; longer ones are cut, as the rule is."""
    p = table(spark, sf, "part")
    row = lambda k: p.where(f"p_partkey % 2 = {k}").select(
        F.col("p_partkey").cast("string").alias("page_id"), F.concat(F.lit("img/"), F.col("p_partkey")).alias("image_path"),
        F.repeat("p_name", F.col("p_partkey").cast("int") % 100).alias("reference"), *[F.lit("").alias(f.name) for f in readers.GOLD_MANIFEST if f.name not in ("page_id", "image_path", "reference")],
    )
    existing = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("img/"), F.col("p_partkey")).alias("image_path"))
    got = readers.gold_pairs([row(0), row(1)], existing)
    return got.select("page_id", F.char_length("reference").cast("long").alias("n"), F.md5("reference").alias("reference"))


def _crops(spark, sf):
    region = F.element_at(F.array(*map(F.lit, ("colL", "colR", "header", "other"))), (key() % 4 + 1).cast("int"))
    return table(spark, sf, "supplier").select(F.concat(F.lit("SSA_"), F.expr("s_suppkey div 3"), F.lit("_"), region).alias("stem"))


def page_id_list(spark, sf):
    return readers.page_ids(_crops(spark, sf))


def region_crops(spark, sf):
    return readers.region_inputs(_crops(spark, sf)).select("page", "region", F.col("region_ord").cast("long").alias("region_ord"))


def voter_texts(spark, sf):
    s = table(spark, sf, "supplier").select(F.lit("dots").alias("engine"), F.concat(F.lit("p"), key()).alias("page_id"), "s_suppkey", "s_name")
    first = s.where("s_suppkey % 2 = 0").select("engine", "page_id", F.concat(F.lit("```txt\n"), F.col("s_name"), F.lit("\n```")).alias("text"))
    second = s.where("s_suppkey % 5 > 0").select("engine", "page_id", F.concat(F.lit("<b>"), F.col("s_name"), F.lit("</b>")).alias("text"))
    return readers.voter_reads(first, second, s.select("engine", "page_id")).select("page_id", "text")


def prompt_texts(spark, sf):
    folder = put(table(spark, sf, "nation"), F.concat(F.lit("prompt_"), F.col("n_nationkey"), F.lit(".txt")), F.concat(F.lit("Läs "), F.col("n_name")))
    return spark.createDataFrame(sorted(readers.prompts(spark, folder).items()), "stem string, text string")


def made_records(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.format_string("K_%06d", "c_custkey").alias("record_id"), F.concat(F.lit("v"), F.col("c_nationkey") % 3).alias("volume"), "c_name", F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey")).alias("income"),
    )


def written_records(spark, sf):
    """Records as Parquet by volume and as CSV with their figures; the answer counts what is in both."""
    r, path = made_records(spark, sf), scratch(spark)
    qa = r.groupBy("volume").agg(F.count(F.lit(1)).alias("records"))
    sinks.write_records(r, qa, path)
    stored = spark.read.parquet(f"{path}/records").groupBy("volume").agg(F.count(F.lit(1)).alias("n"), F.sum("income").alias("income"))
    schema = readers._schema(record_id=readers._S, volume=readers._S, c_name=readers._S, income=readers._S)
    shown = readers.csv_table(spark, f"{path}/records_csv", schema).groupBy("volume").agg(F.count("c_name").alias("n_csv"), F.count(F.nullif("income", F.lit(""))).alias("n_income"))
    figures = spark.read.schema("volume string, records long").json(f"{path}/qa")
    return stored.join(shown, "volume").join(figures, "volume")


def upserted_versions(spark, sf):
    """A table of documents by id, replaced twice by key."""
    o, path = table(spark, sf, "orders"), scratch(spark)
    some = lambda rest, mark: o.where(f"o_orderkey % 3 <> {rest}").select((F.col("o_orderkey") % 500).alias("k"), (F.col("o_orderkey") + mark).alias("v"))
    for rest, mark in ((0, 0), (1, 1_000_000), (2, 500_000)):
        sinks.upsert(some(rest, mark).groupBy("k").agg(F.max("v").alias("v")).where(f"k % 7 <> {rest}"), path, ["k"])
    return sinks.current(spark, path).select("k", "v")


def failure_log(spark, sf):
    split = table(spark, sf, "supplier").select(
        F.concat(F.lit("p"), F.expr("s_suppkey div 2")).alias("page"), F.when(key() % 5 == 0, F.concat(F.lit("IOError: "), key() % 2)).alias("error"),
        images.gutter_class((key() % 10) / 10).alias("gutter_conf"), (key() % 3 > 0).alias("has_header"),
    )
    path = scratch(spark)
    sinks.write_csv(sinks.failures(split), path, ["page", "reason"])
    got = readers.csv_table(spark, path, readers._schema(page=readers._S, stage=readers._S, reason=readers._S, detail=readers._S))
    return got.withColumn("detail", F.coalesce("detail", F.lit("")))


def made_reads(spark, sf):
    """Three engines' reads of pages of two regions, made from customers; some are blank."""
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    return c.select(
        F.concat(F.lit("p"), F.expr("c_custkey div 6")).alias("page"), F.when(k % 2 == 0, "colL").otherwise("header").alias("region"),
        F.element_at(F.array(*map(F.lit, ("a", "b", "c"))), F.expr("int(c_custkey div 2 % 3) + 1")).alias("engine"), F.when(k % 11 == 0, " ").otherwise(F.concat(F.col("c_name"), F.lit("\n"), F.col("c_mktsegment"))).alias("text"),
    )


def read_coverage(spark, sf):
    return assembly.coverage(made_reads(spark, sf)).select("engine", "reads", F.col("chars").cast("long").alias("chars"), "corroborated")


def read_manifest_rows(spark, sf):
    r = made_reads(spark, sf).withColumn("text_path", F.concat_ws("/", "engine", "page"))
    return assembly.read_manifest(r).select("page", "region", "text_path", F.col("n_chars").cast("long").alias("n_chars"), F.col("n_lines").cast("long").alias("n_lines"))


def fused_page_reads(spark, sf):
    """Lines of the anchor where it read the region, else the first other engine's text."""
    r = made_reads(spark, sf).where(F.regexp_like("text", F.lit(r"\S")))
    lines = r.where("engine = 'a'").select("page", "region", F.posexplode(X.lines(F.col("text"))).alias("line_idx", "text")).withColumn("agreement", F.when(F.col("line_idx") == 0, 0.5))
    got = assembly.fused_pages(lines, r, "a", ["c", "b"])
    return got.select("page", *[F.col(f"{x}.text").alias(f"{x}_text") for x in assembly.REGIONS], *[micro(F.col(f"{x}.confidence")).alias(f"{x}_conf") for x in assembly.REGIONS])


def layout_texts(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.when(F.col("l_linenumber") > 2, (F.col("l_linenumber") % 3).cast("int")).alias("region_position"), F.concat(F.lit("r"), F.col("l_linenumber") % 3).alias("region_label"),
        (F.col("l_linenumber") * 1000 + F.col("l_partkey") % 1000).alias("reading_no"), F.col("l_partkey").cast("string").alias("text"),
    )
    return assembly.grouped_layout_text(li, ["page"]).select("page", F.md5("text").alias("text"))


def _page_records(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    value = lambda t, n: F.struct(t.alias("text"), F.when(k % n != 0, (k % 100) / 100).alias("confidence"))
    pages = c.select(k.alias("page"), value(F.concat(F.col("c_mktsegment"), F.lit(" "), k % 3000), 2).alias("header"), value(F.col("c_name"), 3).alias("colL"), value(F.col("c_mktsegment"), 5).alias("colR"))
    return assembly.page_records(pages)


def page_markdown(spark, sf):
    return assembly.render_pages(_page_records(spark, sf)).select("ssa_id", F.md5("markdown").alias("markdown"))


def page_documents(spark, sf):
    """Page JSON, the index as CSV and the master document, written and read back."""
    path = scratch(spark)
    sinks.write_page_documents(_page_records(spark, sf), path)
    pages = spark.read.schema("ssa_id string, n_chars long, page_number struct<text:string,source:string>").json(f"{path}/pages")
    schema = readers._schema(ssa_id=readers._S, page_number=readers._S, header=readers._S, header_conf=readers._D, page_confidence=readers._D)
    index = readers.csv_table(spark, f"{path}/page_index", schema).select("ssa_id", "header", micro(F.col("header_conf")).alias("header_conf"))
    master = spark.read.option("wholetext", True).text(f"{path}/master").select(F.sum(F.regexp_count("value", F.lit(r"(?m)^## "))).alias("in_master"))
    return pages.join(index, "ssa_id").crossJoin(F.broadcast(master)).select("ssa_id", "n_chars", F.col("page_number.text").alias("page_number"), F.col("page_number.source").alias("source"), "header", "header_conf", "in_master")


def engine_runs(spark, sf):
    """Two engines and one that is not known over all crops; an error is the value of its cell."""

    def upper():
        return lambda crop: crop.decode().upper()

    def fails():
        def run(crop):
            if crop.endswith(b"7"):
                raise ValueError("cannot read")
            return str(len(crop))

        return run

    from folioforge.operators import models

    crops = table(spark, sf, "supplier").select(key().cast("string").alias("page"), F.lit("colL").alias("region"), F.col("s_name").cast("binary").alias("content"))
    got = models.run_engines(crops, ["upper", "unknown", "fails"], {"upper": upper, "fails": fails})
    return got.select("page", "engine", "status", "text", "error")


def mediated_texts(spark, sf):
    """The model's answer is the prompt it was asked, so the answer shows which reads were put together."""
    from folioforge.operators import models

    got = models.mediate(made_reads(spark, sf).withColumn("image", F.lit(None).cast("binary")), lambda: lambda prompt, image: prompt.upper(), "Merge:", ["page", "region"])
    return got.select("page", "region", F.md5("text").alias("text"), "error")


def serving(spark, sf):
    from folioforge.operators import models

    s = table(spark, sf, "supplier").select("s_suppkey", F.when(key() % 3 == 0, "ok").when(key() % 3 == 1, "loading").alias("status"))
    return models.serving_models(s).select("s_suppkey")


def region_values(spark, sf):
    """Region values of three shapes: JSON text, an object with text and confidence, and null."""
    k = key() % 4
    v = F.when(k == 0, F.to_json(F.struct(F.col("s_name").alias("text"), ((key() % 10) / 10).alias("confidence")))).when(k == 1, F.concat(F.lit('"a \\"'), F.col("s_name"), F.lit('\\""'))).when(k == 2, "null")
    got = X.region_value(v)
    return table(spark, sf, "supplier").select("s_suppkey", got["text"].alias("text"), micro(got["confidence"]).alias("confidence"))


def fitted_sides(spark, sf):
    got = images.fit_side(F.col("p_partkey").cast("double") * 7 % 4000 + 1, F.col("p_partkey").cast("double") * 13 % 3000 + 1)
    return table(spark, sf, "part").select("p_partkey", got["height"].cast("long").alias("height"), got["width"].cast("long").alias("width"))


QUERIES = {
    f.__name__: f
    for f in (
        registry_volumes, volume_routes, page_files, text_layers, rendered_pages, image_files, csv_round_trip, discovered_reads, chosen_region, engine_texts, eval_read_files, reference_files,
        gold_rows, page_id_list, region_crops, voter_texts, prompt_texts, written_records, upserted_versions, failure_log, read_coverage, read_manifest_rows, fused_page_reads, layout_texts,
        page_markdown, page_documents, engine_runs, mediated_texts, serving, region_values, fitted_sides,
    )
}

MADE_READS = """
made AS (SELECT 'p' || (c_custkey // 6) AS page, CASE WHEN c_custkey % 2 = 0 THEN 'colL' ELSE 'header' END AS region, ['a', 'b', 'c'][CAST(c_custkey // 2 % 3 AS INT) + 1] AS engine,
  CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name || chr(10) || c_mktsegment END AS text FROM customer)
"""
NESTED = """
nested AS (SELECT 'SSA_' || s_suppkey AS page, CASE WHEN s_suppkey % 2 = 0 THEN 'colL' ELSE '' END AS region, ['surya', 'paddle', NULL][CAST(s_suppkey % 3 AS INT) + 1] AS engine, 'é nested ' || s_name AS text FROM supplier),
flat AS (SELECT 'SSA_' || s_suppkey AS page, '' AS region, CASE WHEN s_suppkey % 4 = 0 THEN 'surya' ELSE 'paddle' END AS engine, 'flat ' || s_name AS text FROM supplier WHERE s_suppkey % 4 < 2)
"""
CROPS = """
crops AS (SELECT 'SSA_' || (s_suppkey // 3) AS page, ['colL', 'colR', 'header', 'other'][CAST(s_suppkey % 4 AS INT) + 1] AS region FROM supplier)
"""
PAGE_RECORDS = """
pages AS (SELECT CAST(c_custkey AS VARCHAR) AS ssa_id, c_custkey AS k, c_mktsegment || ' ' || (c_custkey % 3000) AS header, c_name AS l, c_mktsegment AS r,
  CASE WHEN c_custkey % 2 <> 0 THEN (c_custkey % 100) / 100.0::DOUBLE END AS hc, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 100) / 100.0::DOUBLE END AS lc, CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 100) / 100.0::DOUBLE END AS rc,
  CASE WHEN CAST(c_custkey % 3000 AS VARCHAR) IN ('1934', '1935', '1936') THEN '' ELSE CAST(c_custkey % 3000 AS VARCHAR) END AS number FROM customer)
"""
SQL = {
    "registry_volumes": """SELECT 'v_' || s_suppkey || '_' || (1900 + s_suppkey % 37) AS volume_id, 1900 + s_suppkey % 37 AS year, CASE WHEN s_suppkey % 3 = 0 THEN 'ocr_pdf' ELSE 'image_scans' END AS kind,
        s_name AS source_pdf, CAST(NULL AS VARCHAR) AS image_dir, s_suppkey % 500 AS n_pages, 'ok' AS status FROM supplier""",
    "volume_routes": "SELECT 'v_' || s_suppkey || '_' || (1900 + s_suppkey % 37) AS volume_id, CASE WHEN s_suppkey % 3 = 0 THEN 'text_layer' ELSE 'images' END AS route FROM supplier",
    "page_files": """SELECT CAST(l_orderkey // 20 AS INT) AS page, 'v' || (l_orderkey // 20 % 5) AS volume, count(*) AS n, CAST(sum(CAST(trunc(l_quantity + 6) AS BIGINT)) AS BIGINT) AS bottoms,
        max(CAST(l_partkey AS VARCHAR)) AS last, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem GROUP BY 1, 2""",
    "text_layers": """SELECT 'file_' || s_suppkey AS file, k AS page, 1 AS n_words, 'w' || s_suppkey AS word, 10 AS x0, 1 AS n_spans, 90 AS size FROM supplier, range(3) r(k) WHERE k <= s_suppkey % 3""",
    "rendered_pages": "SELECT 'file_' || s_suppkey AS file, k AS page, md5(s_suppkey || ':' || k || ':2.0000') AS image FROM supplier, range(2) r(k) WHERE k <= s_suppkey % 2",
    "image_files": "SELECT 'page.' || s_suppkey AS page, md5(s_name) AS content FROM supplier WHERE s_suppkey % 4 <> 0",
    "csv_round_trip": """SELECT c_custkey, md5('say "' || c_name || '",' || chr(10) || c_mktsegment) AS note, '[' || c_nationkey || ',1]' AS pair, '' AS nothing FROM customer""",
    "discovered_reads": f"WITH {NESTED} SELECT * FROM nested WHERE engine IS NOT NULL UNION ALL SELECT * FROM flat f WHERE NOT EXISTS (FROM nested n WHERE n.page = f.page AND n.region = f.region AND n.engine = f.engine)",
    "chosen_region": f"WITH {NESTED} SELECT ['surya_text', 'PaddleOCR', 'quality'][CAST(4 % 3 AS INT) + 1] AS engine, text FROM nested WHERE page = 'SSA_4' AND region = 'colL'",
    "engine_texts": "SELECT s_suppkey AS page, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE '' END AS text FROM supplier",
    "eval_read_files": "SELECT 'dots' AS engine, 'p' || s_suppkey AS page_id, CASE WHEN s_suppkey % 3 = 0 THEN 'own ' ELSE 'vlm ' END || s_name AS text FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0",
    "reference_files": "SELECT CAST(1900 + s_suppkey % 2 AS VARCHAR) AS year, 'p' || s_suppkey AS page_id, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE '' END AS reference FROM supplier",
    "gold_rows": """WITH g AS (SELECT CAST(p_partkey AS VARCHAR) AS page_id, repeat(p_name, p_partkey % 100) AS r FROM part WHERE p_partkey % 3 = 0)
        SELECT page_id, length(substring(r, 1, 1200)) AS n, md5(substring(r, 1, 1200)) AS reference FROM g WHERE length(r) >= 80""",
    "page_id_list": f"WITH {CROPS} SELECT DISTINCT page FROM crops",
    "region_crops": f"WITH {CROPS} SELECT page, region, list_position(['colL', 'colR', 'header'], region) AS region_ord FROM crops WHERE region <> 'other'",
    "voter_texts": "SELECT 'p' || s_suppkey AS page_id, CASE WHEN s_suppkey % 2 = 0 THEN s_name WHEN s_suppkey % 5 > 0 THEN ' ' || s_name || ' ' ELSE '' END AS text FROM supplier",
    "prompt_texts": "SELECT 'prompt_' || n_nationkey AS stem, 'Läs ' || n_name AS text FROM nation",
    "written_records": """SELECT 'v' || (c_nationkey % 3) AS volume, count(*) AS n, CAST(sum(CASE WHEN c_custkey % 5 > 0 THEN c_custkey END) AS BIGINT) AS income, count(*) AS n_csv,
        count(*) FILTER (WHERE c_custkey % 5 > 0) AS n_income, count(*) AS records FROM customer GROUP BY 1""",
    "upserted_versions": """WITH s AS (SELECT * FROM (VALUES (0, 0), (1, 1000000), (2, 500000)) v(rest, mark)),
        r AS (SELECT rest, o_orderkey % 500 AS k, max(o_orderkey + mark) AS v FROM orders, s WHERE o_orderkey % 3 <> rest AND o_orderkey % 500 % 7 <> rest GROUP BY 1, 2)
        SELECT k, arg_max(v, rest) AS v FROM r GROUP BY k""",
    "failure_log": """WITH f AS (SELECT 'p' || (s_suppkey // 2) AS page, 'crop' AS stage, CASE WHEN s_suppkey % 5 = 0 THEN 'exception' WHEN s_suppkey % 10 / 10.0 >= 0.55 THEN 'gutter_poor' WHEN s_suppkey % 3 = 0 THEN 'no_header' END AS reason,
        CASE WHEN s_suppkey % 5 = 0 THEN 'IOError: ' || (s_suppkey % 2) ELSE '' END AS detail FROM supplier) SELECT DISTINCT * FROM f WHERE reason IS NOT NULL""",
    "read_coverage": f"""WITH {MADE_READS}, c AS (SELECT page, region, count(*) FILTER (WHERE regexp_matches(text, '\\S')) >= 2 AS several FROM made GROUP BY 1, 2)
        SELECT engine, count(*) AS reads, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) FILTER (WHERE several) AS corroborated FROM made JOIN c USING (page, region) GROUP BY 1""",
    "read_manifest_rows": f"""WITH {MADE_READS} SELECT page, region, engine || '/' || page AS text_path, length(text) AS n_chars, length(text) - length(replace(text, chr(10), ''))
        + CASE WHEN text <> '' AND right(text, 1) <> chr(10) THEN 1 ELSE 0 END AS n_lines FROM made""",
    "fused_page_reads": f"""WITH {MADE_READS}, seen AS (SELECT * FROM made WHERE regexp_matches(text, '\\S')),
        each_ AS (SELECT page, region, max(text) FILTER (WHERE engine = 'a') AS a, max(text) FILTER (WHERE engine = 'b') AS b, max(text) FILTER (WHERE engine = 'c') AS c FROM seen GROUP BY 1, 2),
        v AS (SELECT page, region, coalesce(a, c, b, '') AS t, CASE WHEN a IS NOT NULL THEN 500000 END AS conf FROM each_)
        SELECT page, coalesce(max(t) FILTER (WHERE region = 'header'), '') AS header_text, coalesce(max(t) FILTER (WHERE region = 'colL'), '') AS "colL_text", '' AS "colR_text",
        CAST(max(conf) FILTER (WHERE region = 'header') AS BIGINT) AS header_conf, CAST(max(conf) FILTER (WHERE region = 'colL') AS BIGINT) AS "colL_conf", CAST(NULL AS BIGINT) AS "colR_conf" FROM v GROUP BY page""",
    "layout_texts": """WITH l AS (SELECT l_orderkey AS page, CASE WHEN l_linenumber > 2 THEN l_linenumber % 3 END AS p, 'r' || (l_linenumber % 3) AS label, l_linenumber * 1000 + l_partkey % 1000 AS n, CAST(l_partkey AS VARCHAR) AS t FROM lineitem),
        b AS (SELECT page, coalesce(p, 9999) AS o, CASE WHEN p IS NULL THEN '===== [no region] =====' ELSE '===== [region ' || p || '] ' || label || ' =====' END AS head, string_agg(t, chr(10) ORDER BY n, t) AS body FROM l GROUP BY 1, 2, 3)
        SELECT page, md5(string_agg(head || chr(10) || body, chr(10) || chr(10) ORDER BY o, head || chr(10) || body)) AS text FROM b GROUP BY page""",
    "page_markdown": f"""WITH {PAGE_RECORDS} SELECT ssa_id, md5('## ' || ssa_id || CASE WHEN number <> '' THEN chr(10) || chr(10) || 'Page ' || number ELSE '' END
        || chr(10) || chr(10) || '### header' || coalesce(printf(' (confidence %.4f)', hc), '') || chr(10) || header || chr(10) || chr(10) || '### left column' || coalesce(printf(' (confidence %.4f)', lc), '') || chr(10) || l
        || chr(10) || chr(10) || '### right column' || coalesce(printf(' (confidence %.4f)', rc), '') || chr(10) || r) AS markdown FROM pages""",
    "page_documents": f"""WITH {PAGE_RECORDS} SELECT ssa_id, length(l) + length(r) AS n_chars, number AS page_number, CASE WHEN number = '' THEN 'none' ELSE 'recovered_from_header' END AS source, header,
        CAST(round(hc * 1000000) AS BIGINT) AS header_conf, count(*) OVER () AS in_master FROM pages""",
    "engine_runs": """SELECT CAST(s_suppkey AS VARCHAR) AS page, 'upper' AS engine, 'OK' AS status, upper(s_name) AS text, CAST(NULL AS VARCHAR) AS error FROM supplier UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), 'fails', CASE WHEN s_name LIKE '%7' THEN 'ERROR' ELSE 'OK' END, CASE WHEN s_name NOT LIKE '%7' THEN CAST(length(s_name) AS VARCHAR) END,
        CASE WHEN s_name LIKE '%7' THEN 'ValueError: cannot read' END FROM supplier""",
    "mediated_texts": f"""WITH {MADE_READS} SELECT page, region, md5(upper('Merge:' || chr(10) || chr(10) || string_agg('[' || engine || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY engine, text))) AS text,
        CAST(NULL AS VARCHAR) AS error FROM made WHERE regexp_matches(text, '\\S') GROUP BY 1, 2 HAVING count(*) >= 2""",
    "serving": "SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0",
    "region_values": """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN 'a "' || s_name || '"' ELSE '' END AS text,
        CASE WHEN s_suppkey % 4 = 0 THEN CAST(round(s_suppkey % 10 / 10.0 * 1000000) AS BIGINT) END AS confidence FROM supplier""",
    "fitted_sides": """WITH s AS (SELECT p_partkey, CAST(p_partkey * 7 % 4000 + 1 AS DOUBLE) AS h, CAST(p_partkey * 13 % 3000 + 1 AS DOUBLE) AS w FROM part), f AS (SELECT *, least(1.0::DOUBLE, 1600.0::DOUBLE / greatest(h, w)) AS scale FROM s)
        SELECT p_partkey, CAST(floor(h * scale) AS BIGINT) AS height, CAST(floor(w * scale) AS BIGINT) AS width FROM f""",
}
