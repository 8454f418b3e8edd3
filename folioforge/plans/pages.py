"""Queries over directory pages, line groups and reports: the page statistics, the older dialect, sequential folds as recursive SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import patterns as P
from folioforge.functions import text as X
from folioforge.operators import analytics, consensus, evaluation, geometry, images, records, sampling
from folioforge.plans import files
from folioforge.plans.documents import COUNTED, ENTROPY, HYP, hyp_ref, micro, reads, reads_sql, table
from folioforge.plans.tables import BUMPS, DIRECTORY, PARSED, bump_lines, directory
from folioforge.sources import readers, sinks

D = P.DASHES
SIZES = "CASE WHEN c_custkey % (10 + c_custkey // 100 % 5 * 10) = 0 THEN 18.0 ELSE 10.0 END"


def directory_lines(spark, sf):
    """A hundred directory lines to a page; on each page some are set in a large font."""
    d = directory(spark, sf).drop("volume", "page")
    k, page = F.col("line_no"), F.expr("line_no div 100")
    big = F.when(k % (page % 5 * 10 + 10) == 0, 18.0).otherwise(10.0)
    lines = d.withColumns({"page": page, "volume": F.concat(F.lit("v"), page % 3), "max_size": big, "body_size": F.lit(10.0)})
    return lines.withColumn("tag", geometry.tag_line(F.col("text"), F.col("max_size"), F.col("body_size")))


def page_statistics(spark, sf):
    lines = directory_lines(spark, sf)
    gutter = lines.select("volume", "page").distinct().withColumns({"split_x": F.lit(0.0), "gutter_conf": (F.col("page") % 4 + 7) / 10, "n_words": F.col("page") * 2})
    return geometry.page_stats(gutter, lines)


def directory_pages(spark, sf):
    got = page_statistics(spark, sf)
    counts = ("n_words", "n_lines", "n_entry", "n_ad", "income_clean", "income_dirty", "is_body")
    return got.select("volume", "page", *[F.col(c).cast("long").alias(c) for c in counts], micro(F.col("entry_ratio")).alias("entry_ratio"), F.array_join("surnames", ";").alias("surnames"))


def volume_summary(spark, sf):
    got = geometry.volume_summary(page_statistics(spark, sf))
    rates = ("mean_gutter_conf", "gutter_ok_rate", "entries_per_page", "ad_rate", "clean_rate", "monotonicity")
    return got.select("volume", *[F.col(c).cast("long").alias(c) for c in ("pages", "body_pages", "entries")], *[micro(F.round(c, 9)).alias(c) for c in rates])


def trainable_pages(spark, sf):
    """An even stride of seven over the pages that are good enough to learn from."""
    s = page_statistics(spark, sf)
    good = geometry.is_trainable(F.col("is_body") == 1, F.col("gutter_conf"), F.col("n_entry"), F.col("n_ad"), F.col("entry_ratio"))
    return sampling.even_stride(s.where(good).select("page", "n_entry"), ["page"], 7).select("page", F.col("n_entry").cast("long").alias("n_entry"))


def body_lines(spark, sf):
    """Entries and dittos of body pages: of the pages, those that half of the lines were taken from are no body."""
    lines = directory_lines(spark, sf).where("page % 4 < 3 OR line_no % 2 = 0").withColumn("tag", F.when(F.col("page") % 4 == 3, F.lit("other")).otherwise(F.col("tag")))
    gutter = lines.select("volume", "page").distinct().withColumns({"split_x": F.lit(0.0), "gutter_conf": F.lit(1.0), "n_words": F.lit(0)})
    return geometry.body_lines(lines, geometry.page_stats(gutter, lines)).select("line_no", "tag")


def training_cer(spark, sf):
    got = hyp_ref(spark, sf)
    return got.select("doc_id", "line_no", micro(evaluation.training_cer(F.col("ref"), F.col("hyp"))).alias("cer"))


def directory_records_1912(spark, sf):
    got = records.parse_records(directory(spark, sf), "1912")
    flags = ["is_continuation_surname", "is_same_person_2nd_loc", "is_wife", "is_company"]
    return got.select("line_no", "surname", "given_names", "title", "location", "municipal_income", "state_income", *[F.col(f).cast("long").alias(f) for f in flags])


def bump_merge_1912(spark, sf):
    cols = bump_lines(spark, sf).groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]).alias("l"))
    return cols.select("page", F.posexplode(records.merge_bumps_1912(F.col("l"))).alias("line", "text")).select("page", F.col("line").cast("long").alias("line"), "text")


def words_of_lineitem(spark, sf):
    """Order lines as words of a page: quantity is the top, the line number the left."""
    li = table(spark, sf, "lineitem")
    top, left = F.col("l_quantity").cast("double") * 3, F.col("l_linenumber").cast("double") * 10 + F.col("l_partkey") % 10
    return li.select(F.expr("l_orderkey div 20").alias("page"), left.alias("x0"), top.alias("y0"), (left + 8).alias("x1"), (top + 6 + F.col("l_suppkey") % 5).alias("y1"), F.col("l_partkey").cast("string").alias("t"))


def line_clusters(spark, sf):
    got = geometry.cluster_lines(words_of_lineitem(spark, sf), ["page"])
    return got.select("page", F.col("line_no").cast("long").alias("line_no"), "text")


def top_texts(spark, sf):
    """Text in the top band of each page."""
    li, k = table(spark, sf, "lineitem"), F.col("l_orderkey")
    spans = li.select(F.expr("l_orderkey div 10").alias("page"), (k * 10.0 + F.col("l_linenumber")).alias("x0"), (F.col("l_partkey") % 100).cast("double").alias("y0"), F.col("l_partkey").cast("string").alias("t"))
    heights = spans.select("page").distinct().withColumn("height", (F.col("page") % 3 * 50 + 100).cast("double"))
    return geometry.top_text(spans, heights, ["page"]).select("page", F.md5("top_text").alias("top_text"))


def compared_forms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.compare_form(F.col("text"))).alias("form"))


def line_groups(spark, sf):
    """Lines of one place as a group of reads: representative, engines, similarity and agreement of the compared forms."""
    members = reads(spark, sf).withColumnRenamed("region", "slot")
    got = consensus.line_groups(members, ["page"])
    return got.select("page", "slot", "n_engines_on_line", "representative", "engines", micro(F.col("mean_sim")).alias("mean_sim"), micro(F.round("agreement", 9)).alias("agreement"), "band")


def consensus_pick(spark, sf):
    return consensus.pick_read(reads(spark, sf)).select("page", "region", "engine")


def made_groups(spark, sf):
    li, k = table(spark, sf, "lineitem"), F.col("l_partkey")
    sim = (k % 101) / 100
    return li.groupBy(F.expr("l_orderkey div 4").alias("page"), (F.col("l_orderkey") % 2).cast("string").alias("region"), F.col("l_linenumber").alias("slot")).agg(F.max("l_partkey").alias("l_partkey")).select(
        "page", "region", "slot", (k % 5 + 1).alias("n_engines_on_line"), sim.alias("mean_sim"), consensus.band(sim).alias("band"), F.concat(F.lit("line "), k).alias("representative"), F.lit("a|b").alias("engines"),
    )


def made_regions(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    return o.select(
        k.alias("page"), F.lit("colL").alias("region"), (k % 4 + 2).alias("n_engines"), (k * 7 % 1000 / 1000).alias("region_mean_sim"), (k * 3 % 500 / 500).alias("mean_line_agreement"),
        (k % 11).alias("n_high_conf_lines"), (k % 13).alias("n_low_conf_lines"),
    )


def report_totals(spark, sf):
    got = consensus.report_totals(made_regions(spark, sf), made_groups(spark, sf))
    return got.select("regions", "reads", *[micro(F.round(c, 9)).alias(c) for c in ("mean_sim", "mean_line_agreement")], "high_lines", "low_lines", "singletons", "disagreements")


def worst_regions(spark, sf):
    return consensus.worst_regions(made_regions(spark, sf)).select("page", "region", micro(F.col("region_mean_sim")).alias("region_mean_sim"))


def disagreements(spark, sf):
    """Sample lines of a report: five a region, twenty-five in all."""
    return consensus.samples(made_groups(spark, sf)).select("page", "region", "slot", "representative")


def agreements(spark, sf):
    return consensus.samples(made_groups(spark, sf), high=True).select("page", "region", "slot", "representative")


def correction_verdict(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    got = evaluation.correction_verdict(o.select(F.when(k % 2 == 0, "before").otherwise("after").alias("tag"), (k * 13 % 100 / 1000).alias("cer")))
    return got.select(*[micro(F.round(c, 9)).alias(c) for c in ("before", "after", "change")], "helps")


def median_ratios(spark, sf):
    c = table(spark, sf, "customer").withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    return analytics.median_ratios(c, "cents").select("c_custkey", micro(F.col("ratio")).alias("ratio"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _smoothed(rows: pd.Series) -> pd.Series:
    return rows.map(lambda x: images.smooth(x.astype(float), 5)[: len(x)].tolist())


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))
def _bands(rows: pd.Series) -> pd.Series:
    return rows.map(lambda x: [{"first": a, "last": b} for a, b in images.text_bands(x, 2)])


def moving_average(spark, sf):
    """Ink profiles of pages made from orders, smoothed over five rows; beyond the ends there is no ink."""
    li = table(spark, sf, "lineitem").groupBy(F.expr("l_orderkey div 20").alias("page")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_quantity"))).alias("w"))
    got = li.select("page", F.posexplode(_smoothed(F.transform("w", lambda x: x["l_quantity"].cast("double")))).alias("row", "ink"))
    return got.select("page", F.col("row").cast("long").alias("row"), micro(F.col("ink")).alias("ink"))


def text_bands(spark, sf):
    """Bands of text rows of a page, gaps of two rows allowed: rows are customers, text is a positive balance."""
    c = table(spark, sf, "customer").groupBy(F.expr("c_custkey div 50").alias("page")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", (F.col("c_acctbal") > 5000).alias("text")))).alias("r"))
    return c.select("page", F.explode(_bands(F.transform("r", lambda x: x["text"]))).alias("b")).select("page", "b.first", "b.last")


def silver_pairs(spark, sf):
    """Column texts that are long enough, with the crop of their page and the manifest's constants."""
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    columns = p.select(F.concat(F.lit("p"), k).alias("page"), F.lit("colL").alias("region"), F.repeat("p_name", k.cast("int") % 9).alias("text"))
    crops = p.where("p_partkey % 4 > 0").select(F.concat(F.lit("p"), k).alias("page"), F.lit("colL").alias("region"), F.concat(F.lit("image of "), k).cast("binary").alias("content"))
    path = files.scratch(spark)
    sinks.write_pairs(sampling.silver_pairs(columns, crops), path)
    made = readers.csv_table(spark, f"{path}/manifest", readers.GOLD_MANIFEST)
    there = readers.images(spark, f"{path}/crops").select(F.concat(F.lit("crops/"), "page", F.lit(".jpg")).alias("image_path"), F.md5("content").alias("image"))
    return made.join(there, "image_path").select("page_id", "image_path", F.md5("reference").alias("reference"), "status", "language", "image")


def board_lines(spark, sf):
    """The leaderboard as markdown, a row for each line."""
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    names = ("score", "cer", "comma_f1", "comma_recall", "dash_recall", "digit_recall", "field_count_ratio")
    board = s.select(k.alias("rank"), F.col("s_name").alias("engine"), (k * 3).alias("n"), *[F.when(k % 50 != i, (k * (i + 3) % 1000) / 1000).alias(m) for i, m in enumerate(names)])
    return spark.createDataFrame(list(enumerate(sinks.leaderboard_markdown(board).split("\n"))), "line long, text string")


def report_lines(spark, sf):
    """The report of agreement as markdown, a row for each line that is not blank."""
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    central = s.select(k.alias("rank"), F.col("s_name").alias("engine"), (k % 97 / 100).alias("mean_cer"))
    groups = made_groups(spark, sf)
    text = sinks.agreement_report(
        consensus.report_totals(made_regions(spark, sf), groups).select("regions", "reads", "high_lines"), central.orderBy("rank"),
        consensus.worst_regions(made_regions(spark, sf)), consensus.samples(groups), consensus.samples(groups, high=True),
    )
    return spark.createDataFrame([(t,) for t in text.split("\n") if t], "text string").groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def agreement_files(spark, sf):
    """Scores, lines and the matrix of engines as CSV, counted after reading."""
    path, groups = files.scratch(spark), made_groups(spark, sf)
    regions = made_regions(spark, sf).withColumns({"engines": F.lit("a|b"), "region_agreement": F.lit(1.0), "cluster_consensus_frac": F.lit(1.0), "n_lines": F.lit(1)})
    cer = table(spark, sf, "nation").select(F.concat(F.lit("e"), F.expr("n_nationkey div 5")).alias("a"), F.concat(F.lit("e"), F.col("n_nationkey") % 5).alias("b"), (F.col("n_nationkey") / 100).alias("mean_cer"), F.col("n_nationkey").alias("n_shared"))
    sinks.write_agreement(regions, groups, cer, path)
    csv = lambda name: spark.read.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    lines = csv("agreement_lines").agg(F.count(F.lit(1)).alias("lines"), F.sum((F.col("agreement_mean_sim").cast("double") * 10000).cast("long")).alias("sims"), F.count_if(F.col("band") == "HIGH").alias("high"))
    scores = csv("agreement_scores").agg(F.count(F.lit(1)).alias("regions"), F.sum(F.col("n_low_conf").cast("long")).alias("low"))
    matrix = csv("pairwise_cer").agg(F.count(F.lit(1)).alias("engines"), micro(F.sum(F.col("e2").cast("double"))).alias("e2"))
    counts = csv("pairwise_counts").agg(F.sum(F.col("e3").cast("long")).alias("e3"))
    return lines.crossJoin(scores).crossJoin(matrix).crossJoin(counts)  # one row each


def flagged_file(spark, sf):
    """Lines for review as CSV: those of low agreement, in order, their text cut to 200 as the rule is."""
    li, k = table(spark, sf, "lineitem"), F.col("l_partkey")
    lines = li.select(F.col("l_orderkey").alias("page"), F.lit("colL").alias("region"), F.col("l_linenumber").alias("line_idx"), F.when(k % 7 > 0, k % 100 / 100).alias("agreement"), (k % 3).alias("n_corrob"), F.repeat(F.concat(k.cast("string"), F.lit(",\"")), 40).alias("text"))
    path = files.scratch(spark)
    sinks.write_flagged(consensus.flagged(lines), path)
    schema = readers._schema(page=readers._S, region=readers._S, line_idx=readers._S, agreement=readers._D, n_votes=readers._S, text=readers._S)
    got = readers.csv_table(spark, path, schema)
    return got.select(F.col("page").cast("long").alias("page"), F.col("line_idx").cast("long").alias("line_idx"), micro(F.col("agreement")).alias("agreement"), F.col("n_votes").cast("long").alias("n_votes"), F.md5("text").alias("text"))


QUERIES = {
    f.__name__: f
    for f in (
        directory_pages, volume_summary, trainable_pages, body_lines, training_cer, directory_records_1912, bump_merge_1912, line_clusters, top_texts, compared_forms, line_groups, consensus_pick, report_totals, worst_regions,
        disagreements, agreements, correction_verdict, median_ratios, moving_average, text_bands, silver_pairs, board_lines, report_lines, agreement_files, flagged_file,
    )
}

TAGGED = f"""
d AS ({DIRECTORY}),
t AS (SELECT line_no // 100 AS page, 'v' || (line_no // 100 % 3) AS volume, region, line_no, text, {SIZES.replace('c_custkey', 'line_no')} > 16.0 AS big FROM d),
tagged AS (SELECT *, CASE WHEN regexp_matches(text, '^\\\\s*[{D}]') AND (contains(text, ',') OR regexp_matches(text, '[0-9]{{{{3,}}}}')) THEN 'ditto'
    WHEN contains(text, ',') AND regexp_matches(text, '[0-9][0-9 ]*\\\\s*[{D}]\\\\s*[0-9]|\\\\b[0-9]{{{{3,}}}}\\\\b') AND regexp_matches(text, '[A-Za-zÅÄÖåäö]') AND NOT big THEN 'entry'
    WHEN big OR regexp_matches(text, '{P.AD_TOKENS.replace("{", "{{").replace("}", "}}")}') OR (length(text) <= 3 AND NOT regexp_matches(text, '[0-9]{{{{3,}}}}')) THEN 'ad' ELSE 'other' END AS tag FROM t),
named AS (SELECT *, CASE WHEN tag = 'entry' THEN nullif(regexp_extract(text, '^\\\\s*([A-ZÅÄÖ][A-Za-zÅÄÖåäö:\\\\-]+)\\\\s*,', 1), '') END AS surname FROM tagged),
stats AS (SELECT volume, page, page * 2 AS n_words, (page % 4 + 7) / 10.0::DOUBLE AS gutter_conf, count(*) AS n_lines, count(*) FILTER (WHERE tag IN ('entry', 'ditto')) AS n_entry, count(*) FILTER (WHERE tag = 'ad') AS n_ad,
    count(*) FILTER (WHERE tag = 'entry' AND regexp_matches(text, '[0-9][0-9 ]*[–—]\\\\s*[0-9]')) AS income_clean,
    count(*) FILTER (WHERE tag = 'entry' AND NOT regexp_matches(text, '[0-9][0-9 ]*[–—]\\\\s*[0-9]') AND regexp_matches(text, '[0-9]{{{{3,}}}}[ \\\\-]+[0-9]{{{{3,}}}}')) AS income_dirty,
    coalesce(string_agg(surname, ';' ORDER BY region, line_no), '') AS surnames FROM named GROUP BY 1, 2),
s AS (SELECT *, round(n_entry::DOUBLE / n_lines, 3) AS entry_ratio, CAST(n_entry >= 20 AND n_entry >= n_lines * 0.45 AS BIGINT) AS is_body FROM stats)
""".replace("{{", "{").replace("}}", "}").replace("{{", "{").replace("}}", "}").replace("\\\\", "\\")

PARSED_1912 = PARSED + f"""
n AS (SELECT *, length(regexp_replace(coalesce(last_, ''), '[^0-9]', '', 'g')) >= 2 AS ok, regexp_extract_all(last_, '[0-9][0-9 ]*[0-9]|[0-9]') AS g, regexp_matches(last_, '[{D}]') AS dashed,
       length(regexp_extract(last_, '^([^{D}]*)[{D}]', 1)) AS at_dash FROM c),
o AS (SELECT *, len(g) = 1 AND dashed AND strpos(last_, g[1]) - 1 >= at_dash AS only_state, TRY_CAST(regexp_replace(g[1], '[^0-9]', '', 'g') AS BIGINT) AS g1, TRY_CAST(regexp_replace(g[2], '[^0-9]', '', 'g') AS BIGINT) AS g2 FROM n),
p AS (SELECT *, CASE WHEN ok AND NOT only_state THEN g1 END AS municipal_income, CASE WHEN ok THEN CASE WHEN len(g) >= 2 THEN g2 WHEN only_state THEN g1 END END AS state_income, CASE WHEN ok THEN f[1:-2] ELSE f END AS x FROM o),
q AS (SELECT *, n_dash >= 1 OR (len(x) > 0 AND regexp_matches(coalesce(x[1], ''), '{P.TITLE_FIRST}')) AS ditto, n_dash >= 2 AS same FROM p),
h AS (SELECT *, coalesce(last_value(CASE WHEN NOT ditto THEN coalesce(x[1], '') END IGNORE NULLS) OVER w, '') AS surname, CASE WHEN ditto THEN x ELSE x[2:] END AS r2 FROM q
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
j AS (SELECT *, coalesce(last_value(CASE WHEN NOT same THEN coalesce(r2[1], '') END IGNORE NULLS) OVER w, '') AS given_names, CASE WHEN same THEN r2 ELSE r2[2:] END AS loc, regexp_matches(body, '{P.WIFE}') AS wife FROM h
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, regexp_replace(coalesce(loc[-1], ''), '\\.+$', '') AS place, array_to_string(list_filter(loc[1:-2], lambda y: y <> ''), ', ') AS title FROM j),
l AS (SELECT *, last_value(CASE WHEN NOT wife AND place <> '' THEN place END IGNORE NULLS) OVER w AS settled FROM k
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""
GROUPS = """
made AS (SELECT l_orderkey // 4 AS page, CAST(l_orderkey % 2 AS VARCHAR) AS region, l_linenumber AS slot, max(l_partkey) AS k FROM lineitem GROUP BY 1, 2, 3),
groups AS (SELECT page, region, slot, k % 5 + 1 AS n, k % 101 / 100.0::DOUBLE AS sim, 'line ' || k AS representative FROM made),
regions AS (SELECT o_orderkey AS page, 'colL' AS region, o_orderkey % 4 + 2 AS n_engines, o_orderkey * 7 % 1000 / 1000.0::DOUBLE AS sim, o_orderkey * 3 % 500 / 500.0::DOUBLE AS line_sim, o_orderkey % 11 AS high, o_orderkey % 13 AS low FROM orders),
worst AS (SELECT * FROM regions ORDER BY sim, page LIMIT 15),
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page, region ORDER BY slot) AS r FROM groups WHERE sim < 0.6 AND n >= 2) WHERE r <= 5 ORDER BY page, region, slot LIMIT 25),
high AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page, region ORDER BY slot) AS r FROM groups WHERE sim >= 0.85 AND n >= 4) WHERE r <= 8 ORDER BY page, region, slot LIMIT 12)
"""
FORM = "replace(lower(trim(regexp_replace(regexp_replace(regexp_replace({t}, '</?math>', '', 'g'), '[" + P.COMPARE_DASHES + "]', '-', 'g'), '\\s+', ' ', 'g'))), 'ß', 'ss')"
_NAMES = ("score", "cer", "comma_f1", "comma_recall", "dash_recall", "digit_recall", "field_count_ratio")
_CELL = "coalesce(printf('%.4f', {}), 'n/a')"
_BOARD = " || ' | ' || ".join(_CELL.format(f"CASE WHEN s_suppkey % 50 <> {i} THEN s_suppkey * {i + 3} % 1000 / 1000.0::DOUBLE END") for i in range(7))

SQL = {
    "directory_pages": f"WITH {TAGGED} SELECT volume, page, n_words, n_lines, n_entry, n_ad, income_clean, income_dirty, is_body, CAST(round(entry_ratio * 1000000) AS BIGINT) AS entry_ratio, surnames FROM s",
    "volume_summary": f"""WITH {TAGGED}, body AS (FROM s WHERE is_body = 1),
        b AS (SELECT volume, count(*) AS body_pages, sum(n_entry) AS entries, avg(gutter_conf) AS g, avg(CAST(gutter_conf >= 0.5 AS INT)) AS ok, sum(n_ad)::DOUBLE / greatest(sum(n_lines), 1) AS ads,
              coalesce(sum(income_clean)::DOUBLE / nullif(sum(income_clean) + sum(income_dirty), 0), 0) AS clean FROM body GROUP BY 1),
        names AS (SELECT n.volume, replace(lower(surname), 'ß', 'ss') AS x, lag(replace(lower(surname), 'ß', 'ss')) OVER (PARTITION BY n.volume ORDER BY n.page, region, line_no) AS y FROM named n JOIN body ON n.volume = body.volume AND n.page = body.page WHERE surname IS NOT NULL),
        m AS (SELECT volume, count(*) FILTER (WHERE y <= x)::DOUBLE / greatest(count(*) - 1, 1) AS mono FROM names GROUP BY 1 HAVING count(*) >= 2),
        a AS (SELECT volume, count(*) AS pages FROM s GROUP BY 1)
        SELECT a.volume, pages, coalesce(body_pages, 0) AS body_pages, CAST(coalesce(entries, 0) AS BIGINT) AS entries, """
    + ", ".join(
        f"CAST(round(round(coalesce({e}, 0), 9) * 1000000) AS BIGINT) AS {n}"
        for e, n in (("g", "mean_gutter_conf"), ("ok", "gutter_ok_rate"), ("entries::DOUBLE / body_pages", "entries_per_page"), ("ads", "ad_rate"), ("clean", "clean_rate"), ("mono", "monotonicity"))
    )
    + " FROM a LEFT JOIN b ON a.volume = b.volume LEFT JOIN m ON a.volume = m.volume",
    "trainable_pages": f"""WITH {TAGGED}, good AS (SELECT page, n_entry, row_number() OVER (ORDER BY page) - 1 AS i, count(*) OVER () AS n FROM s WHERE is_body = 1 AND gutter_conf >= 0.7 AND n_entry >= 45 AND n_ad <= 4 AND entry_ratio >= 0.6)
        SELECT page, n_entry FROM good WHERE n <= 7 OR i IN (SELECT CAST(floor(k * (SELECT count(*) FROM good) / 7.0) AS BIGINT) FROM range(7) r(k))""",
    "body_lines": f"WITH {TAGGED}, body AS (SELECT page FROM s WHERE is_body = 1 AND page % 4 < 3) SELECT line_no, tag FROM tagged WHERE tag IN ('entry', 'ditto') AND page IN (FROM body)",
    "training_cer": f"WITH {HYP}, compared AS (FROM both_), {COUNTED} SELECT doc_id, line_no, CAST(round(cer * 1000000) AS BIGINT) AS cer FROM scored",
    "directory_records_1912": f"""WITH {PARSED_1912} SELECT line_no, surname, given_names, title, CASE WHEN wife THEN coalesce(settled, place) ELSE place END AS location, municipal_income, state_income,
        CAST(ditto AS BIGINT) AS is_continuation_surname, CAST(same AS BIGINT) AS is_same_person_2nd_loc, CAST(wife AS BIGINT) AS is_wife, CAST(regexp_matches(raw, '{P.COMPANY}') AS BIGINT) AS is_company
        FROM l WHERE surname <> '' OR given_names <> '' OR coalesce(municipal_income, 0) <> 0 OR coalesce(state_income, 0) <> 0""",
    "bump_merge_1912": f"""WITH RECURSIVE b AS ({BUMPS}), o AS (SELECT page, text, row_number() OVER (PARTITION BY page ORDER BY line_no) AS rn FROM b WHERE regexp_matches(text, '\\S')),
        f(page, rn, line, cur) AS (SELECT page, rn, 0, regexp_replace(text, '\\s+$', '') FROM o WHERE rn = 1 UNION ALL
          SELECT page, rn, CASE WHEN joins THEN line ELSE line + 1 END, CASE WHEN joins THEN cur || ' ' || here ELSE regexp_replace(text, '\\s+$', '') END FROM (
            SELECT o.page, o.rn, f.line, f.cur, o.text, trim(o.text) AS here,
              (f.cur LIKE '%,' OR regexp_matches(f.cur, '[{D}]\\s*$') OR length(regexp_replace(string_split(f.cur, ',')[-1], '[^0-9]', '', 'g')) < 2) AND regexp_matches(trim(o.text), '^\\s*[{D}]?\\s*[0-9]') AND length(trim(o.text)) < {P.BUMP_MAX_CHARS} AS joins
            FROM f JOIN o ON o.page = f.page AND o.rn = f.rn + 1))
        SELECT page, CAST(line AS BIGINT) AS line, arg_max(cur, rn) AS text FROM f GROUP BY 1, 2""",
    "line_clusters": """WITH RECURSIVE w AS (SELECT l_orderkey // 20 AS page, l_linenumber * 10 + l_partkey % 10 AS x0, CAST(l_quantity AS DOUBLE) * 3 AS y0, 6 + l_suppkey % 5 AS tall, CAST(l_partkey AS VARCHAR) AS t FROM lineitem),
        tol AS (SELECT page, median(tall) * 0.6::DOUBLE AS tol FROM w GROUP BY page),
        o AS (SELECT page, x0, y0, t, row_number() OVER (PARTITION BY page ORDER BY y0, x0, tall, t) AS rn FROM w),
        f(page, rn, line, c) AS (SELECT page, rn, 0, y0 FROM o WHERE rn = 1 UNION ALL
          SELECT o.page, o.rn, CASE WHEN abs(o.y0 - f.c) <= tol THEN line ELSE line + 1 END, CASE WHEN abs(o.y0 - f.c) <= tol THEN (f.c + o.y0) / 2 ELSE o.y0 END FROM f JOIN o ON o.page = f.page AND o.rn = f.rn + 1 JOIN tol ON tol.page = o.page)
        SELECT f.page, CAST(line AS BIGINT) AS line_no, string_agg(t, ' ' ORDER BY x0, y0, t) AS text FROM f JOIN o ON f.page = o.page AND f.rn = o.rn GROUP BY 1, 2""",
    "top_texts": f"""WITH s AS (SELECT l_orderkey // 10 AS page, l_orderkey * 10.0 + l_linenumber AS x0, l_partkey % 100 AS y0, CAST(l_partkey AS VARCHAR) AS t FROM lineitem)
        SELECT page, md5(string_agg(t, ' ' ORDER BY x0, t)) AS top_text FROM s WHERE y0 < (page % 3 * 50 + 100) * {P.CITY_BAND}::DOUBLE GROUP BY page""",
    "compared_forms": f"SELECT doc_id, md5({FORM.format(t='text')}) AS form FROM documents",
    "line_groups": "WITH " + reads_sql(FORM.format(t="line")) + ENTROPY.partition(reads_sql())[2] + """,
        shown AS (SELECT doc_id - doc_id % 4 AS page, line_no AS region, 'e' || (doc_id % 4) AS engine, line FROM each_line),
        rep AS (SELECT page, region, arg_min(line, (-length(line), engine, line)) AS representative, string_agg(engine, '|' ORDER BY engine) AS engines FROM shown GROUP BY 1, 2),
        g AS (SELECT r.page, r.region, n, representative, engines, CASE WHEN n >= 2 THEN mean_sim ELSE 0.0 END AS sim, CASE WHEN n >= 2 THEN 1 - delta ELSE 0.0 END AS agreement FROM region r JOIN rep ON r.page = rep.page AND r.region = rep.region)
        SELECT page, region AS slot, n AS n_engines_on_line, representative, engines, CAST(round(sim * 1000000) AS BIGINT) AS mean_sim, CAST(round(round(agreement, 9) * 1000000) AS BIGINT) AS agreement,
        CASE WHEN sim >= 0.85 THEN 'HIGH' WHEN sim < 0.6 THEN 'LOW' ELSE 'MID' END AS band FROM g""",
    "consensus_pick": f"""WITH RECURSIVE {ENTROPY},
        near AS (SELECT page, region, a, b FROM both_ways WHERE sim >= 0.8),
        reach(page, region, engine, other) AS (SELECT page, region, engine, engine FROM reads UNION SELECT r.page, r.region, r.engine, b.b FROM reach r JOIN near b ON r.page = b.page AND r.region = b.region AND r.other = b.a),
        cl AS (SELECT page, region, engine, min(other) AS c FROM reach GROUP BY page, region, engine),
        w AS (SELECT page, region, engine, n, (1 / (entropy + 1e-9)) / sum(1 / (entropy + 1e-9)) OVER (PARTITION BY page, region) AS w FROM each_),
        x AS (SELECT w.page, w.region, w.engine, w.w, cl.c, r.text, sum(w.w) OVER (PARTITION BY w.page, w.region, cl.c) AS total FROM w JOIN cl ON w.page = cl.page AND w.region = cl.region AND w.engine = cl.engine
              JOIN reads r ON w.page = r.page AND w.region = r.region AND w.engine = r.engine WHERE w.n >= 2)
        SELECT page, region, arg_min(engine, (-round(total, 12), c, -round(w, 12), -length(text), text, engine)) AS engine FROM x GROUP BY 1, 2""",
    "report_totals": f"""WITH {GROUPS}, r AS (SELECT count(*) AS regions, CAST(sum(n_engines) AS BIGINT) AS reads, CAST(round(round(avg(sim), 9) * 1000000) AS BIGINT) AS mean_sim, CAST(round(round(avg(line_sim), 9) * 1000000) AS BIGINT) AS mean_line_agreement,
        CAST(sum(high) AS BIGINT) AS high_lines, CAST(sum(low) AS BIGINT) AS low_lines FROM regions), g AS (SELECT count(*) FILTER (WHERE sim < 0.6 AND n = 1) AS singletons, count(*) FILTER (WHERE sim < 0.6 AND n > 1) AS disagreements FROM groups) SELECT * FROM r, g""",
    "worst_regions": f"WITH {GROUPS} SELECT page, region, CAST(round(sim * 1000000) AS BIGINT) AS region_mean_sim FROM worst",
    "disagreements": f"WITH {GROUPS} SELECT page, region, slot, representative FROM low",
    "agreements": f"WITH {GROUPS} SELECT page, region, slot, representative FROM high",
    "correction_verdict": """WITH m AS (SELECT avg(o_orderkey * 13 % 100 / 1000.0::DOUBLE) FILTER (WHERE o_orderkey % 2 = 0) AS b, avg(o_orderkey * 13 % 100 / 1000.0::DOUBLE) FILTER (WHERE o_orderkey % 2 <> 0) AS a FROM orders)
        SELECT CAST(round(round(b, 9) * 1000000) AS BIGINT) AS before, CAST(round(round(a, 9) * 1000000) AS BIGINT) AS after, CAST(round(round(a - b, 9) * 1000000) AS BIGINT) AS change, a - b < -0.01 AS helps FROM m""",
    "median_ratios": """WITH c AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)
        SELECT c_custkey, CAST(round(cents / (SELECT quantile_cont(cents, 0.5) FROM c) * 1000000) AS BIGINT) AS ratio FROM c""",
    "moving_average": """WITH p AS (SELECT l_orderkey // 20 AS page, CAST(l_quantity AS BIGINT) AS q, row_number() OVER (PARTITION BY l_orderkey // 20 ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS row FROM lineitem)
        SELECT page, row, CAST(sum(q) OVER (PARTITION BY page ORDER BY row ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) * 200000 AS BIGINT) AS ink FROM p""",
    "text_bands": """WITH r AS (SELECT c_custkey // 50 AS page, c_acctbal > 5000 AS t, row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) - 1 AS row FROM customer),
        t AS (SELECT page, row, CASE WHEN row - lag(row) OVER (PARTITION BY page ORDER BY row) <= 3 THEN 0 ELSE 1 END AS new FROM r WHERE t), b AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY row) AS band FROM t)
        SELECT page, min(row) AS first, max(row) AS last FROM b GROUP BY page, band""",
    "silver_pairs": """WITH c AS (SELECT p_partkey AS k, repeat(p_name, p_partkey % 9) AS text FROM part WHERE p_partkey % 4 > 0)
        SELECT 'p' || k AS page_id, 'crops/p' || k || '_colL.jpg' AS image_path, md5(text) AS reference, 'silver' AS status, 'sv' AS language, md5('image of ' || k) AS image FROM c WHERE length(text) >= 80""",
    "board_lines": f"""WITH s AS (SELECT row_number() OVER (ORDER BY s_suppkey) + 1 AS line, '| ' || s_suppkey || ' | ' || s_name || ' | ' || (s_suppkey * 3) || ' | ' || {_BOARD} || ' |' AS text FROM supplier)
        SELECT 0 AS line, '| rank | engine | n | score | cer | comma_f1 | comma_recall | dash_recall | digit_recall | field_count_ratio |' AS text UNION ALL SELECT 1, '|---|---|---|---|---|---|---|---|---|---|' UNION ALL FROM s""",
    "report_lines": f"""WITH {GROUPS}, t AS (SELECT unnest(['# Agreement of reads', '## Engines by mean distance to the others', '## Regions with the least similarity', '## Disagreements', '## Agreements', '| regions | reads | high_lines |', '|---|---|---|',
          '| rank | engine | mean_cer |', '|---|---|---|', '| page | region | n_engines | region_mean_sim | n_low_conf_lines |', '|---|---|---|---|---|', '| page | region | slot | mean_sim | representative |', '|---|---|---|---|---|',
          '| page | region | slot | mean_sim | representative |', '|---|---|---|---|---|']) AS text
        UNION ALL SELECT '| ' || count(*) || ' | ' || CAST(sum(n_engines) AS BIGINT) || ' | ' || CAST(sum(high) AS BIGINT) || ' |' FROM regions
        UNION ALL SELECT '| ' || s_suppkey || ' | ' || s_name || ' | ' || printf('%.4f', s_suppkey % 97 / 100.0::DOUBLE) || ' |' FROM supplier
        UNION ALL SELECT '| ' || page || ' | ' || region || ' | ' || n_engines || ' | ' || printf('%.4f', sim) || ' | ' || low || ' |' FROM worst
        UNION ALL SELECT '| ' || page || ' | ' || region || ' | ' || slot || ' | ' || printf('%.4f', sim) || ' | ' || representative || ' |' FROM (SELECT * FROM low UNION ALL SELECT * FROM high))
        SELECT text, count(*) AS n FROM t GROUP BY text""",
    "agreement_files": f"""WITH {GROUPS}, l AS (SELECT count(*) AS lines, CAST(sum(CAST(trunc(round(sim, 4) * 10000) AS BIGINT)) AS BIGINT) AS sims, count(*) FILTER (WHERE sim >= 0.85) AS high FROM groups),
        r AS (SELECT count(*) AS regions, CAST(sum(low) AS BIGINT) AS low FROM regions),
        m AS (SELECT count(DISTINCT n_nationkey // 5) AS engines, CAST(round(sum(n_nationkey / 100.0::DOUBLE) FILTER (WHERE n_nationkey % 5 = 2) * 1000000) AS BIGINT) AS e2, CAST(sum(n_nationkey) FILTER (WHERE n_nationkey % 5 = 3) AS BIGINT) AS e3 FROM nation)
        SELECT * FROM l, r, m""",
    "flagged_file": """SELECT l_orderkey AS page, l_linenumber AS line_idx, CAST(round(l_partkey % 100 / 100.0::DOUBLE * 1000000) AS BIGINT) AS agreement, l_partkey % 3 AS n_votes,
        md5(substring(repeat(l_partkey || ',"', 40), 1, 200)) AS text FROM lineitem WHERE l_partkey % 7 > 0 AND l_partkey % 100 / 100.0::DOUBLE < 0.6""",
}
