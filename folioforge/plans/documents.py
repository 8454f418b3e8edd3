"""Queries over documents, pages and conversations: lines, tags, reads, markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import patterns as P
from folioforge.functions import similarity as S
from folioforge.functions import text as X
from folioforge.operators import consensus, evaluation, geometry, records, sampling

D = P.DASHES


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def micro(c):
    """A ratio in millionths, which both engines round alike."""
    return F.round(c * 1_000_000).cast("long")


def document_lines(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("page"), F.col("lang").alias("volume"), "text")
    return docs.select("page", "volume", F.posexplode(X.lines(F.col("text"))).alias("line_no", "text"))


LINES = """
lines AS (
  SELECT doc_id AS page, lang AS volume, line AS text FROM (
    SELECT doc_id, lang, regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS line FROM documents)
  WHERE line <> ''),
tagged AS (
  SELECT page, volume, text, CASE
    WHEN regexp_matches(text, '^\\s*[{d}]') AND (contains(text, ',') OR regexp_matches(text, '[0-9]{{3,}}')) THEN 'ditto'
    WHEN contains(text, ',') AND regexp_matches(text, '[0-9][0-9 ]*\\s*[{d}]\\s*[0-9]|\\b[0-9]{{3,}}\\b')
         AND regexp_matches(text, '[A-Za-zÅÄÖåäö]') THEN 'entry'
    WHEN regexp_matches(text, '{ad}') OR (length(text) <= 3 AND NOT regexp_matches(text, '[0-9]{{3,}}')) THEN 'ad'
    ELSE 'other' END AS tag
  FROM lines),
stats AS (
  SELECT page, volume, count(*) AS n_lines, count(*) FILTER (WHERE tag IN ('entry', 'ditto')) AS n_entry,
         count(*) FILTER (WHERE tag = 'ad') AS n_ad,
         count(*) FILTER (WHERE tag = 'entry' AND regexp_matches(text, '[0-9][0-9 ]*[–—]\\s*[0-9]')) AS income_clean,
         count(*) FILTER (WHERE tag = 'entry' AND NOT regexp_matches(text, '[0-9][0-9 ]*[–—]\\s*[0-9]')
                          AND regexp_matches(text, '[0-9]{{3,}}[ \\-]+[0-9]{{3,}}')) AS income_dirty
  FROM tagged GROUP BY page, volume)
""".format(d=D, ad=P.AD_TOKENS.replace("'", "''"))


def tagged_lines(spark, sf) -> DataFrame:
    return document_lines(spark, sf).withColumn("tag", geometry.tag_line(F.col("text"), F.lit(0.0), F.lit(0.0)))


def stats(spark, sf) -> DataFrame:
    kind = geometry.income_kind(F.col("text"), F.col("tag"))
    return tagged_lines(spark, sf).groupBy("page", "volume").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("tag").isin("entry", "ditto")).alias("n_entry"), F.count_if(F.col("tag") == "ad").alias("n_ad"),
        F.count_if(kind == "clean").alias("income_clean"), F.count_if(kind == "dirty").alias("income_dirty"),
    )


def page_quality(spark, sf):
    return stats(spark, sf).withColumn("is_body", geometry.is_body(F.col("n_entry"), F.col("n_lines")).cast("long"))


def line_tags(spark, sf):
    return tagged_lines(spark, sf).groupBy("volume", "tag").agg(F.count(F.lit(1)).alias("n"))


def systematic_sample(spark, sf):
    return sampling.systematic(stats(spark, sf).select("page", "n_lines"), ["page"], 10)


def todo_antijoin(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return sampling.todo(docs.select("doc_id", "source"), labels.select("doc_id"), ["doc_id"])


def read_manifest(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), X.read_line_count(F.col("text")).cast("long").alias("n_lines"))


def reads(spark, sf) -> DataFrame:
    """Every line of every document: four documents are four engines' reads of a page, and a line's place is its region."""
    page = F.col("page")
    return document_lines(spark, sf).select((page - page % 4).alias("page"), F.col("line_no").alias("region"), F.concat(F.lit("e"), page % 4).alias("engine"), "text")


def blocks(spark, sf) -> DataFrame:
    """Whole documents in blocks of two lines: three documents are three engines' reads of a page, a block's place is its region."""
    docs = table(spark, sf, "documents").select("doc_id", X.lines(F.col("text")).alias("l")).where(F.size("l") > 0)
    at = docs.select("doc_id", "l", F.explode(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / 2).cast("int"))).alias("region"))
    text = F.array_join(F.slice("l", F.col("region") * 2 + 1, F.lit(2)), "\n")
    return at.select((F.col("doc_id") - F.col("doc_id") % 3).alias("page"), "region", F.concat(F.lit("e"), F.col("doc_id") % 3).alias("engine"), text.alias("text"))


# DuckDB's levenshtein counts bytes: letters of more than one byte stand as one control character each there
LETTERS = "éóèñüçäöêßíÉÈÑÓÇÊÜÖÄÍáúâî"
ONE_BYTE = "regexp_replace(translate({t}, '" + LETTERS + "', " + " || ".join(f"chr({k})" for k in (*range(1, 9), *range(14, 31))) + "), '[^\\x00-\\x7F]', chr(31), 'g')"
EACH_LINE = """
each_doc AS (
  SELECT doc_id, lang, source, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS l FROM documents),
each_line AS (SELECT doc_id, lang, source, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no FROM each_doc)
"""
def reads_sql(form: str = "line") -> str:
    """Reads and the distances of their pairs; ``form``: what of a line is compared."""
    return f"""
{EACH_LINE},
reads AS (SELECT doc_id - doc_id % 4 AS page, line_no AS region, 'e' || (doc_id % 4) AS engine, {form} AS text, {ONE_BYTE.format(t=form)} AS bytes FROM each_line),
pairs AS (
  SELECT x.page, x.region, x.engine AS a, y.engine AS b,
         CASE WHEN greatest(length(x.text), length(y.text)) = 0 THEN 0.0
              ELSE levenshtein(x.bytes, y.bytes)::DOUBLE / greatest(length(x.text), length(y.text)) END AS ned
  FROM reads x JOIN reads y ON x.page = y.page AND x.region = y.region AND x.engine < y.engine),
both_ways AS (SELECT page, region, a, b, 1 - ned AS sim FROM pairs UNION ALL SELECT page, region, b, a, 1 - ned FROM pairs)
"""


READS = reads_sql()


def read_pairs(spark, sf):
    return consensus.pair_similarity(reads(spark, sf)).select("page", "region", "a", "b", micro(F.col("ned")).alias("ned"))


def pairwise_cer(spark, sf):
    return consensus.pairwise_cer(reads(spark, sf)).select("a", "b", micro(F.col("mean_cer")).alias("mean_cer"), "n_shared")


def engine_centrality(spark, sf):
    got = consensus.engine_centrality(consensus.pairwise_cer(reads(spark, sf)))
    return got.select("engine", micro(F.col("mean_cer")).alias("mean_cer"), F.col("rank").cast("long").alias("rank"))


def consensus_entropy(spark, sf):
    _, region = consensus.consensus_entropy(reads(spark, sf))
    return region.select("page", "region", "n", micro(F.col("mean_sim")).alias("mean_sim"), micro(F.round("delta", 9)).alias("delta"))


def consensus_weights(spark, sf):
    each, _ = consensus.consensus_entropy(reads(spark, sf))
    return each.select("page", "region", "engine", micro(F.round("entropy", 9)).alias("entropy"))


def cluster_fraction(spark, sf):
    got = consensus.cluster_fraction(reads(spark, sf))
    return got.select("page", "region", micro(F.round("cluster_fraction", 9)).alias("cluster_fraction"))


def agreement_bands(spark, sf):
    _, region = consensus.consensus_entropy(reads(spark, sf))
    return region.groupBy(consensus.band(F.col("mean_sim")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


def flagged_lines(spark, sf):
    return consensus.flagged(consensus.anchored_agreement(blocks(spark, sf), "e0")).select("page", "region", "line_idx", "agreement", "n_corrob", "text")


def hyp_ref(spark, sf) -> DataFrame:
    """Every line of a document of an even id as reference, that of the next document at the same place as hypothesis; what only one
    of the two has stands against an empty line."""
    lines = document_lines(spark, sf)
    mine = lines.where("page % 2 = 0").select(F.col("page").alias("doc_id"), "line_no", F.col("text").alias("ref"))
    other = lines.where("page % 2 <> 0").select((F.col("page") - 1).alias("doc_id"), "line_no", F.col("text").alias("hyp"), F.col("volume").alias("engine"))
    return mine.join(other, ["doc_id", "line_no"], "full").fillna("", ["ref", "hyp"])


HYP = f"""
{EACH_LINE},
both_ AS (
  SELECT coalesce(a.doc_id, b.doc_id - 1) AS doc_id, coalesce(a.line_no, b.line_no) AS line_no, coalesce(a.line, '') AS ref, coalesce(b.line, '') AS hyp, b.lang AS engine
  FROM (SELECT * FROM each_line WHERE doc_id % 2 = 0) a FULL JOIN (SELECT * FROM each_line WHERE doc_id % 2 <> 0) b ON a.doc_id = b.doc_id - 1 AND a.line_no = b.line_no)
"""
CLEAN = """replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(coalesce({t}, ''),
        '(?s)^\\s*---\\s*\\n.*?\\n---\\s*\\n', ''), '(?i)^```[a-z]*\\s*|\\s*```\\s*\\z', '', 'g'), '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"""
COUNTED = f"""
counted AS (
  SELECT *, length(ref) - length(replace(ref, ',', '')) AS rc, length(hyp) - length(replace(hyp, ',', '')) AS hc,
         length(ref) - length(regexp_replace(ref, '[{D}]', '', 'g')) AS rd, length(hyp) - length(regexp_replace(hyp, '[{D}]', '', 'g')) AS hd,
         length(regexp_replace(ref, '[^0-9]', '', 'g')) AS rg, length(regexp_replace(hyp, '[^0-9]', '', 'g')) AS hg,
         trim(regexp_replace(ref, '\\s+', ' ', 'g')) AS r, trim(regexp_replace(hyp, '\\s+', ' ', 'g')) AS h FROM compared),
scored AS (
  SELECT *,
    CASE WHEN rc = 0 THEN 1.0 ELSE least(rc, hc)::DOUBLE / rc END AS comma_recall,
    CASE WHEN hc = 0 THEN 1.0 ELSE least(rc, hc)::DOUBLE / hc END AS comma_precision,
    CASE WHEN rc + hc = 0 THEN 1.0 ELSE 2.0 * least(rc, hc) / (rc + hc) END AS comma_f1,
    CASE WHEN rd = 0 THEN 1.0 ELSE least(rd, hd)::DOUBLE / rd END AS dash_recall,
    CASE WHEN rg = 0 THEN 1.0 ELSE least(rg, hg)::DOUBLE / rg END AS digit_recall,
    CASE WHEN rc = 0 OR r = '' THEN 1.0 WHEN h = '' THEN 0.0 ELSE least(rc, hc)::DOUBLE / rc END AS field_count_ratio,
    CASE WHEN r = '' THEN CASE WHEN h = '' THEN 0.0 ELSE 1.0 END ELSE levenshtein({ONE_BYTE.format(t="r")}, {ONE_BYTE.format(t="h")})::DOUBLE / length(r) END AS cer
  FROM counted)
"""
MEASURES = ("comma_recall", "comma_precision", "comma_f1", "dash_recall", "digit_recall", "field_count_ratio", "cer")


def punct_score(spark, sf):
    got = evaluation.score(F.col("ref"), F.col("hyp"))
    return hyp_ref(spark, sf).select("doc_id", "line_no", *[micro(got[m]).alias(m) for m in MEASURES])


def leaderboard(spark, sf):
    """Languages of the hypotheses as engines; references under the least length do not count."""
    pairs = hyp_ref(spark, sf).select(F.lit("0").alias("year"), F.concat_ws("-", "doc_id", "line_no").alias("page_id"), "ref", "hyp", "engine")
    reads_ = pairs.where(F.col("engine").isNotNull()).select("page_id", "engine", F.col("hyp").alias("text"))
    references = pairs.select("year", "page_id", F.col("ref").alias("reference"))
    got = evaluation.leaderboard(reads_, references, references.select("year", "page_id"))
    return got.select("engine", "n", *[micro(F.col(m)).alias(m) for m in (*evaluation.METRICS, "score")], F.col("rank").cast("long").alias("rank"))


def accepted_corrections(spark, sf):
    got = hyp_ref(spark, sf)
    return got.select("doc_id", "line_no", (S.accepted(F.col("ref"), F.col("hyp")) == F.col("hyp")).alias("accepted"))


def clean_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(X.clean_markup(F.col("html"))).alias("clean_md5"))


def protected_tokens(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "[ \n]+")).alias("w")).where("w <> ''")
    return words.groupBy("doc_id").agg(F.count_if(X.is_protected(F.col("w"))).alias("n_protected"))


def monotone_documents(spark, sf):
    got = records.monotonicity(table(spark, sf, "documents"), "text", ["source"], ["doc_id"])
    return got.select("source", micro(F.col("monotonicity")).alias("monotonicity"), "n_names")


def light_forms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.light_form(F.col("text"))).alias("form"))


QUERIES = {
    f.__name__: f
    for f in (
        page_quality, line_tags, systematic_sample, todo_antijoin, read_manifest, read_pairs, pairwise_cer, engine_centrality,
        consensus_entropy, consensus_weights, cluster_fraction, agreement_bands, flagged_lines, punct_score, leaderboard,
        accepted_corrections, clean_markup, protected_tokens, monotone_documents, light_forms,
    )
}

ENTROPY = READS + """,
sums AS (SELECT page, region, a, sum(sim) AS s FROM both_ways GROUP BY page, region, a),
h AS (
  SELECT b.page, b.region, b.a AS engine, CASE WHEN max(s.s) > 1e-9 THEN sum(CASE WHEN b.sim > 0 THEN -(b.sim / s.s) * ln(b.sim / s.s) ELSE 0.0 END) END AS h
  FROM both_ways b JOIN sums s ON b.page = s.page AND b.region = s.region AND b.a = s.a GROUP BY b.page, b.region, b.a),
sized AS (SELECT page, region, engine, count(*) OVER (PARTITION BY page, region) AS n FROM reads),
each_ AS (
  SELECT z.page, z.region, z.engine, z.n, CASE WHEN z.n = 1 THEN 0.0 ELSE coalesce(h.h, max(h.h) OVER (PARTITION BY z.page, z.region), ln(z.n)) END AS entropy
  FROM sized z LEFT JOIN h ON z.page = h.page AND z.region = h.region AND z.engine = h.engine),
means AS (SELECT page, region, round(avg(sim), 12) AS m FROM both_ways GROUP BY page, region),
region AS (
  SELECT e.page, e.region, count(*) AS n, greatest(0.0, least(1.0, coalesce(CASE WHEN count(*) > 1 THEN stddev_pop(entropy) / ln(count(*)) END, 0.0))) AS delta,
         coalesce(max(m.m), 1.0) AS mean_sim
  FROM each_ e LEFT JOIN means m ON e.page = m.page AND e.region = m.region GROUP BY e.page, e.region)
"""

SQL = {
    "page_quality": f"WITH {LINES} SELECT *, CAST(n_entry >= 20 AND n_entry >= n_lines * 0.45 AS BIGINT) AS is_body FROM stats",
    "line_tags": f"WITH {LINES} SELECT volume, tag, count(*) AS n FROM tagged GROUP BY volume, tag",
    "systematic_sample": f"""WITH {LINES}, s AS (SELECT page, n_lines, row_number() OVER (ORDER BY page) - 1 AS i, greatest(1, count(*) OVER () // 10) AS step FROM stats)
        SELECT page, n_lines FROM s WHERE i % step = 0 AND i < step * 10""",
    "todo_antijoin": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "read_manifest": """SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(length(text) - length(replace(text, chr(10), ''))
        + CASE WHEN text <> '' AND right(text, 1) <> chr(10) THEN 1 ELSE 0 END AS BIGINT) AS n_lines FROM documents""",
    "read_pairs": f"WITH {READS} SELECT page, region, a, b, CAST(round(ned * 1000000) AS BIGINT) AS ned FROM pairs",
    "pairwise_cer": f"""WITH {READS}, half AS (SELECT a, b, avg(ned) AS m, count(*) AS n FROM pairs GROUP BY a, b)
        SELECT a, b, CAST(round(m * 1000000) AS BIGINT) AS mean_cer, n AS n_shared FROM (SELECT a, b, m, n FROM half UNION ALL SELECT b, a, m, n FROM half
        UNION ALL SELECT DISTINCT engine, engine, 0.0, 0 FROM reads)""",
    "engine_centrality": f"""WITH {READS}, half AS (SELECT a, b, avg(ned) AS m FROM pairs GROUP BY a, b), mean AS (
        SELECT a AS engine, avg(m) AS m FROM (SELECT a, b, m FROM half UNION ALL SELECT b, a, m FROM half) GROUP BY a)
        SELECT engine, CAST(round(m * 1000000) AS BIGINT) AS mean_cer, row_number() OVER (ORDER BY m, engine) AS rank FROM mean""",
    "consensus_entropy": f"""WITH {ENTROPY} SELECT page, region, n, CAST(round(mean_sim * 1000000) AS BIGINT) AS mean_sim, CAST(round(round(delta, 9) * 1000000) AS BIGINT) AS delta FROM region""",
    "consensus_weights": f"WITH {ENTROPY} SELECT page, region, engine, CAST(round(round(entropy, 9) * 1000000) AS BIGINT) AS entropy FROM each_",
    "cluster_fraction": f"""WITH RECURSIVE {ENTROPY},
        near AS (SELECT page, region, a, b FROM both_ways WHERE sim >= 0.8),
        reach(page, region, engine, other) AS (SELECT page, region, engine, engine FROM reads UNION SELECT r.page, r.region, r.engine, b.b FROM reach r JOIN near b ON r.page = b.page AND r.region = b.region AND r.other = b.a),
        cl AS (SELECT page, region, engine, min(other) AS c FROM reach GROUP BY page, region, engine),
        w AS (SELECT page, region, engine, (1 / (entropy + 1e-9)) / sum(1 / (entropy + 1e-9)) OVER (PARTITION BY page, region) AS w FROM each_),
        t AS (SELECT cl.page, cl.region, c, sum(w) AS w FROM cl JOIN w ON cl.page = w.page AND cl.region = w.region AND cl.engine = w.engine GROUP BY cl.page, cl.region, c)
        SELECT page, region, CAST(round(round(max(w), 9) * 1000000) AS BIGINT) AS cluster_fraction FROM t GROUP BY page, region""",
    "agreement_bands": f"""WITH {ENTROPY} SELECT CASE WHEN mean_sim >= 0.85 THEN 'HIGH' WHEN mean_sim < 0.6 THEN 'LOW' ELSE 'MID' END AS band, count(*) AS n FROM region GROUP BY 1""",
    "punct_score": f"WITH {HYP}, compared AS (FROM both_), {COUNTED} SELECT doc_id, line_no, " + ", ".join(f"CAST(round({m} * 1000000) AS BIGINT) AS {m}" for m in MEASURES) + " FROM scored",
    "leaderboard": f"""WITH {HYP}, compared AS (SELECT ref, {CLEAN.format(t="hyp")} AS hyp, engine FROM both_ WHERE engine IS NOT NULL AND length(ref) >= 40), {COUNTED},
        m AS (SELECT engine, count(*) AS n, """ + ", ".join(f"round(avg({m}), 4) AS {m}" for m in evaluation.METRICS) + """ FROM scored GROUP BY engine),
        s AS (SELECT *, round((1 - cer) * 0.40 + comma_f1 * 0.35 + field_count_ratio * 0.25, 4) AS score FROM m)
        SELECT engine, n, """ + ", ".join(f"CAST(round({m} * 1000000) AS BIGINT) AS {m}" for m in (*evaluation.METRICS, "score")) + """, row_number() OVER (ORDER BY score DESC, engine) AS rank FROM s""",
    "accepted_corrections": f"""WITH {HYP}, y AS (SELECT doc_id, line_no, ref AS src, hyp AS o, {ONE_BYTE.format(t="ref")} AS a, {ONE_BYTE.format(t="hyp")} AS b FROM both_)
        SELECT doc_id, line_no, CASE WHEN o = '' OR (CASE WHEN greatest(length(a), length(b)) = 0 THEN 0 ELSE levenshtein(a, b)::DOUBLE / greatest(length(a), length(b)) END > 0.5
        AND (length(o) > length(src) * 1.5 + 8 OR length(a) < 6)) THEN src ELSE o END = o AS accepted FROM y""",
    "clean_markup": f"""SELECT page_id, md5({CLEAN.format(t="html")}) AS clean_md5 FROM pages""",
    "protected_tokens": """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\n]+')) AS w FROM documents), c AS (SELECT doc_id, w, trim(w, ',.;:()[]"''«»') AS core FROM w WHERE w <> '')
        SELECT doc_id, count(*) FILTER (WHERE core <> '' AND (regexp_matches(core, '[0-9]') OR regexp_matches(w, '^[A-ZÅÄÖ][.:][A-Za-zÅÄÖåäö]?$|^[A-ZÅÄÖ][.:]?$')
        OR regexp_matches(core, '^[A-ZÅÄÖ][.:][A-Za-zÅÄÖåäö]?$|^[A-ZÅÄÖ][.:]?$'))) AS n_protected FROM c GROUP BY doc_id""",
    "monotone_documents": """WITH s AS (SELECT source, b, lag(b) OVER (PARTITION BY source ORDER BY doc_id) AS a FROM (SELECT source, doc_id, replace(lower(text), 'ß', 'ss') AS b FROM documents))
        SELECT source, CAST(round(count(*) FILTER (WHERE a <= b)::DOUBLE / greatest(count(*) - 1, 1) * 1000000) AS BIGINT) AS monotonicity, count(*) AS n_names FROM s GROUP BY source""",
    "light_forms": """SELECT doc_id, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS form FROM documents""",
}
