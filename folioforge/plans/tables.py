"""Queries over the relational tables: carry-forward, directory records, geometry, analytics, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import patterns as P
from folioforge.functions import text as X
from folioforge.operators import analytics, assembly, geometry, images, records, sampling
from folioforge.plans.documents import micro, table

D = P.DASHES


def carry_forward(spark, sf):
    """Each event with its user's last purchase value so far; errors inherit it."""
    cents = F.when(F.col("event_type") == "purchase", F.round(F.col("value") * 100).cast("long"))
    return records.carry_last(table(spark, sf, "events"), cents, ["user_id"], ["ts", "event_id"], "carried").select("event_id", "carried")


# Directory lines made from customers: a key stands for each kind of line
DIRECTORY = """
SELECT c_nationkey AS volume, c_custkey // 40 AS page, CASE WHEN c_custkey % 2 = 0 THEN 'colL' ELSE 'colR' END AS region, c_custkey AS line_no,
       CASE c_custkey % 7
         WHEN 0 THEN concat('– Anna, fröken, ', substring(c_mktsegment, 1, 3), ', ', c_custkey, '–')
         WHEN 1 THEN concat('– – ', substring(c_mktsegment, 1, 4), ', –', c_custkey)
         WHEN 2 THEN concat('– Greta, hustru, 9', c_custkey % 100, '–')
         WHEN 3 THEN concat(substring(c_mktsegment, 1, 5), ' Fonden, A, 300–')
         WHEN 4 THEN concat(substring(c_mktsegment, 1, 4), ' A.-B., Sundby, ', c_custkey, '–2', c_custkey % 1000)
         ELSE concat(substring(c_mktsegment, 1, 6), ', K., köpman, ', CASE WHEN c_custkey % 3 = 0 THEN 'Mt' ELSE 'Farsta' END, ', ', c_custkey, '–1', c_custkey % 1000)
       END AS text
FROM customer"""


def directory(spark, sf):
    return spark.sql(DIRECTORY.replace("c_custkey // 40", "c_custkey div 40").replace("FROM customer", "FROM {customer}"), customer=table(spark, sf, "customer"))


def directory_records(spark, sf):
    got = records.parse_records(directory(spark, sf))
    flags = ["is_continuation_surname", "is_same_person_2nd_loc", "is_wife", "is_company", "location_is_known_parish"]
    return got.select("line_no", "surname", "given_names", "title", "location", "municipal_income", "state_income", *[F.col(f).cast("long").alias(f) for f in flags])


def record_qa(spark, sf):
    qa = records.record_qa(records.parse_records(directory(spark, sf)))
    return qa.select(
        "volume", "records", micro(F.col("pct_with_income")).alias("with_income"), micro(F.col("pct_with_location")).alias("with_location"), "companies", "wives",
        "continuation_surnames", "same_person_2nd_loc", micro(F.col("surname_monotonicity")).alias("monotonicity"),
    )


def record_ids(spark, sf):
    return records.with_record_ids(directory(spark, sf), "K1936").select("volume", "line_no", "record_id")


def dash_counts(spark, sf):
    return directory(spark, sf).select("line_no", records.dash_count(F.col("text")).cast("long").alias("n_dash"))


def income_fields(spark, sf):
    last = F.element_at(records.fields(F.col("text")), -1)
    got = records.income_1936(last)
    return directory(spark, sf).select("line_no", got["municipal"].alias("municipal"), got["state"].alias("state"), got["is_income"].alias("is_income"))


BUMPS = """
SELECT o_orderkey // 40 AS page, o_orderkey AS line_no, CASE o_orderkey % 5
  WHEN 0 THEN concat('Berg, Erik, köpman, ', substring(o_orderpriority, 1, 1), ',') WHEN 1 THEN concat('8 1', o_orderkey % 100, '–7 900')
  WHEN 2 THEN 'Fidei-' WHEN 3 THEN concat('kommiss, ', o_orderkey % 10, '–') ELSE concat('12', o_orderkey % 10) END AS text
FROM orders"""


def bump_lines(spark, sf):
    return spark.sql(BUMPS.replace("o_orderkey // 40", "o_orderkey div 40").replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))


def line_merge(spark, sf):
    lines = bump_lines(spark, sf)
    return records.merge_lines_1936(lines, keys=("page",)).select("page", "line_no", "text")


def monotonicity(spark, sf):
    got = records.monotonicity(table(spark, sf, "part"), "p_name", ["p_brand"], ["p_partkey"])
    return got.select("p_brand", micro(F.col("monotonicity")).alias("monotonicity"), "n_names")


def _words(spark, sf):
    li = table(spark, sf, "lineitem")
    x0 = F.col("l_quantity").cast("double")
    return li.select(F.expr("l_orderkey div 100").alias("page"), "l_orderkey", "l_linenumber", x0.alias("x0"), (x0 + 1 + F.col("l_linenumber")).alias("x1"))


def gutter(spark, sf):
    words = _words(spark, sf)
    pages = words.select("page").distinct().withColumn("width", F.lit(60.0))
    got = geometry.gutters(pages, words, ["page"])
    return got.select("page", micro(F.col("split_x")).alias("split_x"), micro(F.col("gutter_conf")).alias("gutter_conf"), "n_words")


def column_sides(spark, sf):
    return _words(spark, sf).groupBy("page", geometry.side(F.col("x0"), F.col("x1"), F.lit(30.0)).alias("region")).agg(F.count(F.lit(1)).alias("n"))


def interval_overlap(spark, sf):
    """Lines of a page with the largest font among spans that overlap them in height."""
    words = _words(spark, sf)
    lines = words.select("page", "l_orderkey", "l_linenumber", F.col("x0").alias("y0"), F.col("x1").alias("y1"))
    spans = words.where("l_linenumber = 1").select("page", (F.col("x0") + 2).alias("y0"), (F.col("x0") + 3).alias("y1"), (F.col("l_orderkey") % 17 + 1).cast("double").alias("size"))
    return geometry.line_sizes(lines, spans, ["page"]).select("page", "l_orderkey", "l_linenumber", F.col("max_size").cast("long").alias("max_size"))


def region_assign(spark, sf):
    o = table(spark, sf, "orders")
    page = F.expr("o_custkey div 8")
    lines = o.select(page.alias("page"), F.col("o_orderkey").alias("line_id"), (F.col("o_orderkey") % 97).cast("double").alias("cx"), (F.col("o_custkey") % 89).cast("double").alias("cy"))
    p = table(spark, sf, "part")
    regions = p.select(
        F.expr("p_partkey div 8").alias("page"), F.col("p_partkey").alias("position"), F.col("p_brand").alias("label"), (F.col("p_partkey") % 40).cast("double").alias("x0"),
        (F.col("p_partkey") % 30).cast("double").alias("y0"), (F.col("p_partkey") % 40 + 50).cast("double").alias("x1"), (F.col("p_partkey") % 30 + 40 + F.col("p_partkey") % 3).cast("double").alias("y1"),
    )
    return geometry.assign_regions(lines, regions, ["page"]).select("page", "line_id", "region_position")


def layout_order(spark, sf):
    words = _words(spark, sf).withColumn("region_position", F.when(F.col("l_linenumber") < 3, F.col("l_linenumber")))
    got = geometry.layout_order(words.withColumn("y0", (F.col("l_orderkey") % 13 * 3).cast("double")).withColumn("x0", F.col("l_orderkey") * 10.0 + F.col("l_linenumber")), ["page"])
    return got.select("page", "l_orderkey", "l_linenumber", F.col("reading_no").cast("long").alias("reading_no"))


def polygon_boxes(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    poly = F.array(F.array(k % 7, k % 5), F.array(k % 11, k % 3), F.array(k % 13, k % 17))
    return c.select("c_custkey", *[F.get(X.polygon_box(poly), F.lit(i)).cast("long").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


def split_pixels(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.split_pixel((F.col("o_orderkey") % 1000).cast("double"), F.lit(2480), F.lit(595.0)).cast("long").alias("px"))


def page_numbers(spark, sf):
    header = F.concat_ws("  ", F.when(F.col("o_orderkey") % 3 == 0, F.lit("1936")).otherwise(F.col("o_orderpriority")), F.concat(F.col("o_orderkey") % 2000, F.lit(".")), F.lit("1935"))
    return table(spark, sf, "orders").select("o_orderkey", X.page_number(header).alias("page_number"))


def city_carry(spark, sf):
    top = F.concat(F.lit("S A. "), F.when(F.col("s_suppkey") % 5 == 0, F.lit("G ö T e b org")).when(F.col("s_suppkey") % 7 == 0, F.lit("Lundin Falun")).otherwise(F.col("s_name")))
    pages = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("volume"), F.col("s_suppkey").alias("page"), records.city_of_page(top).alias("city"))
    return records.carry_city(pages).select("page", "city")


def top_groups(spark, sf):
    c = table(spark, sf, "customer").withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    got = analytics.profile_groups(c, "c_nationkey", "cents", "c_mktsegment", 20)
    return got.select("c_nationkey", "n", F.floor("avg_value").alias("avg_cents"), "mode", "mode_n")


def mode_by_group(spark, sf):
    p = table(spark, sf, "part").withColumn("cents", F.round(F.col("p_retailprice") * 100).cast("long"))
    return analytics.profile_groups(p, "p_type", "cents", "p_brand", 30).select("p_type", "n", "mode", "mode_n")


def percentiles(spark, sf):
    c = table(spark, sf, "customer").withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    d = analytics.distribution(c, "cents")
    return d.select("least", "most", *[F.round(F.col(f"p{q}") * 100).cast("long").alias(f"p{q}") for q in analytics.PERCENTILES])


def having_topk(spark, sf):
    o = table(spark, sf, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    return analytics.best_paid(o, "o_custkey", "cents").select("o_custkey", "n", F.floor("avg_value").alias("avg_cents"))


def class_buckets(spark, sf):
    c = table(spark, sf, "customer")
    got = analytics.shares(c, analytics.income_class(F.col("c_acctbal"), (0, 3000, 6000)))
    return got.select("class", "n", micro(F.col("share")).alias("share"))


def marked_shares(spark, sf):
    c = table(spark, sf, "customer")
    got = analytics.shares(c, analytics.marked_gender(F.col("c_mktsegment"), ["building", "furni"]), "marker")
    return got.select("marker", "n", micro(F.col("share")).alias("share"))


def completeness(spark, sf):
    e = table(spark, sf, "customer").withColumn("seg", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    got = analytics.completeness(e, ["seg", "c_name"], ["seg", "c_nationkey"])
    return got.select("n", micro(F.col("seg_rate")).alias("seg_rate"), micro(F.col("c_name_rate")).alias("c_name_rate"), "seg_distinct", "c_nationkey_distinct")


def extrapolation(spark, sf):
    got = analytics.extrapolate(table(spark, sf, "lineitem"), "l_orderkey", 417)
    return got.select("n", "pages", F.floor("expected").alias("expected"))


def upsert_latest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id")
    return sampling.latest(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id"])


def seeded_split(spark, sf):
    return sampling.seeded_split(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 100).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def selected_pages(spark, sf):
    return sampling.select_pages(table(spark, sf, "part").withColumnRenamed("p_partkey", "page"), limit=50).select("page")


def image_quality(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    lap, std, ink = (k % 200).cast("double"), (k % 40).cast("double"), (k % 12) / 100
    return p.select("p_partkey", F.round(images.quality_score(lap, std, ink) * 10).cast("long").alias("score"), images.is_faded(lap, std, ink).alias("faded"), images.gutter_class((k % 10) / 10).alias("gutter"))


def engine_names(spark, sf):
    c = table(spark, sf, "customer")
    token = F.element_at(F.array(*[F.lit(t) for t in ("Dots.OCR", "surya_text", "quality", "olmOCR-2-7b", "New")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return c.select("c_custkey", X.canonical_engine(token).alias("engine"))


def file_stems(spark, sf):
    s = table(spark, sf, "supplier")
    stem = F.concat(F.lit("SSA_"), F.col("s_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, "_colL").otherwise("_header"))
    return s.select("s_suppkey", X.stem_page(stem).alias("page"), X.stem_region(stem).alias("region"), X.volume_year(F.concat(F.lit("v_"), F.col("s_suppkey"))).alias("year"))


def page_assembly(spark, sf):
    """Headers and columns made from customers, as page records."""
    c = table(spark, sf, "customer")
    value = lambda t, k: F.struct(t.alias("text"), F.when(F.col("c_custkey") % k != 0, (F.col("c_custkey") % 100) / 100).alias("confidence"))
    pages = c.select(F.col("c_custkey").alias("page"), value(F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_custkey") % 3000, F.lit(" 1936")), 2).alias("header"), value(F.col("c_name"), 3).alias("colL"), value(F.col("c_mktsegment"), 5).alias("colR"))
    got = assembly.page_records(pages)
    return got.select("ssa_id", F.col("page_number.text").alias("page_number"), micro(F.col("page_confidence")).alias("page_confidence"), F.col("n_chars").cast("long").alias("n_chars"))


def word_chunks(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("t"))
    return docs.select("doc_id", F.explode(X.byte_chunks(F.col("t"))).alias("c")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("c")).cast("long").alias("most"))


QUERIES = {
    f.__name__: f
    for f in (
        carry_forward, directory_records, record_qa, record_ids, dash_counts, income_fields, line_merge, monotonicity, gutter, column_sides,
        interval_overlap, region_assign, layout_order, polygon_boxes, split_pixels, page_numbers, city_carry, top_groups, mode_by_group, percentiles, having_topk, class_buckets,
        marked_shares, completeness, extrapolation, upsert_latest, seeded_split, selected_pages, image_quality, engine_names, file_stems, page_assembly,
        word_chunks,
    )
}

PARSED = f"""
d AS ({DIRECTORY}),
a AS (SELECT *, trim(text) AS raw, regexp_extract(text, '^\\s*([{D}](?:\\s*[{D}])*)\\s*', 1) AS run, regexp_replace(text, '^\\s*[{D}](?:\\s*[{D}])*\\s*', '') AS body FROM d),
b AS (SELECT *, length(regexp_replace(run, '[^{D}]', '', 'g')) AS n_dash, list_transform(string_split(body, ','), lambda x: trim(x)) AS f FROM a),
c AS (SELECT *, f[-1] AS last_, regexp_matches(f[-1], '^\\s*(?:[0-9][0-9  ]*)?\\s*[{D}]\\s*(?:[0-9][0-9  ]*)?\\s*$') AS pair_ FROM b),
e AS (SELECT *, TRY_CAST(regexp_replace(regexp_extract(last_, '^\\s*([0-9][0-9  ]*)?\\s*[{D}]', 1), '[^0-9]', '', 'g') AS BIGINT) AS m,
       TRY_CAST(regexp_replace(regexp_extract(last_, '[{D}]\\s*([0-9][0-9  ]*)?\\s*$', 1), '[^0-9]', '', 'g') AS BIGINT) AS s,
       CASE WHEN pair_ THEN f[1:-2] ELSE f END AS rest FROM c),
"""

# the records follow the order volume, page, region, line
RECORDS = PARSED + """
g AS (SELECT *, n_dash >= 1 AS ditto, n_dash >= 2 AS same, CASE WHEN n_dash >= 1 THEN rest ELSE rest[2:] END AS r2 FROM e),
h AS (SELECT *, coalesce(last_value(CASE WHEN NOT ditto THEN coalesce(rest[1], '') END IGNORE NULLS) OVER w, '') AS surname FROM g
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
i AS (SELECT *, len(r2) > 0 AND (r2[1] IN ('{parishes}') OR regexp_matches(surname, '{institution}')) AS inst FROM h),
j AS (SELECT *, coalesce(last_value(CASE WHEN NOT same THEN CASE WHEN inst THEN '' ELSE coalesce(r2[1], '') END END IGNORE NULLS) OVER w, '') AS given_names,
        CASE WHEN same OR inst THEN r2 ELSE r2[2:] END AS loc FROM i
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, coalesce(loc[-1], '') AS place, array_to_string(list_filter(loc[1:-2], lambda x: x <> ''), ', ') AS own FROM j),
l AS (SELECT *, CASE WHEN same THEN coalesce(last_value(CASE WHEN NOT same AND own <> '' THEN own END IGNORE NULLS) OVER w, '') ELSE own END AS title FROM k
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m2 AS (SELECT *, regexp_matches(title || ' ' || array_to_string(loc, ' '), '(?i)\\bhustru\\b') AS wife FROM l),
n AS (SELECT *, CASE WHEN wife THEN coalesce(last_value(CASE WHEN NOT wife AND place <> '' THEN place END IGNORE NULLS) OVER w, place) ELSE place END AS location FROM m2
      WINDOW w AS (PARTITION BY volume ORDER BY page, region, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rec AS (SELECT volume, page, region, line_no, surname, given_names, title, location, CASE WHEN pair_ THEN m END AS municipal_income, CASE WHEN pair_ THEN s END AS state_income,
        CAST(ditto AS BIGINT) AS is_continuation_surname, CAST(same AS BIGINT) AS is_same_person_2nd_loc, CAST(wife AS BIGINT) AS is_wife,
        CAST(regexp_matches(raw, 'A\\.?\\s*[–—-]\\s*B\\.?') AS BIGINT) AS is_company, CAST(location IN ('{parishes}') AS BIGINT) AS location_is_known_parish FROM n)
""".replace("{parishes}", "', '".join(P.PARISHES)).replace("{institution}", P.INSTITUTION)

WORDS = """words AS (SELECT l_orderkey // 100 AS page, l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_quantity AS DOUBLE) + 1 + l_linenumber AS x1 FROM lineitem)"""

SQL = {
    # a chunk ends before the first word that would bring it over the budget; a longer word is a chunk of its own
    "word_chunks": f"""WITH RECURSIVE w AS (SELECT doc_id, strlen(x) + 1 AS size, rn FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS x, generate_subscripts(string_split(text, ' '), 1) AS rn FROM documents)),
        c AS (SELECT doc_id, rn, CAST(sum(size) OVER (PARTITION BY doc_id ORDER BY rn) AS BIGINT) AS cum, CAST(sum(size) OVER (PARTITION BY doc_id ORDER BY rn) - size AS BIGINT) AS before FROM w),
        n AS (SELECT a.doc_id, a.rn, CASE WHEN b.rn IS NOT NULL THEN greatest(b.rn, a.rn + 1) END AS nxt, a.before FROM (SELECT *, before + {P.CHUNK_BYTES} AS full_ FROM c) a ASOF LEFT JOIN c b ON a.doc_id = b.doc_id AND a.full_ < b.cum),
        e AS (SELECT n.doc_id, n.rn, n.nxt, coalesce(c.before, t.total) - n.before - 1 AS bytes FROM n LEFT JOIN c ON c.doc_id = n.doc_id AND c.rn = n.nxt JOIN (SELECT doc_id, max(cum) AS total FROM c GROUP BY 1) t ON t.doc_id = n.doc_id),
        f(doc_id, nxt, bytes) AS (SELECT doc_id, nxt, bytes FROM e WHERE rn = 1 UNION ALL SELECT e.doc_id, e.nxt, e.bytes FROM f JOIN e ON e.doc_id = f.doc_id AND e.rn = f.nxt)
        SELECT doc_id, count(*) AS n, CAST(max(bytes) AS BIGINT) AS most FROM f GROUP BY doc_id""",
    "carry_forward": """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events""",
    "directory_records": f"WITH {RECORDS} SELECT * EXCLUDE (volume, page, region) FROM rec",
    "record_qa": f"""WITH {RECORDS}, names AS (SELECT volume, lower(surname) AS b, lag(lower(surname)) OVER (PARTITION BY volume ORDER BY page, region, line_no) AS a FROM rec
        WHERE is_continuation_surname = 0 AND surname <> ''), mono AS (SELECT volume, count(*) FILTER (WHERE a <= b)::DOUBLE / greatest(count(*) - 1, 1) AS m FROM names GROUP BY volume)
        SELECT rec.volume, count(*) AS records, CAST(round(count(*) FILTER (WHERE coalesce(municipal_income, 0) <> 0 OR coalesce(state_income, 0) <> 0)::DOUBLE / count(*) * 1000000) AS BIGINT) AS with_income,
        CAST(round(count(*) FILTER (WHERE location <> '')::DOUBLE / count(*) * 1000000) AS BIGINT) AS with_location, CAST(sum(is_company) AS BIGINT) AS companies, CAST(sum(is_wife) AS BIGINT) AS wives,
        CAST(sum(is_continuation_surname) AS BIGINT) AS continuation_surnames, CAST(sum(is_same_person_2nd_loc) AS BIGINT) AS same_person_2nd_loc,
        CAST(round(coalesce(max(m), 0.0) * 1000000) AS BIGINT) AS monotonicity FROM rec LEFT JOIN mono ON rec.volume = mono.volume GROUP BY rec.volume""",
    "record_ids": f"WITH d AS ({DIRECTORY}) SELECT volume, line_no, 'K1936_' || lpad(CAST(row_number() OVER (PARTITION BY volume ORDER BY page, region, line_no) AS VARCHAR), 6, '0') AS record_id FROM d",
    "dash_counts": f"WITH {PARSED} z AS (SELECT 1) SELECT line_no, CAST(n_dash AS BIGINT) AS n_dash FROM e",
    "income_fields": f"WITH {PARSED} z AS (SELECT 1) SELECT line_no, CASE WHEN pair_ THEN m END AS municipal, CASE WHEN pair_ THEN s END AS state, pair_ AS is_income FROM e",
    "line_merge": f"""WITH b AS ({BUMPS}), l AS (SELECT *, lag(text) OVER (PARTITION BY page ORDER BY line_no) AS p FROM b),
        h AS (SELECT *, CASE WHEN regexp_matches(p, '[A-Za-zÅÄÖåäö]-$') AND regexp_matches(text, '^[a-zåäö]') THEN 'word'
          WHEN (p LIKE '%,' OR regexp_matches(p, '[{D}]\\s*$')) AND (regexp_matches(text, '^\\s*(?:[0-9][0-9 ]*)?\\s*[{D}]\\s*(?:[0-9][0-9 ]*)?\\s*$') OR regexp_matches(text, '^\\s*[0-9][0-9 ]*\\s*$')) THEN 'bump' ELSE 'new' END AS how FROM l),
        g AS (SELECT *, lead(how) OVER (PARTITION BY page ORDER BY line_no) AS nx, sum(CASE WHEN how = 'new' THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY line_no) AS grp FROM h)
        SELECT page, min(line_no) AS line_no, string_agg(CASE WHEN how = 'bump' THEN ' ' ELSE '' END || CASE WHEN nx = 'word' THEN regexp_replace(text, '-$', '') ELSE text END, '' ORDER BY line_no) AS text
        FROM g GROUP BY page, grp""",
    "monotonicity": """WITH s AS (SELECT p_brand, lower(p_name) AS b, lag(lower(p_name)) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS a FROM part)
        SELECT p_brand, CAST(round(count(*) FILTER (WHERE a <= b)::DOUBLE / greatest(count(*) - 1, 1) * 1000000) AS BIGINT) AS monotonicity, count(*) AS n_names FROM s GROUP BY p_brand""",
    "gutter": f"""WITH {WORDS}, k AS (SELECT k, 60.0::DOUBLE * 0.3::DOUBLE + (60.0::DOUBLE * 0.7::DOUBLE - 60.0::DOUBLE * 0.3::DOUBLE) * k / 40 AS x FROM range(41) r(k)), p AS (SELECT page, count(*) AS n FROM words GROUP BY page),
        c AS (SELECT p.page, p.n, k.k, k.x, (SELECT count(*) FROM words w WHERE w.page = p.page AND w.x0 < k.x AND k.x < w.x1) AS c FROM p, k),
        m AS (SELECT page, n, arg_min(x, (c, abs(x - 30.0), k)) AS x, min(c) AS best, median(c) AS med FROM c GROUP BY page, n)
        SELECT page, CAST(round(x * 1000000) AS BIGINT) AS split_x, CAST(round(round(greatest(0.0, least(1.0, 1 - best / CASE WHEN med = 0 THEN 1.0 ELSE med END)), 3) * 1000000) AS BIGINT) AS gutter_conf, n AS n_words FROM m""",
    "column_sides": f"WITH {WORDS} SELECT page, CASE WHEN (x0 + x1) / 2 < 30 THEN 'colL' ELSE 'colR' END AS region, count(*) AS n FROM words GROUP BY 1, 2",
    "interval_overlap": f"""WITH {WORDS}, l AS (SELECT *, row_number() OVER () AS i FROM words), s AS (SELECT page, x0 + 2 AS y0, x0 + 3 AS y1, CAST(l_orderkey % 17 + 1 AS DOUBLE) AS size FROM l WHERE l_linenumber = 1),
        b AS (SELECT page, median(size) AS body FROM s GROUP BY page)
        SELECT l.page, l.l_orderkey, l.l_linenumber, CAST(trunc(coalesce(max(s.size), max(coalesce(b.body, 0)))) AS BIGINT) AS max_size FROM l LEFT JOIN b ON l.page = b.page
        LEFT JOIN s ON l.page = s.page AND NOT (s.y1 < l.x0 OR s.y0 > l.x1) GROUP BY 1, 2, 3, l.i""",
    "region_assign": """WITH l AS (SELECT o_custkey // 8 AS page, o_orderkey AS line_id, o_orderkey % 97 AS cx, o_custkey % 89 AS cy FROM orders),
        r AS (SELECT p_partkey // 8 AS page, p_partkey AS position, p_partkey % 40 AS x0, p_partkey % 30 AS y0, p_partkey % 40 + 50 AS x1, p_partkey % 30 + 40 + p_partkey % 3 AS y1 FROM part)
        SELECT l.page, l.line_id, arg_min(r.position, ((r.x1 - r.x0) * (r.y1 - r.y0), r.position)) AS region_position FROM l
        LEFT JOIN r ON l.page = r.page AND l.cx BETWEEN r.x0 AND r.x1 AND l.cy BETWEEN r.y0 AND r.y1 GROUP BY l.page, l.line_id""",
    "layout_order": f"""WITH {WORDS} SELECT page, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY page ORDER BY coalesce(CASE WHEN l_linenumber < 3 THEN l_linenumber END, 9999),
        round_even(l_orderkey % 13 * 3 / 10.0, 0), l_orderkey * 10.0 + l_linenumber) AS reading_no FROM words""",
    "polygon_boxes": """SELECT c_custkey, CAST(least(c_custkey % 7, c_custkey % 11, c_custkey % 13) AS BIGINT) AS x0, CAST(least(c_custkey % 5, c_custkey % 3, c_custkey % 17) AS BIGINT) AS y0,
        CAST(greatest(c_custkey % 7, c_custkey % 11, c_custkey % 13) AS BIGINT) AS x1, CAST(greatest(c_custkey % 5, c_custkey % 3, c_custkey % 17) AS BIGINT) AS y1 FROM customer""",
    "split_pixels": "SELECT o_orderkey, CAST(floor(CAST(o_orderkey % 1000 AS DOUBLE) * 2480 / 595.0::DOUBLE) AS BIGINT) AS px FROM orders",
    "page_numbers": """WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '1936' ELSE o_orderpriority END || '  ' || (o_orderkey % 2000) || '.  1935' AS header FROM orders)
        SELECT o_orderkey, list_filter(list_transform(list_filter(regexp_split_to_array(header, '\\s+'), lambda w: w <> ''), lambda w: regexp_extract(w, '\\b([0-9]{1,4})\\b', 1)),
        lambda n: n <> '' AND n NOT IN ('1934', '1935', '1936'))[1] AS page_number FROM h""",
    "city_carry": """WITH p AS (SELECT s_nationkey, s_suppkey AS page, CASE WHEN s_suppkey % 5 = 0 THEN 'Göteborg' WHEN s_suppkey % 7 = 0 THEN 'Falun' END AS city FROM supplier)
        SELECT page, coalesce(last_value(city IGNORE NULLS) OVER (PARTITION BY s_nationkey ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS city FROM p""",
    "top_groups": """WITH g AS (SELECT c_nationkey, count(*) AS n, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS s FROM customer GROUP BY 1), k AS (SELECT c_nationkey, c_mktsegment AS m, count(*) AS k FROM customer GROUP BY 1, 2),
        b AS (SELECT c_nationkey, arg_min(m, (-k, m)) AS mode, max(k) AS mode_n FROM k GROUP BY 1)
        SELECT g.c_nationkey, n, CAST(floor(s / n) AS BIGINT) AS avg_cents, mode, mode_n FROM g JOIN b ON g.c_nationkey = b.c_nationkey ORDER BY n DESC, g.c_nationkey LIMIT 20""",
    "mode_by_group": """WITH g AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1), k AS (SELECT p_type, p_brand AS m, count(*) AS k FROM part GROUP BY 1, 2),
        b AS (SELECT p_type, arg_min(m, (-k, m)) AS mode, max(k) AS mode_n FROM k GROUP BY 1) SELECT g.p_type, n, mode, mode_n FROM g JOIN b ON g.p_type = b.p_type ORDER BY n DESC, g.p_type LIMIT 30""",
    "percentiles": "WITH c AS (SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS v FROM customer) SELECT min(v) AS least, max(v) AS most, "
    + ", ".join(f"CAST(round(quantile_cont(v, {q / 100}) * 100) AS BIGINT) AS p{q}" for q in analytics.PERCENTILES) + " FROM c",
    "having_topk": """SELECT o_custkey, count(*) AS n, CAST(floor(avg(CAST(round(o_totalprice * 100) AS BIGINT))) AS BIGINT) AS avg_cents FROM orders GROUP BY 1 HAVING count(*) >= 5
        ORDER BY avg(CAST(round(o_totalprice * 100) AS BIGINT)) DESC, o_custkey LIMIT 10""",
    "class_buckets": """WITH c AS (SELECT CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 3000 THEN 'middle' WHEN c_acctbal < 6000 THEN 'upper' ELSE 'high' END AS class FROM customer)
        SELECT class, count(*) AS n, CAST(round(count(*)::DOUBLE / sum(count(*)) OVER () * 1000000) AS BIGINT) AS share FROM c GROUP BY class""",
    "marked_shares": """WITH c AS (SELECT CASE WHEN coalesce(c_mktsegment, '') = '' THEN 'unknown' WHEN regexp_matches(lower(c_mktsegment), 'building|furni') THEN 'female' ELSE 'unmarked' END AS marker FROM customer)
        SELECT marker, count(*) AS n, CAST(round(count(*)::DOUBLE / sum(count(*)) OVER () * 1000000) AS BIGINT) AS share FROM c GROUP BY marker""",
    "completeness": """WITH e AS (SELECT *, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS seg FROM customer) SELECT count(*) AS n, CAST(round(count(*) FILTER (WHERE coalesce(seg, '') <> '')::DOUBLE / count(*) * 1000000) AS BIGINT) AS seg_rate,
        CAST(round(count(*) FILTER (WHERE coalesce(c_name, '') <> '')::DOUBLE / count(*) * 1000000) AS BIGINT) AS c_name_rate, count(DISTINCT seg) AS seg_distinct, count(DISTINCT c_nationkey) AS c_nationkey_distinct FROM e""",
    "extrapolation": "SELECT count(*) AS n, count(DISTINCT l_orderkey) AS pages, CAST(floor(count(*)::DOUBLE / count(DISTINCT l_orderkey) * 417) AS BIGINT) AS expected FROM lineitem",
    "upsert_latest": "SELECT user_id, coalesce(max(event_id) FILTER (WHERE event_id % 2 = 1), max(event_id)) AS event_id FROM events GROUP BY user_id",
    "seeded_split": "SELECT 'eval' AS split, CAST(least(100, count(*)) AS BIGINT) AS n FROM customer UNION ALL SELECT 'train', CAST(count(*) - 100 AS BIGINT) FROM customer HAVING count(*) > 100",
    "selected_pages": "SELECT p_partkey AS page FROM part WHERE p_partkey < 50",
    "image_quality": """WITH k AS (SELECT p_partkey, CAST(p_partkey % 200 AS DOUBLE) AS lap, CAST(p_partkey % 40 AS DOUBLE) AS std, (p_partkey % 12)::DOUBLE / 100 AS ink, (p_partkey % 10)::DOUBLE / 10 AS r FROM part)
        SELECT p_partkey, CAST(round(round((least(lap / 130.0::DOUBLE, 1.0::DOUBLE) * 0.45::DOUBLE + least(std / 28.0::DOUBLE, 1.0::DOUBLE) * 0.35::DOUBLE + least(ink / 0.1::DOUBLE, 1.0::DOUBLE) * 0.2::DOUBLE) * 100, 1) * 10) AS BIGINT) AS score,
        lap < 80 OR std < 19 OR ink < 0.055 AS faded, CASE WHEN r < 0.25 THEN 'ok' WHEN r < 0.55 THEN 'weak' ELSE 'poor' END AS gutter FROM k""",


    "engine_names": "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'dots' WHEN 1 THEN 'surya' WHEN 2 THEN NULL WHEN 3 THEN 'olmocr' ELSE 'new' END AS engine FROM customer",
    "file_stems": "SELECT s_suppkey, 'SSA_' || s_suppkey AS page, CASE WHEN s_suppkey % 2 = 0 THEN 'colL' ELSE 'header' END AS region, CAST(s_suppkey AS VARCHAR) AS year FROM supplier",
    "page_assembly": """WITH k AS (SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_custkey % 2 <> 0 THEN (c_custkey % 100)::DOUBLE / 100 END AS a, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 100)::DOUBLE / 100 END AS b,
        CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 100)::DOUBLE / 100 END AS c FROM customer)
        SELECT CAST(c_custkey AS VARCHAR) AS ssa_id, CASE WHEN c_custkey % 3000 IN (1934, 1935, 1936) THEN '' ELSE CAST(c_custkey % 3000 AS VARCHAR) END AS page_number,
        CAST(round(round(list_avg(list_filter([a, b, c], lambda x: x IS NOT NULL)), 4) * 1000000) AS BIGINT) AS page_confidence, CAST(length(c_name) + length(c_mktsegment) AS BIGINT) AS n_chars FROM k""",
}
