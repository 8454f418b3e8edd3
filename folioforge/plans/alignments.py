"""Queries over alignments of the reads of a region, and SQL that folds over a region's lines with the groups so far as its state."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioforge.functions import patterns as P
from folioforge.operators import consensus
from folioforge.plans.documents import EACH_LINE, ENTROPY, ONE_BYTE, blocks, micro, reads_sql
from folioforge.plans.pages import FORM


def _members(got):
    return got.select("page", F.col("region").cast("long").alias("region"), F.col("slot").cast("long").alias("slot"), "engine", F.md5("text").alias("text"))


def free_alignment(spark, sf):
    return _members(consensus.aligned_lines(blocks(spark, sf)))


def ordered_alignment(spark, sf):
    return _members(consensus.aligned_lines(blocks(spark, sf), ordered=True))


def aligned_regions(spark, sf):
    """Regions of two reads or more: how their lines agree."""
    regions, _ = consensus.analyze_regions(blocks(spark, sf))
    return regions.select(
        "page", F.col("region").cast("long").alias("region"), "n_engines", "n_lines", "n_high_conf_lines", "n_low_conf_lines", "engines", micro(F.round("mean_line_agreement", 9)).alias("mean_line_agreement"),
        micro(F.col("region_mean_sim")).alias("region_mean_sim"),
    )


def fused_lines(spark, sf):
    got = consensus.fuse_regions(blocks(spark, sf))
    return got.select("page", F.col("region").cast("long").alias("region"), F.col("line_idx").cast("long").alias("line_idx"), F.md5("text").alias("text"), "n_votes", micro(F.round("confidence", 9)).alias("confidence"))


QUERIES = {f.__name__: f for f in (free_alignment, ordered_alignment, aligned_regions, fused_lines)}

LIGHT = "trim(regexp_replace(lower({t}), '\\s+', ' ', 'g'))"
BLOCKS = f"""
{EACH_LINE},
blocks AS (
  SELECT doc_id - doc_id % 3 AS page, line_no // 2 AS region, 'e' || (doc_id % 3) AS engine, array_agg(line ORDER BY line_no) AS l FROM each_line GROUP BY ALL),
anchors AS (SELECT page, region, arg_min(engine, (-len(l), engine)) AS anchor FROM blocks GROUP BY ALL)
"""


def _similar(a: str, b: str) -> str:
    return f"(1 - levenshtein({ONE_BYTE.format(t=a)}, {ONE_BYTE.format(t=b)})::DOUBLE / greatest(length({a}), length({b}), 1))"


_FREE_FORM = FORM.format(t="t")
_SHOWN = "trim(regexp_replace(t, '\\s+', ' ', 'g'))"
_ONE = "{'e': engine, 't': t}"
FREE = f"""{BLOCKS},
steps AS (
  SELECT page, region, engine, t, {_FREE_FORM} AS here, row_number() OVER (PARTITION BY page, region ORDER BY engine, k) AS rn
  FROM (SELECT b.page, b.region, engine, unnest(list_transform(l, lambda t: {_SHOWN})) AS t, generate_subscripts(l, 1) AS k FROM blocks b JOIN anchors a ON b.page = a.page AND b.region = a.region WHERE engine <> anchor)),
f(page, region, rn, groups) AS (
  SELECT b.page, b.region, 0, list_transform(l, lambda t: {{'form': {_FREE_FORM}, 'members': [{{'e': engine, 't': {_SHOWN}}}]}}) FROM blocks b JOIN anchors a ON b.page = a.page AND b.region = a.region WHERE engine = anchor
  UNION ALL
  SELECT page, region, rn, CASE WHEN best > {P.ALIGN_SIM}::DOUBLE
      THEN list_transform(groups, lambda g, i: CASE WHEN i = list_position(sims, best) THEN {{'form': g.form, 'members': list_append(g.members, {_ONE})}} ELSE g END)
      ELSE list_append(groups, {{'form': here, 'members': [{_ONE}]}}) END
  FROM (SELECT *, list_max(sims) AS best FROM (
    SELECT s.page, s.region, s.rn, s.engine, s.t, s.here, f.groups,
           list_transform(f.groups, lambda g: CASE WHEN list_contains(list_transform(g.members, lambda m: m.e), s.engine) THEN -1.0::DOUBLE ELSE {_similar('g.form', 's.here')} END) AS sims
    FROM f JOIN steps s ON s.page = f.page AND s.region = f.region AND s.rn = f.rn + 1))),
last_ AS (SELECT page, region, arg_max(groups, rn) AS groups FROM f GROUP BY ALL),
slots AS (SELECT page, region, unnest(groups) AS g, generate_subscripts(groups, 1) - 1 AS slot FROM last_),
members AS (SELECT page, region, slot, m.e AS engine, m.t AS text FROM (SELECT page, region, slot, unnest(g.members) AS m FROM slots))
"""
_MERGED = """flatten(list_transform(range(0, len(groups) + 1), lambda k: list_concat(
      list_transform(list_filter(extra, lambda x: x.place = k), lambda x: {'form': '', 'members': [{'e': x.e, 't': x.t}]}), CASE WHEN k < len(groups) THEN [groups[k + 1]] ELSE [] END)))"""
_FREE_OF = "NOT list_contains(list_transform(g.members, lambda m: m.e), engine)"
ORDERED = f"""{BLOCKS},
steps AS (
  SELECT page, region, engine, t, {LIGHT.format(t='t')} AS here, row_number() OVER (PARTITION BY page, region ORDER BY engine, k) AS rn
  FROM (SELECT b.page, b.region, engine, unnest(l) AS t, generate_subscripts(l, 1) AS k FROM blocks b JOIN anchors a ON b.page = a.page AND b.region = a.region WHERE engine <> anchor)),
f(page, region, rn, engine, groups, place, extra) AS (
  SELECT b.page, b.region, 0, '', list_transform(l, lambda t: {{'form': {LIGHT.format(t='t')}, 'members': [{{'e': engine, 't': t}}]}}), 0::BIGINT, CAST([] AS STRUCT(place BIGINT, e VARCHAR, t VARCHAR)[])
  FROM blocks b JOIN anchors a ON b.page = a.page AND b.region = a.region WHERE engine = anchor
  UNION ALL
  SELECT page, region, rn, engine, CASE WHEN hit >= 0 THEN list_transform(groups, lambda g, i: CASE WHEN i = hit + 1 THEN {{'form': g.form, 'members': list_append(g.members, {_ONE})}} ELSE g END) ELSE groups END,
         CASE WHEN hit >= 0 THEN hit + 1 ELSE place END, CASE WHEN hit >= 0 THEN extra ELSE list_append(extra, {{'place': place, 'e': engine, 't': t}}) END
  FROM (SELECT *, CASE WHEN list_max(ahead) >= {P.SPINE_SIM}::DOUBLE THEN list_position(ahead, list_max(ahead)) - 1 WHEN list_max(back) >= {P.SPINE_SIM}::DOUBLE THEN list_position(back, list_max(back)) - 1 ELSE -1 END AS hit FROM (
    SELECT *, list_transform(sims, lambda x, i: CASE WHEN i - 1 BETWEEN place AND place + {P.SPINE_AHEAD} THEN x ELSE -1.0::DOUBLE END) AS ahead,
              list_transform(sims, lambda x, i: CASE WHEN i - 1 BETWEEN place - {P.SPINE_BACK} AND place - 1 THEN x ELSE -1.0::DOUBLE END) AS back FROM (
      SELECT *, list_transform(groups, lambda g: CASE WHEN {_FREE_OF} AND g.form <> '' THEN {_similar('g.form', 'here')} ELSE -1.0::DOUBLE END) AS sims FROM (
        SELECT s.page, s.region, s.rn, s.engine, s.t, s.here, CASE WHEN s.engine = f.engine THEN groups ELSE {_MERGED} END AS groups,
               CASE WHEN s.engine = f.engine THEN place ELSE 0 END AS place, CASE WHEN s.engine = f.engine THEN extra ELSE [] END AS extra
        FROM f JOIN steps s ON s.page = f.page AND s.region = f.region AND s.rn = f.rn + 1))))),
last_ AS (SELECT page, region, {_MERGED} AS groups FROM (SELECT page, region, arg_max(groups, rn) AS groups, arg_max(extra, rn) AS extra FROM f GROUP BY ALL)),
slots AS (SELECT page, region, unnest(groups) AS g, generate_subscripts(groups, 1) - 1 AS slot FROM last_),
members AS (SELECT page, region, slot, m.e AS engine, m.t AS text FROM (SELECT page, region, slot, unnest(g.members) AS m FROM slots))
"""


def _entropy(form: str, source: str) -> str:
    """The measures of reads that are the members of slots: a place is a region and slot in one number."""
    own = f"""reads AS (SELECT page, region * 1000000 + slot AS region, engine, {form} AS text, {ONE_BYTE.format(t=form)} AS bytes, text AS raw FROM {source}),
pairs AS (""" + reads_sql().partition("pairs AS (")[2]
    return own + ENTROPY.partition(reads_sql())[2]


SQL = {
    "free_alignment": f"WITH RECURSIVE {FREE} SELECT page, region, slot, engine, md5(text) AS text FROM members",
    "ordered_alignment": f"WITH RECURSIVE {ORDERED} SELECT page, region, slot, engine, md5(text) AS text FROM members",
    "aligned_regions": f"""WITH RECURSIVE {FREE}, whole AS (SELECT page, region, 0 AS slot, engine, array_to_string(list_transform(l, lambda t: {_SHOWN}), ' ') AS text FROM blocks),
        all_ AS (SELECT page, region, slot + 1 AS slot, engine, text FROM members UNION ALL FROM whole), {_entropy(_FREE_FORM.replace('(t,', '(text,'), 'all_')},
        lines AS (SELECT page, region // 1000000 AS r, CASE WHEN n >= 2 THEN mean_sim ELSE 0.0 END AS sim, n FROM region WHERE region % 1000000 > 0),
        l AS (SELECT page, r, count(*) AS n_lines, count(*) FILTER (WHERE n >= 2 AND sim >= 0.85) AS high, count(*) FILTER (WHERE sim < 0.6) AS low, coalesce(avg(sim) FILTER (WHERE n >= 2), 0.0) AS m FROM lines GROUP BY 1, 2),
        e AS (SELECT page, region, string_agg(engine, '|' ORDER BY engine) AS engines FROM blocks GROUP BY 1, 2)
        SELECT w.page, e.region, w.n AS n_engines, n_lines, high AS n_high_conf_lines, low AS n_low_conf_lines, engines, CAST(round(round(m, 9) * 1000000) AS BIGINT) AS mean_line_agreement,
        CAST(round(mean_sim * 1000000) AS BIGINT) AS region_mean_sim FROM region w JOIN e ON w.page = e.page AND w.region = e.region * 1000000 JOIN l ON l.page = e.page AND l.r = e.region WHERE w.n >= 2""",
    "fused_lines": f"""WITH RECURSIVE {ORDERED}, {_entropy(LIGHT.format(t='text'), 'members')},
        near AS (SELECT page, region, a, b FROM both_ways WHERE sim >= {P.FUSE_SIM}),
        reach(page, region, engine, other) AS (SELECT page, region, engine, engine FROM reads UNION SELECT r.page, r.region, r.engine, b.b FROM reach r JOIN near b ON r.page = b.page AND r.region = b.region AND r.other = b.a),
        cl AS (SELECT page, region, engine, min(other) AS c FROM reach GROUP BY page, region, engine),
        w AS (SELECT page, region, engine, n, (1 / (entropy + 1e-9)) / sum(1 / (entropy + 1e-9)) OVER (PARTITION BY page, region) AS w FROM each_),
        x AS (SELECT w.page, w.region, w.n, w.w, cl.c, r.raw, sum(w.w) OVER (PARTITION BY w.page, w.region, cl.c) AS total FROM w JOIN cl ON w.page = cl.page AND w.region = cl.region AND w.engine = cl.engine
              JOIN reads r ON w.page = r.page AND w.region = r.region AND w.engine = r.engine),
        e AS (SELECT page, region, count(*) AS n_engines FROM blocks GROUP BY 1, 2)
        SELECT x.page, x.region // 1000000 AS region, x.region % 1000000 AS line_idx, md5(arg_min(raw, (-round(total, 12), c, -round(w, 12), -length(raw), raw))) AS text, max(n) AS n_votes,
        CAST(round(round(CASE WHEN max(n_engines) = 1 THEN 1.0 ELSE max(total) END, 9) * 1000000) AS BIGINT) AS confidence
        FROM x JOIN e ON x.page = e.page AND x.region // 1000000 = e.region GROUP BY x.page, x.region""",
}
