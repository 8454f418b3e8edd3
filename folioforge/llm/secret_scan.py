"""Secret scans with corpus-wide ownership frequency. DataFrame functions throughout.

Every text is scanned for credential assignments, access keys and long hex runs (the base kinds) and
for other tokens that look random (kind ``token``). The hash of each such token is counted over distinct
repositories and distinct owners of the whole corpus: a value that several owners or many repositories hold is a copied
example, a value that stays with its owner in few repositories looks live, and only the latter become spans. Base spans
always stay; the ownership counts of the base values are given beside them. The texts are scanned once: what was found is a
table in the shared folder, from which the counts and the verdicts are made.

Skew: owners and repositories of a value are counted after a partial aggregation by (value, owner,
repository), so a value that a third of the corpus holds is no single task's work.

Defined cases: a null text is empty and has no spans; an empty table gives an empty table; a null owner
or repository is one more owner or repository; repeated rows are scanned each but are one repository; a very long text is scanned
whole; spans that start at one place are in the order of the kinds; extra columns stay, but for those of the names that are made here, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm import _store

# The kinds in their order, with the pattern and the least length of each.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the runs of 32 or more among all maximal runs
TOKEN = r"[A-Za-z0-9_-]{24,}"
KINDS = ("assign", "access", "hex", "token")


#: matches whose places are added up together
RUN = 256


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points.

    The gaps between matches (split) and the matches (regexp_extract_all) alternate, so running sums
    of their lengths give the places. Sums are made in runs of ``RUN`` matches and then over the runs, as an array that grows by
    one match at a time is copied each time. Matches are never empty.
    """
    kind = "array<struct<start:int,end:int,value:string>>"
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / RUN).cast("int")), lambda k: F.slice(pairs, k * RUN + 1, RUN))

    def add(acc, x):
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("value")))).alias("out"))

    def shift(acc, run):
        there = F.transform(run["out"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["value"].alias("value")))
        return F.struct((acc["at"] + run["at"]).alias("at"), F.concat(acc["out"], F.array(there)).alias("out"))

    local = F.transform(runs, lambda r: F.aggregate(r, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), add))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    placed = F.aggregate(local, start, shift, lambda a: F.flatten(a["out"]))
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(F.array().cast(kind))


def _tail(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 2)


def _random_looking(v: Column) -> Column:
    """Digits, small and capital letters mixed (or a key of 32 or more hexadecimal digits), and no dictionary-like run of letters."""
    digits = F.char_length(F.regexp_replace(v, "[^0-9]", ""))
    mixed = F.regexp_like(v, F.lit("[a-z]")) & F.regexp_like(v, F.lit("[A-Z]"))
    return (digits >= 3) & (mixed | F.regexp_like(v, F.lit("^[0-9A-F]{32,}$"))) & ~F.regexp_like(v, F.lit("[A-Za-z]{13,}"))


def scan(text: Column) -> dict[str, Column]:
    """Spans of each kind in ``text``; ``token`` are candidates only."""
    assign = F.filter(_matches(text, ASSIGN), lambda x: F.char_length(_tail(x["value"])) >= 8)
    access = F.filter(_matches(text, ACCESS), lambda x: F.char_length(x["value"]) >= 16)
    token = F.filter(_matches(text, TOKEN), lambda x: _random_looking(x["value"]))
    return {"assign": assign, "access": access, "hex": _matches(text, HEX), "token": token}


def _value(kind: str, x: Column) -> Column:
    return _tail(x["value"]) if kind == "assign" else x["value"]


def secret_scan(
    docs: DataFrame,
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    max_owners: int = 1,
    max_repos: int = 8,
) -> DataFrame:
    """``docs`` with column ``secrets``: array<struct<kind, start, end, hash, n_repos, n_owners, live>>, by place.

    ``token`` candidates that overlap a base span or are not live are left out. ``live``: at most ``max_owners`` owners and
    ``max_repos`` repositories hold the value. ``repo_col`` and ``owner_col`` are the table's columns of both; where it has no
    repositories, a document counts as one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    made = scan(text)

    def spans(kind):
        order = KINDS.index(kind)
        return F.transform(
            F.col(f"m.{kind}"),
            lambda x: F.struct(
                x["start"].alias("start"),
                F.lit(order).alias("ord"),
                x["end"].alias("end"),
                F.xxhash64(_value(kind, x)).alias("h1"),
                F.xxhash64(F.lit(1), _value(kind, x)).alias("h2"),
            ),
        )

    key = [F.coalesce(F.xxhash64(F.col(f"`{repo_col}`")), F.lit(0)).alias("k1"), F.xxhash64(F.col(f"`{text_col}`")).alias("k2")]
    owned = docs.select(
        *key,
        F.col(f"`{repo_col}`").alias("repo"),
        F.col(f"`{owner_col}`").alias("owner"),
        F.struct(*[c.alias(k) for k, c in made.items()]).alias("m"),
    )
    base = F.array_sort(F.concat(spans("assign"), spans("access"), spans("hex")))
    outside = F.filter(
        spans("token"),
        lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    found = (
        owned.select("k1", "k2", "repo", "owner", "m", base.alias("base"))
        .select("k1", "k2", "repo", "owner", F.explode(F.concat(F.col("base"), outside)).alias("s"))
        .select("k1", "k2", "repo", "owner", "s.*")
    )
    found = _store.written(found, _store.shared_dir(docs.sparkSession), "found")
    # distinct (value, owner, repository) first, then counts: partial sums at every step
    once = found.groupBy("h1", "h2", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = once.groupBy("h1", "h2", "owner").agg(F.count("one").alias("repos"))
    counted = (
        per_owner.groupBy("h1", "h2")
        .agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
        .select(F.col("h1").alias("v1"), F.col("h2").alias("v2"), "n_repos", "n_owners")
    )
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("ord") + 1)
    judged = (
        found.select("k1", "k2", "ord", "start", "end", "h1", "h2")
        .distinct()
        .join(counted, (F.col("h1") == F.col("v1")) & (F.col("h2") == F.col("v2")))
        .where((F.col("ord") < KINDS.index("token")) | live)
        .groupBy("k1", "k2")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "start", "ord", "end", kind.alias("kind"), F.hex("h1").alias("hash"), "n_repos", "n_owners",
                        live.alias("live"),
                    )
                )
            ).alias("secrets")
        )
        .select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), "secrets")
    )
    keep = [c for c in docs.columns if c.lower() != "secrets"]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *key)
    none = F.array().cast(judged.schema["secrets"].dataType)
    return row.join(judged, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left").select(
        "row.*", F.coalesce("secrets", none).alias("secrets")
    )


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    got = secret_scan(docs)
    base = F.filter("secrets", lambda s: s["kind"] != "token")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    def said(spans):
        place = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, place), ",")

    live = F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("n_live")
    return got.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("secrets")).alias("spans"), live,
    )


def _sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    assign = quoted(ASSIGN)
    each = " UNION ALL ".join(
        f"SELECT doc_id, source, {k} AS ord, string_split_regex(t, {quoted(p)}) AS gaps, regexp_extract_all(t, {quoted(p)}) AS hits FROM d WHERE regexp_matches(t, {quoted(p)})"
        for k, p in enumerate((ASSIGN, ACCESS, HEX, TOKEN))
    )
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
runs AS ({each}),
hits AS (SELECT doc_id, source, ord, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM runs),
placed AS (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, ord ORDER BY i) AS BIGINT) AS e FROM hits),
valued AS (SELECT doc_id, source, ord, e - length(hit) AS s, e, CASE WHEN ord = 0 THEN regexp_extract(hit, {assign}, 2) ELSE hit END AS v FROM placed),
good AS (
  SELECT * FROM valued WHERE CASE ord WHEN 0 THEN length(v) >= 8 WHEN 1 THEN length(v) >= 16 WHEN 2 THEN TRUE
    ELSE length(regexp_replace(v, '[^0-9]', '', 'g')) >= 3 AND NOT regexp_matches(v, '[A-Za-z]{{13,}}')
         AND ((regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')) OR regexp_matches(v, '^[0-9A-F]{{32,}}$')) END),
found AS (
  SELECT * FROM good WHERE ord < 3 UNION ALL
  SELECT * FROM good t WHERE ord = 3 AND NOT EXISTS (FROM good b WHERE b.ord < 3 AND b.doc_id = t.doc_id AND b.s < t.e AND t.s < b.e)),
counted AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (coalesce(source, chr(0)), doc_id)) AS repos FROM found GROUP BY v),
judged AS (SELECT f.*, owners <= 1 AND repos <= 8 AS live, ['assign', 'access', 'hex', 'token'][ord + 1] || ':' || s || ':' || e AS said FROM found f JOIN counted c ON f.v = c.v),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access, count(*) FILTER (WHERE ord = 2) AS n_hex,
         string_agg(said, ',' ORDER BY s, ord) FILTER (WHERE ord < 3) AS base, string_agg(said, ',' ORDER BY s, ord) AS spans, count(*) FILTER (WHERE live) AS n_live
  FROM judged WHERE ord < 3 OR live GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live FROM d LEFT JOIN per_doc p ON d.doc_id = p.doc_id
"""


SQL = _sql()
