"""Line dedup: lines that many documents share are kept in one document only. DataFrame functions throughout.

Each document's lines are exploded, normalised and hashed (two 64-bit hashes with different seeds,
so 128 bits); distinct documents are counted for each hash; hashes over the threshold are joined
back, and each text is put together again from the positions that stay.

Skew: a line may lie in a third of all documents. The distinct count is aggregated by (hash, document)
first, so no task gathers the documents of one line; the join back is left to adaptive skew splitting,
because the table of frequent hashes has one row for each of them.

Defined cases: a null text is one empty line and stays null; an empty table gives an empty
table; a null document id counts as one more document, smaller than all others; repeated rows of one
id count as one document and are each cut alike; a very long text is split whole, and its lines travel as hashes; the
largest id keeps a line however often it holds it; extra columns stay, but for those of the names that are made here, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20
) -> DataFrame:
    """``docs`` with shared lines cut from the text, and columns n_lines and n_dropped.

    A line of at least ``min_chars`` code points whose key lies in at least ``min_docs`` documents is
    dropped everywhere except in the document with the largest id that holds it.
    """
    spark_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(
        spark_row,
        F.col(f"`{id_col}`").alias("id"),
        F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "\n", -1).alias("lines"),
    )
    # the id alone is no key where rows repeat: two texts of one id are told apart by their hash
    row_key = [F.coalesce(F.xxhash64(F.col("id")), F.lit(0)).alias("k1"), F.xxhash64(F.col(f"row.`{text_col}`")).alias("k2")]
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    line = (
        slim.select(
            F.col("id"),
            F.coalesce(F.xxhash64("id"), F.lit(0)).alias("k1"),
            F.xxhash64("text").alias("k2"),
            F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("pos", "line"),
        )
        .select("id", "k1", "k2", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "k1", "k2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))
    )
    # (hash, document) first: a hot line is spread over as many tasks as there are documents
    frequent = (
        line.groupBy("h1", "h2", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n"), F.max("id").alias("last_id"))
        .where(F.col("n") >= min_docs)
        # no longer the grouping columns themselves: the join gets exchanges of its own, which skew splitting can cut
        .select(F.col("h1").bitwiseXOR(F.lit(0)).alias("f1"), F.col("h2").bitwiseXOR(F.lit(0)).alias("f2"), "last_id")
    )
    dropped = (
        line.join(frequent, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")))
        .where(~F.col("id").eqNullSafe(F.col("last_id")))
        .groupBy("k1", "k2")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), "gone")
    )
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    joined = base.select("row", "id", "lines", *row_key).join(
        dropped, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left"
    )
    text = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(kept)
    made = {"n_lines", "n_dropped"}
    out = [
        (text if c == text_col else F.col(f"row.`{c}`")).alias(c)
        for c in docs.columns
        if c == text_col or c.lower() not in made
    ]
    return joined.select(
        *out,
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = line_dedup(docs)
    return got.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
frequent AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.last_id AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
