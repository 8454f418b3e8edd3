import pytest
from folioforge.functions import similarity as S
from folioforge.functions import text as X
from folioforge.operators import analytics, assembly, evaluation, sampling
from pyspark.sql import functions as F


def one(spark, column, *values):
    names = [f"c{k}" for k in range(len(values))]
    return spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(column(*map(F.col, names))).first()[0]


def test_scores(spark):
    ref, hyp = "Aa, B., x, 10–20\nCc, D., y, 30–40", "Aa B. x 10–20\nCc, D., y, 30 40"
    rows = spark.createDataFrame([(ref, hyp), ("", ""), ("", "x")], "r string, h string")
    a, b, c = (r.asDict() for r in rows.select(*[v.alias(k) for k, v in evaluation.score(F.col("r"), F.col("h")).items()]).collect())
    assert (a["comma_recall"], a["comma_precision"], a["dash_recall"], a["digit_recall"], a["field_count_ratio"]) == (0.5, 1.0, 0.5, 1.0, 0.5)
    assert a["comma_f1"] == pytest.approx(0.6667, abs=1e-4) and a["cer"] == pytest.approx(4 / 33)
    assert all(b[m] == 1.0 for m in ("comma_recall", "comma_precision", "comma_f1", "dash_recall", "digit_recall", "field_count_ratio")) and b["cer"] == 0
    assert c["cer"] == 1


def test_leaderboard(spark):
    reads = spark.createDataFrame([("p1", "x", "```\nEk, A., O, 900–800 and some more text here\n```"), ("p1", "y", "Ek A O 900 800"), ("p2", "x", "short")], "page_id string, engine string, text string")
    refs = spark.createDataFrame([("1912", "p1", "Ek, A., O, 900–800 and some more text here"), ("1912", "p2", "short")], "year string, page_id string, reference string")
    got = evaluation.leaderboard(reads, refs, refs.select("year", "page_id")).orderBy("rank").collect()
    assert [(r["engine"], r["n"]) for r in got] == [("x", 1), ("y", 1)] and got[0]["cer"] == 0


def test_scalars(spark):
    assert one(spark, X.page_number, "1936  Riksdelen  12") == "12"
    assert one(spark, X.page_number, "13  Orten  1936") == "13"
    assert one(spark, X.page_number, "1936") is None
    for t, n in (("", 0), ("a", 1), ("a\n", 1), ("a\nb", 2)):
        assert one(spark, X.read_line_count, t) == n
    assert one(spark, X.compare_form, "Ek —  <math>ÅÄ</math> x") == "ek - åä x"
    assert one(spark, X.canonical_engine, "Dots.OCR") == "dots" and one(spark, X.canonical_engine, "quality") is None and one(spark, X.canonical_engine, "New") == "new"
    assert one(spark, X.lines, " a \r\n\r b\n") == ["a", "b"]
    assert one(spark, X.is_protected, "(12)") and one(spark, X.is_protected, "K.") and not one(spark, X.is_protected, "Karl") and not one(spark, X.is_protected, "..")
    assert one(spark, X.clean_markup, "---\na: b\n---\n<td>x &amp; y</td>") == " x & y "
    assert one(spark, lambda c: X.byte_chunks(c, 6), "aa bb cc dddddddd e") == ["aa bb", "cc", "dddddddd", "e"]
    assert one(spark, S.accepted, "abc", "completely different text here") == "abc" and one(spark, S.accepted, "Stokholm by", "Stockholm by") == "Stockholm by"
    assert one(spark, S.matcher_ratio, "abcd", "bcde") == pytest.approx(0.75)
    r = [x[0] for x in spark.createDataFrame([('"t"',), ('{"text": "u", "confidence": 0.5}',), (None,), ("null",)], "v string").select(X.region_value(F.col("v"))).collect()]
    assert [(x["text"], x["confidence"]) for x in r] == [("t", None), ("u", 0.5), ("", None), ("", None)]


def test_assembly(spark):
    lines = spark.createDataFrame([("p1", "colL", 0, "b", 0.5), ("p1", "colL", 1, "a", 0.7)], "page string, region string, line_idx int, text string, agreement double")
    reads = spark.createDataFrame([("p1", "header", "z", "12 Riks 1936"), ("p1", "header", "y", "other"), ("p1", "colL", "y", "q")], "page string, region string, engine string, text string")
    got = assembly.page_records(assembly.fused_pages(lines, reads, "dots", ["y", "z"]))
    r = got.first()
    assert r["columns"]["colL"]["text"] == "b\na" and r["header"]["text"] == "other" and r["page_confidence"] == 0.6 and r["n_chars"] == 3
    assert r["page_number"]["source"] == "none" and assembly.page_index(got).first()["header_conf"] is None
    assert "### left column (confidence 0.6000)\nb\na" in assembly.render_pages(got).first()["markdown"]


def test_samples(spark):
    df = spark.range(23).withColumn("x", F.col("id") * 2)
    assert sorted(r["id"] for r in sampling.systematic(df, ["id"], 5).collect()) == [0, 4, 8, 12, 16]
    assert sorted(r["id"] for r in sampling.even_stride(df, ["id"], 5).collect()) == [int(i * 23 / 5) for i in range(5)]
    assert sampling.even_stride(df, ["id"], 50).count() == 23
    assert sampling.seeded_split(df, "id", 7).where("split = 'eval'").count() == 7
    new = spark.createDataFrame([(3, 99), (40, 1)], "id long, x long")
    up = {r["id"]: r["x"] for r in sampling.latest(df, new, ["id"]).collect()}
    assert up[3] == 99 and up[40] == 1 and len(up) == 24
    assert sampling.todo(df, new, ["id"], F.col("x") - 1).count() == 22


def test_analytics(spark):
    df = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 20.0), ("a", "y", None), ("b", "x", 5.0), (None, "x", 1.0)], "g string, o string, v double")
    got = [tuple(r) for r in analytics.profile_groups(df, "g", "v", "o", 5).collect()]
    assert got == [("a", 3, 15.0, "y", 2), ("b", 1, 5.0, "x", 1)]
    d = analytics.distribution(df, "v").first()
    assert d["coverage"] == 0.8 and d["p50"] == 7.5
    assert {r["class"]: r["n"] for r in analytics.shares(df, analytics.income_class(F.col("v"), (6, 11), ("l", "m", "h"))).collect()} == {"l": 2, "m": 1, "h": 1, None: 1}
