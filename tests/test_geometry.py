import pytest
from folioforge.operators import geometry as G
from pyspark.sql import functions as F


def test_gutter(spark):
    pages = spark.createDataFrame([(1, 100.0), (2, 100.0)], "page int, width double")
    words = spark.createDataFrame([(1, 5.0, 45.0)] * 2 + [(1, 55.0, 95.0)] * 2, "page int, x0 double, x1 double")
    got = {r["page"]: (r["split_x"], r["gutter_conf"], r["n_words"]) for r in G.gutters(pages, words, ["page"]).collect()}
    assert got == {1: (50.0, 1.0, 4), 2: (50.0, 0.0, 0)}


@pytest.mark.parametrize(
    "line, size, tag",
    [("– Karl, 500", 30.0, "ditto"), ("Ek, A., O, 900–800", 10.0, "entry"), ("Ek, A., O, 900–800", 17.0, "ad"), ("KRONOR", 10.0, "ad"), ("ab", 10.0, "ad"), ("sida", 10.0, "other"), ("  ", 10.0, "blank")],
)
def test_tags(spark, line, size, tag):
    df = spark.createDataFrame([(line, size)], "t string, s double")
    assert df.select(G.tag_line(F.col("t"), F.col("s"), F.lit(10.0))).first()[0] == tag


def test_clusters(spark):
    rows = [(1, 10.0 * k, y, 10.0 * k + 5, y + 10, f"w{k}") for k, y in enumerate([0.0, 5.0, 8.0, 15.0])]
    got = G.cluster_lines(spark.createDataFrame(rows, "page int, x0 double, y0 double, x1 double, y1 double, t string"), ["page"])
    assert [r["text"] for r in got.orderBy("line_no").collect()] == ["w0 w1 w2", "w3"]
    G.register_functions(spark)
    sql = "SELECT * FROM cluster_lines(array(0d, 5d, 8d, 15d), array(0d, 10d, 20d, 30d), array(10d, 10d, 10d, 10d), array('w0', 'w1', 'w2', 'w3'))"
    assert [r["text"] for r in spark.sql(sql).collect()] == ["w0 w1 w2", "w3"]


def test_pages_to_records(spark):
    words, spans = [], []
    for k in range(24):
        for x, t in ((5.0, f"Ek{k},"), (15.0, "A., O,"), (25.0, "900–800")):
            words.append((x, 20.0 * k, x + 8, 20.0 * k + 10, t, 0, k, 0))
        words.append((60.0, 20.0 * k, 90.0, 20.0 * k + 10, f"– Karl, {500 + k}", 1, k, 0))
        spans.append((5.0, 20.0 * k, 90.0, 20.0 * k + 10, 10.0, "x"))
    pages = spark.createDataFrame([(1, 1912, "v", [100.0, 500.0], words, spans), (2, 1912, "v", [100.0, 500.0], [], [])], G.PAGE)
    gutter, lines = G.split_pages(pages)
    stats = {r["page"]: r for r in G.page_stats(gutter, lines).collect()}
    assert (stats[1]["n_lines"], stats[1]["n_entry"], stats[1]["income_clean"], stats[1]["is_body"]) == (48, 48, 24, 1)
    assert stats[2]["is_body"] == 0 and stats[2]["gutter_conf"] == 0.0 and len(stats[1]["surnames"]) == 0
    summary = G.volume_summary(G.page_stats(gutter, lines)).first()
    assert (summary["pages"], summary["body_pages"], summary["entries"]) == (2, 1, 48)


def test_regions(spark):
    lines = spark.createDataFrame([(1, 0, 5.0, 5.0), (1, 1, 50.0, 50.0)], "page int, line_id int, cx double, cy double")
    regions = spark.createDataFrame([(1, 0, "page", 0.0, 0.0, 40.0, 40.0), (1, 1, "box", 0.0, 0.0, 10.0, 10.0), (1, 2, "late", 0.0, 0.0, 10.0, 10.0)], "page int, position int, label string, x0 double, y0 double, x1 double, y1 double")
    got = {r["line_id"]: (r["region_position"], r["region_label"]) for r in G.assign_regions(lines, regions, ["page"]).collect()}
    assert got == {0: (1, "box"), 1: (None, None)}
