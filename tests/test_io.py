import json
import os

import numpy as np
import pytest
from folioforge.operators import geometry, images, models
from folioforge.sources import readers, sinks
from folioforge.streaming import incremental
from pyspark.sql import functions as F


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_volumes(spark, tmp_path):
    put(f"{tmp_path}/v.json", json.dumps({"volumes": [{"volume_id": "a_1912", "year": 1912, "kind": "ocr_pdf", "n_pages": 3}, {"volume_id": "b", "kind": "x"}]}))
    row = readers.volume(spark, f"{tmp_path}/v.json", "a_1912")
    assert row["n_pages"] == 3 and row["image_dir"] is None and readers.route(row) == "text_layer"
    with pytest.raises(KeyError):
        readers.volume(spark, f"{tmp_path}/v.json", "c")
    with pytest.raises(ValueError):
        readers.route({"kind": "x"})


def test_reads(spark, tmp_path):
    put(f"{tmp_path}/reads/dots.ocr/SSA_1_colL.txt", "canonical")
    put(f"{tmp_path}/reads/quality/SSA_1_colL.txt", "no engine")
    put(f"{tmp_path}/reads/Other/SSA_1.txt", b"bad \xff byte")
    put(f"{tmp_path}/reads/surya/SSA_2.txt", "wins")
    put(f"{tmp_path}/regions/SSA_2_surya_text.txt", "loses")
    put(f"{tmp_path}/regions/SSA_2_surya_layout.txt", "no engine")
    got = {(r["page"], r["region"], r["engine"]): r["text"] for r in readers.discover_reads(spark, f"{tmp_path}/reads", f"{tmp_path}/regions").collect()}
    assert got == {("SSA_1", "colL", "dots"): "canonical", ("SSA_1", "", "other"): "bad � byte", ("SSA_2", "", "surya"): "wins"}
    one = {r["engine"]: r["text"] for r in readers.region_reads(spark, f"{tmp_path}/reads", "SSA_1", "colL", ["dots.ocr"]).collect()}
    assert one == {"dots.ocr": "canonical"}
    ids = readers.page_ids(spark.createDataFrame([("p_1_colL",), ("p_1_colR",), ("p_2_colL",)], "stem string"))
    assert [r[0] for r in ids.collect()] == ["p_1", "p_2"]


def test_eval_reads(spark, tmp_path):
    put(f"{tmp_path}/_vlm/p1__m__x.txt", "vlm")
    put(f"{tmp_path}/eng/p1.txt", "plain")
    put(f"{tmp_path}/_skip/p1.txt", "no")
    got = {(r["engine"], r["page_id"]): r["text"] for r in readers.eval_reads(spark, str(tmp_path)).collect()}
    assert got == {("m__x", "p1"): "vlm", ("eng", "p1"): "plain"}


def test_text_layer(spark, tmp_path):
    put(f"{tmp_path}/a.pdf", "x")
    opened = lambda content: [{"page": 0, "rect": [10, 20], "words": [(0.04, 1, 2, 3, "w", 0, 0, 0), (0, 1, 2, 3, " ", 0, 0, 1)], "blocks": [{"type": 0, "lines": [{"spans": [{"bbox": (1, 2, 3, 4), "size": 9, "text": "s"}]}]}, {"type": 1}]}]
    r = readers.text_layer(spark, str(tmp_path), opened).first()
    assert len(r["words"]) == 1 and r["words"][0]["x0"] == 0.0 and r["spans"][0]["size"] == 9.0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("p1", 1.5, ["a"])], "page string, v double, l array<string>")
    sinks.write_csv(df, f"{tmp_path}/c", ["page"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").first()["page"] == "p1"
    schema = "page string, v long"
    for rows in ([("p1", 1), ("p2", 2)], [("p2", 3)], [("p3", 4)]):
        sinks.upsert(spark.createDataFrame(rows, schema), f"{tmp_path}/u", ["page"])
    assert {r["page"]: r["v"] for r in sinks.current(spark, f"{tmp_path}/u").collect()} == {"p1": 1, "p2": 3, "p3": 4}
    pages = spark.createDataFrame([(1, 1912, "v", [1.0, 2.0], [], [])], geometry.PAGE)
    sinks.write_pages(pages, f"{tmp_path}/pages")
    assert readers.pages(spark, f"{tmp_path}/pages").first()["rect"] == [1.0, 2.0]
    split = spark.createDataFrame([("a", "poor", True, None), ("b", "ok", False, None), ("c", "ok", True, None), ("d", None, None, "boom")], "page string, gutter_conf string, has_header boolean, error string")
    assert [(r["page"], r["reason"]) for r in sinks.failures(split).collect()] == [("a", "gutter_poor"), ("b", "no_header"), ("d", "exception")]


def test_incremental(spark, tmp_path):
    src = f"{tmp_path}/src"
    for k, rows in enumerate([[("p1", 1)], [("p1", 5), ("p2", 2)]]):
        spark.createDataFrame(rows, "page string, v long").coalesce(1).write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        incremental.process_new(spark, src, schema, f"{tmp_path}/t", f"{tmp_path}/ck", ["page"], lambda d: d.withColumn("v", F.col("v") * 10))
    assert {r["page"]: r["v"] for r in sinks.current(spark, f"{tmp_path}/t").collect()} == {"p1": 50, "p2": 20}


def page_image():
    r = np.random.default_rng(0)
    img = np.full((600, 400), 235, dtype=np.uint8)
    for y in range(36, 44):
        img[y, 40:360] = 30
    for y in range(100, 560, 12):
        for x0, x1 in ((20, 185), (215, 380)):
            img[y : y + 5, x0:x1] = np.where(r.random((5, x1 - x0)) < 0.7, 30, 235)
    return img


def test_images(spark):
    img = page_image()
    assert abs(images.skew_by_projection(images.rotate(img, 2.0, 235)) + 2.0) <= 0.3
    df = spark.createDataFrame([("p1", bytearray(img.tobytes())), ("p2", bytearray(b"x"))], "page string, content binary")
    got = {r["page"]: r for r in images.split_pages(df, lambda b: np.frombuffer(b, dtype=np.uint8).reshape(600, 400), method="otsu").collect()}
    assert 185 <= got["p1"]["split_x"] <= 215 and got["p1"]["gutter_conf"] == "ok" and got["p1"]["header_status"] == "ok" and 44 <= got["p1"]["header_end"] <= 78
    assert got["p2"]["error"].startswith("ValueError")
    s = spark.range(1).select(images.quality_score(F.lit(65.0), F.lit(14.0), F.lit(0.05)), images.is_faded(F.lit(65.0), F.lit(14.0), F.lit(0.05))).first()
    assert tuple(s) == (50.0, True)
    assert images.text_bands(np.array([0, 1, 1, 0, 1, 0, 0, 1], dtype=bool), 1) == [(1, 4), (7, 7)]
    assert images.smooth(np.ones(5), 3).tolist() == pytest.approx([2 / 3, 1, 1, 1, 2 / 3])
    lonely = np.full((5, 5), 255, np.uint8)
    lonely[1, 1] = 0
    lonely[2:4, 2:4] = 0
    assert (images.despeckle(lonely) == 0).sum() == 4


def test_models(spark):
    crops = spark.createDataFrame([("p", "colL", bytearray(b"abc"))], "page string, region string, content binary")
    registry = {"up": lambda: lambda b: b.decode().upper(), "bad": lambda: lambda b: 1 / 0, "cat": models.command_engine(["cat"])}
    got = {r["engine"]: (r["status"], r["text"]) for r in models.run_engines(crops, ["up", "bad", "cat", "none"], registry).collect()}
    assert got == {"up": ("OK", "ABC"), "bad": ("ERROR", None), "cat": ("OK", "abc")}
    assert models.restore_protected("Karl K. 12500 kr", "Carl X. 12600 kr") == "Carl K. 12500 kr"
    assert models.restore_protected("a 12 b", "a b") == "a 12 b"
    df = spark.createDataFrame([("Stokholm by 12\n\nA.",), (None,)], "text string")
    fixed = [r["corrected"] for r in models.correct_texts(df, lambda: lambda t: t.replace("Stokholm", "Stockholm").replace("12", "13")).collect()]
    assert fixed == ["Stockholm by 12\n\nA.", None]
    cand = spark.createDataFrame([("p", "a", "x", None), ("p", "b", "y", None), ("q", "a", "x", None)], "page_id string, engine string, text string, image binary")
    out = models.mediate(cand, lambda: lambda q, i: q.splitlines()[-1], "choose").collect()
    assert [(r["page_id"], r["text"]) for r in out] == [("p", "y")]
