import json
import os

import numpy as np
from folioforge.plans import volume
from folioforge.sources import readers, sinks

from .test_io import page_image, put


def opened(content):
    """A body page of two columns, and a title page."""
    words, spans = [], [{"bbox": (10, 1, 60, 9), "size": 14, "text": "GÖTEBORG 1912"}]
    for k in range(24):
        y = 100 + 20 * k
        for x, t in ((5.0, f"Ek{chr(97 + k)},"), (15.0, "A., handl., O.,"), (25.0, "900–800")):
            words.append((x, y, x + 8, y + 10, t, 0, k, 0))
        words.append((60.0, y, 90.0, y + 10, f"– Karl, E., {500 + k}–", 1, k, 0))
        spans.append({"bbox": (5, y, 90, y + 10), "size": 10, "text": "x"})
    rect = [100.0, 700.0]
    yield {"page": 0, "rect": rect, "words": [], "blocks": []}
    yield {"page": 1, "rect": rect, "words": words, "blocks": [{"type": 0, "lines": [{"spans": spans}]}]}


def test_text_layer(spark, tmp_path):
    put(f"{tmp_path}/in/a.pdf", "x")
    put(f"{tmp_path}/v.json", json.dumps({"volumes": [{"volume_id": "tax_1912", "year": 1912, "kind": "ocr_pdf", "n_pages": 2}]}))
    out = f"{tmp_path}/out"
    qa = volume.run_volume(spark, f"{tmp_path}/v.json", "tax_1912", f"{tmp_path}/in", out, open_pages=opened)
    assert qa["records"] == 48 and qa["continuation_surnames"] == 24 and qa["cities"] == ["Göteborg"] and qa["pct_with_income"] == 1
    got = spark.read.parquet(f"{out}/records/records").orderBy("record_id").collect()
    assert got[0]["record_id"] == "K1912_000001" and got[0]["surname"] == "Eka" and got[0]["municipal_income"] == 900
    assert {r["surname"] for r in got if r["region"] == "colR"} == {"Ekx"}  # carried over the column border
    assert spark.read.json(f"{out}/quality_summary").first()["body_pages"] == 1


def test_images_twice(spark, tmp_path):
    put(f"{tmp_path}/v.json", json.dumps({"volumes": [{"volume_id": "s_1936", "year": 1936, "kind": "image_scans"}]}))
    put(f"{tmp_path}/in/SSA_1.jpg", page_image().tobytes())
    decode = lambda b: np.frombuffer(b, dtype=np.uint8).reshape(600, 400)
    options = {"decode": decode, "engines": ["size"], "loaders": {"size": lambda: lambda b: str(len(b))}}
    run = lambda: volume.run_volume(spark, f"{tmp_path}/v.json", "s_1936", f"{tmp_path}/in", f"{tmp_path}/out", **options)
    assert run()["pages"] == 1
    put(f"{tmp_path}/in/SSA_2.jpg", "broken")
    assert run() == {"pages": 2, "failures": 1}
    reads = spark.read.parquet(f"{tmp_path}/out/reads").collect()
    assert {(r["page"], r["region"]) for r in reads} == {("SSA_1", "header"), ("SSA_1", "colL"), ("SSA_1", "colR")}


def test_reads_to_documents(spark, tmp_path):
    rows = [
        ("p1", "colL", "dots", "Almqvist, K., direktör, O, 12500–11000\n– Anna, fröken, E, 4200–"), ("p1", "colL", "tess", "Almqvist, K., direktor, O, 12500-11000\nxx"),
        ("p1", "colR", "dots", "– – Djursholm, –5100"), ("p1", "colR", "tess", "zzz"), ("p1", "header", "tess", "12 Riksdelen 1936"),
    ]
    reads = spark.createDataFrame(rows, "page string, region string, engine string, text string")
    pages = volume.assemble(reads, "dots", ["tess"], f"{tmp_path}/a").first()
    assert pages["page_number"]["text"] == "12" and pages["header"]["confidence"] is None and pages["n_chars"] > 60
    got = spark.read.parquet(f"{tmp_path}/a/records/records").orderBy("record_id").collect()
    assert [(r["surname"], r["given_names"], r["location"]) for r in got] == [("Almqvist", "K.", "O"), ("Almqvist", "Anna", "E"), ("Almqvist", "Anna", "Djursholm")]
    assert os.path.isdir(f"{tmp_path}/a/documents/master") and spark.read.option("header", True).csv(f"{tmp_path}/a/flagged").count() >= 1
    report = volume.agreement(reads, f"{tmp_path}/b")
    assert "| dots |" in report and "## Disagreements" in report
    refs = spark.createDataFrame([("1912", "p1", rows[0][3])], "year string, page_id string, reference string")
    board = volume.bakeoff(reads.where("region = 'colL'").selectExpr("page AS page_id", "engine", "text"), refs, refs.select("year", "page_id"), f"{tmp_path}/c")
    assert board.splitlines()[2].startswith("| 1 | dots |")
    assert sinks.current(spark, f"{tmp_path}/none") is None and readers.VOLUME.fieldNames()[0] == "volume_id"
