"""Queries without SQL against brute force on the driver's smallest tables."""

import collections
import difflib
import hashlib
import os
import re
import statistics
import unicodedata

import numpy as np
import pytest
from folioforge.functions import patterns
from folioforge.operators import images, models
from folioforge.plans import documents, registry, sequences, tables
from folioforge.plans import pages as page_plans

from . import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="the driver's tables are not here")


def run(spark, name):
    return registry.QUERIES[name](spark, oracle.SF).collect()


def test_line_clusters(spark):
    pages = collections.defaultdict(list)
    for r in page_plans.words_of_lineitem(spark, oracle.SF).collect():
        pages[r["page"]].append((r["y0"], r["x0"], r["y1"], r["x1"], r["t"]))
    expect = {}
    for page, words in pages.items():
        words.sort()
        tolerance = statistics.median([w[2] - w[0] for w in words if w[2] > w[0]]) * 0.6
        lines, centre = [], None
        for w in words:
            if centre is None or abs(w[0] - centre) > tolerance:
                lines.append([])
                centre = w[0]
            else:
                centre = (centre + w[0]) / 2
            lines[-1].append((w[1], w[0], w[4]))
        for k, line in enumerate(lines):
            expect[page, k] = " ".join(t for _, _, t in sorted(line))
    assert {(r["page"], r["line_no"]): r["text"] for r in run(spark, "line_clusters")} == expect


def test_matcher_ratios(spark):
    pairs = {(r["doc_id"], r["line_no"]): (r["ref"], r["hyp"]) for r in documents.hyp_ref(spark, oracle.SF).collect()}
    for r in run(spark, "matcher_ratios"):
        assert r["ratio"] == pytest.approx(difflib.SequenceMatcher(None, *pairs[r["doc_id"], r["line_no"]]).ratio() * 1e6, abs=1)


def test_compared_forms(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{oracle.SF}/documents.parquet").collect()}
    for r in run(spark, "compared_forms"):
        t = re.sub("</?math>", "", unicodedata.normalize("NFKC", texts[r["doc_id"]]))
        t = " ".join(re.sub("[‐‑‒–—―−]", "-", t).split()).casefold()
        assert hashlib.md5(t.encode()).hexdigest() == r["form"]


@pytest.mark.parametrize("name", ["free_alignment", "ordered_alignment"])
def test_alignments_keep_all_lines(spark, name):
    lines = collections.Counter()
    for r in documents.blocks(spark, oracle.SF).collect():
        lines[r["page"], r["region"]] += len([x for x in r["text"].split("\n") if x.strip()])
    got, slots = collections.Counter(), collections.Counter()
    for r in run(spark, name):
        got[r["page"], r["region"]] += 1
        slots[r["page"], r["region"], r["slot"], r["engine"]] += 1
    assert got == lines and set(slots.values()) == {1}


def small_documents(spark, folder):
    """Long texts, more than two lines, other letters, long words late."""
    texts = ["\n".join(f"the line {k} of 1936" for k in range(9)), "ö日 " * 300 + "x" * 5000 + " end", "", "one", "word " * 2000]
    spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return texts


def test_corrected_lines_takes_all_lines(spark, tmp_path):
    texts = small_documents(spark, tmp_path)
    got = sequences.corrected_lines(spark, str(tmp_path)).collect()
    generate = lambda t: t.replace("th", "dh").translate({48 + d: 57 - d for d in range(10)})
    expect = {}
    for k, t in enumerate(texts):
        for n, line in enumerate(x.strip() for x in t.split("\n") if x.strip()):
            expect[k, n] = hashlib.md5(models.correct_line(line, generate).encode()).hexdigest()
    assert sorted(((r["page"], r["line_no"]), r["corrected"]) for r in got) == sorted(expect.items())


def test_word_chunks_takes_whole_texts(spark, tmp_path):
    texts = small_documents(spark, tmp_path)
    expect = {}
    for k, t in enumerate(texts):
        chunks, size = [], 0
        for w in t.split():
            n = len(w.encode()) + 1
            if chunks and size + n <= patterns.CHUNK_BYTES:
                chunks[-1] += " " + w
                size += n
            else:
                chunks.append(w)
                size = n
        expect[k] = (max(len(chunks), 1), max((len(c.encode()) for c in chunks), default=0))  # an empty text is one empty chunk
    assert {r["doc_id"]: (r["n"], r["most"]) for r in tables.word_chunks(spark, str(tmp_path)).collect()} == expect


def test_others_run(spark):
    assert len(run(spark, "corrected_lines")) > 100
    assert {r["gutter_conf"] for r in run(spark, "image_splits")} == {"ok"}
    assert len(run(spark, "drawn_sample")) == 25


def test_image_splits_deals_pages_to_all_partitions(spark, tmp_path):
    spark.range(1, 2001).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    df = sequences.image_splits(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_skew_and_rotation_pixel_by_pixel():
    def skew(gray):
        y, x = np.nonzero(gray <= images.otsu_threshold(gray))

        def sharp(angle):
            a = np.radians(angle)
            at = np.rint(np.cos(a) * (y - 65) - np.sin(a) * (x - 85) + 65).astype(int)
            return np.bincount(at[(at >= 0) & (at < 130)], minlength=130).var()

        best = max(np.arange(-4, 4 + 1e-9, 0.5), key=sharp)
        return max(np.arange(best - 0.5, best + 0.5 + 1e-9, 0.1), key=sharp)

    r = np.random.default_rng(4)
    page = np.full((130, 170), 230, np.uint8)
    page[20:110:9, 15:150] = 20
    page = np.minimum(page, r.integers(60, 256, page.shape).astype(np.uint8))
    for degrees in (-3.5, -0.1, 0.5, 2.0):
        y, x = np.mgrid[:130, :170].astype(float)
        a, dx, dy = np.radians(degrees), x - 85, y - 65
        sx, sy = np.rint(np.cos(a) * dx - np.sin(a) * dy + 85).astype(int), np.rint(np.sin(a) * dx + np.cos(a) * dy + 65).astype(int)
        near = page[np.clip(sy, 0, 129), np.clip(sx, 0, 169)]
        assert (images.rotate(page, degrees) == near).all()
        assert (images.rotate(page, degrees, 7) == np.where((sx < 0) | (sx > 169) | (sy < 0) | (sy > 129), 7, near)).all()
        assert images.skew_by_projection(near) == skew(near)
    p = np.pad(page.astype(float), 1, mode="reflect")
    assert images.laplacian_variance(page) == (p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var()
