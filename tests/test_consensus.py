import math

import pytest
from folioforge.operators import consensus as C
from hypothesis import given, settings
from hypothesis import strategies as st

CASES = {
    1: (["abcd"], 1.0, [0.0], 0.0, [1.0], 1.0),
    2: (["abcd", "wxyz"], 0.0, [math.log(2)] * 2, 0.0, [0.5, 0.5], 0.5),
    3: (["abcd", "abcd", "wxyz"], 1 / 3, [0.0, 0.0, 0.0], 0.0, [1 / 3] * 3, 2 / 3),
    4: (["abcd", "abce", "abff"], 0.583333, [0.673012, 0.673012, 0.693147], 0.008640, [0.336593, 0.336593, 0.326815], 0.336593),
}


def test_entropy(spark):
    rows = [(p, "", f"e{k}", t) for p, (texts, *_) in CASES.items() for k, t in enumerate(texts)]
    reads = spark.createDataFrame(rows, "page int, region string, engine string, text string")
    each, region = C.consensus_entropy(reads)
    got = {r["page"]: r for r in region.collect()}
    frac = {r["page"]: r["cluster_fraction"] for r in C.cluster_fraction(reads).collect()}
    per = {p: sorted((r["engine"], r["entropy"], r["weight"]) for r in each.collect() if r["page"] == p) for p in CASES}
    for p, (texts, mean, hs, delta, ws, fraction) in CASES.items():
        assert got[p]["n"] == len(texts)
        assert got[p]["mean_sim"] == pytest.approx(mean, abs=1e-6) and got[p]["delta"] == pytest.approx(delta, abs=1e-6)
        assert [x[1] for x in per[p]] == pytest.approx(hs, abs=1e-6) and [x[2] for x in per[p]] == pytest.approx(ws, abs=1e-6)
        assert frac[p] == pytest.approx(fraction, abs=1e-6)


def test_chain_of_clusters(spark):
    texts = ["aaaaaaaaaa", "aaaaaaaaab", "aaaaaaaabb", "aaaaaaabbb", "aaaaaabbbb", "zzzzzzzzzz"]
    reads = spark.createDataFrame([(1, "", f"e{9 - k}", t) for k, t in enumerate(texts)], "page int, region string, engine string, text string")
    got = {r["engine"]: r["cluster"] for r in C.clusters(reads, threshold=0.9).collect()}
    assert got == {**{f"e{9 - k}": "e5" for k in range(5)}, "e4": "e4"}


def test_alignment_keeps_every_line():
    reads = {"a": ["one line here", "two lines here", "three"], "b": ["zzz", "two lines hera", "one line herr", "qqq"]}
    for got in (C.align_free(reads), C.align_ordered(reads)):
        for e, texts in reads.items():
            assert sorted(s[e] for s in got if e in s) == sorted(texts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abc"), st.lists(st.text("xyz ", min_size=1, max_size=6), max_size=6)))
def test_alignments_lose_nothing(reads):
    for got in (C.align_free(reads), C.align_ordered(reads)):
        for e, texts in reads.items():
            assert sorted(s[e] for s in got if e in s) == sorted(texts)


def test_regions_and_fusion(spark):
    rows = [(1, "colL", "a", "Ek, A., O, 900–800\nBerg, B., E, 10–20"), (1, "colL", "b", "Ek, A., O, 900-800\nBerg, B, E, 10-20"), (1, "colL", "c", "Ek, A., O, 900–800\nother text entirely"), (2, "colL", "a", "alone")]
    reads = spark.createDataFrame(rows, "page int, region string, engine string, text string")
    regions, groups = C.analyze_regions(reads)
    r = regions.collect()
    assert len(r) == 1 and r[0]["n_engines"] == 3 and r[0]["n_lines"] == 3 and r[0]["engines"] == "a|b|c"
    assert C.report_totals(regions, groups).first()["singletons"] == 1
    fused = {(x["page"], x["line_idx"]): x for x in C.fuse_regions(reads).collect()}
    assert fused[1, 0]["text"] == "Ek, A., O, 900–800" and fused[1, 0]["n_votes"] == 3
    assert fused[2, 0]["confidence"] == 1.0 and C.fused_text(C.fuse_regions(reads)).count() == 2
    anchored = {(x["page"], x["line_idx"]): x for x in C.anchored_agreement(reads, "a").collect()}
    assert anchored[1, 0]["n_corrob"] == 2 and anchored[2, 0]["agreement"] is None and set(anchored[1, 1]["sims"]) == {"b", "c"}
    assert C.pick_read(reads).collect()[0]["engine"] in {"a", "b"}


def test_best_in_band():
    """The best of all ratios in the band, though not all are computed."""
    import random
    from difflib import SequenceMatcher

    from folioforge.functions import similarity as S

    r = random.Random(8)
    line = lambda: " ".join(r.choice(["Ek", "Berg", "köpman", "hustru", "O", "12500", "Åsa\u00a0B"]) for _ in range(r.randint(1, 60)))
    for n, m in ((1, 1), (30, 40), (40, 7)):
        mine = [line() for _ in range(n)]
        theirs = [r.choice(mine)[: r.randint(1, 300)] + r.choice(["", "x"]) if r.random() < 0.5 else line() for _ in range(m)]
        form = lambda t: " ".join(t.replace("\u00a0", " ").split()).casefold()
        want = []
        for i, t in enumerate(mine):
            lo = max(0, int(i / n * m) - 10)
            want.append(max(SequenceMatcher(None, form(t), form(o)).ratio() for o in theirs[lo : lo + 21]))
        assert S.best_in_band(mine, theirs) == want
