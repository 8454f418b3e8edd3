import collections
import math
import re

import numpy as np
import pytest
from folioforge.llm import kneser_ney as kn


def brute(train, texts):
    """Interpolated modified Kneser-Ney of order two, by its definition."""
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    tok = lambda t: [*re.findall("[^\x20\x09-\x0d]+", lower(t)), None]
    uni, bi = collections.Counter(), collections.Counter()
    for t in train:
        w = tok(t)
        uni.update(w)
        bi.update(zip(["<s>", *w], w))
    cont = collections.Counter(w for _, w in bi)
    follow = collections.defaultdict(list)
    for (u, _), c in bi.items():
        follow[u].append(c)
    stat = lambda cs: [sum(c == k for c in cs) for k in (1, 2, 3, 4)]
    d1, d2 = kn.discounts(stat(cont.values())), kn.discounts(stat(bi.values()))
    n, v, types = sum(uni.values()), len(uni), max(len(bi), 1)
    g0 = sum(d1[min(c, 3)] for c in cont.values()) / types if bi else 1.0

    def p1(w):
        return max(cont[w] - d1[min(cont[w], 3)], 0) / types + g0 / (v + 1)

    def p2(u, w):
        cs = follow.get(u)
        if not cs:
            return p1(w)
        return max(bi[u, w] - d2[min(bi[u, w], 3)], 0) / sum(cs) + sum(d2[min(c, 3)] for c in cs) / sum(cs) * p1(w)

    out = []
    for t in texts:
        w = tok(t)
        base = sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, sum(math.log10(p2(u, x)) for u, x in zip(["<s>", *w], w))))
    total = [sum(p2(u, w) for w in [*uni, "never seen"]) for u in ["<s>", *list(uni)[:20], "never seen"]] if uni else []
    return out, total


def rows(n):
    words = ["the", "a", "Of", "cat", "dog", "sat", "ran", "on", "mat", "x1", "über", "日本"]
    out = []
    for k in range(n):
        out.append((k, " ".join(words[(k * 7 + j * j * (k % 5 + 1)) % (3 + k % 10)] for j in range(k % 40))))
    return [*out, (n, None), (n + 1, ""), (n + 2, "  \n\t"), (n + 3, "Unknownword the unknownword"), (3, "the cat"), (None, "a dog"), (n + 4, "the cat " * 20000)]


@pytest.mark.parametrize("size", [0, 1, 200])
def test_against_definition(spark, size):
    data = rows(size) if size else []
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumnsRenamed({})
    docs = docs.selectExpr("doc_id", "text", "1 AS n_tokens", "'x' AS perplexity", "array(1) AS h")
    train = docs.where(~kn.held_out("doc_id"))
    model = kn.fit(train, "doc_id", "text")
    got = kn.lm_scores(docs, model).collect()
    expect, total = brute([r["text"] for r in train.collect()], [r["text"] for r in got])
    for t in total:
        assert t == pytest.approx(1.0, abs=1e-9)
    assert len(got) == len(data)
    for r, e in zip(got, expect, strict=True):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:3]
        assert r["base_score"] == pytest.approx(e[3], rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(e[4], rel=1e-9, abs=1e-9)


def test_counts_past_32_bits(tmp_path):
    """Counts and continuation counts are not clipped, and too many words are an error."""
    folder, big = f"file://{tmp_path}", np.array([5, 2**40, 2**63], dtype=np.uint64)
    kn._store.put(f"{folder}/count-0", big)
    voc = kn.Vocabulary(folder, [3])
    assert voc.gather("count", np.uint64, np.arange(3, dtype=np.uint64)).tolist() == big.tolist()
    with pytest.raises(ValueError):
        kn.Vocabulary(folder, [2**31, 2**31])
