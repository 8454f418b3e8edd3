"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (one to three characters of the lower-cased letters, anything
else being one blank), weighted by relative term frequency times inverse document frequency. Weights and an intercept for each
language are trained with follow-the-regularised-leader (per-coordinate rates, elastic net: the L1 part leaves about a third of
the n-grams seen with a weight, and only these are sent to the workers), then one temperature is
fitted on rows kept back, so that scores are calibrated probabilities.

The model is fitted on the driver from a bounded sample: at most about ``per_language`` labelled rows of each
language, drawn by a hash of the id, whole texts, each language within its own share of the characters. All languages
that have learnable rows are in the model. The prediction reads every row and is linear in the n-grams'
occurrences, so it is one table lookup for each n-gram; the table has ``1 << bits`` rows and a column for each
language, which bounds what is sent to the workers.

Defined cases: a null text and a text without letters are ``und`` with score 0; without any labelled row all
texts are ``und``; with one language its score is 1; equal scores give the first language by name; an
empty table gives an empty table; repeated rows are predicted each; a very long text is read whole; extra columns stay, but for those of the names that are made here, which are replaced.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow

BITS, ORDERS, PER_LANGUAGE, MAX_CHARS = 16, 3, 1200, 24_000_000
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_LETTER: list = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def features(texts: list, bits: int = BITS) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each n-gram order the slots of all occurrences and each text's first one; and the texts' letters."""
    joined = [("\0" if not t else "\0" + t.lower()) for t in texts]
    code = np.frombuffer("".join([*joined, "\0"]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(j) for j in joined], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(size)))
    table = _letters()
    letter = np.take(table, code)
    total = np.concatenate(([0], np.cumsum(letter)))
    n_letters = total[starts[1:]] - total[starts[:-1]]
    code = np.where(letter, code, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each run of letters
    keep[starts] = True  # and one before each text
    place = np.concatenate(([0], np.cumsum(keep)))
    code, starts = code[keep], place[starts]
    slots, firsts = [], []
    h = np.zeros(len(code), dtype=np.uint32)
    for n in range(ORDERS):
        h = (h[: len(code) - n] if n == 0 else h[:-1]) ^ (code[n:] * _MULT[n])
        h = h * np.uint32(0x27D4EB2F)
        h ^= h >> np.uint32(15)
        slots.append((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits))
        firsts.append(np.minimum(starts, len(slots[-1])))
    return slots, firsts, n_letters


def sums(table: np.ndarray, slots: list, firsts: list) -> np.ndarray:
    """Mean over a text's n-grams of the rows of ``table``, the n-grams that run into the next text included in neither."""
    n = len(firsts[0]) - 1
    out, count = np.zeros((n, table.shape[1])), np.zeros(n)
    for order, (s, f) in enumerate(zip(slots, firsts, strict=True)):
        end = np.maximum(f[1:] - order, f[:-1])
        for c in range(table.shape[1]):
            run = np.zeros(len(s) + 1)
            np.cumsum(table[s, c], out=run[1:])
            out[:, c] += run[end] - run[f[:-1]]
        count += end - f[:-1]
    return out / np.maximum(count, 1)[:, None]


class Model:
    """Weights, labels and temperature; ``fit`` trains them."""

    def __init__(self, labels: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, bits: int):
        self.labels, self.table, self.bias, self.temperature, self.bits = labels, table, bias, temperature, bits

    def __getstate__(self):
        """Only slots with a weight travel."""
        used = np.flatnonzero(self.table.any(axis=1))
        return self.__dict__ | {"table": (self.table.shape, used, self.table[used])}

    def __setstate__(self, state):
        shape, used, rows = state["table"]
        self.__dict__.update(state)
        self.table = np.zeros(shape)
        self.table[used] = rows

    def logits(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        slots, firsts, letters = features(texts, self.bits)
        return sums(self.table, slots, firsts) + self.bias, letters

    def predict(self, texts: list) -> dict:
        if not self.labels:
            return {"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts)}
        z, letters = self.logits(texts)
        p = softmax(z / self.temperature)
        best = p.argmax(1)
        return {
            "lang_pred": [self.labels[b] if n else "und" for b, n in zip(best, letters, strict=True)],
            "score": [float(p[k, b]) if n else 0.0 for k, (b, n) in enumerate(zip(best, letters, strict=True))],
        }


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(
    rows: list[tuple[str, str, bool]],
    bits: int = BITS,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 5e-2,
    l2: float = 1e-3,
    scale: float = 20.0,
) -> Model:
    """``rows``: text, language, whether the row is kept back for the temperature."""
    rows = [r for r in rows if r[0] and any(map(str.isalpha, r[0]))]
    labels = sorted({r[1] for r in rows})
    if not labels:
        return Model([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    if len(labels) == 1:
        return Model(labels, np.zeros((1 << bits, 1)), np.zeros(1), 1.0, bits)
    docs, df = [], np.zeros(1 << bits)
    for text, lang, back in rows:
        slots, firsts, _ = features([text], bits)
        ids, n = np.unique(np.concatenate([s[f[0] : max(f[1] - k, f[0])] for k, (s, f) in enumerate(zip(slots, firsts, strict=True))]), return_counts=True)
        docs.append((ids, n / n.sum(), labels.index(lang), back))
        df[ids] += 1
    idf = np.log((1 + len(docs)) / (1 + df)) + 1
    if all(d[3] for d in docs) or not any(d[3] for d in docs):
        docs = [(*d[:3], k % 5 == 0) for k, d in enumerate(docs)]
    z, n = np.zeros((1 << bits, len(labels))), np.zeros((1 << bits, len(labels)))
    bz, bn = np.zeros(len(labels)), np.zeros(len(labels))  # of the intercepts, which L1 leaves alone

    def weights(ids):
        zi = z[ids]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[ids])) / alpha + l2))

    def intercepts():
        return -bz / ((beta + np.sqrt(bn)) / alpha + l2)

    order = np.random.default_rng(0)
    train = [d for d in docs if not d[3]] or docs
    for _ in range(epochs):
        for k in order.permutation(len(train)):
            ids, tf, y, _ = train[k]
            x = scale * tf * idf[ids]
            w, b = weights(ids), intercepts()
            p = softmax((x @ w + b)[None])[0]
            p[y] -= 1.0
            bz += p - (np.sqrt(bn + p * p) - np.sqrt(bn)) / alpha * b
            bn += p * p
            g = x[:, None] * p[None]
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
    table = weights(np.arange(1 << bits)) * (scale * idf)[:, None]
    back = [d for d in docs if d[3]] or docs
    logits = np.stack([(tf[:, None] * table[ids]).sum(0) for ids, tf, _, _ in back]) + intercepts()
    ys = np.array([d[2] for d in back])

    def loss(t):
        # one smoothing row for each label keeps the temperature above 0 where every row is right
        q = softmax(logits / t)
        return -np.log(np.maximum(q[np.arange(len(ys)), ys], 1e-12)).mean() - np.log(np.maximum(q, 1e-12)).mean() / (len(ys) + 1)

    lo, hi = math.log(0.02), math.log(20.0)
    for _ in range(60):  # golden section on the logarithm of the temperature
        a, b = hi - (hi - lo) * 0.618, lo + (hi - lo) * 0.618
        lo, hi = (lo, b) if loss(math.exp(a)) < loss(math.exp(b)) else (a, hi)
    return Model(labels, table.astype(np.float64), intercepts(), math.exp((lo + hi) / 2), bits)


def learnable(id_col: str):
    """Rows that may be learned from: crc32 of the id as text, modulo 3, is not 1. A null id is never learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 != 1, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> list:
    """A bounded sample of labelled rows: (text, language, kept back).

    The share drawn of each language follows from its count; the hash of the id decides, so the draw is
    the same however the table is partitioned. ``max_chars`` bounds the driver's memory: each language has an equal
    share of it, what some do not need being shared by the others, and takes its rows in the order of the hash; rows
    that do not fit into the share are left out of the fit (never of the prediction). A language of which no
    row fits takes its shortest.
    """
    u = F.pmod(F.xxhash64(F.lit(11), F.col(f"`{id_col}`")), F.lit(1 << 30))
    rows = docs.where(learnable(id_col) & F.col(f"`{text_col}`").isNotNull() & F.col(f"`{lang_col}`").isNotNull())
    rows = rows.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l"), u.alias("u"))
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return []
    limits = [(r["l"], int((1 << 30) * min(1.0, per_language / r["n"]))) for r in counts]
    limits = F.broadcast(docs.sparkSession.createDataFrame(limits, "l string, below long"))
    drawn = rows.join(limits, "l").where("u < below").select("t", "l", "u", F.char_length("t").alias("size"), F.xxhash64("t").alias("h"))
    sizes = [tuple(r) for r in drawn.select("l", "u", "h", "size").collect()]
    if sum(r[3] for r in sizes) > max_chars:
        fits = within(sizes, max_chars)
        schema = "l string, u long, h long, size int, copies long"
        drawn = drawn.join(F.broadcast(docs.sparkSession.createDataFrame([(*r, n) for r, n in fits.items()], schema)), ["l", "u", "h", "size"])
    else:
        fits = Counter(sizes)
    got = []
    for r in drawn.toLocalIterator():
        key = (r["l"], r["u"], r["h"], r["size"])
        if fits[key] > 0:  # of equal rows as many as fit
            fits[key] -= 1
            got.append((r["u"], r["l"], r["t"]))
    return [(t, lang, u % 5 == 0) for u, lang, t in sorted(got)]


def within(sizes: list[tuple], max_chars: int) -> Counter:
    """How many rows of each (language, hash of the id, hash of the text, characters) fit into the languages' shares."""
    by, out, rest = defaultdict(list), Counter(), max_chars
    for row in sizes:
        by[row[0]].append(row)
    need = sorted((sum(r[3] for r in rows), lang) for lang, rows in by.items())
    for k, (total, lang) in enumerate(need):
        share = min(total, rest // (len(need) - k))
        left = share
        for row in sorted(by[lang]):
            if row[3] <= left:
                out[row] += 1
                left -= row[3]
        if left == share and total > share:
            out[min(by[lang], key=lambda r: (r[3], r))] += 1
        rest -= share
    return out


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def language_id(
    docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", drop_text: bool = False
) -> DataFrame:
    """``docs`` with held_out, lang_pred and score. Without ``model`` one is fitted on the learnable labelled rows."""
    model = model or fit(sample(docs, id_col, text_col, lang_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*[F.col(f"`{c}`") for c in _arrow.free_of(docs, ["held_out"], keep=[text_col, id_col, lang_col])])
    got = _arrow.map_texts(src, text_col, PREDICTION, lambda: shared.value.predict, drop_text)
    return got.withColumn("held_out", ~learnable(id_col))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = _arrow.documents(spark, sf_dir).select("doc_id", "text", "lang")
    return language_id(docs, drop_text=True).select("doc_id", "held_out", "lang_pred", "score")
