"""Quality rules from tokeniser fertility.

Public vocabularies (one with byte fallback, one of bytes) encode each whole text. Three measures follow for each: characters
per token (fertility), the share of tokens that are single bytes of non-ASCII characters, and the entropy of the
token distribution. Each language, or else script, has a band for each measure of each vocabulary; a text outside a band
is rejected. Short texts are noisy, so bands hold from ``min_tokens`` tokens on.

Beside them stand the plain rules: number of words, characters in words, symbols, repeated lines, and words
in repeated three-word windows.

Everything is a function of one row: no shuffle, no collected statistics. Defined cases: a null or empty
text has no words and fails the plain rules; an empty table gives an empty table; a null or unknown
language takes the band of its script; repeated rows are judged each; very long texts are encoded whole; a measure that equals
an end of its band is inside; extra columns stay, but for those of the names made here, which are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow, _words, packing

SYMBOLS = b"#*$%&|<>"
U64 = np.uint64

# Bands (least and most) of characters per token, byte share and token entropy in bits per token,
# by language or script; None: no limit.
BANDS = {
    "en": {"chars_per_token": (2.35, 6.5), "byte_share": (0.0, 0.05), "entropy": (5.5, None)},
    "de": {"chars_per_token": (2.35, 6.5), "byte_share": (0.0, 0.05), "entropy": (5.5, None)},
    "fr": {"chars_per_token": (2.1, 6.5), "byte_share": (0.0, 0.05), "entropy": (5.4, None)},
    "es": {"chars_per_token": (2.1, 6.5), "byte_share": (0.0, 0.05), "entropy": (5.4, None)},
    "latin": {"chars_per_token": (1.9, 6.5), "byte_share": (0.0, 0.10), "entropy": (5.2, None)},
    "greek": {"chars_per_token": (0.6, 4.0), "byte_share": (0.0, 0.60), "entropy": (3.5, None)},
    "cyrillic": {"chars_per_token": (1.0, 5.0), "byte_share": (0.0, 0.30), "entropy": (3.5, None)},
    "cjk": {"chars_per_token": (0.3, 2.0), "byte_share": (0.0, 0.90), "entropy": (3.5, None)},
    "other": {"chars_per_token": (0.25, 6.5), "byte_share": (0.0, 1.0), "entropy": (3.0, None)},
}
# the same for a vocabulary of bytes, which has fewer letters of other languages than English in its tokens
BYTE_BANDS = {
    "en": {"chars_per_token": (1.9, 7.0), "byte_share": (0.0, 0.05), "entropy": (4.8, None)},
    "de": {"chars_per_token": (1.6, 7.0), "byte_share": (0.0, 0.15), "entropy": (4.8, None)},
    "fr": {"chars_per_token": (1.5, 7.0), "byte_share": (0.0, 0.15), "entropy": (4.7, None)},
    "es": {"chars_per_token": (1.5, 7.0), "byte_share": (0.0, 0.15), "entropy": (4.7, None)},
    "latin": {"chars_per_token": (1.1, 7.0), "byte_share": (0.0, 0.40), "entropy": (4.5, None)},
    "greek": {"chars_per_token": (0.4, 4.0), "byte_share": (0.0, 1.0), "entropy": (3.0, None)},
    "cyrillic": {"chars_per_token": (0.4, 5.0), "byte_share": (0.0, 1.0), "entropy": (3.0, None)},
    "cjk": {"chars_per_token": (0.2, 2.5), "byte_share": (0.0, 1.0), "entropy": (3.0, None)},
    "other": {"chars_per_token": (0.2, 7.0), "byte_share": (0.0, 1.0), "entropy": (3.0, None)},
}
MIN_TOKENS = 120

MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("chars_per_token", T.DoubleType()),
        T.StructField("byte_share", T.DoubleType()),
        T.StructField("entropy", T.DoubleType()),
        T.StructField("script", T.StringType()),
    ]
)
SCRIPTS = ("latin", "greek", "cyrillic", "cjk", "other")


def _script_of_byte() -> np.ndarray:
    """Script of the character that a UTF-8 byte begins; -1 for none (a continuation, digit or mark)."""
    kind = np.full(256, -1, dtype=np.int8)
    for b in range(256):
        if 65 <= b <= 90 or 97 <= b <= 122 or 0xC3 <= b <= 0xC9:
            kind[b] = 0
        elif b in (0xCE, 0xCF):
            kind[b] = 1
        elif 0xD0 <= b <= 0xD4:
            kind[b] = 2
        elif 0xE3 <= b <= 0xED:
            kind[b] = 3
        elif 0xCA <= b <= 0xF4 and b != 0xE2:
            kind[b] = 4
    return kind


_KIND = _script_of_byte()
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_BLANK = b" \t\n\x0b\x0c\r"


def _sums(flag: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flag) + 1, dtype=np.int64)
    np.cumsum(flag, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def plain_rules(texts: list) -> dict:
    """The counts that need no vocabulary."""
    buf, starts = _words.pack(texts, lower=False)
    s, e = _words.spans(buf, _words.NOT_SPACE)
    h = _words.hash_spans(buf, s, e)
    first = np.searchsorted(s, starts)
    begins = (buf & 0xC0) != 0x80  # first bytes of characters
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), n_words)
    repeat = np.zeros(len(h), dtype=bool)
    if len(h) >= 3:
        g = _words.ngrams(h, 3)
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = _words.mix(g[at] + _words.mix(doc[at].astype(U64)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        for k in range(3):
            repeat[at[twice] + k] = True
    dup = []
    for t in texts:
        if not t or "\n" not in t:
            dup.append(0)
            continue
        lines = [x for x in t.encode("utf-8", "surrogatepass").split(b"\n") if x.strip(_BLANK)]
        dup.append(len(lines) - len(set(lines)))
    scripts = np.stack([_sums((_KIND == k)[buf], starts) for k in range(len(SCRIPTS))])
    return {
        "n_words": n_words,
        "word_chars": _sums(_words.NOT_SPACE[buf] & begins, starts),
        "n_symbols": _sums(_IS_SYMBOL[buf], starts),
        "n_dup_lines": dup,
        "n_repeat_words": _sums(repeat, first),
        "script": [SCRIPTS[k] if n else "other" for k, n in zip(scripts.argmax(0), scripts.max(0), strict=True)],
    }


def _pieces(path: str):
    """Function from texts to ids, and which ids are single bytes from 0x80 on: of a sentencepiece model, or of a tokenizers file of bytes."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        fallback = [sp.is_byte(k) and int(sp.id_to_piece(k)[3:5], 16) >= 0x80 for k in range(sp.get_piece_size())]
        return lambda texts: sp.encode(texts, num_threads=1), np.array([*fallback, False])
    from tokenizers import Tokenizer

    # bytes stand as letters there: 0xA1 to 0xAC and 0xAE to 0xFF as themselves, 0x80 to 0xA0 and 0xAD from U+0122 on
    exact = Tokenizer.from_file(path)
    letters = {*range(0xA1, 0xAD), *range(0xAE, 0x100), *range(0x122, 0x144)}
    tokens = (exact.id_to_token(k) or "" for k in range(exact.get_vocab_size()))
    return packing.tokenizer(path), np.array([len(t) == 1 and ord(t) in letters for t in tokens] + [False])


def fertility(model_path: str, suffix: str = ""):
    """Function from texts to the measures under a public vocabulary."""
    encode, fallback = _pieces(model_path)

    def fn(texts):
        n, chars, share, entropy = [], [], [], []
        for t, ids in zip(texts, encode([t or "" for t in texts]), strict=True):
            ids = np.asarray(ids, dtype=np.int32)
            n.append(len(ids))
            if not len(ids):
                chars.append(0.0), share.append(0.0), entropy.append(0.0)
                continue
            p = np.bincount(ids)
            p = p[p > 0] / len(ids)
            chars.append(len(t) / len(ids))
            share.append(float(fallback[ids].mean()))
            entropy.append(float(-(p * np.log2(p)).sum()) + 0.0)
        return {f"{k}{suffix}": v for k, v in (("n_tokens", n), ("chars_per_token", chars), ("byte_share", share), ("entropy", entropy))}

    return fn


def _inside(band, bands: dict, suffix: str, min_tokens: int):
    out = F.lit(True)
    for name, limits in bands.items():
        ok = F.lit(True)
        for measure, (least, most) in limits.items():
            if least is not None:
                ok = ok & (F.col(f"{measure}{suffix}") >= least)
            if most is not None:
                ok = ok & (F.col(f"{measure}{suffix}") <= most)
        out = F.when(band == name, ok).otherwise(out)
    return out | (F.col(f"n_tokens{suffix}") < min_tokens)


def quality_rules(
    docs: DataFrame,
    model_path: str,
    text_col: str = "text",
    lang_col: str | None = "lang",
    bands: dict | None = None,
    min_tokens: int = MIN_TOKENS,
    byte_path: str | None = None,
    byte_bands: dict | None = None,
) -> DataFrame:
    """``docs`` with the counts and measures, base_failed, in_band and kept. With ``byte_path`` the measures of that vocabulary
    stand beside, their names ending in _bytes, and its bands must hold as well."""
    bands, kinds = bands or BANDS, [("", model_path)] + ([("_bytes", byte_path)] if byte_path else [])

    def make():
        measures = [fertility(path, suffix) for suffix, path in kinds]

        def fn(texts):
            out = plain_rules(texts)
            for m in measures:
                out |= m(texts)
            return out

        return fn

    extra = ["base_failed", "in_band", "kept"]
    src = docs.select(*[F.col(f"`{c}`") for c in _arrow.free_of(docs, extra, keep=[text_col])])
    more = [T.StructField(f"{n}_bytes", MEASURES[n].dataType) for n in ("n_tokens", "chars_per_token", "byte_share", "entropy")] if byte_path else []
    got = _arrow.map_texts(src, text_col, T.StructType([*MEASURES, *more]), make, drop_text=False)
    names = {c.lower(): c for c in got.columns}
    lang = F.col(f"`{names[lang_col.lower()]}`") if lang_col and lang_col.lower() in names else F.lit(None).cast("string")
    band = F.when(lang.isin(*bands), lang).otherwise(F.col("script"))
    inside = _inside(band, bands, "", min_tokens)
    if byte_path:
        inside = inside & _inside(band, byte_bands or BYTE_BANDS, "_bytes", min_tokens)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return got.withColumns({"base_failed": failed, "in_band": inside, "kept": ~failed & inside})


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _arrow.documents(spark, sf_dir).select("doc_id", "lang", "text")
    got = quality_rules(docs, public_tokenizers.path("piece_bpe_32k.model"), byte_path=public_tokenizers.path("byte_bpe_50k.json"))
    return got.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "byte_share", "entropy", "chars_per_token_bytes", "byte_share_bytes", "entropy_bytes",
    )
