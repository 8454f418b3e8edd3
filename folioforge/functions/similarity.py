"""Similarity functions as column expressions; distances count code points."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import distance as D
from folioforge.functions import patterns as P
from folioforge.functions import text as X


def ned(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 where both are empty."""
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / F.greatest(longer, F.lit(1)))


def similarity(a: Column, b: Column) -> Column:
    return F.lit(1.0) - ned(a, b)


@F.pandas_udf(T.LongType())
def _distances(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(D.distances(a.fillna("").tolist(), b.fillna("").tolist()))


def long_distance(a: Column, b: Column) -> Column:
    """``F.levenshtein`` for texts of lines and more: all pairs of an Arrow batch together, some ten times as fast."""
    return F.when(a.isNotNull() & b.isNotNull(), _distances(a, b))


def long_ned(a: Column, b: Column) -> Column:
    """``ned`` by ``long_distance``."""
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(long_distance(a, b) / F.greatest(longer, F.lit(1)))


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def similarity_matrix(texts: pd.Series) -> pd.Series:
    """Similarities of the texts of each row to each other; each pair is measured once, a null is empty."""
    rows = [["" if t is None else t for t in row] for row in texts]
    pairs = [(row[i], row[j]) for row in rows for i in range(len(row)) for j in range(i)]
    far = iter(D.distances([a for a, _ in pairs], [b for _, b in pairs]).tolist())
    out = []
    for row in rows:
        m = [[1.0] * len(row) for _ in row]
        for i in range(len(row)):
            for j in range(i):
                m[i][j] = m[j][i] = 1.0 - next(far) / max(len(row[i]), len(row[j]), 1)
        out.append(m)
    return pd.Series(out)


def token_ned(a: Column, b: Column) -> Column:
    """As ``ned``, but 1 where exactly one side is empty (which ``ned`` gives too), nulls being empty."""
    return long_ned(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def cer(ref: Column, hyp: Column, nfkc_first: bool = True) -> Column:
    """Edit distance over the reference's length, white space collapsed; an empty reference gives 0 or 1."""
    form = (lambda t: X.collapse(X.nfkc(F.coalesce(t, F.lit(""))))) if nfkc_first else (lambda t: X.collapse(F.coalesce(t, F.lit(""))))
    r, h = form(ref), form(hyp)
    return F.when(r == "", F.when(h == "", 0.0).otherwise(1.0)).otherwise(long_distance(r, h) / F.greatest(F.char_length(r), F.lit(1)))


def safe_div(a: Column, b: Column) -> Column:
    """a / b; 1 for 0 / 0 and 0 for x / 0."""
    return F.coalesce(F.try_divide(a, b), F.when(a == 0, 1.0).otherwise(0.0))


def accepted(src: Column, out: Column) -> Column:
    """A correction, or its source where the correction drifted: far, and much longer or from a very short source."""
    far = token_ned(X.strip(src), X.strip(out)) > P.ACCEPT_NED
    longer = F.char_length(out) > F.char_length(src) * P.ACCEPT_GROWTH + P.ACCEPT_EXTRA
    short = F.char_length(X.strip(src)) < P.ACCEPT_SHORT
    return F.when((F.coalesce(out, F.lit("")) == "") | (far & (longer | short)), src).otherwise(out)


@F.pandas_udf(T.DoubleType())
def matcher_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio, with the automatic junk rule from 200 characters on."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


# white space as the patterns of the text functions have it
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def best_in_band(mine: list[str], theirs: list[str], radius: int = P.BAND_RADIUS) -> list[float]:
    """For each line of one read the best Ratcliff-Obershelp ratio to the other's lines around the same relative place.

    Candidates are tried in order of what their lengths allow at most, until that is no more than the best ratio so far; where
    that is high already, those whose letters allow no more are left out too.
    """
    import re
    import unicodedata
    from difflib import SequenceMatcher

    form = lambda t: re.sub(_BLANK, " ", unicodedata.normalize("NFKC", t)).strip(" ").casefold()
    matchers = [SequenceMatcher(None, "", form(t)) for t in theirs]
    out = []
    for i, line in enumerate(map(form, mine)):
        lo = max(0, int(i / max(1, len(mine)) * len(theirs)) - radius)
        near = matchers[lo : lo + 2 * radius + 1]
        for m in near:
            m.set_seq1(line)
        best = 0.0
        for most, k in sorted(((m.real_quick_ratio(), -k) for k, m in enumerate(near)), reverse=True):
            if most <= best:
                break
            if best < 0.6 or near[-k].quick_ratio() > best:
                best = max(best, near[-k].ratio())
        out.append(best)
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def best_ratios(mine: pd.Series, theirs: pd.Series) -> pd.Series:
    """``best_in_band`` of two arrays of lines."""
    return pd.Series([best_in_band(list(a), list(b)) for a, b in zip(mine, theirs, strict=True)])
