"""Text functions as column expressions. NFKC is the one that Spark lacks; it is a pandas UDF that ASCII texts skip."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import patterns as P


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


@F.pandas_udf(T.StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.str.casefold()


def _is_ascii(t: Column) -> Column:
    return F.regexp_like(t, F.lit(r"^[\x00-\x7F]*$"))


def nfkc(t: Column) -> Column:
    """Compatibility form; a no-break space becomes a space."""
    return F.when(_is_ascii(t), t).otherwise(_nfkc(t))


def nfc_collapsed(t: Column) -> Column:
    return collapse(F.when(_is_ascii(t), t).otherwise(_nfc(t)))


def casefold(t: Column) -> Column:
    return F.when(_is_ascii(t), F.lower(t)).otherwise(_casefold(t))


def collapse(t: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.btrim(F.regexp_replace(t, r"(?U)\s+", " "))


def strip(t: Column) -> Column:
    return F.regexp_replace(t, r"(?U)^\s+|\s+\z", "")


def compare_form(t: Column, nfkc_first: bool = True) -> Column:
    """Form in which reads are compared: NFKC, no math tags, one dash, one space, case folded; null is empty."""
    t = F.coalesce(t, F.lit(""))
    t = nfkc(t) if nfkc_first else t
    t = collapse(F.regexp_replace(F.regexp_replace(t, P.MATH_TAG, ""), f"[{P.COMPARE_DASHES}]", "-"))
    return casefold(t) if nfkc_first else F.lower(t)


def light_form(t: Column) -> Column:
    return collapse(F.lower(F.coalesce(t, F.lit(""))))


def clean_markup(t: Column) -> Column:
    """Model output without front matter, fences, tags and the three entities."""
    t = F.regexp_replace(F.coalesce(t, F.lit("")), P.FRONT_MATTER, "")
    t = F.regexp_replace(F.regexp_replace(t, P.FENCE, ""), P.TAG, " ")
    for entity, char in P.ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return t


def lines(t: Column) -> Column:
    """Trimmed lines that are not blank; any line end counts."""
    t = F.regexp_replace(F.coalesce(t, F.lit("")), "\r\n?", "\n")
    return F.filter(F.transform(F.split(t, "\n", -1), strip), lambda x: x != "")


def engine_lines(t: Column, engine: Column) -> Column:
    """Display lines of an engine's read; separator lines of one layout engine are dropped."""
    raw = F.filter(
        F.split(F.regexp_replace(F.coalesce(t, F.lit("")), "\r\n?", "\n"), "\n", -1),
        lambda x: ~((engine == "surya") & F.regexp_like(x, F.lit(P.SEPARATOR_LINE))),
    )
    shown = F.transform(raw, lambda x: F.btrim(F.regexp_replace(collapse(x), P.MATH_TAG, "")))
    return F.filter(shown, lambda x: x != "")


def digits_as_int(t: Column) -> Column:
    """The digits of ``t`` as one number; null where there are none."""
    return F.regexp_replace(F.coalesce(t, F.lit("")), "[^0-9]", "").try_cast("bigint")


def canonical_engine(token: Column) -> Column:
    """Engine name of a file token; null for what is no engine; unknown tokens in lower case."""
    t = F.lower(token)
    known = F.create_map(*[F.lit(x) for kv in P.ENGINE_NAMES.items() for x in kv])
    return F.when(t.isin(*P.NOT_ENGINES), F.lit(None)).otherwise(F.coalesce(F.try_element_at(known, t), t))


def page_number(header: Column) -> Column:
    """First number of up to four digits in a header that is no year of the volume; null if none."""
    words = F.filter(F.split(F.coalesce(header, F.lit("")), r"\s+"), lambda w: w != "")
    found = F.transform(words, lambda w: F.regexp_extract(w, P.PAGE_NUMBER, 1))
    return F.get(F.filter(found, lambda n: (n != "") & ~n.isin(*P.YEARS_IN_HEADER)), F.lit(0))


def read_line_count(t: Column) -> Column:
    """Newlines, and one more for a last line without one."""
    n = F.char_length(t) - F.char_length(F.replace(t, F.lit("\n"), F.lit("")))
    return n + F.when((t != "") & ~t.endswith("\n"), 1).otherwise(0)


def stem_page(stem: Column) -> Column:
    return F.regexp_replace(stem, "_[^_]*$", "")


def stem_region(stem: Column) -> Column:
    return F.regexp_extract(stem, "_([^_]*)$", 1)


def volume_year(volume_id: Column) -> Column:
    return F.element_at(F.split(volume_id, "_"), -1)


def polygon_box(polygon: Column) -> Column:
    """[x0, y0, x1, y1] of an array of [x, y]."""
    xs, ys = F.transform(polygon, lambda p: F.get(p, F.lit(0))), F.transform(polygon, lambda p: F.get(p, F.lit(1)))
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def split_pixel(split_x: Column, image_width: Column, page_width: Column) -> Column:
    return F.floor(F.try_divide(split_x * image_width, page_width)).cast("int")


def is_protected(token: Column) -> Column:
    """Tokens that correction must not touch: any with a digit, and initials."""
    core = F.btrim(token, F.lit(",.;:()[]\"'«»"))
    initial = F.lit("^[A-ZÅÄÖ][.:][A-Za-zÅÄÖåäö]?$|^[A-ZÅÄÖ][.:]?$")
    return (core != "") & (F.regexp_like(core, F.lit("[0-9]")) | F.regexp_like(token, initial) | F.regexp_like(core, initial))


def byte_chunks(t: Column, budget: int = P.CHUNK_BYTES) -> Column:
    """Words of ``t`` in chunks of at most ``budget`` bytes (a longer word is a chunk of its own)."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("size"), F.lit(False).alias("any"))

    def add(acc, w):
        size = F.octet_length(w) + 1
        full = acc["any"] & (acc["size"] + size > budget)
        return F.struct(
            F.when(full, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]).alias("done"),
            F.when(full | ~acc["any"], w).otherwise(F.concat(acc["cur"], F.lit(" "), w)).alias("cur"),
            F.when(full, size).otherwise(acc["size"] + size).alias("size"),
            F.lit(True).alias("any"),
        )

    return F.aggregate(
        F.split(t, " ", -1), start, add, lambda a: F.when(a["any"], F.array_append(a["done"], a["cur"])).otherwise(a["done"])
    )


def region_value(v: Column) -> Column:
    """A region's value as struct<text, confidence>, from JSON text that is a string, an object or null."""
    is_object = F.regexp_like(v, F.lit(r"^\s*\{"))
    got = F.from_json(v, "struct<text:string,confidence:double>")
    plain = F.when(F.regexp_like(v, F.lit(r'^\s*"')), F.from_json(F.concat(F.lit('{"text":'), v, F.lit("}")), "struct<text:string,confidence:double>")["text"]).otherwise(v)
    return F.struct(
        F.coalesce(F.when(is_object, got["text"]).otherwise(F.when(v != "null", plain)), F.lit("")).alias("text"),
        F.when(is_object, got["confidence"]).alias("confidence"),
    )
