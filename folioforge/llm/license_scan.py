"""License scans by canonical digest lookup. DataFrame functions throughout.

Texts are normalised so that copies of one licence agree: A-Z lower-cased, lines of copyright notices taken
out, equivalent spellings made one, punctuation and white space made single blanks. The digest of an
entire normalised text is then looked up among the digests of known licences by a hash join; the same
lookup is made for each line as a text of its own, which finds licence notices inside documents.

The known licences are a registry that callers may extend (``known``: DataFrame of license_id, text). It is
broadcast only while it has at most ``BROADCAST_ROWS`` rows; a larger registry is joined by shuffle.

Defined cases: a null text has no licence and no lines; a text that is empty once normalised matches nothing; an empty
table gives an empty table; several registry texts with one digest give the first id by name; repeated rows are
scanned each; a very long text is normalised whole, in one row; extra columns stay, but for those of the names that are made here, which are replaced.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Spellings that count as the same, the second being the one used.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("copyright owner", "copyright holder"),
    ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("favour", "favor"), ("fulfil ", "fulfill "), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labour", "labor"), ("non-commercial", "noncommercial"),
    ("per cent", "percent"), ("programme", "program"), ("recognise", "recognize"), ("utilisation", "utilization"),
    ("while", "whilst"), ("wilful", "willful"), ("http:", "https:"), ("(c)", "©"), ("&", " and "),
)
COPYRIGHT = r"(?m)^[^a-z0-9\n]*(copyright|©)[^\n]*$|(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
# The rule of the scan: as COPYRIGHT (which the SQL has), but body text whose line begins with the word, or with (c) and no year, stays.
BODY_WORDS = (
    "also|and|are|assignment|claims?|disclaimers?|doctrines?|for|holders?|holdership|if|in|infringement|interests?|is|law|laws|licenses?|like|lines?|material|notices?|of|on|or|"
    "owners?|ownership|patents?|permissions?|protection|resulting|rights?|statements?|status|statutes?|that|the(?= *(?:$|software|library))|those|to|trademarks?|treaty|treatment|which|with"
)
NOTICE_LINE = (
    r"(?m)^[^a-z0-9\n]*(?:©[^a-z0-9\n]*(?:copyright[^a-z0-9\n]*)?(?:[12][0-9]{3}|19[xy]{2}|yyyy|year)|copyright(?![a-z.;])(?![^a-z0-9©\n]*(?:" + BODY_WORDS + r")(?![a-z]))(?=[^\n]*[a-z0-9©]))[^\n]*$"
    r"|(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
)
MARKS = r"""[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f“”‘’–—…©®™ ]+"""

# Short licence texts and notices. Names and phrases below are combined by rule.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED'
TEXTS = {
    "MIT": "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _AS_IS + ", INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
}
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL v2", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL v3", "GNU GPL v3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
}
PHRASES = (
    "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.",
    "This work is licensed under {}.", "This work is licensed under the {}.", "SPDX-License-Identifier: {}",
)


def registry() -> list[tuple[str, str]]:
    """(license_id, text) of the built-in texts and notices."""
    out = list(TEXTS.items())
    for key, names in NAMES.items():
        out += [(key, p.format(n)) for p in PHRASES for n in (*names, key)]
    return out


FOLDER = Path(__file__).parent / "licenses"
TITLES = {
    "MIT": ("", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"),
    "Zlib": ("zlib License", "The zlib License"),
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
}
_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of {name} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_BSD_NAMES = ("the copyright holder", "the copyright holders", "the author", "the University", "the organization", "the project")
_BSD_LIABLE = (
    ("copyright holders", "copyright holder"), ("copyright holders", "copyright holders"), ("regents", "regents"), ("author", "author"), ("authors", "authors"),
)


def _bsd(clauses: int, name: str, by: str, liable: str, numbered: bool) -> str:
    conditions = [f"{k}. {c}" if numbered else c for k, c in enumerate(_CONDITIONS[:clauses], 1)]
    return "\n".join((
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        *conditions,
        f'THIS SOFTWARE IS PROVIDED BY THE {by} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
        f"IN NO EVENT SHALL THE {liable} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    )).format(name=name)


def entire_texts() -> list[tuple[str, str]]:
    """(license_id, text) of entire licences besides the registry's: titles and usual variants, and the texts of ``FOLDER``."""
    bodies = [("MIT", TEXTS["MIT"].removeprefix("MIT License\n"))] + [(k, TEXTS[k]) for k in ("ISC", "0BSD", "Zlib")]
    bodies += [
        (f"BSD-{clauses}-Clause", _bsd(clauses, name, *pair, numbered))
        for clauses, names in ((2, ("",)), (3, _BSD_NAMES)) for name in names for pair in _BSD_LIABLE for numbered in (True, False)
    ]
    out = [(key, f"{title}\n{body}") for key, body in bodies for title in TITLES[key]]
    for path in sorted(FOLDER.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        # with and without the advice on how to apply the terms, and the line that ends them
        out += [(path.stem, t) for t in dict.fromkeys((text, terms + end, terms))]
    return out


def normalise(text: Column) -> Column:
    """Canonical form; lines stay apart."""
    out = F.translate(text, UPPER, LOWER)
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.regexp_replace(out, NOTICE_LINE, "")
    return F.regexp_replace(out, MARKS, " ")


def _whole(norm: Column) -> Column:
    return F.btrim(F.regexp_replace(norm, "[ \n]+", " "))


def known_digests(spark, known: DataFrame | None = None) -> DataFrame:
    rows = spark.createDataFrame(registry() + entire_texts(), "license_id string, text string")
    if known is not None:
        rows = rows.unionByName(known.select("license_id", "text"))
    canon = rows.select("license_id", _whole(normalise(F.col("text"))).alias("canon")).where("canon <> ''")
    return canon.groupBy(F.sha2("canon", 256).alias("digest")).agg(F.min("license_id").alias("known_id"))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None
) -> DataFrame:
    """``docs`` with license_id (of the entire text, or null), n_notices and notices (ids of lines that are licences)."""
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    if known is None or known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    made = ["license_id", "n_notices", "notices"]
    keep = [c for c in docs.columns if c.lower() not in made or c == text_col]
    key = [F.coalesce(F.xxhash64(F.col(f"`{id_col}`")), F.lit(0)).alias("k1"), F.xxhash64(F.col(f"`{text_col}`")).alias("k2")]
    norm = docs.select(*key, normalise(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("norm")).select(
        "k1", "k2", "norm", F.split("norm", "\n", -1).alias("lines")
    )
    # position -1 is the entire text; lines that hold neither a licence word nor a known short form still go through
    cand = F.concat(F.array(F.struct(F.lit(-1).alias("pos"), F.sha2(_whole(F.col("norm")), 256).alias("digest"))),
                    F.transform("lines", lambda x, i: F.struct(i.alias("pos"), F.sha2(F.btrim(x), 256).alias("digest"))))
    hits = (
        norm.select("k1", "k2", F.explode(cand).alias("c"))
        .join(digests, F.col("c.digest") == F.col("digest"))
        .select("k1", "k2", F.col("c.pos").alias("pos"), "known_id")
        .distinct()
        .groupBy("k1", "k2")
        .agg(
            F.max(F.when(F.col("pos") == -1, F.col("known_id"))).alias("license_id"),
            F.count(F.when(F.col("pos") >= 0, 1)).alias("n_notices"),
            F.array_sort(F.collect_set(F.when(F.col("pos") >= 0, F.col("known_id")))).alias("notices"),
        )
        .withColumnsRenamed({"k1": "g1", "k2": "g2"})
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *key)
    return row.join(hits, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left").select(
        "row.*", "license_id", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = license_scan(docs.select("doc_id", "text"))
    return got.select("doc_id", "license_id", "n_notices", F.array_join("notices", ",").alias("notices"))


def _sql_normalise(x: str) -> str:
    out = f"translate({x}, '{UPPER}', '{LOWER}')"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    out = f"regexp_replace({out}, '{COPYRIGHT}', '', 'g')"
    return f"regexp_replace({out}, '{MARKS}', ' ', 'g')"


def _sql() -> str:
    rows = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in registry())
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS known_id FROM (
    SELECT license_id, trim(regexp_replace({_sql_normalise('text')}, '[ \\n]+', ' ', 'g')) AS digest
    FROM (VALUES {rows}) r(license_id, text)) WHERE digest <> '' GROUP BY digest),
norm AS (SELECT doc_id, {_sql_normalise("coalesce(text, '')")} AS norm FROM documents),
lines AS (SELECT doc_id, unnest(string_split(norm, chr(10))) AS line FROM norm),
entire AS (
  SELECT n.doc_id, max(k.known_id) AS license_id
  FROM norm n JOIN known k ON trim(regexp_replace(n.norm, '[ \\n]+', ' ', 'g')) = k.digest GROUP BY n.doc_id),
notice AS (
  SELECT l.doc_id, count(*) AS n_notices, string_agg(DISTINCT k.known_id, ',' ORDER BY k.known_id) AS notices
  FROM lines l JOIN known k ON trim(l.line) = k.digest GROUP BY l.doc_id)
SELECT d.doc_id, e.license_id, coalesce(n.n_notices, 0) AS n_notices, coalesce(n.notices, '') AS notices
FROM documents d LEFT JOIN entire e ON d.doc_id = e.doc_id LEFT JOIN notice n ON d.doc_id = n.doc_id
"""


SQL = _sql()
