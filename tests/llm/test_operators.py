import collections
import hashlib
import os
import pickle
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from folioforge.llm import (
    decontam, fertility, language_id, license_scan, line_dedup, ngram_join, packing, secret_scan, substring_dedup,
)
from folioforge.llm.gsaca import suffix_array

from . import cases

LOWER = {c: c + 32 for c in range(65, 91)}
OPERATORS = {
    "license": lambda d: license_scan.license_scan(d),
    "lines": lambda d: line_dedup.line_dedup(d),
    "secrets": lambda d: secret_scan.secret_scan(d),
    "rules": lambda d: fertility.quality_rules(d, public_tokenizers.path("piece_bpe_32k.model")),
    "language": lambda d: language_id.language_id(d),
    "join": lambda d: ngram_join.ngram_join(d),
    "substrings": lambda d: substring_dedup.substring_dedup(d),
    "packing": lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json")),
    "decontam": lambda d: decontam.decontaminate(d, d.sparkSession.createDataFrame([(1, "a b c"), (None, "x"), (2, None), (3, "")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_tables_of_any_shape(spark, name):
    """Empty tables, clashing columns, nulls in every column."""
    empty = cases.table(spark, [])
    assert OPERATORS[name](empty).count() == 0
    nulls = cases.table(spark, [(None, None, None, None)] * 3, extra=False)
    assert OPERATORS[name](nulls).count() == 3
    full = cases.table(spark)
    got = OPERATORS[name](full)
    assert len({c.lower() for c in got.columns}) == len(got.columns)
    if name != "packing":
        assert got.count() == len(cases.rows())


def sql(query, **tables):
    con = duckdb.connect()
    for name, data in tables.items():
        con.register(name, data)
    return con.sql(query).fetchall()


def plain(data):
    return pd.DataFrame({"doc_id": pd.array([r[0] for r in data], dtype="Int64"), "text": [r[1] for r in data]})


def test_line_dedup(spark):
    seen, data = set(), []
    for r in cases.rows():
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            data.append(r)
    got = line_dedup.line_dedup(cases.table(spark, data)).collect()
    mine = {r["doc_id"]: (r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in got}
    expect = {r[0]: tuple(r[1:]) for r in sql(line_dedup.SQL, documents=plain(data))}
    assert mine == expect
    assert sum(v[1] for v in mine.values()) > 10


def test_line_dedup_repeated_rows(spark):
    line = "a line that is long enough to count"
    data = [(1, line + "\nx", "en", "s")] * 3 + [(2, line, "en", "s"), (2, line, "en", "s"), (3, "q\n" + line, "en", "s")]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.line_dedup(cases.table(spark, data)).collect())
    assert got == [(1, "x")] * 3 + [(2, ""), (2, ""), (3, "q\n" + line)]


def test_license_scan(spark):
    data = [r for r in cases.rows() if r[0] is not None][:12] + [(50, "MIT LICENSE\n(c) 1999 Me\n" + license_scan.TEXTS["MIT"][12:].replace("Software", "software"), "en", "s")]
    got = license_scan.license_scan(cases.table(spark, data)).collect()
    mine = {r["doc_id"]: (r["license_id"], r["n_notices"], ",".join(r["notices"])) for r in got}
    expect = {r[0]: tuple(r[1:]) for r in sql(license_scan.SQL, documents=plain(data))}
    assert mine == expect
    assert mine[50][0] == "MIT" and mine[11][0] == "MIT" and mine[10] == (None, 1, "MIT")


def test_license_wrapped_anywhere(spark):
    """A text's digest is the same however its lines are wrapped."""
    import textwrap

    data, want = [], {}
    for key in ("MIT", "ISC", "0BSD", "Zlib"):
        for width in (30, 50, *range(60, 100), 120):
            want[len(data)] = key
            data.append((len(data), "\n".join("\n".join(textwrap.wrap(p, width)) for p in license_scan.TEXTS[key].split("\n")), "en", "s"))
    got = {r["doc_id"]: r["license_id"] for r in license_scan.license_scan(cases.table(spark, data)).collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_entire_licenses(spark):
    """Whole texts under usual titles, with notices, and with lines that begin with 'copyright' wherever they are wrapped."""
    mit = license_scan.TEXTS["MIT"][12:]
    broken = lambda t: re.sub(r"(?i) (?=copyright(?! *(?:\(c\)|©|\[|owner\])))", "\n", t)
    data = [("MIT", f"{title}\n\nCopyright (c) 2020 Someone\n\n{body}") for title in ("The MIT License (MIT)", "The MIT License", "") for body in (mit, broken(mit))]
    data += [("MIT", "MIT License\n" + notice + "\n" + mit) for notice in ("Copyright Someone Ltd.", "Copyright 2020 The Authors", "© 1999 Me", "Copyright (c) Rights Inc")]
    root = os.path.dirname(license_scan.__file__)
    for name in sorted(os.listdir(os.path.join(root, "licenses"))):
        with open(os.path.join(root, "licenses", name), encoding="utf-8") as f:
            text = f.read()
        data += [(name[:-4], " " + text), (name[:-4], broken(text)), (name[:-4], text.replace("\n", "\r\n"))]
        if "END OF TERMS AND CONDITIONS" in text:
            data.append((name[:-4], text.split("END OF TERMS AND CONDITIONS")[0]))
    bsd = license_scan._bsd(3, "the copyright holder", "COPYRIGHT HOLDERS", "COPYRIGHT HOLDER", True)
    data += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n" + bsd), ("BSD-2-Clause", re.sub(r"\n3\. .*", "", bsd)), (None, bsd + " And more.")]
    if os.path.exists("/usr/share/common-licenses/BSD"):
        with open("/usr/share/common-licenses/BSD") as f:
            data.append(("BSD-3-Clause", f.read()))
    got = license_scan.license_scan(cases.table(spark, [(k, t, "en", "s") for k, (_, t) in enumerate(data)])).collect()
    found = {r["doc_id"]: r["license_id"] for r in got}
    assert [(k, key, found[k]) for k, (key, _) in enumerate(data) if found[k] != key] == []


def base_secrets(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("(?:", "(?i:"), text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_secret_scan(spark):
    shown = "Zk93JdLm27QpWx81RtYv55Ab"
    data = cases.rows() + [(900 + k, f"\U0001f600 see {shown} here", "en", f"o{k}") for k in range(3)]
    data += [(950 + k, "mine Qw7eRt91YuIo22PaSd44FgZ9 token", "en", "only") for k in range(4)]
    got = secret_scan.secret_scan(cases.table(spark, data)).collect()
    texts = collections.defaultdict(list)
    for r in data:
        texts[r[0]].append(base_secrets(r[1]))
    for r in got:
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secrets"] if s["kind"] != "token"] in texts[r["doc_id"]]
    by_id = {r["doc_id"]: r["secrets"] for r in got}
    assert by_id[6] and by_id[7]
    assert not by_id[900]  # three owners have it: a copied example
    assert [(s["kind"], s["n_repos"], s["n_owners"], s["live"]) for s in by_id[950]] == [("token", 4, 1, True)]


def test_secret_in_many_repositories(spark):
    """One owner's value is live in few repositories and an example in many; the verdict decides whether a token is a span."""
    few, many = "Qw7eRt91YuIo22PaSd44FgZ9", "Xk3PzLm81VbNq55TyUi20OpAs"
    data = [(k, f"see {many}", "en", "one") for k in range(9)] + [(50 + k, f"see {few} and {many[::-1]}", "en", "one") for k in range(8)] + [(90, "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "en", "b")]
    got = {r["doc_id"]: [(s["kind"], s["n_repos"], s["live"]) for s in r["secrets"]] for r in secret_scan.secret_scan(cases.table(spark, data)).collect()}
    assert got[0] == [] and got[50] == [("token", 8, True)] * 2 and got[90] == [("token", 1, True)]


def test_secret_scan_of_many_matches(spark):
    """Places are right over many runs of matches, and the SQL says the same of every case."""
    text = " ".join(f"é{k} token={k:08x}zz AKIA{k:016d}" for k in range(700))
    data = [r for r in cases.rows() if r[0] is not None]
    data = list({r[0]: r for r in data}.values()) + [(8000, text, "en", "a"), (8001, "Zk93JdLm27QpWx81RtYv55Ab", "en", None)]
    got = secret_scan.secret_scan(cases.table(spark, data)).collect()
    by_id = {r["doc_id"]: [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secrets"]] for r in got}
    assert [s for s in by_id[8000] if not s.startswith("token")] == base_secrets(text)
    frame = pd.DataFrame({"doc_id": [r[0] for r in data], "text": [r[1] for r in data], "source": [r[3] for r in data]})
    assert {r[0]: r[5] for r in sql(secret_scan.SQL, documents=frame)} == {i: ",".join(s) for i, s in by_id.items()}


def test_fertility_measures():
    """Characters per token, byte share and entropy by their definitions."""
    import math

    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r[1] for r in cases.rows(20)] + ["", None, "\U0001f9ff\u0f00 ཀ" * 40, "a" * 5000]
    got = fertility.fertility(path)(texts)
    for k, t in enumerate(texts):
        pieces = sp.encode(t or "", out_type=str)
        count = collections.Counter(pieces)
        back = sum(n for p, n in count.items() if re.fullmatch("<0x[89A-F].>", p))
        n = len(pieces)
        want = (n, len(t) / n, back / n, -sum(c / n * math.log2(c / n) for c in count.values())) if n else (0, 0.0, 0.0, 0.0)
        assert (got["n_tokens"][k], got["chars_per_token"][k], got["byte_share"][k], got["entropy"][k]) == pytest.approx(want, abs=1e-9)


def test_byte_vocabulary_measures():
    """Single bytes from 0x80 on, found by what the vocabulary's own library decodes."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(path)
    texts = ["plain words", "\U0001f9ff\u0f00 ཀ ཁ " * 30, "für naïve café " * 20, "", None]
    got = fertility.fertility(path, "_bytes")(texts)
    for k, t in enumerate(texts):
        e = exact.encode(t or "", add_special_tokens=False)
        # a token that covers no whole character of the text and is one letter of the byte alphabet
        lone = sum(len(x) == 1 and len(exact.decode([i]).encode()) != 1 and exact.decode([i]) == "\ufffd" for i, x in zip(e.ids, e.tokens, strict=True))
        assert got["n_tokens_bytes"][k] == len(e.ids) and got["byte_share_bytes"][k] * max(len(e.ids), 1) == pytest.approx(lone)
    assert got["byte_share_bytes"][1] > 0.3 and got["byte_share_bytes"][2] == 0


def test_quality_rules(spark):
    got = fertility.quality_rules(cases.table(spark), public_tokenizers.path("piece_bpe_32k.model")).collect()
    data = cases.rows()
    for r, (doc, text, *_) in zip(got, data, strict=True):
        assert r["doc_id"] == doc
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        repeat = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(repeat)
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_bands_reject(spark):
    clean = "The committee published its annual report on the state of public libraries, noting that visits had risen in every region since the previous survey was taken. " \
            "Several members asked how the new reading rooms would be paid for and whether evening hours could be kept through the winter months. " * 2
    noise = "".join(f"{'XQZJKW'[k % 6]}{'#%&*'[k % 4]}{'vbxz'[k % 4]}%%% " for k in range(400))
    got = fertility.quality_rules(cases.table(spark, [(1, clean, "en", "s"), (2, noise, "en", "s"), (3, clean, None, "s")]), public_tokenizers.path("piece_bpe_32k.model"))
    assert [r["in_band"] for r in got.orderBy("doc_id").collect()] == [True, False, True]


def test_language_id(spark):
    words = {"en": "the of and that with from this have which were".split(), "de": "der die und nicht mit eine sich auch werden über".split(), "fr": "le la des que dans pour était avec être même".split()}
    data = [(k, " ".join(words[lang][(k * 3 + j * j) % 10] for j in range(20 + k % 30)), lang, "s") for k in range(240) for lang in [sorted(words)[k % 3]]]
    data += [(1000, None, "en", "s"), (1001, "123 !!", "en", "s"), (1002, "", None, "s"), (1003, "der und die", None, "s"), (None, "the of", "en", "s")]
    got = language_id.language_id(cases.table(spark, data)).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 50 and sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by_id[k] for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]


def test_language_of_letters_of_every_plane():
    model = language_id.Model(["en", "zh"], np.zeros((1 << 16, 2)), np.zeros(2), 1.0, 16)
    got = model.predict(["\U00030000\U00031000", "\U0002ffff 12 !", "\U0001f600", None])
    assert [p for p in got["lang_pred"]] == ["en", "und", "und", "und"]


def test_language_fit_is_ftrl():
    """The weights against a plain loop over features, one at a time."""
    import math

    r = np.random.default_rng(4)
    words = {"en": ["the", "and", "house"], "de": ["der", "und", "haus"], "fr": ["le", "et", "maison"]}
    rows = [(" ".join(r.choice(words[l], 6)), l, k % 4 == 0) for k, l in enumerate(["en", "de", "fr"] * 8)]
    bits, alpha, beta, l1, l2, scale = 8, 0.3, 1.0, 5e-2, 1e-3, 20.0
    model = language_id.fit(rows, bits=bits, epochs=2)
    labels = sorted(words)
    grams = []
    for t, *_ in rows:
        slots, firsts, _ = language_id.features([t], bits)
        flat = [int(x) for k, s in enumerate(slots) for x in s[firsts[k][0] : max(firsts[k][1] - k, firsts[k][0])]]
        grams.append({i: flat.count(i) / len(flat) for i in sorted(set(flat))})
    df = collections.Counter(i for g in grams for i in g)
    idf = {i: math.log((1 + len(rows)) / (1 + n)) + 1 for i, n in df.items()}
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i, c, l1=l1):
        v = z[i, c]
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(n[i, c])) / alpha + l2)

    train = [k for k, row in enumerate(rows) if not row[2]]
    order = np.random.default_rng(0)
    for _ in range(2):
        for k in order.permutation(len(train)):
            g, y = grams[train[k]], labels.index(rows[train[k]][1])
            x = {i: scale * v * idf[i] for i, v in g.items()}
            w = {(i, c): weight(i, c) for i in x for c in range(3)}
            base = [weight("intercept", c, 0.0) for c in range(3)]
            e = [math.exp(sum(x[i] * w[i, c] for i in x) + base[c]) for c in range(3)]
            for c in range(3):
                off = e[c] / sum(e) - (c == y)
                z["intercept", c] += off - (math.sqrt(n["intercept", c] + off * off) - math.sqrt(n["intercept", c])) / alpha * base[c]
                n["intercept", c] += off * off
                for i, v in x.items():
                    d = v * off
                    z[i, c] += d - (math.sqrt(n[i, c] + d * d) - math.sqrt(n[i, c])) / alpha * w[i, c]
                    n[i, c] += d * d
    for i in idf:
        assert model.table[i].tolist() == pytest.approx([weight(i, c) * scale * idf[i] for c in range(3)], rel=1e-6, abs=1e-9)
    assert model.bias.tolist() == pytest.approx([weight("intercept", c, 0.0) for c in range(3)], rel=1e-6)
    again = pickle.loads(pickle.dumps(model))
    assert (again.table == model.table).all() and (model.table == 0).any(axis=1).sum() > 0
    # the temperature is the best one for the rows kept back, with one row of smoothing for each label
    back = [row for row in rows if row[2]]
    logits, _ = model.logits([t for t, *_ in back])
    right = [labels.index(row[1]) for row in back]

    def loss(t):
        q = np.log(np.maximum(language_id.softmax(logits / t), 1e-12))
        return -q[np.arange(len(back)), right].mean() - q.mean() / (len(back) + 1)

    assert all(loss(model.temperature) <= loss(t) + 1e-9 for t in (0.05, 0.3, 1.0, 1.5, 2.5, 8.0))


def test_language_id_without_labels(spark):
    got = language_id.language_id(cases.table(spark, [(1, "text", None, "s")])).collect()
    assert got[0]["lang_pred"] == "und" and got[0]["score"] == 0


def test_language_sample_has_all_languages(spark):
    """Tables ordered by language, huge texts and many languages: every language is in the fit, however rows are partitioned."""
    data = [(k, f"{lang} wort " * (3000 if k % 100 == 0 else 20), lang, "s") for j, lang in enumerate(["aa", "bb", "cc", "dd", "ee"]) for k in range(j * 100, j * 100 + 100)]
    got = [sorted(language_id.sample(cases.table(spark, rows).repartition(n) if n else cases.table(spark, rows).coalesce(1), "doc_id", "text", "lang", max_chars=10_000)) for n, rows in ((0, data), (7, data[::-1]))]
    assert got[0] == got[1]
    n = collections.Counter(lang for _, lang, _ in got[0])
    assert sorted(n) == ["aa", "bb", "cc", "dd", "ee"] and min(n.values()) >= 10
    assert sum(len(t) for t, _, _ in got[0]) <= 10_000
    huge = [(k, "x" * 900 if k < 20 else "short", "big" if k < 20 else "small", "s") for k in range(40)]
    assert {lang for _, lang, _ in language_id.sample(cases.table(spark, huge), "doc_id", "text", "lang", max_chars=1000)} == {"big", "small"}
    many = [(k, "text", f"l{k % 300}", "s") for k in range(3000)]
    assert len({lang for _, lang, _ in language_id.sample(cases.table(spark, many), "doc_id", "text", "lang")}) == 300


def test_decontamination(spark):
    bench = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"), (3, None), (4, "!!"),
             (5, " ".join(f"w{k % 7}" for k in range(30))), (10, "five six seven eight nine ten eleven twelve thirteen fourteen one two three")]
    long = "one two three four five six seven eight nine ten eleven twelve thirteen"
    data = [(1, "x " + long + " y", "", ""), (2, long[4:], "", ""), (3, "A SHORT,Item here", "", ""), (4, None, "", ""), (5, "", "", ""),
            (6, " ".join(f"w{k % 7}" for k in range(200)), "", ""), (7, long.replace(" ", "\n!") + " fourteen " + "z " * 600, "", ""), (8, long + " " + long, "", ""), (9, "short", "", "")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    for words in (decontam.SHARD_WORDS, 20):  # one automaton, and several
        got = decontam.decontaminate(cases.table(spark, data), items, shard_words=words).collect()
        expect = decontam.brute_force([r[:2] for r in data], bench)
        for r in got:
            digest = hashlib.sha256(",".join(sorted(r["hit_items"])).encode()).hexdigest()
            assert (r["n_words"], r["n_hit"], r["n_items"], digest, r["contaminated"]) == expect[r["doc_id"]]
    cleaned = {r["doc_id"]: r["clean_text"] for r in decontam.cut_contaminated(decontam.decontaminate(cases.table(spark, data), items)).collect()}
    assert cleaned[1] == "x  y" and cleaned[3] == "A  here" and cleaned[4] is None and cleaned[7].startswith("one\n!two")


def test_one_shard_at_a_time():
    """Ten shards, and never two of them in use."""
    import weakref

    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(10)] + [(3, "i3w0 short"), (7, "i3w0 short")]
    built = [decontam.build([x]) for x in items]
    alive, most = weakref.WeakSet(), []

    def matchers():
        for a in built:
            m = decontam.Matcher(a.__getitem__)
            alive.add(m)
            most.append(len(alive))
            yield m
            del m

    texts = [f"x {items[4][1]} y {items[9][1]}", "i3w0 short", None, items[2][1][:-6]]
    got = decontam.mark(texts, matchers())
    assert max(most) <= 2 and len(most) == len(items)  # the one before goes as the next one comes
    expect = decontam.brute_force(list(enumerate(texts)), items)
    for k, (n, ranges, found) in enumerate(got):
        hit = sum(b - a for a, b in decontam.merged(ranges))
        assert (n, hit, len(found)) == expect[k][:3]


def test_packing(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(path)  # with its own settings
    data = cases.rows() + [(7000, "a <|endoftext|> b", "en", "a"), (7001, "日本 <|endoftext|>", "en", "a")]
    assert exact.encode(data[-2][1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = packing.pack(cases.table(spark, data), path, with_ids=True).collect()
    pieces, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and len(r["ids"]) == r["length"] > 0
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    want = collections.defaultdict(list)
    for doc, text, *_ in data:
        want[doc].append(exact.encode(text or "", add_special_tokens=False).ids + [0])
    for doc, texts in want.items():
        copies = sorted(pieces[doc], key=lambda p: p[0])
        total = sum(len(p[1]) for p in copies)
        assert total == sum(map(len, texts))
        if len(texts) == 1:
            assert [i for p in copies for i in p[1]] == texts[0] and {p[2] for p in copies} == {total}


def test_packing_wastes_little():
    r = np.random.default_rng(0)
    bins, full, used = packing.Bins(0), 0, 0
    for n in r.integers(1, 3000, 4000).tolist():
        assert sum(packing.cuts(n)) == n
        for length in packing.cuts(n):
            used += length
            full += bins.add([length]) is not None
    full += len(bins.rest())
    assert used / (full * 1024) > 0.98


def test_ngram_join(spark):
    seen, data = set(), []
    for r in cases.rows(300):
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            data.append(r)
    got = ngram_join.ngram_join(cases.table(spark, data)).collect()
    expect = ngram_join.brute_force([r[:2] for r in data])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expect
    assert sum(k != v[1] for k, v in expect.items()) > 20


def test_ngram_join_with_clashing_digests(spark, monkeypatch):
    """Sets that share a first digest are told apart by the second one, and all is done again with another seed."""
    plain_digest = ngram_join.digest
    monkeypatch.setattr(ngram_join, "members", _clashing(ngram_join.members))
    data = [(k, " ".join(f"w{k}x{j}" for j in range(9)), "", "") for k in range(6)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(cases.table(spark, data)).collect()}
    assert got == {k: k for k in range(6)} and plain_digest(np.arange(3, dtype=np.uint64), 1) != plain_digest(np.arange(3, dtype=np.uint64))


def _clashing(members):
    def made(docs, text_col, size, drop_text=True, seed=0):
        from pyspark.sql import functions as F

        got = members(docs, text_col, size, drop_text, seed)
        return got.withColumn("cls", F.lit(7).cast("long")) if seed == 0 else got

    return made


@pytest.mark.parametrize("hot", [2, 64])
def test_ngram_join_hot_passages(spark, hot, monkeypatch):
    """One group of near copies, and a passage in every document; chains of links."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "SPLIT", 4 * hot)
    passage = [f"p{k}" for k in range(40)]
    data = [(k, " ".join(passage + [f"d{k}x{j}" for j in range(k % 60)]), "", "") for k in range(150)]
    base = [f"b{k}" for k in range(100)]
    data += [(1000 + k, " ".join(base[: 100 - k] + [f"c{j}" for j in range(k)]), "", "") for k in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(cases.table(spark, data)).collect()}
    assert got == ngram_join.brute_force([r[:2] for r in data])


def test_suffix_array():
    r = np.random.default_rng(3)
    for n in range(60):
        for letters in (1, 2, 3, 40):
            t = r.integers(1, letters + 1, n).tolist()
            assert suffix_array(t) == sorted(range(n), key=lambda k: t[k:])


@pytest.mark.parametrize("hot, size", [(2, 120_000), (4096, 120_000), (2, 50), (4096, 50)])
def test_substring_dedup(spark, hot, size, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SUB_SIZE", size)
    monkeypatch.setattr(substring_dedup.shared_anchors, "__defaults__", (hot,))
    seen, data = set(), []
    for r in cases.rows(150):
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            data.append(r)
    data += [(k, data[-1][1][: 48 + k % 4] + " ab" * k, "", "") for k in range(2000, 2030)]
    got = substring_dedup.substring_dedup(cases.table(spark, data), with_kept=True).collect()
    expect = substring_dedup.brute_force([r[:2] for r in data])
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == expect
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert sum(v[1] > 0 for v in expect.values()) > 20


def test_substring_dedup_hot_anchors_do_not_grow_with_the_corpus(spark):
    r = np.random.default_rng(5)
    passage = lambda: "".join(r.choice(list("abcdefghij "), 90))
    once, often = [passage() for _ in range(400)], passage()
    data = [(2 * i + k, t, "en", "s") for i, t in enumerate(once) for k in range(2)] + [(10_000 + i, often, "en", "s") for i in range(5)]
    shared = substring_dedup.shared_anchors(cases.table(spark, data).select("doc_id", "text"), 4)
    hot = [substring_dedup._store.mapped(f"{shared.folder}/hot-{b}", np.uint8) for b in range(len(shared.sizes))]
    assert sum(len(h) for h in hot) >= 401 and not any(h.any() for h in hot)


def test_substring_dedup_sorts_only_windows_that_can_meet(monkeypatch):
    def part(sides):  # contexts of one anchor: what is before and after it
        raw = np.frombuffer(b"".join(a + b for a, b in sides), dtype=np.uint8)
        n = len(sides)
        return [
            np.full(n, 9, np.uint64), np.diff(np.arange(1, n + 1, dtype=np.uint64), prepend=np.uint64(0)), np.arange(n), np.full(n, 90),
            np.array([len(a) for a, _ in sides], np.uint8), np.array([len(a) + len(b) + substring_dedup.K for a, b in sides], np.uint8), np.zeros(n, np.uint8), raw,
        ]

    sorted_, true = [], substring_dedup.suffix_array
    monkeypatch.setattr(substring_dedup, "suffix_array", lambda t: sorted_.append(len(t)) or true(t))
    # ten bytes to the left and ten to the right are shared: not enough for a window
    near = [(b"A" * 14 + b"b" * 10, b"c" * 10 + b"D" * 14), (b"E" * 14 + b"b" * 10, b"c" * 10 + b"F" * 14)]
    key, first, last, value, _ = substring_dedup._solve([part(near)])
    assert not sorted_ and list(zip(key, first, last, value, strict=True)) == [(1, 0, 24, 0), (2, 0, 24, 1)]
    # ten to the left and fourteen to the right make one window
    near = [(b"A" * 14 + b"b" * 10, b"c" * 14 + b"D" * 10), (b"E" * 14 + b"b" * 10, b"c" * 14 + b"F" * 10)]
    got = sorted(zip(*(x.tolist() for x in substring_dedup._solve([part(near)])[:4]), strict=True))
    assert len(sorted_) == 1 and sorted_[0] <= 2 * (10 + 1 + 14 + 1) and [g for g in got if g[0] == 2] == [(2, 0, 13, 1), (2, 14, 14, 0), (2, 15, 24, 1)]


def test_substring_dedup_sends_many_buckets_in_one_batch():
    at = np.arange(0, 3 * 600 + 1, 3)
    assert len(list(substring_dedup._sealed(at, 600, 1, lambda own: (np.arange(own.start, own.stop),)))) == 1


def test_substring_dedup_null_and_repeated_ids(spark):
    text = "this passage is quite a bit longer than fifty bytes, so that it counts as a repeat"
    data = [(5, text, "", ""), (5, text, "", ""), (None, text, "", ""), (7, "x" + text, "", "")]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.substring_dedup(cases.table(spark, data)).collect())
    assert got == [(False, 5, 0), (False, 5, 0), (False, 7, len(text)), (True, 0, len(text))]
