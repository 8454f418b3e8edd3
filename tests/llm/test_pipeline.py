import collections
import os

import duckdb
import pytest
import public_tokenizers
from folioforge.llm import decontam, line_dedup, ngram_join, registry
from tokenizers import Tokenizer

from .. import oracle
from . import cases

needs_data = pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="the driver's tables are not here")


def fixture(n=150):
    seen, out = set(), []
    for r in cases.rows(n):
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append((*r, len(r[1]) if r[1] is not None else None))
    return out


BENCH = [(1, "benchmark item words that stand in no other place of this small fixture at all today"), (2, "the lazy dog"), (3, None)]


def test_pipeline_against_definitions(spark, tmp_path):
    import corpus_pipeline as cp

    data = fixture() + [(5000, BENCH[0][1] + " and a little more", "en", "s", 1), (5001, BENCH[0][1] + " x y z" * 200, "en", "s", 1)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = []
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{name}")
        docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        steps.append(docs)
    for df in steps[:-1]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    text = {r[0]: r[1] for r in data}
    expect = {i: t for i, t in text.items() if t and any(map(str.isalpha, t))}
    assert {r["doc_id"] for r in steps[0].collect()} == set(expect)
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": list(expect), "text": list(expect.values())}))
    dropped = {r[0]: r[2] for r in con.sql(line_dedup.SQL).project("doc_id, n_lines, n_dropped").fetchall()}
    lined = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    assert {i: expect[i].count("\n") - lined[i].count("\n") for i in lined if lined[i]} == {i: dropped[i] for i in lined if lined[i]}
    assert all(r["n_chars"] == len(r["text"]) for r in steps[1].collect())
    groups = ngram_join.brute_force(list(lined.items()))
    first = {i for i, (_, c) in groups.items() if c == i}
    assert {r["doc_id"] for r in steps[2].collect()} == first and len(first) < len(lined)
    marks = decontam.brute_force([(i, lined[i]) for i in first], BENCH)
    clean = {i for i in first if not marks[i][4]}
    assert {r["doc_id"]: r["text"] for r in steps[3].collect()} == {i: lined[i] for i in clean} and 5000 not in clean and 5001 in clean
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = collections.Counter()
    for r in steps[4].collect():
        got[r["doc_id"]] += r["length"]
    assert got == {i: len(exact.encode(lined[i], add_special_tokens=False).ids) + 1 for i in clean}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SHAPES = {
    "empty": ([], ""),
    "nulls": ([(None, None, None, None, None)] * 3 + [(1, "one text", "en", "s", 8)], ""),
    "repeated rows": ([(1, "a text of some words that stands here twice", "en", "s", 43)] * 2 + [(2, "quite another text with letters", "en", "s", 31)], ""),
    "clashing columns": ([(1, "a first text", "en", "s", 12, "kept", 5), (2, "and a second one", "de", "s", 16, "kept", 6)], ", CLS string, n_words int"),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_stages_on_tables_of_any_shape(spark, tmp_path, shape):
    """Every stage gives the columns of its input; repeated rows of an id stay repeated; rows without a text or letter go in the first."""
    import corpus_pipeline as cp

    rows, more = SHAPES[shape]
    docs = spark.createDataFrame(rows, SCHEMA + more)
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{name}")
        docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        if name != "packing":
            assert docs.columns == columns
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r[0] for r in rows if r[1])
    got = collections.Counter(r["doc_id"] for r in docs.where("start = 0").collect())
    assert got == collections.Counter(r[0] for r in rows if r[1])


@needs_data
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_agrees_with_sql(spark, name):
    oracle.agree(spark, registry.QUERIES[name], registry.SQL[name])


@needs_data
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs_over_all_documents(spark, name):
    n = spark.read.parquet(f"{oracle.SF}/documents.parquet").count()
    got = registry.QUERIES[name](spark, oracle.SF)
    assert got.select("doc_id").distinct().count() == n
