"""Registered queries against their SQL, and the pipeline's stages against plain versions."""

import json
import os
import random

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from __spark_entry__ import oracle_sql, queries
from strataflow.llm import bpe, raking
from tests.llm.test_operators import DOCS, documents, least_reachable, plain_base, plain_sets, sentence, words_of
from tests.oracle import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(q for q in queries() if q.startswith("op"))


def test_all_ten_and_the_pipeline_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in NAMES) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "tokens"]


@pytest.mark.parametrize("name", [q for q in NAMES if q in oracle_sql()])
def test_query_equals_sql(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip(f"{FOLDER} is not there")
    assert compare(spark, duck(FOLDER), FOLDER, queries()[name], oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(21)
    rows = []
    for i in range(40):
        rows.append((i, sentence(draw, draw.randrange(8, 60)) + draw.choice(["", " mail a.b@c.org", " +1 (743) 555-3824"])))
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, None), (201, ""), (202, "12 34 !!"), (None, "loose words here"), (4, rows[4][1])]
    return documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("lang")))


def rows_of(frame):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect()), key=repr)


def test_language_stage(spark, docs):
    got = corpus_pipeline.language(spark, docs, "")
    assert got.columns == docs.columns
    want = [(i, t, lang or "en", s, n) for i, t, lang, s, n in rows_of(docs) if t and any(c.isalpha() for c in t)]
    assert rows_of(got) == sorted(want, key=repr)


def test_near_duplicates_stage(spark, docs):
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    rows = rows_of(docs)
    sets = plain_sets([(r[0], r[1]) for r in rows if r[0] is not None])
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = least_reachable(sets, links)
    want = {r for r in rows if r[0] is not None and top[r[0]] == r[0]}
    assert rows_of(got) == sorted([*want, *[r for r in rows if r[0] is None]], key=repr)


def test_personal_data_stage(spark, docs):
    got = corpus_pipeline.personal_data(spark, docs, "")
    assert got.columns == docs.columns and got.count() == docs.count()
    before = {(r[0], r[3]): r[1] for r in rows_of(docs)}
    for i, text, _, source, n in rows_of(got):
        old = before[(i, source)]
        assert plain_base(text or "") == []
        assert n == (len(text) if text is not None else None)
        assert (text == old) == (plain_base(old or "") == [])


def test_mixing_stage(spark, docs):
    got = corpus_pipeline.mixing(spark, docs, "")
    assert got.columns == docs.columns
    mixed = raking.mix(docs.withColumn("t", raking.format_of(F.col("text"))), {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col("t")}, temper=0.9)
    assert rows_of(got) == rows_of(mixed.filter("copies > 0"))


def test_tokens_stage(spark, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r[1] or "" for r in rows_of(docs)]
    got = corpus_pipeline.tokens(spark, docs, "").collect()
    assert all(r.round_trip for r in got)
    assert sorted(json.dumps(r.ids) for r in got) == sorted(json.dumps(plain.encode_ordinary(t)) for t in texts)


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, "")
    assert docs.count() == 0


def test_pipeline_runs_whole(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip(f"{FOLDER} is not there")
    got = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert got and all(r.round_trip and words_of(texts[r.doc_id]) for r in got)
    assert len({r.doc_id for r in got}) == len(got)
