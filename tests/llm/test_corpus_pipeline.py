"""The corpus pipeline, stage by stage, against plain versions on small tables."""

import base64
import hashlib
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from growthledger.llm import quality_knn
from growthledger.llm.common import table
from test_decontaminate import words_of
from test_line_dedup import brute as plain_lines
from test_ngram_join import brute as plain_groups

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage, and the last stage's rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(table(stage(spark, found[-1], SF_DIR), "stage"))
        if len(found) < 6:
            assert found[-1].columns == docs.columns
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_quality_keeps_what_is_predicted_good(spark, stages):
    scored = quality_knn.quality(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert texts(stages[1]) == texts(scored.where("predicted = 1"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert sum(labels.get(d) == 1 for d in texts(stages[0])) == sum(labels.get(d) == 1 for d in texts(stages[1]))


def test_lines(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[1].collect()]
    want = {i: t for i, t, gone in plain_lines(rows, 10) if not gone or t.strip()}
    assert texts(stages[2]) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    rows = sorted(texts(stages[2]).items())
    groups = [eval(r) for r in plain_groups(rows, 5, 80)]  # noqa: S307 - tuples of numbers
    assert set(texts(stages[3])) == {i for i, _, component in groups if i == component}


def test_leaks(spark, stages):
    items = [f" {words_of(r.text)} " for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = {d: t for d, t in texts(stages[3]).items() if not any(i in f" {words_of(t)} " for i in items)}
    assert texts(stages[4]) == kept


def test_encoding_and_run(spark, stages):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = defaultdict(tuple)
    for d, t in texts(stages[4]).items():
        ids = library.encode_ordinary(t)
        want[d] = (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
        )
    assert {r.doc_id: tuple(r)[1:] for r in stages[5].collect()} == want
    assert {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want


def test_odd_rows_pass_through_every_stage(spark, stages):
    docs = stages[0].limit(40).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (9001, None, "en", None, None), (9002, "", "en", "s", 0)], stages[0].schema)
    )
    docs = docs.unionByName(docs.where("doc_id < 3"))
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = table(stage(spark, frame, SF_DIR), "odd")
            assert frame.columns == docs.columns
        found = table(corpus_pipeline.encode(spark, frame, SF_DIR), "odd")
        assert found.count() == frame.count()


def test_reused_ids_and_clashing_columns(spark):
    """Different texts of an id that stays all stay; rows that repeat id and text stay once."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, a), (1, b), (2, b), (3, c), (None, c), (None, None), (4, None), (5, "")]
    schema = "doc_id long, text string, score string, predicted int, leaks int, `lower-cased text` int, `a.b` int"
    docs = spark.createDataFrame([(i, t, "mine", 7, 8, 9, 10) for i, t in rows], schema)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (1, b), (3, c), (None, c), (None, None), (4, None), (5, "")], key=str
    )
    clean = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF_DIR)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert {tuple(r)[2:] for r in clean.collect()} == {("mine", 7, 8, 9, 10)}
    judged = corpus_pipeline.keep_quality(spark, docs, SF_DIR)
    assert judged.columns == docs.columns
    assert {tuple(r)[2:] for r in judged.collect()} <= {("mine", 7, 8, 9, 10)}


def test_short_shared_lines_go_and_blank_lines_stay(spark):
    rows = [(i, f"Share\n\n \t \nMenu here\nonly in {i}", "en", f"s{i}", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = texts(corpus_pipeline.drop_shared_lines(spark, docs, SF_DIR))
    assert found == {0: rows[0][1]} | {i: f"\n \t \nonly in {i}" for i in range(1, 12)}
