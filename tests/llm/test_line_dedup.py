"""Line dedup (4) against plain counting, and its SQL."""

import random
from collections import defaultdict

import pytest
from growthledger.llm import line_dedup as module
from growthledger.llm.line_dedup import line_dedup
from helpers import TESTDATA
from oracle import compare, connect

from growthledger.llm import registry

SF_SMALL = f"{TESTDATA}/sf0.001"


def brute(rows, min_sites, min_words=1):
    """rows: (id, text, site)."""
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for place, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" ")
            if len(line.split()) >= min_words:
                sites[line].add(site)
                here = (i is None, i, place)
                first[line] = min(first.get(line, here), here) if i is not None else first.get(line, here)
    out = []
    for i, text, _site in rows:
        if text is None:
            out.append((i, None, 0))
            continue
        lines = text.split("\n")
        gone = [
            k for k, x in enumerate(lines)
            if len(sites.get(x.strip(" "), ())) >= min_sites and first[x.strip(" ")] != (i is None, i, k)
        ]
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return sorted(out, key=str)


def documents():
    rng = random.Random(4)
    pool = [f"line number {k} of the pool" for k in range(30)]
    rows = []
    for i in range(300):
        lines = [rng.choice(pool[: 1 + i % 30]) for _ in range(rng.randint(0, 6))]
        lines += [f"only here {i}", "two words", "  spaced line here  ", ""]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), None if i % 25 == 0 else f"s{min(i % 40, int(rng.expovariate(0.1)))}"))
    rows += [(400, None, "s1"), (401, "", "s1"), (402, "\n\n", "s1"), (0, rows[0][1], rows[0][2])]
    return rows + [(403, "\n".join(["spaced line here"] * 20_000), "s9")]


@pytest.mark.parametrize("min_sites", [2, 10, 12, 25])
def test_equals_plain_counting(spark, min_sites):
    rows = documents()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, n_removed int, key string")
    found = line_dedup(docs.repartition(6), min_sites)
    assert found.columns == ["doc_id", "text", "source", "key", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in found.collect()), key=str) == brute(rows, min_sites)


def test_rows_without_id(spark):
    rows = [(i, "shared by all of them", f"s{i}") for i in range(12)] + [(None, "shared by all of them", "x")]
    found = line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.doc_id: r.text for r in found.collect()} == {None: "", 0: "shared by all of them", **{i: "" for i in range(1, 12)}}


def test_exact_counts_decide_near_the_threshold(spark, monkeypatch):
    # A tiny sketch errs; a wide band must make up for it.
    monkeypatch.setattr(module, "SKETCH_K", 4)
    monkeypatch.setattr(module, "NEAR", 0.9)
    rows = [(i, f"line {i % 2} is shared", f"s{i}") for i in range(399)]
    found = line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"), 200)
    assert sum(r.n_removed for r in found.collect()) == 199


def test_native_plan_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    found = line_dedup(docs)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_query_equals_its_sql(spark):
    name = "op4_line_dedup"
    ours, theirs = compare(spark, connect(SF_SMALL), registry.QUERIES[name], registry.ORACLE_SQL[name], SF_SMALL)
    assert ours == theirs


def test_short_lines_and_odd_names(spark):
    rows = [(i, f"Les.\n{i}\n\n", f"s{i}", 1, 2) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` int, `c d` int")
    found = line_dedup(docs)
    assert found.columns == [*docs.columns, "n_removed"]
    assert {r.doc_id: (r.text, r.n_removed, r[3]) for r in found.collect()} == {
        i: (t, 0, 1) if i == 0 else (f"{i}\n\n", 1, 1) for i, t, *_ in rows
    }
