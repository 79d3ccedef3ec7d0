"""Spelling variants (12) against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import TESTDATA

from growthledger.llm import registry
from growthledger.llm import variants as module
from growthledger.llm.variants import PositionIndex, spelling_variants


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return total


def brute(rows, min_count=5, times=5):
    words = {w: n for w, n in counted(rows).items() if len(w) >= 6 and n >= min_count}
    around = {}  # by what is left when a letter is taken out
    for w in words:
        for k in range(len(w)):
            around.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for (_, left), group in around.items():
        for w in group:
            near[w] |= group - {w}
            if left in words:
                near[w].add(left)
                near[left].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(spark, rows, schema="doc_id long, text string", **options):
    result = spelling_variants(spark.createDataFrame(rows, schema), **options)
    return sorted(tuple(r) for r in result.select("word", "form", "root", "n", "n_near", "form_n").collect())


def family(rng, letters="abé"):
    """Words around one another, with frequencies that make chains of forms."""
    base = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 9)))
    text = [base] * rng.randrange(1, 300)
    for _ in range(40):
        k, word = rng.randrange(len(base)), base
        kind = rng.randrange(3)
        word = word[:k] + ("" if kind == 0 else rng.choice(letters)) + word[k + (kind < 2) :]
        text += [word] * rng.choice([1, 4, 5, 7, 30])
        base = word if len(word) >= 6 and rng.random() < 0.5 else base
    rng.shuffle(text)
    return text


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_index_finds_exactly_the_near_words(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(150)} | {"", "aaaaÿ" * 40})
    index = PositionIndex(words)
    for word in [*words, "bbbbbbbbbb", "c"]:
        assert {words[k] for k in module._members(index.near(word))} == {w for w in words if one_apart(w, word)}


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        words = family(rng)
        cut = len(words) // 2
        rows += [(rng.randrange(10**6), rng.choice(" -7×\n").join(part)) for part in (words[:cut], words[cut:])]
    rows += [(None, "Letter LETTER letter") for _ in range(4)] + [(7, None), (8, ""), (None, None)] + rows[:3]
    want = brute(rows)
    assert found(spark, rows) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_WORDS", 16)
    rng = random.Random(5)
    words = [f"{'pre'}{''.join(rng.choice('xy') for _ in range(7))}" for _ in range(3000)]
    assert found(spark, [(1, " ".join(words))]) == brute([(1, " ".join(words))])


def test_spoiled_runs(spark):
    rows = [(i, "Königreich wanderung wanderungen") for i in range(3000)]
    assert len(counted(rows)) > 10
    assert found(spark, rows, min_count=1) == brute(rows, min_count=1)


def test_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (None, ""), (2, "short words only"), (3, "1234567 ......")]) == []
    schema = "word string, doc_id string, text string, n int, `a.b` int"
    assert found(spark, [("w", "d", "letters", 1, 2)] * 5, schema) == [("letters", None, "letters", 5, 0, None)]
    long = "x" * 30_000
    rows = [(1, " ".join([long, long + "y", "abcdef " * 200_000]))] * 5
    assert found(spark, rows) == brute(rows)


def test_query_over_the_given_table(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    result = registry.QUERIES["op12_spelling_variants"](spark, sf_dir)
    got = sorted(tuple(r) for r in result.select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute([tuple(d) for d in docs])
