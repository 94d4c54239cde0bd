"""Spelling variants: near pairs against all pairs, the whole result against a plain version, edge cases."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import awkward, empty
from tessera.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_words(rows, least_length=7, least_count=2, every=31):
    n = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def brute(n, times=10):
    form, count = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w], count[w] = (best if best is not None and n[best] >= times * n[w] else None), len(others)
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def made_words(rng, k, letters="abcdeé"):
    words = set()
    while len(words) < k:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(3, 7)))
        words.add(w)
        at = rng.randrange(len(w))
        words.add(rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]]))
    return sorted(words - {""})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abß", min_size=4, max_size=4), max_size=30, unique=True),
       st.lists(st.text("abß", min_size=3, max_size=4), max_size=30, unique=True))
def test_tree_search_equals_all_pairs(points, asked):
    for size in (4, 3):
        queries = [w for w in asked if len(w) == size]
        got = sorted((queries[a], points[b]) for q, p in S.near_words(points, queries) for a, b in zip(q, p))
        assert got == sorted((a, b) for a in queries for b in points if near(a, b))


def test_search_reaches_few_leaves():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrst") for _ in range(9)) for _ in range(4000)})
    vectors = S.letter_counts(S.letters(words))
    tree = S.KdTree(vectors)
    q, leaf = tree.leaves_in_reach(vectors[:200], 1, 1)
    assert len(q) / 200 < 0.5 * (tree.child[:, 0] < 0).sum()
    assert (np.bincount(q, minlength=200) > 0).all()


@pytest.mark.parametrize("cell,points,queries", [(1 << 13, 1 << 14, 1 << 16), (16, 5, 7)])
def test_equals_a_plain_version(spark, monkeypatch, cell, points, queries):
    """Also with so many cells and blocks that every word is dealt out to several."""
    monkeypatch.setattr(S, "CELL_WORDS", cell)
    monkeypatch.setattr(S, "BLOCK_POINTS", points)
    monkeypatch.setattr(S, "BLOCK_QUERIES", queries)
    rng = random.Random(3)
    n = {w: int(10 ** rng.uniform(0.3, 5)) for w in made_words(rng, 300)}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(4)
    assert rows_of(S.variants(df)) == brute(n)


def test_long_chains_of_forms_and_ties(spark):
    chain = {"a" * (7 + i): 2 * 10 ** i for i in range(12)}
    ties = {"xxxxxxx": 5, "xxxxxxy": 50, "xxxxxxb": 50, "äxxxxxxx": 50}
    n = chain | ties
    got = rows_of(S.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute(n) and {r[2] for r in got if r[0] in chain} == {"a" * 18}
    assert [r[1] for r in got if r[0] == "xxxxxxx"] == ["xxxxxxb"]


def test_words_of_a_corpus(spark):
    rng = random.Random(9)
    base = ["Correction", "letterbox", "naïveté", "ÉCOLIERS", "×÷multiply", "tiny"]
    rows = [(i if i % 7 else None, " ".join(rng.choice(base) + rng.choice(["", "s", "-x", "9", "ß"]) for _ in range(40))) for i in range(60)]
    rows += [(None, None), (4, ""), (5, "x" * 30000 + " " + "yz " * 9000), (5, "x" * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_words(rows)
    assert {r["word"]: r["n"] for r in S.corpus_words(df).collect()} == want
    assert rows_of(S.spelling_variants(df)) == brute(want)
    assert {r["word"]: r["n"] for r in S.corpus_words(df, every=0, least_length=3, least_count=1).collect()} == brute_words(rows, 3, 1, 0)


def test_awkward_and_empty_tables(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert rows_of(S.spelling_variants(df, least_length=2)) == brute(brute_words(rows, 2))
    assert rows_of(S.spelling_variants(empty(spark))) == []
