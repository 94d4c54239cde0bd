"""Collocations: the index against counting, the ranking against a plain version, edge cases."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import awkward, empty
from tessera.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, depth=3, least=10, percent=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, depth + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    held = Counter()
    for (lang, p), a in cands.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                held[lang, p[i:i + m]] = max(held[lang, p[i:i + m]], a)
    out = []
    for lang in n:
        mine = []
        for (x, p), a in cands.items():
            if x == lang and not 100 * held[lang, p] >= percent * a:
                score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
                mine.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(mine)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(2, 5))
def test_intervals_count_phrases(symbols, depth):
    s = np.array(symbols)
    rows, n = C.phrase_rows(s, depth)
    want = Counter()
    for i in range(len(symbols)):
        j = i
        while j < len(symbols) and j < i + depth and symbols[j]:
            j += 1
        if j - i > 1:
            want[tuple(symbols[i:j] + [0] * (depth - (j - i)))] += 1
    assert dict(zip(map(tuple, rows.tolist()), n.tolist())) == want and len(rows) == len(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(2, 5))
def test_all_lengths_have_their_own_rows(symbols, depth):
    rows, n = C.phrase_rows(np.array(symbols), depth, all_lengths=True)
    want = Counter()
    for i in range(len(symbols)):
        for j in range(i + 1, min(i + depth, len(symbols)) + 1):
            if not symbols[j - 1]:
                break
            if j - i > 1:
                want[tuple(symbols[i:j] + [0] * (depth - (j - i)))] += 1
    assert dict(zip(map(tuple, rows.tolist()), n.tolist())) == want and len(rows) == len(want)


def test_rare_phrases_are_not_stored(spark, monkeypatch):
    stored = {}
    monkeypatch.setattr(C, "written", lambda df, name, write=C.written: stored.setdefault(name, write(df, name)))
    words = [f"w{i % 40} w{i * 7 % 41}" for i in range(400)]
    df = spark.createDataFrame([("en", " ".join(words))], "lang string, text string")
    C.phrase_counts(df)
    rare = stored["phrase-counts"].where("f < 10").count()
    assert "phrase-grams" not in stored and rare == 0


def test_wide_alphabets_are_sorted_by_columns():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 3, 300) * 10_000_000 * rng.integers(0, 2, 300)
    small = np.unique(s, return_inverse=True)[1]
    index = C.ShardIndex(small, 3, 3)
    wide = C.ShardIndex(small, 3, 1 << 22)                               # 23 bits a symbol: more than a key holds
    assert (index.bwt == wide.bwt).all()


def corpus():
    rng = random.Random(7)
    vocabulary = ["New", "york", "city", "the", "of", "über", "a", "b", "c", "漢字", "x y"]
    rows = []
    for i in range(120):
        words = [vocabulary[min(int(rng.expovariate(0.4)), 10)] for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None]), text))
    rows += [("en", None), ("en", ""), (None, None), ("fr", "a b"), ("en", "a a a a a a a a a a a a a a"), ("de", "b c " * 3000)]
    return rows


@pytest.mark.parametrize("tokens", [50, 1 << 21])
def test_equals_a_plain_version(spark, tokens):
    rows = corpus() + corpus()[:40]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert got(C.mine_phrases(df, shard_tokens=tokens)) == brute(rows)


def test_longer_phrases_and_ties(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(C.mine_phrases(df, depth=4, min_count=3, top=7)) == brute(rows, 4, 3, 50, 7)
    assert got(C.mine_phrases(df, depth=2, min_count=2)) == brute(rows, 2, 2)


def test_awkward_and_empty_tables(spark):
    df = awkward(spark)
    rows = [(r["lang"], r["text"]) for r in df.collect()]
    assert got(C.mine_phrases(df, min_count=2)) == brute(rows, least=2)
    assert got(C.mine_phrases(empty(spark))) == []


def test_scores_pass_64_bits(spark):
    phrases = spark.createDataFrame([(10 ** 11,)], "f long").selectExpr("f", "f l", "f r")
    wide = {c: f"cast({c} as decimal(16,0))" for c in "flr"}
    assert phrases.selectExpr("({f} * {f} * 1000000) div ({l} * {r}) s".format(**wide)).collect()[0]["s"] == 1000000


def test_ids_are_packed_as_many_to_a_long_as_fit():
    assert C._packed_columns(3, 20) == [[(0, 40), (1, 20), (2, 0)]]
    assert C._packed_columns(3, 31) == [[(0, 31), (1, 0)], [(2, 0)]]
    assert C._packed_columns(2, 63) == [[(0, 0)], [(1, 0)]]


def test_wide_ids_give_the_same(spark, monkeypatch):
    rows = corpus()
    packed = C._packed_columns
    monkeypatch.setattr(C, "_packed_columns", lambda depth, bits: packed(depth, 40))      # one id to a long
    df = spark.createDataFrame(rows, "lang string, text string")
    assert got(C.mine_phrases(df, min_count=3)) == brute(rows, least=3)
