import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward, empty
from tessera.llm import suffix_dedup as S


def brute(rows, length, keep):
    """(spans, kept) of each row; rows in the order of (key, text hash) decide what comes first."""
    data = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5(data[i]).hexdigest()))
    counts, first, same = Counter(), {}, {}
    for i in order:
        leader = same.setdefault((rows[i][0], data[i]), i)
        for a in range(len(data[i]) - length + 1):
            s = data[i][a:a + length]
            counts[s] += 1
            first.setdefault(s, (leader, a))
    out = {}
    for i, b in enumerate(data):
        spans = []
        for a in range(len(b) - length + 1):
            s = b[a:a + length]
            if counts[s] > 1 and (keep == "none" or first[s] != (same[rows[i][0], b], a)):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = a + length
                else:
                    spans.append([a, a + length])
        gone = {j for a, e in spans for j in range(a, e)}
        out[i] = ([tuple(s) for s in spans], bytes(x for j, x in enumerate(b) if j not in gone))
    return out


def cases(seed, n=40):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abc ") for _ in range(rng.randrange(5, 120))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) if rng.random() < .5 else "".join(rng.choice("défghij") for _ in range(rng.randrange(60)))
                        for _ in range(rng.randrange(6)))) for i in range(n)]
    return rows + [(100, rows[3][1]), (101, rows[5][1]), (102, "x" * 300), (103, "ab" * 150), (104, None), (105, ""),
                   (106, "é" * 70)]


def result(df, rows):
    got = {}
    for r in df.collect():
        got.setdefault((r["doc_id"], r["text_md5"]), []).append(r)
    for i, (k, t) in enumerate(rows):
        b = (t or "").encode()
        r = got[k, hashlib.md5(b).hexdigest()][0]
        spans = [tuple(s) for s in r["spans"]]
        kept = b if not spans else (r["kept"] if r["kept"] is not None else b"")
        assert r["n_bytes"] == len(b) and r["text_sha256"] == hashlib.sha256(b).hexdigest()
        yield i, (spans, bytes(kept))


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [S.HOT_BYTES, 100])
def test_equals_brute_force(spark, keep, hot):
    rows = cases(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = dict(result(S.repeated_spans(df, length=40, gram=16, keep=keep, hot_bytes=hot), rows))
    want = brute(rows, 40, keep)
    for i in want:
        assert got[i] == want[i], (rows[i], got[i], want[i])


@pytest.mark.parametrize("length", [1, 2, 5, 8, 9, 16, 17, 40, 200])
def test_suffix_order_and_matches(length):
    rng = np.random.default_rng(length)
    data = np.frombuffer(bytes(rng.integers(97, 99, 500).astype(np.uint8)) * 2, np.uint8)
    starts = np.arange(len(data) - length + 1)
    order, rank = S.suffix_order(data, starts, length)
    text = [bytes(data[i:i + length]) for i in starts]
    assert [text[i] for i in order] == sorted(text)
    assert all((rank[a] == rank[b]) == (text[a] == text[b]) for a, b in zip(order, order[1:]))
    counts, seen = Counter(text), set()
    first = []
    for t in text:
        first.append(t in seen)
        seen.add(t)
    assert S.removable(data, starts, length, "first").tolist() == first
    assert S.removable(data, starts, length, "none").tolist() == [counts[t] > 1 for t in text]


def test_sliding_min():
    rng = np.random.default_rng(0)
    for n, w in ((10, 3), (10, 10), (100, 7), (5, 1)):
        v = rng.integers(0, 50, n).astype(np.uint64)
        assert S.sliding_min(v, w).tolist() == [int(v[i:i + w].min()) for i in range(n - w + 1)]


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 5000]
    got = S.repeated_spans(docs, keep="none")
    assert got.count() == docs.count()
    long = [r for r in got.collect() if r["n_bytes"] == 60000][0]
    assert [tuple(s) for s in long["spans"]] == [(0, 60000)]
    assert S.repeated_spans(empty(spark)).count() == 0
    some = docs.where("text is null or length(text) < 5000")
    assert dict(result(S.repeated_spans(some, keep="none"), rows)) == brute(rows, 200, "none")
