import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import awkward, empty, sentence, words
from tessera.llm import decontamination as D
from tessera.llm.scratch import text_steps


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        at, kind = rng.randrange(len(w)), rng.randrange(3)
        if kind == 0:
            w[at] = f"q{rng.randrange(10 ** 6)}"
        elif kind == 1:
            w.insert(at, f"q{rng.randrange(10 ** 6)}")
        else:
            del w[at]
    return " ".join(w)


def hashes(text):
    got = [D.words_of(d, o)[0] for _, _, d, o in text_steps(pa.array([text.lower()]))]
    return got[0] if got else np.zeros(0, np.uint64)


def exhaustive(docs, items, edits=D.EDITS):
    """{(doc, item): distance} of all pairs in reach."""
    out = {}
    for d, t in docs:
        w = hashes(t or "")
        for i, q in items:
            q = hashes(q or "")
            if len(q) and len(w):
                n = int(D.nearest(q, w[None, :])[0][0])
                if n <= (int(edits * len(q)) if len(q) >= 4 else 0):
                    out[d, i] = n
    return out


def planted(seed=2, n=120):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.choice([3, 5, 8, 13, 24, 40, 60]), 300)) for i in range(30)]
    docs = []
    for d in range(n):
        item = rng.choice(items)[1]
        count = len(item.split())
        text = [sentence(rng, rng.randrange(80), 300)]
        if d % 3:
            text += [edited(rng, item, rng.randrange(int(D.EDITS * count) + 1)).upper().replace(" ", rng.choice([" ", "\n", "  "]))]
        docs.append((d, " ".join([*text, sentence(rng, rng.randrange(80), 300)])))
    return docs, items


@pytest.mark.parametrize("block", [D.BLOCK_ITEMS, 7])
def test_recall_against_exhaustive_search(spark, block):
    docs, items = planted()
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                         spark.createDataFrame(items, "item_id long, text string"), block=block).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in found}
    want = exhaustive(docs, items)
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want) and {k for k, v in want.items() if v == 0} <= set(got)
    text = dict(docs)
    for r in found:                                     # the span holds the passage
        w = [x.lower() for x in words(text[r["doc_id"]])][r["start_word"]:r["start_word"] + r["n_words"]]
        assert r["distance"] > 0 or w == dict(items)[r["item_id"]].split()


def test_distance_and_span():
    q = hashes("a b c d e")
    region = np.stack([hashes("x a b c d e y z"), hashes("a b x c d e y z"), hashes("a c d e y z z z")])
    distance, end = D.nearest(q, region)
    assert distance.tolist() == [0, 1, 1] and end.tolist() == [6, 6, 4]
    assert D.match_length(q, region[1][:6], 1) == 6 and D.match_length(q, region[2][:4], 1) == 4


def test_case_and_punctuation_are_no_edits(spark):
    docs = spark.createDataFrame([(1, "x DOESBO, EL Ñ; \"CIÓNMIÍRR\"\nÄÖÜ!! (QUEN) Y ZZ"), (2, "doesbo el ñ quen y")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "Doesbo el ñ ciónmiírr äöü quen")], "item_id long, text string")
    assert [tuple(r) for r in D.find_leaks(docs, bench).collect()] == [(1, 7, 0, 6, 1, 6)]


def test_repetitions_are_added_until_the_target(monkeypatch):
    _, items = planted()
    made = [hashes(t) for _, t in items]
    low, high = (D.Items(list(range(len(made))), made, D.EDITS).indexed(r) for r in (0.5, 1.0))
    assert 8 <= low.repeats < high.repeats <= D.MOST_REPEATS


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "one"), (None, "éa ñ b 漢字 éa"), (5, "no such words here")],
                                  "item_id long, text string")
    found = D.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(7, 3), (8, 3), (11, None)}
    kept = D.drop_leaking(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert D.find_leaks(empty(spark), bench).count() == 0
    assert D.find_leaks(docs, bench.limit(0)).count() == 0 and D.drop_leaking(docs, bench.limit(0)).count() == docs.count()


def test_each_size_of_items_reaches_the_target():
    rng = random.Random(6)
    made = [hashes(sentence(rng, n, 10 ** 6)) for n in [16] * 180 + [200] * 20 + [3] * 50]
    items = D.Items(list(range(len(made))), made, D.EDITS).indexed()
    assert items.rounds[3] == 0 and 8 <= items.rounds[16] < D.MOST_REPEATS
    for n, lo, hi in ((16, 0, 180), (200, 180, 200)):     # the short ones must not end the search for the long ones
        found = total = 0
        for i in range(lo, hi):
            for _ in range(10 if n == 200 else 1):
                w = [str(x) for x in made[i]]
                w = np.array([int(x) if x.isdigit() else rng.getrandbits(64) for x in edited(rng, " ".join(w), n // 5).split()], np.uint64)
                total += 1
                found += any(m[1] == i for m in items.matches(w, np.array([0, len(w)])))
        assert found >= 0.95 * total, (n, found, total)


def test_items_beyond_the_walks_are_all_found():
    rng = random.Random(7)
    made = [hashes(sentence(rng, 400, 10 ** 6)) for _ in range(3)]
    items = D.Items([0, 1, 2], made, D.EDITS).indexed()
    assert items.rounds[400] == 0
    for i in [0, 1, 2] * 4:
        w = edited(rng, " ".join(str(x) for x in made[i]), 80).split()
        w = np.array([int(x) if x.isdigit() else rng.getrandbits(64) for x in ["q", *w, "q", "q"]], np.uint64)
        assert [m[1] for m in items.matches(w, np.array([0, len(w)]))] == [i]
