"""Personal data: base patterns against plain ones, the field against enumeration, rewritten spans held out, edge cases."""
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import awkward, empty
from tessera.llm import pii as P

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_base(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(x) < 256 for x in m.group().split(".")),
                  "card": lambda: 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                  "phone": lambda: 8 <= len(d) <= 15}[kind]()
            if ok:
                out.append((kind, *m.span()))
    return out


def numbers(seed):
    rng = random.Random(seed)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "5555555555554444", "+1 (017) 555-7713", "+44 20 7946 0958 ", "1.2.3.4", "300.1.1.1",
             "10.20.30.40.50.60.70.80", "a.b+c@mail.example.com", "x@y", "a@b@c.de", "@", "+", "é", "\n", "1", " ", "-", "(at)", "000.001.002.3", "."]
    return "".join(rng.choice(parts) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(1, 25)))


@pytest.mark.parametrize("seed", range(150))
def test_base_equals_the_plain_patterns(seed):
    text = numbers(seed)
    assert P.base_spans(text) == plain_base(text)


@settings(max_examples=300, deadline=None)
@given(st.text("a1@.+- ()\n9é", max_size=40))
def test_base_equals_the_plain_patterns_on_any_text(text):
    assert P.base_spans(text) == plain_base(text)


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 200_000, "7" * 200_000, "a@" * 50_000, "+1 " * 50_000, "1." * 50_000, "a" * 200_000 + "@b.c"):
        P.base_spans(text)
    assert P.base_spans("a" * 200_000 + "@b.c") == [("email", 0, 200_004)] and time.time() - began < 20


def labelings(n, segments):
    def go(place):
        if place == n:
            yield {}
            return
        yield from go(place + 1)
        for i, j, _ in segments:
            if i == place:
                for rest in go(j):
                    for k in range(len(P.KINDS)):
                        yield {(i, j): k, **rest}
    yield from go(0)


def small_field(seed=0):
    rng = np.random.default_rng(seed)
    return P.Field((rng.normal(size=(4, P._FEATURES)), rng.normal(size=5), rng.normal(size=(5, 5))))


CLASSES = np.array([0, 2, 0, 4, 1])
SEGMENTS = [(0, 1, [3, 9]), (0, 3, [4, 5]), (1, 3, [7]), (2, 5, [3, 11, 20]), (4, 5, [6])]


def test_likelihood_and_best_equal_enumeration():
    field = small_field()
    logs = {}
    for gold in labelings(5, SEGMENTS):
        place, last, total = 0, 0, 0.0
        while place < 5:
            j, y = next(((j, k + 1) for (i, j), k in gold.items() if i == place), (place + 1, 0))
            seg = next((f for i2, j2, f in SEGMENTS if (i2, j2) == (place, j)), None)
            total += field.t[last, y] + (field.w[y - 1, seg].sum() if y else field.o[CLASSES[place]])
            place, last = j, y
        logs[tuple(sorted(gold.items()))] = total
    z = np.log(sum(np.exp(v) for v in logs.values()))
    for gold, value in list(logs.items())[::7]:
        assert abs(field.log_likelihood(CLASSES, SEGMENTS, dict(gold)) - (value - z)) < 1e-9
    # what follows the end is a place outside
    best = max(logs, key=lambda g: logs[g] + field.t[next((k + 1 for (i, j), k in g if j == 5), 0), 0])
    assert field.best(CLASSES, SEGMENTS) == sorted((i, j, k) for (i, j), k in best)


def test_gradient_equals_differences():
    field, gold = small_field(2), {(0, 3): 1, (4, 5): 2}
    gradient = tuple(np.zeros(x.shape) for x in (field.w, field.o, field.t))
    field.log_likelihood(CLASSES, SEGMENTS, gold, gradient)
    for x, g, places in ((field.w, gradient[0], [(1, 4), (0, 3), (3, 20)]), (field.o, gradient[1], [(0,), (4,)]),
                         (field.t, gradient[2], [(0, 2), (2, 0), (3, 3)])):
        for at in places:
            x[at] += 1e-5
            up = field.log_likelihood(CLASSES, SEGMENTS, gold)
            x[at] -= 2e-5
            down = field.log_likelihood(CLASSES, SEGMENTS, gold)
            x[at] += 1e-5
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def prose(rng, k):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(k))


def personal(rng, kind):
    f = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    if kind == "card":
        head = rng.choice("345") + f(14)
        return next(head + c for c in "0123456789" if P.luhn(head + c))
    return {"email": f"{prose(rng, 1)}.{f(2)}@mail{f(1)}.example.com", "ip": ".".join(str(rng.randrange(256)) for _ in range(4)),
            "phone": f"+{rng.randrange(1, 99)} ({f(3)}) {f(3)}-{f(4)}"}[kind]


def corpus(seed, n):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        inside = personal(rng, P.KINDS[i // 2 % 4]) if i % 2 else rng.choice(["version 3.0", "in 1987,", "no. 12345", "12:30", ""])
        texts.append(f"{prose(rng, 12)} {inside} {prose(rng, 9)}.\n{prose(rng, 6)}")
    return texts


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(1, 400))], "doc_id long, text string")
    return P.fit(docs)


def test_finds_rewritten_spans_and_leaves_clean_text(field):
    """Held out: other prose, other numbers, other ways to write them."""
    model, rng, right, wrong, clean = P.Field.unpacked(field), random.Random(99), 0, 0, 0
    for i in range(400):
        kind = P.KINDS[i % 4]
        new, as_kind = P.rewritten(kind, personal(rng, kind), rng)
        head = prose(rng, 7) + " "
        text = f"{head}{new} {prose(rng, 6)}"
        base = P.base_spans(text)
        found = base + model.spans(text, base)
        if as_kind:
            right += (as_kind, len(head), len(head) + len(new)) in found
            wrong += (as_kind, len(head), len(head) + len(new)) not in found
        else:
            clean += not model.spans(text, base)
    assert right / (right + wrong) > 0.9 and clean / (400 - right - wrong) > 0.93


def test_query_result_on_documents(spark, field):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus(5, 60))] + [(99, None), (98, ""), (97, "call (017) 555-7713 or write a.b (at) c.org")],
                                 "doc_id long, text string")
    for r in P.find_personal_data(docs, field).collect():
        base = [tuple(x) for x in r["base"]]
        assert base == plain_base(r["text"] or "") and set(base) <= {tuple(x) for x in r["spans"]}
        assert [tuple(x) for x in r["spans"]] == sorted([tuple(x) for x in r["spans"]], key=lambda x: (P.KINDS.index(x[0]), x[1]))
        for kind, s, e in r["spans"]:
            if (kind, s, e) not in base:
                assert not any(a < e and s < b for _, a, b in base)
        if r["doc_id"] == 97:
            assert ("phone", 5, 19) in {tuple(x) for x in r["spans"]}
    text = P.find_personal_data(docs, field).where("doc_id = 97").select(P.written_out("spans").alias("s")).collect()[0]["s"]
    assert re.fullmatch(r"(\w+:\d+:\d+)(,\w+:\d+:\d+)*", text)


def test_awkward_and_empty_tables(spark, field):
    df = awkward(spark).withColumn("base", F.lit(1))
    out = P.find_personal_data(df, field)
    assert out.count() == df.count() and set(out.columns) == set(df.columns) | {"spans"} and out.columns.count("base") == 1
    assert out.where("size(spans) > 0").count() == 0
    assert P.find_personal_data(empty(spark), field).count() == 0
    nothing = P.fit(empty(spark))
    assert P.Field.unpacked(nothing).spans("call (017) 555-7713") == []


def test_registered_query(spark):
    import hashlib

    from conftest import SF0001
    from tessera.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = QUERIES["op13_pii"](spark, SF0001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == k for x in base) for k in P.KINDS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
