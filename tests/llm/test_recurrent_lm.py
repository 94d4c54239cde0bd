import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_cases import awkward, empty, words
from pyspark.sql import functions as F
from tessera.llm import recurrent_lm as R
from tessera.llm.scratch import crc_mod, text_steps

TEXTS = ["the cat sat on the mat", "The dog\tsat", "", None, "a b c a b c " * 40, "one"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary_of(texts, most=R.LOOKUP_WORDS):
    keys = np.concatenate([R.token_keys(d, o)[0] for _, _, d, o in text_steps(pa.array(texts, pa.string()))])
    h, c = np.unique(keys, return_counts=True)
    order = np.lexsort((h, -c))[:most]
    k, n = h[order], c[order]
    symbols = np.zeros(len(k), np.int32)
    symbols[:6] = np.arange(len(k[:6])) + 1 + R.SIGNATURES
    frequency = np.zeros(R.SYMBOLS)
    frequency[0], frequency[1:1 + R.SIGNATURES] = len(texts), 1
    frequency[1 + R.SIGNATURES:1 + R.SIGNATURES + len(k[:6])] = n[:6]
    return R.Vocabulary(R.Lookup(k), n, symbols, frequency, np.ones(R.SIGNATURES), int(c.sum()), len(h), len(texts))


def test_lookup_finds_every_key_and_no_other():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(-2 ** 63, 2 ** 63, 5000), np.arange(3000)]))   # the latter share a slot
    table = R.Lookup(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(rng.integers(2 ** 40, 2 ** 50, 1000)) == -1).all()


def test_probabilities_of_all_symbols_sum_to_one():
    model = R.new_model(vocabulary_of(TEXTS))
    h = np.random.default_rng(0).normal(size=(1, R.HIDDEN)).astype(np.float32)
    p, _, _ = R.output(model, np.repeat(h, R.SYMBOLS, 0), np.arange(R.SYMBOLS))
    assert abs(np.exp(p.astype(float)).sum() - 1) < 1e-3


def test_lanes_and_windows_do_not_change_a_score():
    vocab = vocabulary_of(TEXTS)
    model = R.new_model(vocab)
    symbols, offset, *_ = R._symbols_of_batch(pa.array(TEXTS, pa.string()), vocab)
    want = []
    for a, b in zip(offset, offset[1:]):                 # one text, one token at a time, state carried throughout
        h, before, total = np.zeros((1, R.HIDDEN), np.float32), 0, 0.0
        for s in symbols[a:b]:
            h, _ = R.step(model, h, np.array([before]))
            total += float(R.output(model, h, np.array([s]))[0][0])
            before = s
        want.append(total)
    for lanes, window in ((1, 7), (2, 3), (512, 32)):
        assert np.allclose(R.score_texts(model, symbols, offset, lanes, window), want, rtol=1e-4)


def test_gradients_equal_finite_differences(monkeypatch):
    vocab = vocabulary_of(TEXTS)
    symbols, offset, *_ = R._symbols_of_batch(pa.array(["the cat sat on", "dog sat"], pa.string()), vocab)
    trainer = R.Trainer(R.new_model(vocab))
    seen = {}
    monkeypatch.setattr(trainer, "_apply", lambda name, grad, rows=None: seen.__setitem__(name, (grad.copy(), rows)))
    trainer.learn(symbols, offset, lanes=2, window=16)
    base = {k: v.astype(float) if v.dtype == np.float32 else v for k, v in trainer.model.items()}

    def loss(model):
        return -R.score_texts(model, symbols, offset).sum() / 2

    rng = np.random.default_rng(2)
    for name, (grad, rows) in seen.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in grad.shape)
            full = at if rows is None else (rows[at[0]], *at[1:])
            pair = []
            for eps in (1e-3, -1e-3):
                model = {k: v.copy() for k, v in base.items()}
                model[name][full] += eps
                pair.append(loss(model))
            assert abs((pair[0] - pair[1]) / 2e-3 - grad[at]) < 5e-3 + 0.02 * abs(grad[at]), name


def test_long_texts_are_learned_once_and_read_on_over_span_bounds(monkeypatch):
    offset = np.array([0, 3, 2503, 2504, 4552])
    starts, learned, ends = R.training_spans(offset, 1024, 64)
    assert np.concatenate([np.arange(a, b) for a, b in zip(learned, ends)]).tolist() == list(range(4552))
    assert all((s == a) if a in offset else (s == a - 64) for s, a in zip(starts, learned))

    # One text of spans with a lead-in as long as the text equals the same text unbroken, step for step.
    vocab = vocabulary_of(TEXTS)
    symbols, offset, *_ = R._symbols_of_batch(pa.array(["the cat sat on the mat and the dog sat on the cat"]), vocab)
    losses = []
    real = R.output

    def output(model, h, targets, gradient=False):
        got = real(model, h, targets, gradient)
        losses.append(dict(zip(map(tuple, np.round(h, 5).tolist()), got[0].tolist())))
        return got

    monkeypatch.setattr(R, "output", output)
    whole = R.Trainer(R.new_model(vocab))
    whole.learn(symbols, offset, lanes=4, window=64)
    monkeypatch.setattr(R, "training_spans", lambda o, f=R.training_spans: f(o, 5, 64))
    cut = R.Trainer(R.new_model(vocab))
    cut.learn(symbols, offset, lanes=4, window=64)
    assert whole.tokens == cut.tokens == len(symbols)
    assert sorted(np.round(list(losses[0].values()), 4)) == sorted(np.round(list(losses[1].values()), 4))


def test_a_plain_scorer_gives_the_same_scores(spark):
    """The model's score of each text, word by word, with the model that the query fitted."""
    fitted = {}
    train, score_vocab = R.train, R.vocabulary
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string")
    try:
        R.train = lambda *a, **k: fitted.setdefault("model", train(*a, **k))
        R.vocabulary = lambda *a, **k: fitted.setdefault("vocab", score_vocab(*a, **k))
        got = {r["doc_id"]: r["score"] for r in R.score(docs, crc_mod("doc_id", 7) != 2).collect()}
    finally:
        R.train, R.vocabulary = train, score_vocab
    model, vocab = fitted["model"], fitted["vocab"]
    for i, text in docs.collect():
        symbols, _, keys, rows, _ = R._symbols_of_batch(pa.array([text], pa.string()), vocab)
        h, before, want = np.zeros(R.HIDDEN), 0, 0.0
        for s in symbols.tolist():
            x, hu = model["x"][before].astype(float), h @ model["u"] + model["b"]
            n = R.HIDDEN
            r, z = (1 / (1 + np.exp(-(x[k:k + n] + hu[k:k + n]))) for k in (0, n))
            new = np.tanh(x[2 * n:] + r * hu[2 * n:])
            h = (1 - z) * new + z * h
            c, slot = divmod(int(model["place"][s]), R.CLASSES)
            for logits, at in ((h @ model["wc"] + model["bc"], c), (h @ model["ww"][c] + model["bw"][c], slot)):
                want += logits[at] - np.log(np.exp(logits).sum())
            before = s
        want /= math.log(10)
        for s, row in zip(symbols.tolist(), rows.tolist()):
            if 0 < s <= R.SIGNATURES:
                want += math.log10((vocab.counts[row] if row >= 0 else 0) + 1) - vocab.log_rest[s - 1]
        assert abs(got[i] - want) < 1e-3 * abs(want), text


def test_base_figures_equal_brute_force_and_the_model_beats_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10 ** 6 + i, t) for i, t in enumerate(TEXTS)], docs.schema)).repartition(2)
    texts = {r["doc_id"]: words((r["text"] or "").translate(LOWER)) + ["\n"] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, t in texts.items() if not held[d] for w in t)
    n, v = sum(counts.values()), len(counts)
    for lookup in (R.LOOKUP_WORDS, 300):                 # all counts in the table, or most of them joined
        got = R.score(docs, crc_mod("doc_id", 7) != 2, share=1.0, lookup_words=lookup).collect()
        assert len(got) == len(texts)
        for r in got:
            t = texts[r["doc_id"]]
            want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
            assert (r["trained"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
                not held[r["doc_id"]], len(t), sum(counts[w] > 0 for w in t), n)
            assert abs(r["base_score"] - want) < 1e-6 * abs(want)
            assert math.isfinite(r["score"])
        if lookup > 300:
            out = [r for r in got if not r["trained"]]
            assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_awkward_rows_empty_tables_and_no_training_text(spark):
    docs = awkward(spark)
    assert R.score(docs, F.lit(True)).count() == docs.count()
    assert R.score(empty(spark), F.lit(True)).count() == 0
    none = R.score(docs, F.lit(False)).collect()
    assert len(none) == docs.count() and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in none)


def test_every_training_document_is_learned_from(spark, monkeypatch):
    docs = awkward(spark).select("doc_id", "text").union(spark.createDataFrame(
        [(1000 + i, f"a{i} b c") for i in range(200)], "doc_id long, text string"))
    learned = []

    def written(df, name, real=R.written):
        out = real(df, name)
        if name == "models":
            learned.append(out.agg(F.sum("weight")).first()[0])
        return out

    monkeypatch.setattr(R, "written", written)
    train = crc_mod("doc_id", 7) != 2
    R.score(docs, train).count()
    want = sum(len(words(r["text"])) + 1 for r in docs.where(train).collect())
    first = [learned[0]]                                # a round's models, then their averages with the same sum
    first += [b for a, b in zip(learned, learned[1:]) if b != a]
    assert sum(first) == want
