"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words (runs of letters, digits and non-ASCII bytes,
A-Z lower-cased) and their first four and six bytes, which catch inflected
and disguised forms; each is hashed into ``2**BITS`` slots. Terms count once
a text. The machine adds to a bias one weight per term and, for each pair of
terms, the dot product of their factor vectors, so that two terms can weigh
more together than apart.

Fitting takes a bounded sample of labelled rows (at most ``max_toxic`` and
``max_clean``, the lowest by a hash of their key), keeps the terms whose
share differs between the classes beyond chance (G test), and trains with
Adam on the logistic loss in one Spark task; rows are weighted so that the
sampled classes count as often as they occur. The model has a fixed size and
scoring is one pass over the whole texts.

Edge cases: null and empty texts have no terms and get the bias alone; very
long texts are scored whole; repeated rows score alike; without labelled
rows, or with one class only, the score is that class's share (0 without
rows); a column called like an output column gives way to it.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import appended, mixed, prefix_hashes, powers, ship, text_steps, word_spans

BITS = 20
THRESHOLD = 0.7
#: Bounds of the labelled sample that the machine is fitted on.
MAX_TOXIC, MAX_CLEAN = 4096, 8192
#: G statistic beyond which a term's association with the label is not chance.
LEAST_G = 12.0
FACTORS = 8
_PREFIXES = (0, 4, 6)            # 0: the whole word

_NOT_WORD = np.ones(256, bool)
_NOT_WORD[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _NOT_WORD[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def hashed_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every term of a piece of text; repeats included."""
    starts, ends, first = word_spans(data, offsets, _NOT_WORD)
    s = prefix_hashes(_LOWER[data])
    _, inverse = powers(len(data) + 1)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out_rows, out = [], []
    for k in _PREFIXES:
        use = slice(None) if k == 0 else np.flatnonzero(ends - starts >= k + 1)
        a = starts[use]
        b = ends[use] if k == 0 else a + k
        h = mixed((s[b] - s[a]) * inverse[a] + np.uint64(k))
        out_rows.append(rows[use])
        out.append((h >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out_rows), np.concatenate(out)


@dataclass
class FactorizationMachine:
    bias: float
    index: np.ndarray        # slot -> row of weights, -1: not used
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Score before the logistic of ``n`` texts from distinct (row, term) pairs."""
        out = self.bias + np.bincount(rows, self.weights[terms], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[terms, f]
            out += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return out

    def probabilities(self, column) -> np.ndarray:
        scores = np.zeros(len(column))
        used = max(1, len(self.weights))
        for lo, hi, data, offsets in text_steps(column):
            rows, slots = hashed_terms(data, offsets)
            terms = self.index[slots]
            pairs = np.unique(rows[terms >= 0] * used + terms[terms >= 0])
            scores[lo:hi] = self.margins(pairs // used, pairs % used, hi - lo)
        return 1.0 / (1.0 + np.exp(-np.clip(scores, -60, 60)))


def train(texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = 60, rate: float = 0.05,
          decay: tuple[float, float] = (1e-4, 1e-3), drop: float = 0.5, batch: int = 256,
          seed: int = 5) -> FactorizationMachine:
    """Fit on texts given as arrays of distinct slots; everything here is bounded by the sample.

    Weights start at half their terms' log odds, and each step leaves out a
    part ``drop`` of the terms: a text with one telling term must do without
    the others that it mostly comes with.
    """
    index = np.full(1 << BITS, -1, np.int32)
    total = float(weights.sum())
    share = float((weights * labels).sum() / total) if total else 0.0
    none = FactorizationMachine(float(np.log((share + 1e-9) / (1 - share + 1e-9))), index, np.zeros(0),
                                np.zeros((0, FACTORS)))
    if share in (0.0, 1.0):
        return none
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    seen = [np.bincount(np.concatenate([t for t, y in zip(texts, labels) if y == c] + [np.zeros(0, np.int64)]),
                        minlength=1 << BITS).astype(float) for c in (1, 0)]

    def part(a, e):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(e, 1e-12)), 0.0)

    both = seen[0] + seen[1]
    e1, e0 = both * n1 / (n1 + n0), both * n0 / (n1 + n0)
    g = 2 * (part(seen[0], e1) + part(seen[1], e0) + part(n1 - seen[0], n1 - e1) + part(n0 - seen[1], n0 - e0))
    chosen = np.flatnonzero(g > LEAST_G)
    if not len(chosen):
        return none
    index[chosen] = np.arange(len(chosen))
    rng = np.random.default_rng(seed)
    rows = [index[t][index[t] >= 0] for t in texts]
    y, sw = labels.astype(float), weights / weights.mean()
    w = 0.5 * np.log((seen[0][chosen] + 0.5) / (n1 + 1) / ((seen[1][chosen] + 0.5) / (n0 + 1)))
    v, b = rng.normal(0, 0.01, (len(chosen), FACTORS)), none.bias
    mw, vw, mv, vv, mb, vb, t = *(np.zeros_like(w) for _ in range(2)), *(np.zeros_like(v) for _ in range(2)), 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            at = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
            terms = np.concatenate([rows[i] for i in pick])
            kept = rng.random(len(terms)) >= drop
            at, terms = at[kept], terms[kept]
            sums = np.stack([np.bincount(at, v[terms, f], len(pick)) for f in range(FACTORS)], 1)
            squares = np.bincount(at, (v[terms] ** 2).sum(1), len(pick))
            margin = b + np.bincount(at, w[terms], len(pick)) + 0.5 * ((sums ** 2).sum(1) - squares)
            err = sw[pick] * (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - y[pick]) / len(pick)
            gw = np.bincount(terms, err[at], len(w)) + decay[0] * w
            gv = np.zeros_like(v)
            np.add.at(gv, terms, err[at, None] * (sums[at] - v[terms]))
            gv += decay[1] * v
            t += 1
            c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
            mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw ** 2
            mv, vv = 0.9 * mv + 0.1 * gv, 0.999 * vv + 0.001 * gv ** 2
            mb, vb = 0.9 * mb + 0.1 * err.sum(), 0.999 * vb + 0.001 * err.sum() ** 2
            w -= rate * (mw / c1) / (np.sqrt(vw / c2) + 1e-8)
            v -= rate * (mv / c1) / (np.sqrt(vv / c2) + 1e-8)
            b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return FactorizationMachine(float(b), index, w, v)


def fit(docs: DataFrame, labels: DataFrame, usable, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> FactorizationMachine:
    """Fit on labelled documents; ``usable`` is a condition on the key that training rows meet."""
    ship(docs.sparkSession)
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("__y"))
    marked = marked.where(usable).join(docs.select(key).distinct(), key, "left_semi")
    totals = {r["__y"]: r["n"] for r in marked.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    order = F.xxhash64(F.lit("toxic sample"), F.col(key))
    picked = [marked.where(F.col("__y") == y).orderBy(order, key).limit(most) for y, most in ((1, max_toxic), (0, max_clean))]
    keys = picked[0].unionByName(picked[1])                    # at most max_toxic + max_clean rows
    rows = (docs.select(F.col(key), F.col(text).cast("string").alias("__text")).join(F.broadcast(keys), key)
            .groupBy(key, "__y").agg(F.max("__text").alias("__text")))

    def slots(column):
        out = []
        for lo, hi, data, offsets in text_steps(column):
            at, found = hashed_terms(data, offsets)
            pairs = np.unique(at * (1 << BITS) + found)
            cut = np.searchsorted(pairs, np.arange(hi - lo + 1) << BITS)
            found = (pairs & ((1 << BITS) - 1)).astype("<i4")
            out += [found[a:b].tobytes() for a, b in zip(cut, cut[1:])]
        return [pa.array(out, pa.binary())]

    weight = {1: n1 / max(1, min(n1, max_toxic)), 0: n0 / max(1, min(n0, max_clean))}

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(key, ignore_index=True)
        y = frame["__y"].to_numpy(np.int64)
        w = np.where(y == 1, weight[1], weight[0]).astype(float)
        model = train([np.frombuffer(s, "<i4") for s in frame["slots"]], y, w)
        return pd.DataFrame({"model": [pickle.dumps((model.bias, np.flatnonzero(model.index >= 0), model.weights,
                                                     model.factors))]})

    made = (appended(rows.select(key, "__y", "__text"), "__text", "slots binary", slots)
            .select(key, "__y", "slots", F.lit(1).alias("__all")).groupBy("__all").applyInPandas(learn, "model binary").first())
    if made is None:
        return train([], np.zeros(0, np.int64), np.zeros(0))
    bias, chosen, w, v = pickle.loads(bytes(made["model"]))
    index = np.full(1 << BITS, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    return FactorizationMachine(bias, index, w, v)


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on)."""

    def run(column):
        p = model.probabilities(column)
        return [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())]

    return appended(docs, text, "score double, predicted int", run)
