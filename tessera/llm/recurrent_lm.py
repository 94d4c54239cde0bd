"""LM scoring: a gated recurrent language model over words.

Tokens are words (A-Z lower-cased) and one end per text. Counts cover every
training text. The model's symbols are the end, the most frequent words and,
for all other words, one of 64 signatures (of a word's last two bytes); a
gated recurrent unit reads the symbols and a class-factored softmax gives the
next one, P(class | state) P(symbol | class, state). A word behind a
signature has its smoothed share of that signature's training tokens, so
every text has a probability.

Training is truncated backpropagation through time in numpy: lanes of
documents in windows of ``WINDOW`` tokens, the state carried from window to
window and reset at each document. Output biases start at the counts, so the
untrained model is the unigram model. Each round, every task trains a copy on
its own documents; the copies are averaged by their tokens, level by level in
tasks, never all at the driver. The rounds split the training documents by a
hash of the key, so together they learn from every one of them once (a
``share`` under 1 leaves some out, for trials only).

Scoring carries the state through the whole text. Counts of at most
``LOOKUP_WORDS`` frequent words go to the tasks (a bounded table); the rest
are joined by word hash.

Edge cases: null and empty texts are one end token; texts of any length are
scored whole; repeated rows score alike; without training texts N and V are
0, every word is unknown and scores follow from that; extra columns are not
read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import mixed, ship, span_hashes, text_steps, word_spans, written

HIDDEN = 16
CLASSES = 64
SYMBOLS = CLASSES * CLASSES
SIGNATURES = 64
WINDOW = 32
TRAIN_LANES, SCORE_LANES = 128, 512
ROUNDS = 2
#: Every training document is learned from.
TRAIN_SHARE = 1.0
#: Training deals a longer document to the lanes as spans (scoring never does). A span after the first reads the
#: ``LEAD`` tokens before it, without learning them again, so that it starts with a state and never as a document.
TRAIN_SPAN, LEAD = 1024, 64
RATE = 0.1
#: Words whose counts are sent to the tasks (12 bytes each, in a table twice as large).
LOOKUP_WORDS = 1 << 19
END_KEY = -1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def token_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key of each word (its low six bits are the signature) and first word per text."""
    starts, ends, first = word_spans(data, offsets)
    data = _LOWER[data]
    h = span_hashes(data, starts, ends)
    if len(ends):
        tail = data[ends - 1].astype(np.uint64) * np.uint64(256)
        tail += np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        h = (h & ~np.uint64(SIGNATURES - 1)) | (mixed(tail + np.uint64(1)) >> np.uint64(58))
    return h.view(np.int64), first


class Lookup:
    """Open-addressing table from word key to row, for whole arrays of keys."""

    def __init__(self, keys: np.ndarray):
        self.size = 1 << max(4, int(2 * len(keys) - 1).bit_length())
        self.keys = np.zeros(self.size, np.int64)
        self.rows = np.full(self.size, -1, np.int32)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.rows[at[left]] < 0
            took = left[free]
            _, one = np.unique(at[took], return_index=True)
            took = took[one]
            self.rows[at[took]], self.keys[at[took]] = took, keys[took]
            left = left[self.rows[at[left]] != left]
            at[left] = (at[left] + 1) & (self.size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) >> np.uint64(64 - (self.size.bit_length() - 1))).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is absent."""
        at = self._slot(keys)
        out = self.rows[at]
        left = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        while len(left):
            at[left] = (at[left] + 1) & (self.size - 1)
            out[left] = self.rows[at[left]]
            left = left[(out[left] >= 0) & (self.keys[at[left]] != keys[left])]
        return out


@dataclass
class Vocabulary:
    """What the tasks need of the counts; sizes are bounded by ``LOOKUP_WORDS`` and ``SYMBOLS``."""

    lookup: Lookup
    counts: np.ndarray               # of the lookup's rows
    symbols: np.ndarray              # symbol of the lookup's rows
    frequency: np.ndarray            # training tokens of each symbol
    log_rest: np.ndarray             # log10 of the tokens + words + 1 behind each signature
    tokens: int
    types: int
    ends: int

    @property
    def log_base(self) -> float:
        return math.log10(self.tokens + self.types + 1)

    def symbols_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, row or -1): symbol 0 is the end, 1 to 64 are signatures, then words."""
        rows = self.lookup.find(keys)
        out = np.append(self.symbols, 0)[rows]                 # row -1: none
        return np.where(out > SIGNATURES, out, 1 + (keys & (SIGNATURES - 1))), rows


def count_words(docs: DataFrame, training) -> DataFrame:
    """(h, c) over all training texts, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [token_keys(data, offsets)[0] for _, _, data, offsets in text_steps(batch.column(0))]
            keys = np.concatenate([*keys, np.zeros(0, np.int64)])
            h, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(h, END_KEY)), pa.array(np.append(n, batch.num_rows))],
                                             names=["h", "n"])

    rows = docs.where(training).select("__text").mapInArrow(run, "h long, n long")
    return written(rows.groupBy("h").agg(F.sum("n").alias("c")).where("c > 0"), "word-counts")


def vocabulary(counts: DataFrame, lookup_words: int = LOOKUP_WORDS) -> Vocabulary:
    words = counts.where(F.col("h") != END_KEY)
    sums = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("h") == END_KEY, F.col("c")))).first()
    tokens, types, ends = (int(x or 0) for x in sums)
    steps = sorted(words.groupBy(F.ceil(F.log2("c") * 16).alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c"))
                   .collect(), key=lambda r: -r["b"])
    least, total = None, 0
    for r in steps:                                   # whole steps of counts, as many as fit
        total += r["n"]
        if total > lookup_words:
            break
        least = r["c"]
    keys = c = np.zeros(0, np.int64)
    if least is not None:
        top = words.where(F.col("c") >= least).toArrow()           # at most lookup_words rows of 16 bytes
        keys, c = top.column("h").to_numpy(), top.column("c").to_numpy()
        order = np.lexsort((keys, -c))
        keys, c = keys[order], c[order]
    known = SYMBOLS - 1 - SIGNATURES
    symbols = np.zeros(len(keys), np.int32)
    symbols[:known] = np.arange(len(keys[:known])) + 1 + SIGNATURES
    by = {r["s"]: r for r in words.groupBy(F.col("h").bitwiseAND(SIGNATURES - 1).alias("s")).agg(
        F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    rest_c = np.array([by[s]["c"] if s in by else 0 for s in range(SIGNATURES)], float)
    rest_n = np.array([by[s]["n"] if s in by else 0 for s in range(SIGNATURES)], float)
    sign = keys[:known] & (SIGNATURES - 1)
    rest_c -= np.bincount(sign, c[:known], SIGNATURES)
    rest_n -= np.bincount(sign, minlength=SIGNATURES)
    frequency = np.concatenate([[ends], rest_c, c[:known], np.zeros(known - len(keys[:known]))])
    return Vocabulary(Lookup(keys), c, symbols, frequency, np.log10(rest_c + rest_n + 1), tokens, types, ends)


# -- the model --------------------------------------------------------------

def new_model(vocab: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    """Random recurrent weights; output biases at the smoothed counts."""
    rng = np.random.default_rng(seed)
    order = np.argsort(-vocab.frequency, kind="stable")
    place = np.empty(SYMBOLS, np.int32)                 # class and slot of each symbol, by falling frequency
    place[order] = np.arange(SYMBOLS)
    f = np.log((vocab.frequency[order] + 0.1) / (vocab.frequency.sum() + 0.1 * SYMBOLS)).reshape(CLASSES, CLASSES)
    whole = np.log(np.exp(f).sum(1))

    def normal(scale, *shape):
        return rng.normal(0, scale, shape).astype(np.float32)

    return {"place": place, "x": normal(0.3, SYMBOLS, 3 * HIDDEN), "u": normal(0.25, HIDDEN, 3 * HIDDEN),
            "b": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(HIDDEN)]).astype(np.float32),
            "wc": normal(0.01, HIDDEN, CLASSES), "bc": whole.astype(np.float32),
            "ww": normal(0.01, CLASSES, HIDDEN, CLASSES), "bw": (f - whole[:, None]).astype(np.float32)}


LEARNED = ("x", "u", "b", "wc", "bc", "ww", "bw")


def packed(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as f:
        return {k: f[k] for k in f.files}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def step(model, h, symbols):
    """One step of the unit: the next state, and what its gradient needs."""
    x = model["x"].take(symbols, axis=0)
    hu = h @ model["u"]
    hu += model["b"]
    gates = _sigmoid(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
    r, z, hun = gates[:, :HIDDEN], gates[:, HIDDEN:], hu[:, 2 * HIDDEN:]
    n = r * hun
    n += x[:, 2 * HIDDEN:]
    n *= 2
    _sigmoid(n)
    n *= 2
    n -= 1
    return n + z * (h - n), (r, z, n, hun)


_ONES = np.ones(CLASSES, np.float32)


def _log_softmax(logits: np.ndarray, target: np.ndarray):
    """Log probability of the targets, exponentials and their sums; float32 holds 64 of e**80."""
    np.minimum(logits, 80, out=logits)
    at = logits[np.arange(len(target)), target]
    e = np.exp(logits, out=logits)
    total = e @ _ONES
    return at - np.log(total), e, total


def output(model, h, targets, gradient: bool = False):
    """Natural log probability of each target symbol; with its gradients if asked for."""
    place = model["place"][targets]
    order = np.argsort(place // CLASSES, kind="stable")
    h, place = h.take(order, axis=0), place[order]
    classes, slots = place // CLASSES, place % CLASSES
    cut = np.searchsorted(classes, np.arange(CLASSES + 1))
    logits = h @ model["wc"]
    logits += model["bc"]
    logp, e, total = _log_softmax(logits, classes)
    dh = None
    grads: dict[str, np.ndarray] = {}
    if gradient:
        e /= total[:, None]
        e[np.arange(len(e)), classes] -= 1
        grads["wc"], grads["bc"] = h.T @ e, e.sum(0)
        dh = e @ model["wc"].T
        grads["ww"], grads["bw"] = np.zeros_like(model["ww"]), np.zeros_like(model["bw"])
    for c in range(CLASSES):
        lo, hi = cut[c], cut[c + 1]
        if lo == hi:
            continue
        logits = h[lo:hi] @ model["ww"][c]
        logits += model["bw"][c]
        lp, e, total = _log_softmax(logits, slots[lo:hi])
        logp[lo:hi] += lp
        if gradient:
            e /= total[:, None]
            e[np.arange(hi - lo), slots[lo:hi]] -= 1
            grads["ww"][c], grads["bw"][c] = h[lo:hi].T @ e, e.sum(0)
            dh[lo:hi] += e @ model["ww"][c].T
    back = np.empty_like(logp)
    back[order] = logp
    if gradient:
        d = np.empty_like(dh)
        d[order] = dh
        dh = d
    return back, dh, grads


def lanes_of(lengths: np.ndarray, lanes: int) -> list[np.ndarray]:
    """Texts dealt to lanes of about equal token counts, longest lane first; a lane reads its texts in turn."""
    lanes = max(1, min(lanes, len(lengths)))
    total = np.zeros(lanes, np.int64)
    out: list[list[int]] = [[] for _ in range(lanes)]
    import heapq

    heap = [(0, i) for i in range(lanes)]
    for t in np.argsort(-lengths, kind="stable").tolist():
        size, i = heapq.heappop(heap)
        out[i].append(t)
        total[i] = size + lengths[t]
        heapq.heappush(heap, (int(total[i]), i))
    return [np.array(out[i], np.int64) for i in np.argsort(-total, kind="stable")]


def _grid(starts: np.ndarray, learned: np.ndarray, ends: np.ndarray, lanes: list[np.ndarray]):
    """Token index grid (lane, time), -1 beyond the lane's end; where spans start, and are past their lead-in; lane sizes."""
    lengths = ends - starts
    sizes = np.array([lengths[lane].sum() for lane in lanes])
    grid = np.full((len(lanes), int(sizes.max(initial=0))), -1, np.int64)
    fresh, own = np.zeros(grid.shape, bool), np.zeros(grid.shape, bool)
    for i, lane in enumerate(lanes):
        n = lengths[lane]
        age = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = age + np.repeat(starts[lane], n)
        grid[i, :len(at)] = at
        fresh[i, :len(at)] = age == 0
        own[i, :len(at)] = at >= np.repeat(learned[lane], n)
    return grid, fresh, own, sizes


def training_spans(offset: np.ndarray, span: int = TRAIN_SPAN, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token read, first token learned, end) of each span; the learned parts cover every text once."""
    cuts = np.unique(np.concatenate([offset, *(np.arange(a, b, span) for a, b in zip(offset, offset[1:]) if b - a > span)]))
    learned, ends = cuts[:-1], cuts[1:]
    begins = offset[np.searchsorted(offset, learned, "right") - 1]                 # of each span's text
    return np.maximum(learned - lead, begins), learned, ends


def score_texts(model, symbols: np.ndarray, offset: np.ndarray, lanes: int = SCORE_LANES,
                window: int = WINDOW) -> np.ndarray:
    """Natural log probability of each text's symbols (each text ends in the end symbol)."""
    out = np.zeros(len(symbols), np.float32)
    grid, fresh, _, sizes = _grid(offset[:-1], offset[:-1], offset[1:], lanes_of(np.diff(offset), lanes))
    h = np.zeros((len(sizes), HIDDEN), np.float32)
    before = np.zeros(len(sizes), np.int32)              # the end symbol precedes a text
    for lo in range(0, grid.shape[1], window):
        live = int(np.searchsorted(-sizes, -lo, "left"))
        states, where = [], []
        for t in range(lo, min(lo + window, grid.shape[1])):
            live = int(np.searchsorted(-sizes[:live], -t, "left"))
            if not live:
                break
            h, before = h[:live], before[:live]
            new = fresh[:live, t]
            h = np.where(new[:, None], np.float32(0), h)
            h, _ = step(model, h, np.where(new, 0, before))
            at = grid[:live, t]
            states.append(h)
            where.append(at)
            before = symbols[at]
        if states:
            at = np.concatenate(where)
            out[at] = output(model, np.concatenate(states), symbols[at])[0]
    return np.add.reduceat(out.astype(float), offset[:-1]) if len(offset) > 1 else np.zeros(0)


class Trainer:
    """Truncated backpropagation through time with Adagrad."""

    def __init__(self, model, rate: float = RATE):
        self.model = {k: v.copy() for k, v in model.items()}
        self.rate = rate
        self.squares = {k: np.full_like(self.model[k], 1e-2) for k in LEARNED}
        self.tokens = 0

    def _apply(self, name: str, grad: np.ndarray, rows=None) -> None:
        square, value = self.squares[name], self.model[name]
        if rows is None:
            square += grad * grad
            value -= self.rate * grad / np.sqrt(square)
        else:
            square[rows] += grad * grad
            value[rows] -= self.rate * grad / np.sqrt(square[rows])

    def learn(self, symbols: np.ndarray, offset: np.ndarray, lanes: int = TRAIN_LANES, window: int = WINDOW) -> None:
        m = self.model
        starts, learned, ends = training_spans(offset)
        grid, fresh, own, sizes = _grid(starts, learned, ends, lanes_of(ends - starts, lanes))
        prior = np.zeros(len(symbols), np.int32)             # what precedes each token; the end symbol, a text
        prior[1:] = symbols[:-1]
        prior[offset[:-1]] = 0
        h = np.zeros((len(sizes), HIDDEN), np.float32)
        for lo in range(0, grid.shape[1], window):
            hs, keeps, ins, states, at = [], [], [], [], []
            for t in range(lo, min(lo + window, grid.shape[1])):
                live = int(np.searchsorted(-sizes[:len(h)], -t, "left"))
                if not live:
                    break
                h = h[:live]
                new = fresh[:live, t]
                h = np.where(new[:, None], np.float32(0), h)
                now = prior[grid[:live, t]]
                hs.append(h)
                ins.append(now)
                h, keep = step(m, h, now)
                keeps.append((keep, new))
                states.append(h)
                at.append(grid[:live, t])
            if not at:
                break
            index, states = np.concatenate(at), np.concatenate(states)
            scale = np.float32(1.0 / len(sizes))             # of all lanes: when few are left, each token weighs as before
            # A token of a lead-in only carries the state: it is learned as part of the span before.
            mine = np.concatenate([own[:len(a), lo + i] for i, a in enumerate(at)])
            dout = np.zeros_like(states)
            _, dout[mine], grads = output(m, states[mine], symbols[index[mine]], gradient=True)
            cut = np.cumsum([0] + [len(a) for a in at])
            # What the steps' gradients are multiplied by, for the whole window at once.
            held = np.concatenate(hs)
            r, z, n, hun = (np.concatenate([keep[k] for keep, _ in keeps]) for k in range(4))
            to_n, to_z, to_r = (1 - z) * (1 - n * n), (held - n) * z * (1 - z), hun * r * (1 - r)
            dx, dhu = np.empty((2, len(held), 3 * HIDDEN), np.float32)
            u = np.ascontiguousarray(m["u"].T)
            carried = np.zeros((0, HIDDEN), np.float32)
            for i in range(len(at) - 1, -1, -1):
                part = slice(cut[i], cut[i + 1])
                d = dout[part]
                d[:len(carried)] += carried
                dn = d * to_n[part]
                dx[part, :HIDDEN] = dn * to_r[part]
                dx[part, HIDDEN:2 * HIDDEN] = d * to_z[part]
                dx[part, 2 * HIDDEN:] = dn
                dhu[part, :2 * HIDDEN] = dx[part, :2 * HIDDEN]
                dhu[part, 2 * HIDDEN:] = dn * r[part]
                carried = d * z[part]
                carried += dhu[part] @ u
                carried[keeps[i][1]] = 0
            for name, g in (("u", held.T @ dhu), ("b", dhu.sum(0)), *grads.items()):
                self._apply(name, np.clip(g * scale, -1, 1))
            ids = np.concatenate(ins)
            order = np.argsort(ids, kind="stable")
            rows, first = np.unique(ids[order], return_index=True)
            self._apply("x", np.clip(np.add.reduceat(dx[order], first) * scale, -1, 1), rows)
            self.tokens += int(mine.sum())


def _symbols_of_batch(column, vocab: Vocabulary):
    """(symbols with ends, offsets, keys, rows, first word per text) of a batch of texts."""
    keys, firsts, n = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], 0
    for _, _, data, offsets in text_steps(column):
        k, first = token_keys(data, offsets)
        keys.append(k)
        firsts.append(first[1:] + n)
        n += len(k)
    keys, first = np.concatenate(keys), np.concatenate(firsts)
    words, rows = vocab.symbols_of(keys)
    texts = len(first) - 1
    offset = first + np.arange(texts + 1)
    out = np.zeros(offset[-1], np.int32)
    out[np.arange(len(keys)) + np.repeat(np.arange(texts), np.diff(first))] = words
    return out, offset, keys, rows, first


def train(docs: DataFrame, vocab: Vocabulary, training, rounds: int = ROUNDS, share: float = TRAIN_SHARE,
          fan_in: int = 32) -> dict[str, np.ndarray]:
    """Rounds of local training and averaging, each over its part of the training documents."""
    sc = docs.sparkSession.sparkContext
    shared_vocab = sc.broadcast(vocab)
    model = new_model(vocab)
    pick = F.pmod(F.xxhash64(F.lit("train"), F.col("__key").cast("string")), F.lit(1_000_000))
    for k in range(rounds):
        part = docs.where(training & (pick >= int(1e6 * share * k / rounds)) & (pick < int(1e6 * share * (k + 1) / rounds)))
        shared = sc.broadcast(packed(model))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trainer, vocab = None, shared_vocab.value
            for batch in batches:
                if trainer is None:
                    trainer = Trainer(unpacked(shared.value))
                symbols, offset, *_ = _symbols_of_batch(batch.column(0), vocab)
                trainer.learn(symbols, offset)
            if trainer is not None and trainer.tokens:
                yield pa.RecordBatch.from_arrays([pa.array([packed(trainer.model)], pa.binary()),
                                                  pa.array([float(trainer.tokens)])], names=["model", "weight"])

        def average(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, sums, rest = 0.0, None, None
            for frame in frames:
                for data, w in zip(frame["model"], frame["weight"]):
                    one = unpacked(data)
                    rest = rest or one
                    sums = {k: one[k].astype(float) * w + (sums[k] if sums else 0) for k in LEARNED}
                    total += w
            if sums:
                yield pd.DataFrame({"model": [packed(rest | {k: (v / total).astype(np.float32) for k, v in sums.items()})],
                                    "weight": [total]})

        models = written(part.select("__text").mapInArrow(run, "model binary, weight double"), "models")
        n = models.count()
        while n > 1:
            n = -(-n // fan_in)
            models = written(models.repartition(n).mapInPandas(average, "model binary, weight double"), "models")
        got = models.first()
        if got is not None:
            model = unpacked(bytes(got["model"]))
    return model


def score(docs: DataFrame, training, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
          share: float = TRAIN_SHARE, lookup_words: int = LOOKUP_WORDS) -> DataFrame:
    """One row per row of ``docs``: key, trained, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` is a condition on ``docs``; scores are log10 probabilities.
    """
    ship(docs.sparkSession)
    work = docs.select(F.col(key).alias("__key"), F.coalesce(training, F.lit(False)).alias("__train"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    in_training = F.col("__train")
    counts = count_words(work, in_training)
    vocab = vocabulary(counts, lookup_words)
    model = train(work, vocab, in_training, rounds, share)
    sc = docs.sparkSession.sparkContext
    shared_vocab, shared_model = sc.broadcast(vocab), sc.broadcast(packed(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = shared_vocab.value, unpacked(shared_model.value)
        logs = np.append(np.log10(vocab.counts + 1.0), 0.0)              # row -1: not in the table
        for batch in batches:
            symbols, offset, keys, rows, first = _symbols_of_batch(batch.column(2), vocab)
            texts = len(offset) - 1
            text_of = np.repeat(np.arange(texts), np.diff(first))
            spelled = symbols[np.arange(len(keys)) + text_of]
            log = logs[rows]
            there = rows >= 0
            n = np.diff(offset)
            base = np.bincount(text_of, log, texts) + math.log10(vocab.ends + 1) - n * vocab.log_base
            behind = spelled <= SIGNATURES
            p = score_texts(model, symbols, offset) / math.log(10)
            p += np.bincount(text_of[behind], log[behind] - vocab.log_rest[spelled[behind] - 1], texts)
            known = np.bincount(text_of[there], minlength=texts) + (vocab.ends > 0)
            rare = np.flatnonzero(~there)
            cut = np.searchsorted(text_of[rare], np.arange(texts + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)),
                pa.array(base), pa.array(p), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(keys[rare]))],
                names=["key", "trained", "n_tokens", "n_known", "base", "p", "rare"])
            pa.default_memory_pool().release_unused()                # a worker outlives its task

    kind = docs.schema[key].dataType.simpleString()
    scored = work.select("__key", "__train", "__text").mapInArrow(
        run, f"key {kind}, trained boolean, n_tokens long, n_known long, base double, p double, rare array<long>")
    scored = written(scored.withColumn("rid", F.monotonically_increasing_id()), "scores")
    rare = scored.select("rid", F.explode("rare").alias("h"))
    found = rare.join(counts.where(F.col("h") != END_KEY), "h")          # words that training never had add nothing
    more = found.groupBy("rid").agg(F.count("*").alias("known"), F.sum(F.log10(F.col("c") + 1)).alias("log"))
    out = scored.drop("rare").join(more, "rid", "left")
    log = F.coalesce("log", F.lit(0.0))
    return out.select(F.col("key").alias(key), "trained", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                      F.lit(vocab.tokens).cast("long").alias("train_tokens"), (F.col("base") + log).alias("base_score"),
                      (F.col("p") + log).alias("score"))
