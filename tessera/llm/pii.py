"""Personal data: fixed patterns, and a semi-Markov conditional random field for other ways to write them.

The patterns (mail address, IP address, card number, phone number) give the
base spans, which always stay. The field scores whole candidate segments of a
text (how many digits in which groups, which separators, check digit, what
stands before and after), not single tokens, and dynamic programming over
segments of at most ``MOST_TOKENS`` tokens chooses boundaries and kinds
together. It is trained here, by exact likelihood, on windows of the corpus:
base spans are its examples, some rewritten as people write them to dodge a
pattern (``name (at) host``, a phone number without plus sign, a card number
with dots or a wrong digit); numbers that no pattern takes are its
counter-examples. A number of a card's length that fails the check digit is
neither: it stays out of training, so the field judges it by the rest.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.scratch import as_row, from_row, ship, text_steps

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the base spans (a mail address is its local part, "@" and this domain).
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]|[\[({]at[\])}]", re.I)
#: Tokens of the longest segment, and characters beside a span in a training window.
MOST_TOKENS, BESIDE = 24, 40
#: Training windows of each kind, and of counter-examples (bounds; the lowest hashes of all windows).
SAMPLE_KIND, SAMPLE_OTHER = 96, 192
_FEATURES, _EPOCHS = 1 << 12, 6


# -- base spans --------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def sign_lines(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the lines with a digit or an at sign; no span leaves its line."""
    m = SIGN.search(text)
    while m:
        start, end = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
        end = len(text) if end < 0 else end
        yield start, end
        m = SIGN.search(text, end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; each pattern leftmost and non-overlapping, misfits dropped."""
    found: dict[str, list] = {k: [] for k in KINDS}
    for lo, hi in sign_lines(text):
        at, floor = text.find("@", lo, hi), lo
        while at >= 0:
            start = at
            while start > floor and text[start - 1] in LOCAL_PART:
                start -= 1
            m = DOMAIN.match(text, at + 1, hi) if start < at else None
            if m:
                found["email"].append((start, m.end()))
                floor = m.end()
            at = text.find("@", max(at + 1, floor), hi)
        for m in IP.finditer(text, lo, hi):
            if all(len(p) < 4 and int(p or "0") < 256 for p in (x.lstrip("0") for x in m.group().split("."))):
                found["ip"].append(m.span())
        for m in CARD.finditer(text, lo, hi):
            d = _digits(m.group()) if m.end() - m.start() < 38 else ""
            if 16 <= len(d) <= 19 and luhn(d):
                found["card"].append(m.span())
        for m in PHONE.finditer(text, lo, hi):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found["phone"].append(m.span())
    return [(k, *span) for k in KINDS for span in found[k]]


# -- segments ----------------------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[A-Za-zª-\U0010FFFF]+|[ \t]+|.", re.S)
_NUMERIC = frozenset(" +().-/_[]")
_NAME = frozenset("._%+-")
_DIGIT, _LETTER, _SPACE, _AT, _OTHER = range(5)


def tokens_of(text: str, lo: int = 0, hi: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, class) of the tokens between two places."""
    out = []
    for m in _TOKEN.finditer(text, lo, len(text) if hi is None else hi):
        c = text[m.start()]
        kind = (_DIGIT if "0" <= c <= "9" else _LETTER if c.isalpha() or ord(c) >= 0xAA else _SPACE if c in " \t"
                else _AT if c == "@" else _OTHER)
        out.append((*m.span(), kind))
    return out


def _at_signs(text: str, tokens) -> list[tuple[int, int]]:
    """Token ranges that say "at": the sign, or the word in brackets."""
    out = []
    for i, (s, e, kind) in enumerate(tokens):
        if kind == _AT:
            out.append((i, i + 1))
        elif kind == _LETTER and text[s:e].lower() == "at" and 0 < i < len(tokens) - 1 and text[tokens[i - 1][0]] in "([{" and text[tokens[i + 1][0]] in ")]}":
            out.append((i - 1, i + 2))
    return out


def candidates(text: str, tokens, blocked=()) -> list[tuple[int, int]]:
    """Segments (first token, end token) that could be personal data, outside ``blocked`` spans."""
    taken = np.zeros(len(tokens) + 1, bool)
    if blocked:
        starts, ends = [t[0] for t in tokens], [t[1] for t in tokens]
        for _, s, e in blocked:
            taken[np.searchsorted(ends, s, "right"):np.searchsorted(starts, e, "left")] = True
    found = set()
    for i, (s, _, kind) in enumerate(tokens):
        if taken[i] or not (kind == _DIGIT or text[s] in "+("):
            continue
        digits = 0
        for j in range(i, min(i + MOST_TOKENS, len(tokens))):
            js, je, jk = tokens[j]
            if taken[j] or (jk != _DIGIT and text[js] not in _NUMERIC) or (jk == _SPACE and je - js > 1):
                break
            if jk == _DIGIT:
                digits += je - js
                if digits > 19:
                    break
                if digits >= 7 or (digits >= 4 and j - i >= 6):
                    found.add((i, j + 1))
    for a, b in _at_signs(text, tokens):
        lefts, rights = [], []
        i = a - 1
        if i >= 0 and tokens[i][2] == _SPACE and b - a > 1:
            i -= 1
        while i >= 0 and a - i < 8 and not taken[i] and (tokens[i][2] in (_DIGIT, _LETTER) or text[tokens[i][0]] in _NAME):
            if tokens[i][2] in (_DIGIT, _LETTER):
                lefts.append(i)
            i -= 1
        j = b
        while j < len(tokens) and j - b < 20 and not taken[j]:
            s, _, kind = tokens[j]
            if kind in (_DIGIT, _LETTER):
                rights.append(j + 1)
            elif not (text[s] in "-._()[]{}" or (kind == _SPACE and (j == b or text[s - 1] in ")]}" or text[s + 1:s + 2] in ("(", "[", "{")))):
                break
            j += 1
        found |= {(x, y) for x in lefts for y in rights if y - x <= MOST_TOKENS}
    return sorted(found)


def _side(c: str) -> str:
    return ("end" if not c else "space" if c.isspace() else "digit" if c.isdigit() else "letter" if c.isalpha()
            else c if c in "+@.-\"'/:=" else "mark")


_DOT = re.compile(r"[\[({]\s?dot\s?[\])}]|\.", re.I)


def segment_features(text: str, tokens, i: int, j: int) -> list[int]:
    """Hashed features of a whole segment."""
    s, e = tokens[i][0], tokens[j - 1][1]
    span = text[s:e]
    groups = re.findall("[0-9]+", span)
    d = sum(map(len, groups))
    names = ["bias", f"digits{min(d, 20)}", f"groups{min(len(groups), 6)}", f"tokens{j - i}",
             f"before {_side(text[s - 1:s])}", f"after {_side(text[e:e + 1])}", f"first {_side(span[0]) if span[0] not in '+(' else span[0]}"]
    letters = any(c.isalpha() for c in span)
    if "@" in span or re.search(r"[\[({]at[\])}]", span, re.I):
        domain = re.split(r"@|[\[({]at[\])}]", span, maxsplit=1, flags=re.I)[1]
        parts = [p.strip() for p in _DOT.split(domain)]
        names += ["mail", f"mail parts{min(len(parts), 4)}", f"mail whole {all(re.fullmatch('[A-Za-z0-9-]+', p) for p in parts)}",
                  f"mail end {bool(re.fullmatch('[A-Za-z]{2,8}', parts[-1]))}", f"mail sign {span.count('@')}"]
    elif letters:
        names.append("letters")
    else:
        marks = "".join(sorted(set(re.sub("[0-9]", "", span))))
        names += [f"marks {marks}", f"sizes {'-'.join(str(min(len(g), 9)) for g in groups[:5])}",
                  f"marks {marks} groups{min(len(groups), 6)}", f"plain {span[0] == '+'} digits{min(d, 20)}",
                  f"equal sizes {len({len(g) for g in groups}) == 1} digits{min(d, 20)}"]
        if len(groups) == 4:
            names.append(f"octets {all(len(g) < 4 and int(g) < 256 for g in groups)} {marks}")
        if 13 <= d <= 19:
            names.append(f"check {luhn(''.join(groups))}")
        if span.startswith("00"):
            names.append("00")
    word = re.search(r"([A-Za-zª-\U0010FFFF]+)[^A-Za-z0-9\n]{0,3}$", text[max(0, s - 24):s])
    if word:
        names.append(f"word {word.group(1).lower()}")
    return [zlib.crc32(n.encode()) % _FEATURES for n in names]


# -- the field ---------------------------------------------------------------

def _lse(x, axis=None):
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        out = np.log(np.sum(np.exp(x - top), axis=axis, keepdims=True)) + top
    return out.item() if axis is None else np.squeeze(out, axis)


class Field:
    """Semi-Markov field: a weight per (kind, segment feature), per token class outside, and per pair of labels."""

    def __init__(self, weights=None):
        n = len(KINDS)
        self.w, self.o, self.t = weights or (np.zeros((n, _FEATURES)), np.zeros(5), np.zeros((n + 1, n + 1)))

    def scores(self, segments) -> list[np.ndarray]:
        return [self.w[:, f].sum(1) for _, _, f in segments]

    def _passes(self, outside: np.ndarray, segments, scores):
        """Log-sums of all labelings before each place (by last label) and after it."""
        n, labels = len(outside), len(KINDS) + 1
        ahead = np.full((n + 1, labels), -np.inf)
        ahead[0, 0] = 0.0
        by_end, by_start = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
        for x, (i, j, _) in enumerate(segments):
            by_end[j].append(x)
            by_start[i].append(x)
        for j in range(1, n + 1):
            ahead[j, 0] = _lse(ahead[j - 1] + self.t[:, 0]) + outside[j - 1]
            for x in by_end[j]:
                ahead[j, 1:] = np.logaddexp(ahead[j, 1:], _lse(ahead[segments[x][0]][:, None] + self.t[:, 1:], 0) + scores[x])
        after = np.full((n + 1, labels), -np.inf)
        after[n] = 0.0
        for i in range(n - 1, -1, -1):
            after[i] = self.t[:, 0] + outside[i] + after[i + 1, 0]
            for x in by_start[i]:
                after[i] = np.logaddexp(after[i], _lse(self.t[:, 1:] + scores[x] + after[segments[x][1], 1:], 1))
        return ahead, after, _lse(ahead[n])

    def log_likelihood(self, classes, segments, gold: dict, gradient=None) -> float:
        """log p of the labeling ``gold`` {(i, j): kind index}; adds its gradient."""
        outside = self.o[classes]
        scores = self.scores(segments)
        ahead, after, z = self._passes(outside, segments, scores)
        at = {(i, j): x for x, (i, j, _) in enumerate(segments)}
        total, place, last = 0.0, 0, 0
        starts = {i: (j, k) for (i, j), k in gold.items()}
        while place < len(classes):
            if place in starts:
                j, k = starts[place]
                total += self.t[last, k + 1] + scores[at[place, j]][k]
                if gradient:
                    gradient[0][k, segments[at[place, j]][2]] += 1
                    gradient[2][last, k + 1] += 1
                place, last = j, k + 1
            else:
                total += self.t[last, 0] + outside[place]
                if gradient:
                    gradient[1][classes[place]] += 1
                    gradient[2][last, 0] += 1
                place, last = place + 1, 0
        if gradient:
            for i, c in enumerate(classes):
                p = np.exp(ahead[i] + self.t[:, 0] + outside[i] + after[i + 1, 0] - z)
                gradient[1][c] -= p.sum()
                gradient[2][:, 0] -= p
            for x, (i, j, f) in enumerate(segments):
                p = np.exp(ahead[i][:, None] + self.t[:, 1:] + scores[x] + after[j, 1:] - z)
                np.subtract.at(gradient[0], (slice(None), f), p.sum(0)[:, None])
                gradient[2][:, 1:] -= p
        return total - z

    def best(self, classes, segments) -> list[tuple[int, int, int]]:
        """Segments (i, j, kind) of the best labeling."""
        outside, scores = self.o[classes], self.scores(segments)
        n, labels = len(classes), len(KINDS) + 1
        top = np.full((n + 1, labels), -np.inf)
        top[0, 0] = 0.0
        came: dict = {}
        by_end = [[] for _ in range(n + 1)]
        for x, (_, j, _) in enumerate(segments):
            by_end[j].append(x)
        for j in range(1, n + 1):
            into = top[j - 1] + self.t[:, 0]
            top[j, 0], came[j, 0] = into.max() + outside[j - 1], (j - 1, int(into.argmax()))
            for x in by_end[j]:
                i = segments[x][0]
                into = top[i][:, None] + self.t[:, 1:]
                value, last = into.max(0) + scores[x], into.argmax(0)
                for k in np.flatnonzero(value > top[j, 1:]):
                    top[j, k + 1], came[j, k + 1] = value[k], (i, int(last[k]))
        out, j, y = [], n, int((top[n] + self.t[:, 0]).argmax())
        while j > 0:
            i, last = came[j, y]
            if y:
                out.append((i, j, y - 1))
            j, y = i, last
        return out[::-1]

    def spans(self, text: str, blocked=()) -> list[tuple[str, int, int]]:
        """Spans that the field finds outside the blocked ones: one program for each cluster of candidates of a line."""
        out = []
        for start, end in sign_lines(text):
            tokens = tokens_of(text, start, end)
            found = candidates(text, tokens, [b for b in blocked if b[1] < end and b[2] > start] if blocked else ())
            x = 0
            while x < len(found):
                lo, hi, y = found[x][0], found[x][1], x + 1
                while y < len(found) and found[y][0] <= hi:
                    hi = max(hi, found[y][1])
                    y += 1
                segments = [(i - lo, j - lo, segment_features(text, tokens, i, j)) for i, j in found[x:y]]
                for i, j, k in self.best(np.array([t[2] for t in tokens[lo:hi]]), segments):
                    out.append((KINDS[k], tokens[lo + i][0], tokens[lo + j - 1][1]))
                x = y
        return out

    def packed(self) -> bytes:
        return np.concatenate([self.w.ravel(), self.o, self.t.ravel()]).astype("<f4").tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Field:
        a, n = np.frombuffer(data, "<f4").astype(float), len(KINDS)
        cut = n * _FEATURES
        return Field((a[:cut].reshape(n, -1), a[cut:cut + 5], a[cut + 5:].reshape(n + 1, n + 1)))


# -- training ----------------------------------------------------------------

def _unsure(text: str) -> bool:
    """A number of a card's length that fails the check digit."""
    return any(16 <= len(d := _digits(m.group())) <= 19 and not luhn(d) for m in CARD.finditer(text))


def windows(text: str) -> Iterator[tuple[str, str, list]]:
    """(kind or "other", text around a span or number, base spans within) of one text."""
    base = base_spans(text)
    covered = 0
    numbers = [("other", *m.span()) for lo, hi in sign_lines(text) for m in re.compile(r"[0-9][0-9.,:/-]*").finditer(text, lo, hi)]
    for group, s, e in sorted([*base, *numbers], key=lambda x: x[1:]):
        if e <= covered:
            continue
        covered = e + BESIDE
        lo, hi = max(0, s - BESIDE), min(len(text), e + BESIDE)
        inside = [(k, a - lo, b - lo) for k, a, b in base if lo <= a and b <= hi]
        cut = any(a < hi and b > lo and not (lo <= a and b <= hi) for _, a, b in base)
        part = text[lo:hi]
        if not cut and len(part) < 400 and not _unsure(part):
            yield (group if group != "other" or not inside else inside[0][0]), part, inside


def rewritten(kind: str, span: str, rng: random.Random) -> tuple[str, str | None]:
    """A span written otherwise, and its kind (None: no personal data any more)."""
    d = _digits(span)
    figures = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    if rng.random() < 0.4:                                               # a counter-example in the same place
        return rng.choice([figures(rng.randrange(1, 7)), f"{rng.randrange(1900, 2100)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}",
                           f"{rng.randrange(24)}:{rng.randrange(10, 60)}", f"{rng.randrange(10)}.{rng.randrange(20)}",
                           f"{rng.randrange(10)}.{rng.randrange(20)}.{rng.randrange(20)}", f"@{span[:3].strip('+(.')}x", figures(rng.randrange(22, 40)),
                           f"{rng.randrange(256, 999)}.{figures(3)}.{rng.randrange(300, 999)}.{figures(2)}",
                           f"{figures(1)},{figures(3)},{figures(3)}", "".join(rng.choice("0123456789abcdef") for _ in range(40)),
                           f"{rng.randrange(1, 30)}/{rng.randrange(1, 12)}/{rng.randrange(1990, 2030)}", "x@y", f"{span.split('@')[0].strip('+(.')}@{figures(2)}",
                           " ".join(str(rng.randrange(100)) for _ in range(rng.randrange(3, 12)))]), None
    if kind == "email":
        name, domain = span.split("@", 1)
        at = rng.choice(["@", "(at)", " (at) ", "[at]", " [at] ", "{at}"])
        dot = rng.choice([".", "(dot)", " (dot) ", "[dot]", "[.]"])
        return f"{name.strip('.%+-') or 'x'}{at}{domain.replace('.', dot)}", kind
    if kind == "ip":
        return rng.choice(["[.]", "(.)", "."]).join(span.split(".")), kind
    if kind == "card":
        wrong = d if rng.random() < 0.5 else d[:-1] + str((int(d[-1]) + rng.randrange(1, 10)) % 10)
        mark = rng.choice(["", "", " ", "-", ".", "_", "/"])
        return mark.join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), kind
    tail = d[-10:] if len(d) >= 10 else d
    a, b, c = tail[:3], tail[3:6], tail[6:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{d[:-len(tail)]} {a} {b} {c}", f"{a}/{b}{c}",
                       f"1 ({a}) {b}-{c}", span, f"+{d}"]), kind


def _example(text: str, spans: list, rng: random.Random):
    """(token classes, segments, gold) of a window, its spans rewritten by chance; None where the gold is no candidate."""
    if spans and rng.random() < 0.6:
        made, done, at = "", [], 0
        for kind, s, e in sorted(spans, key=lambda x: x[1]):
            if s < at:
                return None                                              # overlapping base spans
            new, as_kind = rewritten(kind, text[s:e], rng)
            made += text[at:s]
            if as_kind:
                done.append((as_kind, len(made), len(made) + len(new)))
            made, at = made + new, e
        text, spans = made + text[at:], done
    tokens = tokens_of(text)
    segments = [(i, j, segment_features(text, tokens, i, j)) for i, j in candidates(text, tokens)]
    starts, ends = {t[0]: i for i, t in enumerate(tokens)}, {t[1]: i + 1 for i, t in enumerate(tokens)}
    known, gold = {(i, j) for i, j, _ in segments}, {}
    for kind, s, e in spans:
        at = (starts.get(s), ends.get(e))
        if at not in known:
            return None
        gold[at] = KINDS.index(kind)
    if any(i2 < j1 and i1 < j2 for (i1, j1) in gold for (i2, j2) in gold if (i1, j1) < (i2, j2)):
        return None
    return np.array([t[2] for t in tokens]), segments, gold


def train(rows: list[tuple[str, list]], seed: int = 7) -> Field:
    """The field that explains the windows (text, base spans): AdaGrad on the exact log-likelihood.

    Every epoch rewrites other spans; the order is fixed, so equal windows give an equal field.
    """
    rng, field = random.Random(seed), Field()
    field.w[:, zlib.crc32(b"bias") % _FEATURES] = -4.0                   # rather nothing than a kind unseen
    weights = (field.w, field.o, field.t)
    seen = tuple(np.full(x.shape, 1e-2) for x in weights)
    for _ in range(_EPOCHS):
        rng.shuffle(rows)
        for text, spans in rows:
            made = _example(text, spans, rng)
            if made is None or not made[1]:
                continue
            gradient = tuple(np.zeros(x.shape) for x in weights)
            field.log_likelihood(*made, gradient)
            for x, g, h in zip(weights, gradient, seen):
                g -= 1e-4 * x
                h += g * g
                x += 0.3 * g / np.sqrt(h)
    return field


def fit(docs: DataFrame, text: str = "text", per_kind: int = SAMPLE_KIND, others: int = SAMPLE_OTHER) -> bytes:
    """A field fitted on windows of the corpus (packed), in one task.

    Bound: the ``per_kind`` windows of each kind and ``others`` without a span
    that have the lowest hashes. Without any window the field finds nothing.
    """
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(g, w, json.dumps(spans)) for t in _with_signs(batch.column(0)) for g, w, spans in windows(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["g", "w", "s"])

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(r.w, [tuple(x) for x in json.loads(r.s)]) for f in frames for r in f.itertuples()]
        yield pd.DataFrame({"field": [train(sorted(rows)).packed()]})

    found = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(cut, "g string, w string, s string").distinct()
    first = Window.partitionBy("g").orderBy(F.xxhash64("w"), "w", "s")
    bound = F.when(F.col("g") == "other", others).otherwise(per_kind)
    chosen = found.withColumn("r", F.row_number().over(first)).where(F.col("r") <= max(per_kind, others)).where(F.col("r") <= bound)
    models = chosen.select("w", "s").coalesce(1).mapInPandas(learn, "field binary").collect()
    return bytes(models[0]["field"]) if models else Field().packed()


# -- scoring -----------------------------------------------------------------

_SIGN = np.zeros(256, bool)
_SIGN[[*range(48, 58), 64, *b"([{"]] = True


def _with_signs(column) -> Iterator[str]:
    for row, text in _signed(column):
        yield text


def _signed(column) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts with a digit, an at sign or a bracket; no other text can hold a span."""
    for lo, hi, data, offsets in text_steps(column):
        count = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_SIGN[data], out=count[1:])
        for i in np.flatnonzero(count[offsets[1:]] > count[offsets[:-1]]):
            yield lo + int(i), column[lo + int(i)].as_py()


_SPANS = "array<struct<kind: string, start: long, end: long>>"


def find_personal_data(docs: DataFrame, field: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (kind, start, end), by
    kind (mail, IP, card, phone), then start; code points, end exclusive.

    ``base`` has the patterns' spans, ``spans`` those and what the field adds
    outside them. Null and empty texts have none; repeated rows get equal
    answers; an empty table gives no rows; columns ``base`` and ``spans`` of
    ``docs`` give way, all others stay whatever their names.
    """
    ship(docs.sparkSession)
    rank = {k: i for i, k in enumerate(KINDS)}

    def listed(found: list[list]) -> pa.Array:
        flat = [x for row in found for x in row]
        ends = np.concatenate([[0], np.cumsum([len(row) for row in found])]).astype(np.int32)
        fields = [pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.int64()), pa.array([x[2] for x in flat], pa.int64())]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names=["kind", "start", "end"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field.unpacked(field)
        for batch in batches:
            base: list[list] = [[] for _ in range(batch.num_rows)]
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for i, t in _signed(batch.column(1)):
                base[i] = base_spans(t)
                spans[i] = sorted(base[i] + model.spans(t, base[i]), key=lambda x: (rank[x[0]], x[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed(base), listed(spans)], names=["row", "base", "spans"])
            pa.default_memory_pool().release_unused()

    rows = as_row(docs, t=F.col(text).cast("string"))
    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, base {_SPANS}, spans {_SPANS}")
    return from_row(out, [c for c in docs.columns if c not in ("base", "spans")], base=F.col("base"), spans=F.col("spans"))


def written_out(spans: str):
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
