"""Quality rules: a learned decision list, applied as Spark conditionals.

``text_statistics`` computes per-text figures with SQL functions alone.
``learn_rules`` runs sequential covering on labelled figures: it grows one
conjunction of threshold tests at a time by information gain on two thirds of
the labelled rows, prunes its last tests while that does not lower its
precision on the other third, keeps it if the precision there is high enough,
removes the rows it covers, and goes on. Every step is one aggregation over
all labelled rows (counts per figure and threshold bin); the driver sees only
those bounded counts. ``rules_column`` turns the ordered list into one
``CASE WHEN`` expression.

Edge cases: a null text has no words; texts without words have zero ratios;
repeated rows are judged alike; with no labelled rows (or one class only) the
list is empty and everything is kept; extra columns are carried through
``text_statistics``, whatever their names; those named as a figure give way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import WORD_SPACE, written

#: Words in a window whose repetition counts.
WINDOW = 5
#: Figures the learned rules may test.
FIGURES = ["symbol_ratio", "repeat_ratio", "dup_line_ratio", "word_length", "upper_ratio", "digit_ratio",
           "mark_ratio", "bang_ratio", "distinct_ratio", "line_words"]
BINS = 64
#: Bad rows that the pruning third must hold; with fewer, growing and pruning share all rows.
LEAST_JUDGES = 10


@dataclass(frozen=True)
class Test:
    figure: str
    above: bool          # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        c = F.col(self.figure)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.figure} {'>' if self.above else '<='} {self.threshold:.6g}"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body (or a filter on its result) names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count_chars(text: Column, pattern: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeated_words(names: Column) -> Column:
    """Number of words in windows whose name occurs twice, from the window names in order."""
    def covered(order: Column) -> Column:
        # Starts of windows that equal a neighbour in the order of names, ascending.
        twice = F.filter(order, lambda x, k: ((k > 0) & (F.get(order, k - 1)["h"] == x["h"]))
                         | (F.get(order, k + 1)["h"] == x["h"]))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        # Each window adds what lies before the next one's start, at most its own length.
        return _let(starts, lambda r: F.aggregate(
            F.zip_with(r, F.slice(r, F.lit(2), F.greatest(F.size(r), F.lit(1))),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda s, x: s + x))

    # Only texts with a repeated name pay for the sort.
    ordered = F.array_sort(F.transform(names, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(names)) < F.size(names), _let(ordered, covered)).otherwise(F.lit(0).cast("long"))


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios FIGURES."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def of_words(w: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            # A window is named by the hash of its words' hashes.
            names = F.when(F.size(h) >= WINDOW, F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))))).otherwise(F.expr("cast(array() as array<bigint>)"))
            return F.struct(F.size(h).cast("long").alias("n"), F.size(F.array_distinct(h)).alias("distinct"),
                            _let(names, _repeated_words).alias("repeated"))

        return F.struct(_let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes).alias("h"),
                        F.aggregate(w, F.lit(0).cast("long"), lambda s, x: s + F.char_length(x)).alias("chars"))

    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    held = "__f"
    while held in (c.lower() for c in docs.columns):
        held += "_"
    df = docs.withColumn(held, F.struct(
        _let(F.filter(F.split(t, WORD_SPACE), lambda w: w != ""), of_words).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))).alias("l"),
        _count_chars(t, r"[#*$%&|<>]").alias("symbols"), _count_chars(t, r"\p{Lu}+").alias("upper"),
        _count_chars(t, r"[0-9]+").alias("digits"), _count_chars(t, r"[!\"'(),.:;?]+").alias("marks"),
        _count_chars(t, r"!+").alias("bangs")))
    f = F.col(held)
    n_words, word_chars = f["w"]["h"]["n"], f["w"]["chars"]
    words, chars = F.greatest(n_words, F.lit(1)), F.greatest(word_chars, F.lit(1))
    n_lines = F.greatest(f["l"]["n"], F.lit(1))
    dups = (f["l"]["n"] - f["l"]["distinct"]).cast("long")
    return df.withColumns({
        "n_words": n_words, "word_chars": word_chars, "n_symbols": f["symbols"], "n_dup_lines": dups,
        "n_repeat_words": f["w"]["h"]["repeated"],
        "symbol_ratio": f["symbols"] / words, "repeat_ratio": f["w"]["h"]["repeated"] / words,
        "dup_line_ratio": dups / n_lines, "word_length": word_chars / words, "upper_ratio": f["upper"] / chars,
        "digit_ratio": f["digits"] / chars, "mark_ratio": f["marks"] / chars, "bang_ratio": f["bangs"] / words,
        "distinct_ratio": f["w"]["h"]["distinct"] / words, "line_words": n_words / n_lines,
    }).drop(held)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gain of narrowing (p0, n0) to (p, n), for the class that the rule names."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn_rules(labelled: DataFrame, bad: str = "bad", figures: list[str] = FIGURES, key: str = "doc_id",
                max_rules: int = 8, max_tests: int = 3, least_precision: float = 0.75, least_rows: int = 5,
                bins: int = BINS) -> list[list[Test]]:
    """Ordered conjunctions that name rows with ``bad`` = 1; labelled rows have ``figures``, ``key`` and ``bad``."""
    rows = labelled.where(F.col(bad).isNotNull()).select(
        (F.col(bad) == 1).alias("bad"), *figures,
        (F.pmod(F.xxhash64(F.lit("prune"), F.col(key).cast("string")), F.lit(3)) == 0).alias("prune"))
    cuts = {}
    grid = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.when(F.col("bad") == b, F.col(f)), grid).alias(f"{f}_{int(b)}")
                       for f in figures for b in (True, False)]).first()
    for f in figures:
        both = sorted(set(found[f"{f}_1"] or []) | set(found[f"{f}_0"] or []))
        cuts[f] = [(a + b) / 2 for a, b in zip(both, both[1:])] + both[-1:]      # between seen values: margins
        cuts[f] = sorted(set(cuts[f]) | set(both))

    def bin_of(f: str) -> Column:
        values = F.array(*[F.lit(float(c)) for c in cuts[f]])
        return F.size(F.filter(values, lambda c: c < F.col(f)))

    usable = [f for f in figures if cuts[f]]
    if not usable:
        return []
    binned = written(rows.select("bad", "prune", *[bin_of(f).alias(f) for f in usable])
                     .groupBy("bad", "prune", *usable).agg(F.count("*").alias("n")), "rule-bins")

    def holds(tests: list[Test]) -> Column:
        out = F.lit(True)
        for t in tests:                      # value > cuts[i]  <=>  bin > i
            i = cuts[t.figure].index(t.threshold)
            out = out & (F.col(t.figure) > i if t.above else F.col(t.figure) <= i)
        return out

    def histogram(tests: list[Test], left: Column):
        wide = binned.where(left & holds(tests)).select(
            "bad", "n", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in usable])).alias("x"))
        got: dict[str, dict[int, list[int]]] = {f: {} for f in usable}
        for r in wide.groupBy("x.f", "x.b", "bad").agg(F.sum("n").alias("n")).collect():
            got[r["f"]].setdefault(r["b"], [0, 0])[0 if r["bad"] else 1] += r["n"]
        return got

    # Too few bad rows to judge by a third of them: all rows judge.
    few = (binned.where("bad and prune").agg(F.sum("n")).first()[0] or 0) < LEAST_JUDGES
    rules: list[list[Test]] = []
    covered = F.lit(False)
    while len(rules) < max_rules:
        left = ~covered if few else ~covered & ~F.col("prune")
        tests: list[Test] = []
        while len(tests) < max_tests:
            counts = histogram(tests, left)
            p0 = sum(v[0] for v in counts[usable[0]].values())
            n0 = sum(v[1] for v in counts[usable[0]].values())
            if p0 == 0 or n0 == 0:
                break
            best, best_gain, run = None, 0.0, {}
            for f in usable:
                p = n = 0
                for i in range(len(cuts[f])):
                    p, n = p + counts[f].get(i, [0, 0])[0], n + counts[f].get(i, [0, 0])[1]
                    for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        if a + b < least_rows:
                            continue
                        gain = _gain(a, b, p0, n0)
                        if gain > best_gain + 1e-9:
                            best_gain, run, best = gain, {(a, b): [i]}, (f, above)
                        elif best == (f, above) and (a, b) in run and abs(gain - best_gain) <= 1e-9:
                            run[(a, b)].append(i)     # cuts that part the rows alike: the middle one is taken
            if best is None:
                break
            same = next(iter(run.values()))
            tests.append(Test(best[0], best[1], cuts[best[0]][same[len(same) // 2]]))
        if not tests:
            break

        held = ~covered if few else ~covered & F.col("prune")
        sums = binned.where(held).agg(*[F.sum(F.when(holds(tests[:k]) & (F.col("bad") == b), F.col("n")).otherwise(0))
                                        .alias(f"x{k}_{int(b)}") for k in range(1, len(tests) + 1) for b in (True, False)]).first()

        def precision(k: int) -> float:
            p, n = sums[f"x{k}_1"] or 0, sums[f"x{k}_0"] or 0
            return (p + 1) / (p + n + 2)

        best_k = max(range(1, len(tests) + 1), key=lambda k: (precision(k), -k))
        if precision(best_k) < least_precision:
            break
        rules.append(tests[:best_k])
        covered = covered | holds(rules[-1])
    return rules


def rules_column(rules: list[list[Test]], default: bool = True) -> Column:
    """True where the row is kept: ordered conditions, first match decides."""
    if not rules:
        return F.lit(default)
    out = None
    for tests in rules:
        cond = tests[0].column()
        for t in tests[1:]:
            cond = cond & t.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return out.otherwise(F.lit(default))


def base_failed(least_words: int = 10, most_repeated: int = 20) -> Column:
    """Too few words, or more than ``most_repeated`` percent of them in repeated windows."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def learned_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> list[list[Test]]:
    """Rules from the documents that ``labels`` (key, quality) covers; quality 0 is bad.

    Rows that the base rule fails are not learned from: the list judges the others.
    """
    marked = labels.select(F.col(key), (1 - F.col("quality")).alias("bad")).where(f"bad is not null and `{key}` is not null")
    marked = marked.groupBy(key).agg(F.max("bad").alias("bad"))
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(marked, key)
    stats = written(text_statistics(rows).drop("text"), "rule-rows")
    return learn_rules(stats.where(~base_failed()), key=key)
