import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, empty, words
from pyspark.sql import functions as F
from tessera.llm import quality_rules as Q


def figures(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def got(spark, texts):
    rows = Q.text_statistics(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    return {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            for r in rows.collect()}


def test_figures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "\n\n", "a\na\n a\n\na", "x " * 5000, "é\u00a0b # * $ %&|<>", "\x0b\x0ca\x1cb"]
    for _ in range(300):
        n = rng.randrange(40)
        texts.append("".join(rng.choice("ab") + rng.choice(["", " ", "\n", "\t", "b "]) for _ in range(n * 3)))
        texts.append(" ".join(rng.choice("abc") for _ in range(n)))
    have = got(spark, texts)
    for i, t in enumerate(texts):
        assert have[i] == figures(t), t


def test_rules_find_bad_texts_and_leave_clean_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rules = Q.learned_rules(docs, labels.where(half))
    assert rules and all(1 <= len(r) <= 3 for r in rules)
    stats = Q.text_statistics(docs.join(labels.where(~half), "doc_id"))
    base = Q.base_failed()
    found = {(r["quality"], r["kept"]): r["count"] for r in stats.select(
        "quality", (~base & Q.rules_column(rules)).alias("kept"), base.alias("b")).where("not b or quality = 0")
        .groupBy("quality", "kept").count().collect()}
    assert found.get((0, True), 0) < 0.02 * found[0, False]
    assert found.get((1, False), 0) < 0.005 * found[1, True]


def test_the_list_is_ordered_conditionals(spark):
    rules = [[Q.Test("symbol_ratio", True, 0.5)], [Q.Test("n_words", False, 3.0), Q.Test("upper_ratio", True, 0.9)]]
    rows = spark.createDataFrame([(0.6, 9, 0.0), (0.1, 2, 1.0), (0.1, 2, 0.1), (None, None, None)],
                                 "symbol_ratio double, n_words long, upper_ratio double")
    assert [r[0] for r in rows.select(Q.rules_column(rules)).collect()] == [False, False, True, True]
    assert [r[0] for r in rows.select(Q.rules_column([])).collect()] == [True] * 4


def test_a_callers_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 7, 8, 9)], "doc_id long, text string, __f int, __f_ int, n int")
    row = Q.text_statistics(docs).first()
    assert (row["__f"], row["__f_"], row["n"], row["n_words"]) == (7, 8, 9, 2)


def test_awkward_and_empty_tables(spark):
    assert Q.text_statistics(awkward(spark)).count() == awkward(spark).count()
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.text_statistics(empty(spark)).count() == 0
    assert Q.learned_rules(awkward(spark), none) == []
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    assert Q.learned_rules(awkward(spark), one) == []


def test_main_path_has_no_python(spark):
    plan = Q.text_statistics(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
