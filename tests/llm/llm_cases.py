"""Shared fixtures of the text operators' tests: awkward documents and helpers."""
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, size=4000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    a, b = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, a), (2, a), (2, a), (3, a + " tail"), (4, None), (5, ""), (6, " \t\n "), (None, b), (None, None),
            (7, "one"), (8, "one"), (9, b + "\n" + b), (10, "x " * 30000), (11, "éa ñ\u00a0b 漢字 " * 50), (12, a), (1, b)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, node int, "
              "k int, d int, t string, rid int, h int, row string, n_lines string, n_removed int, gone int, label int, "
              "start string, length int, offset int, spans int, kept int, `__text` int, `__key` int, m int")
    n = len(schema.split(",")) - 5
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None, None if t is None else len(t), *[None] * n)
                                  for i, t in rows], schema)


def empty(spark):
    return awkward(spark).limit(0)
