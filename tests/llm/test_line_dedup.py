import random

import duckdb
from llm_cases import WORD, awkward, empty, sentence
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.oracles import LINE_DEDUP


def plain(rows, least=10):
    """Expected (n_lines, n_removed, text) per (key, text), by looking at every run of lines."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    ties = {}
    for k, t in docs:
        ties.setdefault(k, []).append(t)
    assert all(len(v) == 1 for k, v in ties.items()), "the brute force has no order for texts of one key"
    seen, out = set(), {}
    for k, t in docs:
        raw = (t or "").split("\n")
        at = [i for i, s in enumerate(raw) if WORD.search(s)]
        gone, own = set(), []
        for a in range(len(at)):
            size = 0
            for b in range(a, len(at)):
                size += len(WORD.findall(raw[at[b]]))
                if size >= least:
                    run = tuple(raw[at[j]] for j in range(a, b + 1))
                    own.append((a, b, run))
                    if size >= 40 * least:
                        break
        for a, b, run in own:
            if run in seen:
                gone |= set(range(a, b + 1))
            seen.add(run)
        lost = {at[j] for j in gone}
        out[k] = (len(at), len(gone), t if not gone else "\n".join(s for i, s in enumerate(raw) if i not in lost))
    return out


def rows_with_runs(seed, n=60):
    rng = random.Random(seed)
    lines = [sentence(rng, rng.choice([1, 2, 3, 4, 9, 10, 25]), 50) for _ in range(14)]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice(lines) if rng.random() < .7 else rng.choice(["", " ", sentence(rng, 6, 10 ** 6)])
                         for _ in range(rng.randrange(14)))
        rows.append((i, text))
    return rows + [(n, rows[3][1]), (n + 1, "a b\n" * 12), (n + 2, None), (n + 3, ""), (None, rows[4][1])]


def got(df):
    return {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in df.collect()}


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = rows_with_runs(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert got(dedup_lines(df)) == plain(rows)


def test_other_least_sizes(spark):
    rows = rows_with_runs(3, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 3, 17):
        assert got(dedup_lines(df, min_words=least)) == plain(rows, least)


def test_equals_sql(spark):
    import hashlib

    rows = [r for r in rows_with_runs(5) if r[0] is not None and r[1] is not None]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = {r[0]: r[1:] for r in con.execute(f"select doc_id, n_lines, n_removed, text_md5 from ({LINE_DEDUP})").fetchall()}
    have = got(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: (a, b, hashlib.md5(t.encode()).hexdigest()) for k, (a, b, t) in have.items()} == want


def test_awkward_rows_keep_their_columns(spark):
    docs = awkward(spark)
    out = dedup_lines(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()
    rows = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (4, None) in rows and (5, "") in rows and (7, "one") in rows and (12, "") in rows
    assert dedup_lines(empty(spark)).count() == 0


def test_main_path_has_no_python(spark):
    plan = dedup_lines(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
