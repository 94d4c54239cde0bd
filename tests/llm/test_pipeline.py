import re
from collections import Counter

import corpus_pipeline as P
import public_tokenizers
import pytest
from llm_cases import awkward, empty, words
from test_decontamination import exhaustive
from test_line_dedup import plain
from test_ngram_join import brute
from tessera.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(P.written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]
    assert P.ORACLE_SQL is None


def test_all_but_the_last_return_the_columns_of_documents(steps):
    for df in steps[:-1]:
        assert df.schema.simpleString() == steps[0].schema.simpleString()


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = rows(steps[0]), rows(steps[1])
    assert all(after[d] == before[d] for d in after)
    assert not [d for d in set(before) - set(after) if labels.get(d) == 0]


def test_line_dedup_equals_brute_force(steps):
    before, after = rows(steps[1]), rows(steps[2])
    want = plain([(d, r["text"]) for d, r in before.items()])
    want = {d: t for d, (n, gone, t) in want.items() if not gone or gone < n}
    assert {d: r["text"] for d, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for d, r in after.items() if r["text"] != before[d]["text"])


def test_one_document_of_each_class_stays(steps):
    before, after = rows(steps[2]), rows(steps[3])
    classes = brute([(d, r["text"]) for d, r in sorted(before.items())])
    assert set(after) == {c for _, c, _, _ in classes} and all(after[d] == before[d] for d in after)


def test_leaks_go(spark, steps):
    before, after = rows(steps[3]), rows(steps[4])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in exhaustive([(d, r["text"]) for d, r in before.items()], items)}
    assert set(before) - set(after) == leaks


def test_packing_holds_every_id_once(steps):
    bpe = packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(bpe.ids(r["text"])) + 1 for d, r in rows(steps[4]).items()}
    got = Counter()
    for r in steps[5].collect():
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_run_gives_the_last_stage(spark, steps):
    got = P.run(spark, SF)
    assert sorted(map(str, got.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(str, steps[-1].select("doc_id", "start", "length", "ids_crc32").collect()))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_awkward_and_empty_documents(spark, name, stage):
    docs = awkward(spark)
    for some in (docs, empty(spark), docs.where("text is null"), docs.limit(1)):
        out = stage(spark, some, SF)
        if name != "packing":
            assert out.columns == some.columns and out.count() <= some.count()
        else:
            assert {str(r["doc_id"]) for r in out.collect()} == {str(r["doc_id"]) for r in some.collect()}


def test_a_document_that_was_empty_stays_and_an_emptied_one_goes(spark):
    line = "a line of ten words that two of the documents share\nand one more line so that the run is longer"
    docs = spark.createDataFrame([(1, line), (2, line), (3, ""), (4, None), (5, "x\n" + line)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    got = rows(P.cut_repeated_lines(spark, docs, SF))
    assert {d: r["text"] for d, r in got.items()} == {1: line, 3: "", 4: None, 5: "x"} and got[5]["n_chars"] == 1
    assert re.match("a line", got[1]["text"]) and len(words(got[1]["text"])) > 10
