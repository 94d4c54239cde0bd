import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, empty
from tessera.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_ids_equal_the_reference_library(text):
    bpe = packing.byte_bpe(PATH)
    assert bpe.ids(text) == bpe.exact.encode(text, add_special_tokens=False).ids


def test_special_string_gets_its_id():
    bpe = packing.byte_bpe(PATH)
    text = "a<|endoftext|>b"
    assert 50256 in bpe.ids(text) and bpe.ids(text) == bpe.exact.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_tournament_tree_is_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes), 50)
    free, want = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        j = next((j for j, f in enumerate(free) if f >= sizes[i]), len(free))
        if j == len(free):
            free.append(50)
        want[i] = (j, 50 - free[j])
        free[j] -= sizes[i]
    assert want == list(zip(bins.tolist(), offsets.tolist()))


@pytest.mark.parametrize("group_size", [3, 8192])
def test_round_trip(spark, group_size):
    docs = awkward(spark)
    packed = packing.pack(packing.tokenized_pieces(docs, PATH, with_ids=True), group_size=group_size)
    rows = packed.collect()
    bpe = packing.byte_bpe(PATH)
    want = sorted((str(r["doc_id"]), tuple(bpe.ids(r["text"] or "") + [1])) for r in docs.collect())
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    # Every id of every row is in exactly one piece.
    counts = sum(r["length"] for r in rows)
    assert counts == sum(len(ids) for _, ids in want)
    by = {}
    for r in rows:
        by.setdefault((str(r["doc_id"]), r["doc_tokens"]), {}).setdefault(r["start"], []).append(tuple(r["ids"]))
    for key, ids in want:
        got = ()
        while len(got) < len(ids):
            options = by[key, len(ids)][len(got)]
            piece = next(p for p in options if ids[len(got):len(got) + len(p)] == p)
            got += piece
        assert got == ids


def test_sequences_are_padded_except_at_powers_of_two(spark):
    rows = spark.createDataFrame([(1, 0, [5, 6, 7, 8], 4, 0), (2, 0, [9], 1, 0), (3, 0, [4, 4], 2, 1)],
                                 "sequence_id long, start long, ids array<long>, length long, offset long")
    rows = rows.union(spark.createDataFrame([(3, 0, [3], 1, 0)], rows.schema))
    got = {r["sequence_id"]: r["ids"] for r in packing.sequences(rows, capacity=16).collect()}
    assert got == {1: [5, 6, 7, 8], 2: [9], 3: [3, 4, 4] + [1] * 13}


def test_little_padding_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(packing.tokenized_pieces(docs, PATH)).collect()
    assert sum(r["length"] for r in rows) / (len({r["sequence_id"] for r in rows}) * packing.CAPACITY) > 0.97
    assert packing.pack(packing.tokenized_pieces(empty(spark), PATH)).count() == 0
