import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import words
from tessera.llm import scratch as S


def pieces(texts, limit=S.STEP_BYTES):
    return list(S.text_steps(pa.array(texts, pa.string()), limit))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x1c漢", max_size=12)), max_size=8), st.integers(1, 12))
def test_steps_cover_all_rows_and_words(texts, limit):
    seen, counts = [], []
    for lo, hi, data, offsets in pieces(texts, limit):
        seen += range(lo, hi)
        assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])] == [t or "" for t in texts[lo:hi]]
        starts, ends, first = S.word_spans(data, offsets)
        counts += np.diff(first).tolist()
        got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
        assert got == [w for t in texts[lo:hi] for w in words(t)]
    assert seen == list(range(len(texts))) and counts == [len(words(t)) for t in texts]


def test_hashes_depend_on_the_words_alone():
    (_, _, data, offsets), = pieces(["x ab y", "ab", None, "zz ab ab", ""])
    h, first = S.word_hashes(data, offsets)
    assert first.tolist() == [0, 3, 4, 4, 7, 7] and len({int(x) for x in (h[1], h[3], h[5], h[6])}) == 1
    assert len(set(h.tolist())) == 4


def test_shingles_of_short_and_long_texts():
    (_, _, data, offsets), = pieces(["a b c d e f", "a b c d e", "a b", "", "a b c d e f"])
    h, at = S.shingle_hashes(*S.word_hashes(data, offsets), 5)
    assert np.diff(at).tolist() == [2, 1, 1, 0, 2]
    assert h[0] == h[2] and (h[4:6] == h[:2]).all() and len(set(h.tolist())) == 3


def test_tables_go_to_the_shared_folder_and_can_be_dropped(spark):
    df = S.written(spark.range(5), "probe")
    base = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    folder = df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert folder.startswith(base) and df.count() == 5
    S.dropped(df)
    assert not os.path.exists(folder)


def test_executors_need_not_find_the_package_by_themselves(tmp_path):
    """A driver that imports the package from elsewhere, in another working folder."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            ".config('spark.checkpoint.dir', %r).getOrCreate()\n"
            "from tessera.llm import suffix_dedup\n"
            "df = s.createDataFrame([(1, 'x' * 300), (2, 'y')], 'doc_id long, text string')\n"
            "print('spans', sorted(len(r['spans']) for r in suffix_dedup.repeated_spans(df).collect()))\n" % (repo, str(tmp_path / "c")))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "spans [0, 1]" in out.stdout, out.stderr[-2000:]
