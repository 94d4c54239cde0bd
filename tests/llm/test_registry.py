import inspect
import re

import __spark_entry__ as E
from tessera.llm import oracles, queries


def test_one_query_for_each_operator():
    names = [re.match(r"op(\d+)_", n).group(1) for n in queries.QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(oracles.ORACLES) <= set(E.oracle_sql())


def test_queries_are_thin_and_uncapped():
    for f in queries.QUERIES.values():
        source = inspect.getsource(f)
        assert not re.search(r"\.limit\(|\.sample\(|sampleBy|\.head\(|\.take\(", source)
