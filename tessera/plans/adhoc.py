"""Read-only ad hoc SQL over the curated views (T5, H8).

The caller's query runs in a *separate* session (``newSession``) that
knows only the curated views, with file-path tables switched off, wrapped
as a sub-query so that only one query (no DDL/DML/SET) parses; a ``;`` is left
to the parser, which takes it inside a literal. Before any action, the query
without its literals and comments is searched for JVM reflection, and the
analysed plan for script transforms. This guards against mistakes; it is not a security
boundary.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# What runs code or a process.
_CODE = re.compile(r"`?\b(reflect|try_reflect|java_method)\b`?\s*\(", re.I)
_PROCESS = "ScriptTransformation"
# String literals, then comments: neither holds code.
_LITERAL = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/", re.S)


class ReadOnlyViolation(ValueError):
    pass


def readonly_session(spark: SparkSession,
                     views: dict[str, Callable[[SparkSession], DataFrame]]) -> SparkSession:
    """A fresh session holding only ``views``.

    Temp views belong to one session, so each view is *built* in the new
    session by its builder (``session -> DataFrame``); views of the
    caller's session stay invisible.
    """
    s = spark.newSession()
    s.conf.set("spark.sql.runSQLOnFiles", "false")
    s.conf.set("spark.sql.debug.maxToStringFields", "100000")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    for name, build in views.items():
        build(s).createOrReplaceTempView(name)
    return s


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The text ``df.explain(mode)`` prints (parsed, analysed, optimised and
    physical plans for ``extended``)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def adhoc_readonly(session: SparkSession, query: str) -> DataFrame:
    """Run ``query`` read-only in ``session``; raises on writes or code."""
    q = query.strip().rstrip(";").strip()
    code = _CODE.search(_LITERAL.sub(" ", q))
    if code:
        raise ReadOnlyViolation(f"query uses {code.group(1)}")
    df = session.sql("SELECT * FROM (\n" + q + "\n) q")
    if _runs_process(df._jdf.queryExecution().analyzed()):
        raise ReadOnlyViolation("query uses a script transform")
    return df


def _runs_process(plan) -> bool:
    """Whether a node of the analysed plan, sub-queries' included, is a script transform."""
    if plan.nodeName() == _PROCESS:
        return True
    nodes = [plan.children(), plan.innerChildren(), plan.subqueries()]
    return any(_runs_process(n.apply(i)) for n in nodes for i in range(n.size()) if hasattr(n.apply(i), "nodeName"))
