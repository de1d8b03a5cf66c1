"""Plan inspection: what the physical plan of a DataFrame does, for tests and
for checking a job before running it at scale."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it (no job is run)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the plan (broadcasts not counted)."""
    text = plan_text(df)
    head = text.split("\n\n\n", 1)[0]
    return len(re.findall(r"\bExchange\b", head)) - len(re.findall(r"BroadcastExchange", head))


def operators(df: DataFrame) -> set[str]:
    """Names of the operators in the physical plan."""
    head = plan_text(df).split("\n\n\n", 1)[0]
    return set(re.findall(r"^[\s:+*-]*([A-Z][A-Za-z ]*?)\s+\(\d+\)", head, re.M))


def has_python_or_rdd_scan(df: DataFrame) -> bool:
    """True when the plan leaves the JVM (Python UDFs, ``mapInPandas``) or
    scans an RDD."""
    text = plan_text(df)
    return bool(re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonMapInArrow|"
                          r"FlatMapGroupsInPandas|Scan ExistingRDD", text))
