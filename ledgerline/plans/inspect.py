"""Physical-plan inspection used by tests and the bench."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Operators a mart plan must never contain.
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def operators(df: DataFrame) -> list[str]:
    """Physical operator names in the (pre-AQE) plan, e.g. 'Exchange'."""
    text = plan_text(df, "formatted")
    head = text.split("\n\n")[0]
    return re.findall(r"[+\-:\s]*([A-Z][A-Za-z]+)", head)


def forbidden_operators(df: DataFrame) -> list[str]:
    text = plan_text(df, "formatted")
    return [op for op in FORBIDDEN if op in text]


def count_exchanges(df: DataFrame) -> int:
    return sum(1 for op in operators(df) if op == "Exchange")
