"""The query registry shared by the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def positive_zero_rounding(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``.

    DuckDB's ``round`` can return -0.0 for tiny negative inputs, while Spark's ``round``
    (decimal based) never does; adding 0.0 turns -0.0 into 0.0 and leaves other values
    unchanged.
    """
    out, i, n = [], 0, len(sql)
    while i < n:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                break
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < n:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounding(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1
    return "".join(out)


def register(key: str, oracle: str | None = None):
    """Register ``fn`` under ``key``; ``oracle`` is DuckDB SQL over the stored tables."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = positive_zero_rounding(oracle.strip())
        return fn
    return deco
