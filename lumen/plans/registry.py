"""Registry of named queries: a Spark plan and (where SQL can say it) the
equivalent oracle SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def spark_rounding(sql: str) -> str:
    """Rewrite every ``round(x, k)`` of the oracle SQL to Spark's rounding.

    Spark rounds a double HALF_UP on its shortest decimal form (2248.075 →
    2248.08, although the stored binary value is 2248.07499…); DuckDB rounds
    the binary value.  Going through the text form and an exact decimal gives
    Spark's answer in DuckDB.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, -1
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = spark_rounding(sql[j + 6:comma])
        scale = sql[comma + 1:k].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(CAST(CAST(({inner}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 18)), {scale}) "
                   f"AS DOUBLE)")
        i = k + 1


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = spark_rounding(sql)
        return fn
    return deco


def load_all() -> None:
    from lumen.plans import q_basic, q_charts, q_quality, q_windows  # noqa: F401
