"""Run a query and its SQL side by side and compare them as unordered rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v).__name__ == "str"), v if v is not None else 0) for v in row)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as messages; an empty list means equal columns, types of value and rows."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    theirs = relation.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    order = sorted(names)
    ours = [tuple(r[c] for c in order) for r in spark_df.collect()]
    theirs = [tuple(r[names.index(c)] for c in order) for r in theirs]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    problems = []
    for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key), strict=True):
        for name, x, y in zip(order, a, b, strict=True):
            same = x == y and type(x) is type(y) if not isinstance(x, float) else (
                isinstance(y, float) and (x == y or (math.isnan(x) and math.isnan(y)))
            )
            if not same:
                problems.append(f"{name}: {x!r} != {y!r} in {a} / {b}")
        if len(problems) > 5:
            break
    return problems
