"""Run search by lists of conditions and an order, over the run-log tables.

A search is data: conditions ``Condition(kind, key, op, value)``, all of which must hold, and an order of
``Order(kind, key, ascending)``. The kinds are ``attribute`` (a column of ``runs``), ``metric`` (the
latest value of that key), ``param`` and ``tag``. Conditions on attributes become predicates that
reach the scan of ``runs``. Those on one other kind are settled together: one filter on the keys
asked for, cut to the runs that are left, and one aggregation per run, however many conditions there
are; so a search costs at most one semi join per kind. A comparison with a value that a
run does not have never holds, ``!=`` and ``not in`` included.

Text forms of such searches are not read: a search is built by a program, and Spark's own Column
expressions are at hand for what conditions cannot say.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.runlog import latest_metrics
from tabula.session import ensure_checkpoint_dir

KINDS = ("attribute", "metric", "param", "tag")
_COMPARE = {
    "=": lambda c, v: c == F.lit(v), "!=": lambda c, v: c != F.lit(v),
    "<": lambda c, v: c < F.lit(v), "<=": lambda c, v: c <= F.lit(v),
    ">": lambda c, v: c > F.lit(v), ">=": lambda c, v: c >= F.lit(v),
}
_TEXT = {
    "=": _COMPARE["="], "!=": _COMPARE["!="],
    "like": lambda c, v: c.like(v), "ilike": lambda c, v: c.ilike(v),
    "in": lambda c, v: c.isin(list(v)), "not in": lambda c, v: ~c.isin(list(v)),
}


class SearchError(ValueError):
    """A condition or an order that cannot be asked for."""


@dataclass(frozen=True)
class Condition:
    kind: str
    key: str
    op: str
    value: object


@dataclass(frozen=True)
class Order:
    kind: str
    key: str
    ascending: bool = True


def _holds(c: Column, cond: Condition, numeric: bool) -> Column:
    """The condition on a value column; checks that operator and value fit the column."""
    ops = _COMPARE if numeric else _TEXT
    if cond.op not in ops:
        raise SearchError(f"{cond.kind} {cond.key!r} takes {sorted(ops)}, not {cond.op!r}")
    given = list(cond.value) if cond.op in ("in", "not in") and not isinstance(cond.value, str) else [cond.value]
    wanted = (int, float) if numeric else str
    if not given or any(isinstance(v, bool) or not isinstance(v, wanted) for v in given):
        raise SearchError(f"{cond.kind} {cond.key!r} is compared with {'numbers' if numeric else 'text'}, not {cond.value!r}")
    return ops[cond.op](c, cond.value)


def by_run(df: DataFrame) -> DataFrame:
    """``df`` dealt by run id into as many partitions as the session's shuffles have, which are not merged."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run_id")


def _settled(df: DataFrame) -> DataFrame:
    """``df`` found once and kept in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return by_run(df.checkpoint())


def _attribute(runs: DataFrame, kind: str, key: str) -> T.DataType:
    if key not in runs.columns:
        raise SearchError(f"runs have no attribute {key!r}; they have {runs.columns}")
    return runs.schema[key].dataType


def _runs_with(out: DataFrame, rows: DataFrame, conditions: list[Condition], numeric: bool, latest: bool) -> DataFrame:
    """The rows of ``out`` whose run meets all conditions on the (run_id, key, value) ``rows``."""
    keys = sorted({c.key for c in conditions})
    asked = rows.where(F.col("key").isin(keys)).join(out.select("run_id"), "run_id", "left_semi")
    asked = latest_metrics(asked) if latest else asked
    marks = [
        F.max(F.coalesce((F.col("key") == F.lit(c.key)) & _holds(F.col("value"), c, numeric), F.lit(False))).alias(f"_{i}")
        for i, c in enumerate(conditions)
    ]
    met = reduce(lambda a, b: a & b, (F.col(f"_{i}") for i in range(len(conditions))))
    return out.join(asked.groupBy("run_id").agg(*marks).where(met).select("run_id"), "run_id", "left_semi")


def search(
    runs: DataFrame,
    conditions: Iterable[Condition] = (),
    *,
    metrics: DataFrame | None = None,
    params: DataFrame | None = None,
    tags: DataFrame | None = None,
    order_by: Iterable[Order] = (),
    limit: int | None = None,
) -> DataFrame:
    """Runs that meet all ``conditions``; with ``limit`` the first ones by ``order_by`` (runs without such a
    value last, then by run id), found by top-k and not by a full sort."""
    conditions, order_by = list(conditions), list(order_by)
    tables = {"metric": metrics, "param": params, "tag": tags}
    for asked in (*conditions, *order_by):
        if asked.kind not in KINDS:
            raise SearchError(f"there is no kind {asked.kind!r}; there are {KINDS}")
        if asked.kind == "attribute":
            _attribute(runs, asked.kind, asked.key)
        elif tables[asked.kind] is None:
            raise SearchError(f"{asked.kind} {asked.key!r} is asked for, but no {asked.kind}s are given")
    out = runs
    for c in (c for c in conditions if c.kind == "attribute"):
        out = out.where(_holds(F.col(c.key), c, isinstance(_attribute(runs, c.kind, c.key), T.NumericType)))
    steps = [("order", k) for k in ("metric", "param", "tag") if any(o.kind == k for o in order_by)]
    steps = [("where", k) for k in ("tag", "param", "metric") if any(c.kind == k for c in conditions)] + steps
    if steps:
        out = by_run(out)
    for i, (step, kind) in enumerate(steps):
        if step == "where":
            own = [c for c in conditions if c.kind == kind]
            out = _runs_with(out, tables[kind], own, kind == "metric", kind == "metric")
            out = _settled(out) if i + 1 < len(steps) else out
    if not order_by and limit is None:
        return out
    columns, orders, names = out.columns, [], {}
    for kind in ("metric", "param", "tag"):
        keys = sorted({o.key for o in order_by if o.kind == kind})
        if keys:
            rows = tables[kind].where(F.col("key").isin(keys)).join(out.select("run_id"), "run_id", "left_semi")
            rows = latest_metrics(rows) if kind == "metric" else rows
            names.update({(kind, k): f"_{kind}_{i}" for i, k in enumerate(keys)})
            wide = rows.groupBy("run_id").agg(
                *[F.max(F.when(F.col("key") == F.lit(k), F.col("value"))).alias(names[kind, k]) for k in keys]
            )
            out = out.join(wide, "run_id", "left")
    for o in order_by:
        c = F.col(o.key if o.kind == "attribute" else names[o.kind, o.key])
        orders.append(c.asc_nulls_last() if o.ascending else c.desc_nulls_last())
    out = out.orderBy(*orders, F.col("run_id"))
    return (out if limit is None else out.limit(limit)).select(*columns)
