"""Current state out of a log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starfeed.workspace import written


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last by the ``order`` columns, NULL before all, which should break all ties; of rows that they do not tell apart any one stays.

    Only the key and the order columns are reduced: the largest of the first order column per key, among its rows the largest of
    the second, and so on, each by a hash aggregate that starts in every task, so a key with very many rows is never gathered in one
    place. The whole rows are then cut to these winners, where they are read if the winners are few enough to be broadcast, and are never sorted.
    """
    names = {c: f"_{i}" for i, c in enumerate([key, *order])}
    narrow = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    best, fixed = narrow.select("_0").distinct(), ["_0"]
    for column in list(names.values())[1:]:
        rows = narrow if len(fixed) == 1 else narrow.join(_renamed(best, fixed), _same(fixed), "left_semi")
        best = rows.groupBy(*fixed).agg(F.max(column).alias(column))
        fixed.append(column)
    best = written(best, "last")
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"_w{n}")) for c, n in names.items()]
    won = df.join(_renamed(best, fixed), on, "left_semi")
    first = F.expr(f"row_number() over (partition by `{key}` order by `{key}`)")  # of copies
    return won.withColumn("_n", first).where("_n = 1").select(*[F.col(f"`{c}`") for c in df.columns])


def last_of_batch(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The same for narrow rows, such as messages, from a source that should be read once: one aggregate, which sorts and reduces
    whole rows in each task before it shuffles those that are left."""
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order])).alias("_last")
    return df.groupBy(key).agg(last).select(*[F.col(f"`{c}`") if c == key else F.col(f"_last.`{c}`").alias(c) for c in df.columns])


def _renamed(best: DataFrame, columns: Sequence[str]) -> DataFrame:
    return best.select(*[F.col(c).alias(f"_w{c}") for c in columns])


def _same(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in columns]
