"""Joins that stay balanced when single keys hold a large part of the rows.

``hot_keys`` finds such keys in one pass, and ``skew_join`` spreads their rows
over several slots. The rows of all other keys join as usual. AQE's own
skew join stays on below this; it cannot split a side that shares its stage with
another join, nor the right side of an outer join, which is where this is needed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

Hot = Mapping[Any, int]  # key -> number of slots its rows are spread over


MIN_ROWS = 250_000  # so many rows of one key any task takes in its stride


def hot_keys(
    df: DataFrame,
    columns: Sequence[str],
    share: float | None = None,
    min_rows: int = MIN_ROWS,
    rows: int | None = None,
) -> dict[str, dict[Any, int]]:
    """Per column, the keys that hold more than ``share`` of the rows and more than ``min_rows``, each with the
    number of slots that brings its rows down to about that. The usual share
    is four times what a shuffle task gets on average, 2 % at most.

    Each task keeps a sketch whose size follows the share, so nothing is shuffled by key, and at
    most ``1/share`` keys reach the driver. Keys well above the share are always
    found; the result only steers how rows are spread, never which rows join.
    No sketch is made where no key can have that many rows, by the count or by ``rows``.
    """
    total = df.count() if rows is None else rows
    if share is None:
        share = min(0.02, 4 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    worth = max(total * share, min_rows)
    if total <= worth or not columns:
        return {c: {} for c in columns}
    most = math.ceil(total / worth)
    sketches = [F.expr(f"approx_top_k(`{c}`, {most}, {20 * most})").alias(c) for c in columns]
    found = df.agg(*sketches).first()
    return {c: {e["item"]: math.ceil(e["count"] / worth) for e in found[c] if e["count"] > worth} for c in columns}


def _match(left: str, right: str, null_safe: bool) -> Column:
    return F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str = "inner",
    left_hot: Hot | None = None,
    right_hot: Hot | None = None,
    null_safe: bool = False,
    left_tag: str | None = None,
    right_tag: str | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` for inner, left, left_semi and left_anti joins,
    with the columns of ``left`` first and in their order.

    Hot keys refer to the first key column. The rows of a key in ``left_hot`` are
    spread over slots by a hash of the whole row, and the matching right rows are
    copied into each slot; ``right_hot`` does the same with the sides exchanged and
    applies to inner and left joins only. A key in ``right_hot`` must occur on the right.

    Rows are spread by content, so a recomputed task puts them where they were.
    Whole-row copies then share a slot. Where they can be many, name a tag: a number
    column that differs between the rows and is itself the same when recomputed.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not cover {how!r} joins")
    left_hot, right_hot = dict(left_hot or {}), dict(right_hot or {})
    if how not in ("inner", "left"):
        right_hot = {}
    if not null_safe:
        right_hot.pop(None, None)  # a NULL key on the right matches nothing
        if how in ("inner", "left_semi"):
            left_hot.pop(None, None)  # nor does one on the left, and it is dropped before any shuffle
    columns = left.columns
    extra = [c for c in right.columns if c not in keys] if how in ("inner", "left") else []
    on = [_match(k, f"_r_{k}", null_safe) for k in keys]

    if left_hot or right_hot:
        slots = left.sparkSession.createDataFrame(
            [(k, left_hot.get(k, 1), right_hot.get(k, 1)) for k in {**left_hot, **right_hot}],
            T.StructType(
                [
                    T.StructField("_hot", left.schema[keys[0]].dataType),
                    T.StructField("_of_left", T.IntegerType()),
                    T.StructField("_of_right", T.IntegerType()),
                ]
            ),
        )
        null_hot = None in left_hot or None in right_hot
        left, right = (_with_slots(df, slots, keys[0], null_hot) for df in (left, right))
        if left_hot:
            left = left.withColumn("_i", _own_slot(columns, left_tag, "_of_left"))
            right = right.withColumn("_r_i", _all_slots("_of_left"))
            on.append(F.col("_i") == F.col("_r_i"))
        if right_hot:
            right = right.withColumn("_r_j", _own_slot([*keys, *extra], right_tag, "_of_right"))
            left = left.withColumn("_j", _all_slots("_of_right"))
            on.append(F.col("_j") == F.col("_r_j"))

    slot_columns = [c for c in ("_r_i", "_r_j") if c in right.columns]
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *slot_columns, *extra)
    if right_hot and how == "left":
        right = right.withColumn("_hit", F.lit(True))
    joined = left.join(right, on, how)
    if right_hot and how == "left":
        # a left row was copied into each slot of a key that has matches: slots without one are no result
        joined = joined.where(F.col("_hit") | (F.col("_of_right") == 1))
    return joined.select(*columns, *extra)


def _with_slots(df: DataFrame, slots: DataFrame, key: str, null_hot: bool) -> DataFrame:
    # at most 1/share rows per side, collected by hot_keys: safe to broadcast
    same = df[key].eqNullSafe(slots["_hot"]) if null_hot else df[key] == slots["_hot"]
    tagged = df.join(F.broadcast(slots), same, "left").drop("_hot")
    return tagged.fillna(1, ["_of_left", "_of_right"])


def _own_slot(columns: Sequence[str], tag: str | None, count: str) -> Column:
    number = F.col(tag) if tag else F.xxhash64(*columns)
    return F.when(F.col(count) == 1, 0).otherwise(F.pmod(number, F.col(count))).cast("int")


def _all_slots(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(count) - 1))
