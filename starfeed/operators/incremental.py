"""Loading only what is not stored yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F

from starfeed.functions.widening import alike, key_text
from starfeed.operators.skew import Hot, hot_keys, skew_join
from starfeed.workspace import written

# Most keys ever broadcast, after counting them, and the text they may hold on average:
# about 50 MB of numbers or 150 MB of text on each executor.
BROADCAST_KEYS = 2_000_000
BROADCAST_TEXT = 40
# Rows from which on keys are compared before whole rows are: a second pass over fewer is not worth it.
PROBE_ROWS = 250_000


@dataclass(frozen=True)
class KeySet:
    """Distinct keys that were counted: ``few`` says whether they may be broadcast, and
    ``low``, ``high`` and ``nulls`` what the first key column spans."""

    keys: DataFrame
    few: bool
    low: Any
    high: Any
    nulls: bool

    def cut(self, df: DataFrame, hot: Hot | None = None) -> DataFrame:
        """The rows of ``df`` whose key is in the set; a NULL key matches a NULL key.

        Rows outside the span go first. The scan can skip whole row groups by it, and where
        keys grow over time that alone leaves little. Few keys are then broadcast, and
        more of them joined by shuffle, with the rows of ``hot`` keys split.
        """
        columns = self.keys.columns
        first = F.col(columns[0])
        inside = first.between(F.lit(self.low), F.lit(self.high)) if self.low is not None else F.lit(False)
        near = df.where(inside | first.isNull() if self.nulls else inside)
        if self.few:
            return skew_join(near, F.broadcast(self.keys), columns, "left_semi", null_safe=True)
        if hot is None and len(columns) == 1:
            hot = hot_keys(near, columns)[columns[0]]
        return skew_join(near, self.keys, columns, "left_semi", left_hot=hot, null_safe=True)


def key_set(keys: DataFrame, limit: int) -> KeySet:
    """Count a table of distinct keys. Few are at most ``limit`` rows and, for text keys,
    ``limit * BROADCAST_TEXT`` bytes."""
    return _measured(keys, limit, keys.agg(*_measures(keys)).first().asDict())


def written_with_keys(df: DataFrame, label: str, key: str, limit: int) -> tuple[DataFrame, KeySet]:
    """``df`` written, and the set of its keys, counted while it is written. Repeated keys count as often as they
    occur, so a set that is called few is few indeed."""
    seen = Observation()
    kept = written(df.observe(seen, *_measures(df.select(key))), label)
    return kept, _measured(distinct_keys(kept, key), limit, seen.get)


def _measures(keys: DataFrame) -> list[Column]:
    text = [c for c, kind in keys.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))
    first = F.col(keys.columns[0])
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
        F.min(first).alias("low"),
        F.max(first).alias("high"),
        F.count_if(first.isNull()).alias("nulls"),
    ]


def _measured(keys: DataFrame, limit: int, row: Mapping[str, Any]) -> KeySet:
    few = row["n"] <= limit and row["bytes"] <= limit * BROADCAST_TEXT
    return KeySet(keys, few, row["low"], row["high"], row["nulls"] > 0)


def high_water_mark(stored: DataFrame | None, column: str, partition: str | None = None) -> Any:
    """The largest ``column`` in the stored table; None if the table is missing or empty.

    Name ``partition``, a partition column that grows with ``column``, to read only
    the newest partition. Rows without any date are an error: taking them for "no
    mark" would load everything again.
    """
    if stored is None:
        return None
    if partition is not None:
        newest = stored.agg(F.max(partition)).first()[0]
        if newest is not None:
            stored = stored.where(F.col(partition) == F.lit(newest))
    row = stored.agg(F.max(column).alias("mark"), F.count(F.lit(1)).alias("n")).first()
    if row["n"] and row["mark"] is None:
        raise ValueError(f"stored rows have no {column}: cannot tell what is loaded")
    return row["mark"]


def after_mark(df: DataFrame, column: str, mark: Any) -> DataFrame:
    """Rows strictly later than the mark; all rows when there is none."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark))


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return df.select(*([keys] if isinstance(keys, str) else keys)).distinct()


def in_one_type(frames: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """The frames with the column of each, in order, in one type: as it is where that can be compared, else as text (see ``key_text``)."""
    kinds = [df.schema[c].dataType for df, c in zip(frames, columns)]
    if all(alike(kinds[0], kind) for kind in kinds):
        return list(frames)
    return [df.withColumn(c, key_text(F.col(f"`{c}`"), kind)) for df, c, kind in zip(frames, columns, kinds)]


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row, ``repetidas``: how many keys occur in more than one row. Whole-row
    de-duplication and the incremental load both leave such rows in place."""
    per_key = df.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count_if(F.col("_n") > 1).alias("repetidas"))


def new_rows(
    df: DataFrame,
    stored: DataFrame | None,
    keys: str | Sequence[str],
    null_safe: bool = True,
    hot: Hot | None = None,
    probe: int | None = None,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Rows of ``df`` whose key is not among the stored ones; column order is kept.

    Insert-only: a stored key with changed attributes is not new. With ``null_safe``
    a stored NULL key counts as seen; without it, rows with a NULL key are new each time.

    A key whose type is another one than when it was stored is compared as text.

    By default one anti-join, which shuffles the whole rows, those of ``hot`` keys split.
    With ``probe`` the keys alone are compared first, and ``df`` is cut to the unseen ones
    (see ``KeySet.cut``): where it is read, if at most that many are unseen, the usual daily case.
    That takes a second pass over the keys, which a table below ``probe_rows`` rows is not worth.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if stored is None:
        return df
    plain = [alike(df.schema[k].dataType, stored.schema[k].dataType) for k in keys]
    if not all(plain):
        texts = {f"_key_{i}": k for i, k in enumerate(keys)}
        df, stored = (x.withColumns({t: key_text(F.col(f"`{k}`"), x.schema[k].dataType) for t, k in texts.items()}) for x in (df, stored))
        return new_rows(df, stored, list(texts), null_safe, None, probe, probe_rows).drop(*texts)
    known = distinct_keys(stored, keys)
    if probe is not None and df.count() >= probe_rows:
        unseen = written(
            skew_join(distinct_keys(df, keys), known, keys, "left_anti", null_safe=null_safe), "unseen-keys"
        )
        return key_set(unseen, probe).cut(df, hot)
    return skew_join(df, known, keys, "left_anti", left_hot=hot, null_safe=null_safe)
