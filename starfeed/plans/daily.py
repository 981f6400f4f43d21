"""The daily load: sixteen dimensions, then the two facts."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame

from starfeed.operators.dims import DIMENSIONS, dimension_rows, whole_rows_once
from starfeed.operators.facts import fact_orders, fact_profile, inputs_after, small_dimensions
from starfeed.operators.incremental import BROADCAST_KEYS, PROBE_ROWS, new_rows
from starfeed.operators.skew import hot_keys
from starfeed.plans.load_plan import LOAD_PLAN, ORDER_FACT, ORDER_FACT_DAY, ORDER_FACT_PAIR, RATING_FACT, LoadStep
from starfeed.sinks import JdbcWarehouse, ParquetWarehouse
from starfeed.workspace import written

Warehouse = ParquetWarehouse | JdbcWarehouse


def facts_after(
    inputs: Mapping[str, DataFrame], mark: Any, probe: int, dimension_probe: int = BROADCAST_KEYS, **limits: Any
) -> DataFrame:
    """The order facts dated after ``mark``. The dimensions are sized up while the large inputs are cut."""
    with ThreadPoolExecutor(1) as pool:
        small = pool.submit(small_dimensions, inputs, dimension_probe)
        part = inputs_after(inputs, mark, probe)
        return fact_orders(part, fact_profile(part, small=small.result(), **limits))


def new_order_facts(
    inputs: Mapping[str, DataFrame],
    warehouse: Warehouse,
    mark: Any,
    lookback_days: int = 0,
    probe: int = BROADCAST_KEYS,
) -> DataFrame:
    """The order facts to add after ``mark``.

    ``lookback_days`` reads that many days before the mark again and adds the (order, product) pairs
    that are not stored, such as late orders of a day that was loaded already. The narrow lines are
    compared with the stored pairs, and only lines of unseen pairs meet the other inputs.
    """
    if mark is None or not lookback_days:
        return facts_after(inputs, mark, probe)
    since = mark - timedelta(days=lookback_days)
    stored = warehouse.stored(ORDER_FACT, list(ORDER_FACT_PAIR), after=since)
    part = inputs_after(inputs, since, probe)
    hot = hot_keys(part["pedido_productos"], ["pedido_id"])["pedido_id"]
    lines = new_rows(part["pedido_productos"], stored, ORDER_FACT_PAIR, hot=hot)
    part = {**part, "pedido_productos": written(lines, "unseen-lines")}
    return fact_orders(part, fact_profile(part))


def run_daily(
    inputs: Mapping[str, DataFrame],
    warehouse: Warehouse,
    load_id: str,
    literal: bool = False,
    lookback_days: int = 0,
    probe: int = BROADCAST_KEYS,
    probe_rows: int = PROBE_ROWS,
    writers: int = 8,
) -> dict[str, int]:
    """Load all tables; returns the rows added to each.

    ``inputs`` are best tables read from files (see ``sources.land``). Running it again on
    the same inputs adds nothing, and a load that was cut off is as if it had not been begun. ``literal`` keeps the plain
    rules instead: wallets and the ratings dimension are appended whole each time,
    locations and sessions are keyed by driver alone, and rows with a NULL key are
    added each time.

    The dimensions do not depend on each other and are written ``writers`` at a
    time; the facts follow when all are there. ``load_id`` names the load, e.g. its date.
    ``probe`` and ``probe_rows`` are the limits of ``new_rows`` and ``inputs_after``.
    """
    warehouse.begin(load_id)
    mark = warehouse.mark(ORDER_FACT, ORDER_FACT_DAY)

    def load(step: LoadStep) -> int:
        name = "dim_ratings" if step.table == RATING_FACT.table else step.table
        keys = step.literal_keys if literal else step.keys
        rows = dimension_rows(name, inputs)
        if name == "dim_fecha":  # a few thousand dates, compared and counted below: the orders are read for them once
            rows = written(rows, "calendar")
        if keys:  # known keys go before duplicates do, so only new rows are shuffled whole
            rows = warehouse.unseen(step.table, rows, list(keys), load_id, not literal, probe, probe_rows)
        if name != "dim_fecha":
            wide = DIMENSIONS[name].wide
            rows = whole_rows_once(written(rows, "unseen-rows") if wide else rows, wide)
        return warehouse.append(step.table, rows, load_id)

    with ThreadPoolExecutor(writers) as pool:
        added = dict(zip([s.table for s in LOAD_PLAN], pool.map(load, LOAD_PLAN)))
    facts = new_order_facts(inputs, warehouse, mark, lookback_days, probe)
    added[ORDER_FACT] = warehouse.append(ORDER_FACT, facts, load_id)
    added[RATING_FACT.table] = load(RATING_FACT)
    warehouse.finish(load_id, added)
    return added
