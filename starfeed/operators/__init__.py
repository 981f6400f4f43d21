from starfeed.operators.dims import DIMENSIONS, Dimension, build_dimension, new_dimension_rows
from starfeed.operators.facts import FACT_INPUTS, FactProfile, fact_orders, fact_profile, fact_ratings, inputs_after
from starfeed.operators.incremental import after_mark, distinct_keys, high_water_mark, new_rows, repeated_keys
from starfeed.operators.latest import latest_by_key
from starfeed.operators.skew import hot_keys, skew_join

__all__ = [
    "DIMENSIONS",
    "FACT_INPUTS",
    "Dimension",
    "FactProfile",
    "after_mark",
    "build_dimension",
    "distinct_keys",
    "fact_orders",
    "fact_profile",
    "fact_ratings",
    "high_water_mark",
    "hot_keys",
    "inputs_after",
    "latest_by_key",
    "new_dimension_rows",
    "new_rows",
    "repeated_keys",
    "skew_join",
]
