"""JSON message bodies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def message_fields(value: str, schema: T.StructType) -> Column:
    """The JSON text or bytes in column ``value`` as a struct of ``schema``.

    Permissive: a body that is not JSON gives a struct of NULLs, one bad field
    gives NULL for that field alone, fields outside the schema are left out.
    """
    return F.from_json(F.col(value).cast("string"), schema)
