"""Payment flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the payment method that marks a crypto order.
CRYPTO_METHOD = "CRIPTO"


def paid_in_crypto(method: str) -> Column:
    """True for the crypto method; an unknown (NULL) method counts as false."""
    return F.coalesce(F.col(method) == F.lit(CRYPTO_METHOD), F.lit(False))
