from starfeed.sinks.jdbc import JdbcWarehouse
from starfeed.sinks.keys import KeyStore
from starfeed.sinks.parquet import ParquetWarehouse

__all__ = ["JdbcWarehouse", "KeyStore", "ParquetWarehouse"]
