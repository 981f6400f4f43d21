from starfeed.sources.catalog import SOURCES, Source, land, load_sources, source_path
from starfeed.sources.csv import misfits, read_csv
from starfeed.sources.jdbc import Database
from starfeed.sources.kafka import read_messages

__all__ = ["SOURCES", "Database", "Source", "land", "load_sources", "misfits", "read_csv", "read_messages", "source_path"]
