from starfeed.streaming.feeds import LOCATIONS, STATUSES, Feed, await_feeds, parse_messages, run_feeds, start_feed
from starfeed.streaming.logs import JdbcLog, ParquetLog
from starfeed.streaming.state import JdbcState, LatestState

__all__ = [
    "LOCATIONS",
    "STATUSES",
    "Feed",
    "JdbcLog",
    "JdbcState",
    "LatestState",
    "ParquetLog",
    "await_feeds",
    "parse_messages",
    "run_feeds",
    "start_feed",
]
