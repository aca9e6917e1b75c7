"""String column builders: topics, channels, instruments, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.functions.time import col

# Topic prefixes of the two exchange feeds.
RAW_PREFIX_FIRST = "raw.htx."
RAW_PREFIX_SECOND = "raw.alor."


def topic_name(ch, prefix: str = RAW_PREFIX_FIRST) -> Column:
    """Raw topic for a channel: the prefix is added only once."""
    c = col(ch)
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def kind_topic(ticket, kind, prefix: str = RAW_PREFIX_SECOND) -> Column:
    """``raw.alor.<ticket>.<kind>`` topics of the second feed."""
    return F.concat(F.lit(prefix), col(ticket), F.lit("."), col(kind))


def split_instrument(symbol) -> list[Column]:
    """``exchange.group.code`` -> three columns."""
    parts = F.split(col(symbol), r"\.", 3)
    return [parts.getItem(0).alias("exchange"), parts.getItem(1).alias("board"), parts.getItem(2).alias("code")]


def channel_kind(ch) -> Column:
    """Kind of a market-data channel (lower-cased match on the channel name)."""
    c = F.lower(col(ch))
    return (F.when(c.contains(".kline."), F.lit("candles"))
            .when(c.contains(".depth."), F.lit("level2"))
            .when(c.endswith(".bbo"), F.lit("bid_ask")))


def channel_symbol(ch) -> Column:
    """``market.<symbol>.<rest>`` -> symbol."""
    return F.split(col(ch), r"\.").getItem(1)


def base_name(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def file_date(path) -> Column:
    """Date from a file name ``YYYY-MM-DD_<rest>``: text before the first
    underscore of the base name; null when it is not a date."""
    return F.try_to_date(F.substring_index(base_name(path), "_", 1), "yyyy-MM-dd") \
        if hasattr(F, "try_to_date") else F.to_date(F.substring_index(base_name(path), "_", 1))


def symbol_from_file(path) -> Column:
    """``<date>_<symbol>[_<kind>].csv[.zip]`` -> symbol."""
    return F.split(F.regexp_replace(base_name(path), r"\.csv(\.zip)?$", ""), "_").getItem(1)


def strip_zip(name) -> Column:
    """Drop a trailing ``.zip`` suffix (a suffix, not a character set)."""
    return F.regexp_replace(col(name), r"\.zip$", "")
