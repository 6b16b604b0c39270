"""What several of the text operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

# A broadcast needs a counted side of at most this many rows of a few dozen
# bytes each; larger sides are joined by shuffle.
BROADCAST_ROWS = 200_000

# Words of letters, digits and everything beyond ASCII (after lower-casing A-Z).
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERM_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_TERM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the quicker function."""
    plain = F.length(text) == F.octet_length(text)
    table = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(table)


def words(text: Column, gap: str) -> Column:
    """The non-empty pieces between matches of ``gap``; null text has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), gap, -1)
    return F.filter(pieces, lambda w: w != "")


def text_key(text: Column) -> Column:
    """Together with doc_id this names a row: rows that agree in both are one
    document, whatever its copies."""
    return F.xxhash64(text)


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if, counted, the table is small; else the plain table.

    For stored tables of short rows: the count reads only their footers.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def comma_joined(items: Column) -> Column:
    return F.array_join(items, ",")
