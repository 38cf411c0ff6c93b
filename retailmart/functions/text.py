"""Text expressions used by the cleaning and profiling jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_prefix(c: Column, prefix: str) -> Column:
    """Drop ``prefix`` where it is present; running it twice changes nothing more."""
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def after_first(c: Column, delim: str) -> Column:
    """Text behind the first ``delim``; the whole text when ``delim`` is absent."""
    at = F.instr(c, delim)
    return F.when(at > 0, F.substr(c, at + len(delim))).otherwise(c)


def after_last(c: Column, delim: str) -> Column:
    """Text behind the last ``delim``; the whole text when ``delim`` is absent."""
    return F.substring_index(c, delim, -1)


def visible_length(c: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(c))


def is_missing(c: Column, sentinels: Sequence[str], case_insensitive: bool = False) -> Column:
    """True for NULL and for placeholder texts.

    With ``case_insensitive`` letter case and trailing blanks are ignored, as
    under the usual collations of a database server.
    """
    if case_insensitive:
        found = F.lower(F.rtrim(c)).isin([s.lower().rstrip() for s in sentinels])
    else:
        found = c.isin(list(sentinels))
    return c.isNull() | found
