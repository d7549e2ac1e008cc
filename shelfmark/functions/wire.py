"""Expressions for what goes over the wire: references, times, lists, answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Answers to an order report that mean "ask again". Every 5xx and 0 (no
# answer at all) mean the same.
RETRY_CODES = (401, 408, 409, 423, 425, 429)


def order_ref(install_id: Column, order_id: Column) -> Column:
    """A reference that is stable for one shop and hides the order id."""
    return F.sha2(F.concat(install_id, F.lit("|order|"), order_id.cast("string")), 256)


def wire_timestamp(stored: Column) -> Column:
    """``2026-08-10 14:03:11`` to ``2026-08-10T14:03:11Z`` by moving text, without a
    clock or a timezone. Null when the stored text does not read as a timestamp."""
    pattern = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[ T]([0-9]{2}:[0-9]{2}:[0-9]{2})"
    text = F.trim(stored)
    return F.when(
        text.rlike(pattern),
        F.concat(F.regexp_extract(text, pattern, 1), F.lit("T"), F.regexp_extract(text, pattern, 2), F.lit("Z")),
    )


def version_ms(moment: Column) -> Column:
    """The version of a change: its own time in epoch milliseconds, not the clock's."""
    return F.unix_millis(moment.cast("timestamp"))


def join_ids(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda item: item.cast("string")), ",")


def split_ids(text: Column) -> Column:
    """Back to a list; blanks and zero ids fall out."""
    return F.filter(F.split(text, ","), lambda part: ~part.isin("", "0"))


def is_retry(status: Column) -> Column:
    return (status == 0) | (status >= 500) | status.isin(*RETRY_CODES)


def classify(status: Column) -> Column:
    """``done`` (accepted), ``retry`` (ask again) or ``dropped`` (refused on its merits)."""
    return F.when(status.between(200, 299), "done").when(is_retry(status), "retry").otherwise("dropped")
