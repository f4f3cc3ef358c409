"""Row predicates. Each returns a Column, so that Catalyst can push it down."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_null(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def one_of(name: str, values: Iterable) -> Column:
    """Membership; NULL fails."""
    return F.col(name).isin(*values)


def less_than(left: str, right: str) -> Column:
    return F.col(left) < F.col(right)


def on_date(name: str, day: dt.date) -> Column:
    """Equality with a DATE literal: prunes where the column is a partition."""
    return F.col(name) == F.lit(day)


def in_days(name: str, first: dt.date, last: dt.date) -> Column:
    """Timestamp within whole days, both inclusive.

    A half-open range on the raw column, which a scan or a database index can
    serve; wrapping the column in ``date()`` would hide it from both.
    """
    return (F.col(name) >= F.lit(first)) & (
        F.col(name) < F.lit(last + dt.timedelta(days=1))
    )


def is_true(name: str) -> Column:
    """NULL counts as false."""
    return F.coalesce(F.col(name), F.lit(False))
