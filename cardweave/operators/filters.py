"""Publishing predicates, composed with AND."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardweave import schemas as S


def is_ptlfx() -> Column:
    return F.coalesce(F.col("record_type") == S.PUBLISHED_RECORD_TYPE, F.lit(False))


def is_actionable() -> Column:
    return F.coalesce(F.col("message_type").isin(S.ACTIONABLE_TYPES), F.lit(False))


def all_of(predicates: Sequence[Column | None] | None) -> Column:
    """AND of the predicates, never null.

    An empty list is true; a missing list, a missing predicate and a null outcome are false.
    """
    if predicates is None:
        return F.lit(False)
    tests = [F.lit(False) if p is None else F.coalesce(p, F.lit(False)) for p in predicates]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def filter_publishable(messages: DataFrame, predicates: Sequence[Column | None] | None = ()) -> DataFrame:
    """Keep the published record type and the actionable message types.

    ``predicates`` narrow the choice further.
    """
    extra = all_of(predicates)
    return messages.filter(all_of([is_ptlfx(), is_actionable()]) & extra)
