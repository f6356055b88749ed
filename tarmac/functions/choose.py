"""Ordered choice between rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first rule whose condition is true; a NULL condition does not match."""
    (holds, value), *others = rules
    chain = F.when(holds, value)
    for holds, value in others:
        chain = chain.when(holds, value)
    return chain.otherwise(otherwise)
