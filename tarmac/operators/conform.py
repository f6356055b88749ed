"""Bring rows into the declared shape of a table: missing columns, defaults, casts, widths."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.choose import first_match
from tarmac.functions.time import timestamp_lit
from tarmac.schemas import NOW, Table


def ensure_columns(df: DataFrame, columns: dict[str, tuple[str, Any]]) -> DataFrame:
    """Add each absent column as (type, default); older rows get the default too. Present ones stay."""
    missing = {
        name: F.lit(default).cast(type_) for name, (type_, default) in columns.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def apply_defaults(df: DataFrame, table: Table, run_ts: dt.datetime) -> DataFrame:
    """Fill absent columns of ``table`` from its defaults. An explicit NULL is not replaced."""

    def value(default: Any) -> Column:
        return timestamp_lit(run_ts) if default is NOW else F.lit(default)

    missing = {
        name: value(default).cast(table[name].type)
        for name, default in table.defaults.items()
        if name not in df.columns
    }
    nullable = {
        c.name: F.lit(None).cast(c.type)
        for c in table.columns
        if c.name not in df.columns and c.name not in missing and not c.required
    }
    return df.withColumns({**missing, **nullable}) if missing or nullable else df


def assignment(df: DataFrame, table: Table, name: str) -> tuple[Column, list[tuple[Column, str]]]:
    """One column cast to its declared type, and what can be wrong with a value: (condition, text)."""
    column = table[name]
    source = F.col(name)
    # a decimal is rounded on assignment to an integer column, as databases do
    whole = column.type.lower() in ("int", "integer", "bigint", "long", "smallint", "tinyint")
    fractional = isinstance(df.schema[name].dataType, T.DecimalType)
    checked = (F.round(source) if whole and fractional else source).try_cast(column.type)
    problems = [(source.isNotNull() & checked.isNull(), "does not fit " + column.type)]
    if column.width is not None:
        problems.append((F.length(checked) > column.width, f"is longer than {column.width}"))
    if column.required:
        problems.append((source.isNull(), "must not be NULL"))
    return checked, problems


def _assigned(df: DataFrame, table: Table, name: str) -> Column:
    """Cast one column to its declared type; a value that does not fit ends the job."""
    checked, problems = assignment(df, table, name)
    errors = [
        (broken, F.raise_error(F.lit(f"{table.name}.{name} {text}")).cast(table[name].type)) for broken, text in problems
    ]
    return first_match(errors, checked).alias(name)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` in order, cast as an INSERT would. Needs no shuffle."""
    return df.select(*[_assigned(df, table, name) for name in table.names])
