"""Jobs that check what a database would enforce: keys, NOT NULL, references, widths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schemas import Table


class ConstraintError(ValueError):
    """Raised when a load would break a declared constraint."""


def duplicate_keys(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Key values that occur more than once, as text, with their number of rows. NULL keys never clash."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(present)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
        .select(
            F.lit(label).alias("check_name"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_value"),
            "n_rows",
        )
    )


def duplicate_keys_in(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """``duplicate_keys`` for several keys of one table (label -> columns), which is read once."""

    def key(label: str, columns: list[str]) -> Column:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        return F.struct(F.lit(label).alias("check_name"), F.when(present, text).alias("key_value"))

    rows = df.select(F.inline(F.array(*[key(label, columns) for label, columns in keys.items()])))
    counted = rows.filter("key_value IS NOT NULL").groupBy("check_name", "key_value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def require_unique(df: DataFrame, keys: list[str], label: str) -> None:
    """Stop a load whose rows hold one key twice."""
    found = duplicate_keys(df, keys, label).take(1)
    if found:
        raise ConstraintError(f"{label}: key {found[0]['key_value']} occurs {found[0]['n_rows']} times")


def _long_form(df: DataFrame, metrics: dict[str, dict[str, F.Column]], label: str) -> DataFrame:
    """One aggregation pass, then one row per column with its metrics."""
    aggregates = [expr.alias(f"{m}__{c}") for c, ms in metrics.items() for m, expr in ms.items()]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}__{c}").alias(m) for m in ms])
            for c, ms in metrics.items()
        ]
    )
    return df.agg(*aggregates).select(F.lit(label).alias("table_name"), F.inline(rows))


def null_counts(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Rows and NULLs of each column that must be filled."""
    return _long_form(
        df,
        {c: {"n_rows": F.count(F.lit(1)), "n_nulls": F.count(F.when(F.col(c).isNull(), 1))} for c in columns},
        label,
    )


def over_length(df: DataFrame, widths: dict[str, int], label: str) -> DataFrame:
    """Longest value and number of values beyond the declared width."""
    return _long_form(
        df,
        {
            c: {
                "width": F.max(F.lit(width)),
                "max_length": F.max(F.length(c)),
                "n_over": F.count(F.when(F.length(c) > width, 1)),
            }
            for c, width in widths.items()
        },
        label,
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str) -> DataFrame:
    """Key values without a row in the parent, with their number of child rows. NULL passes.

    Child rows are counted per value before the anti join, so a frequent value is one row there.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("used_key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias("known_key"))
    return used.join(known, F.col("used_key") == F.col("known_key"), "left_anti").select(
        F.lit(label).alias("check_name"), F.col("used_key").cast("string").alias("key_value"), "n_rows"
    )


def orphans_in(child: DataFrame, references: list[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """``orphans`` for several references of one table: (label, column, parent, parent column). The child is read once.

    Its rows are counted per column and value, whatever the number of references of a column.
    """
    columns = sorted({column for _, column, _, _ in references})
    # keys of all columns in one: numbers stay numbers where all are
    whole = all(isinstance(child.schema[c].dataType, T.IntegralType) for c in columns)
    kind = "bigint" if whole else "string"
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("key_value")) for c in columns])
    used = child.select(F.inline(values)).filter("key_value IS NOT NULL").groupBy("column", "key_value").agg(F.count(F.lit(1)).alias("n_rows"))
    labels = F.create_map(*[part for c in columns for part in (F.lit(c), F.array(*[F.lit(label) for label, own, _, _ in references if own == c]))])
    asked = used.select(F.explode(F.element_at(labels, F.col("column"))).alias("check_name"), "key_value", "n_rows")
    known = reduce(
        DataFrame.unionByName,
        [parent.select(F.lit(label).alias("check_name"), F.col(key).try_cast(kind).alias("key_value")) for label, _, parent, key in references],
    )
    lost = asked.join(known, ["check_name", "key_value"], "left_anti")
    return lost.withColumn("key_value", F.col("key_value").cast("string"))


def violations(table: Table, df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """All declared constraints of one table as (check_name, key_value, n_rows); empty when all hold."""
    parts = [duplicate_keys(df, list(key), f"{table.name} unique {','.join(key)}") for key in table.unique]
    for column, other, other_column in table.references:
        if other in parents:
            parts.append(orphans(df, column, parents[other], other_column, f"{table.name}.{column} in {other}"))
    if table.required:
        parts.append(
            null_counts(df, table.required, table.name)
            .filter("n_nulls > 0")
            .select(
                F.concat_ws(" ", F.concat_ws(".", "table_name", "column_name"), F.lit("not null")).alias("check_name"),
                F.lit(None).cast("string").alias("key_value"),
                F.col("n_nulls").alias("n_rows"),
            )
        )
    if table.widths:
        parts.append(
            over_length(df, table.widths, table.name)
            .filter("n_over > 0")
            .select(
                F.concat_ws(" ", F.concat_ws(".", "table_name", "column_name"), F.lit("width")).alias("check_name"),
                F.lit(None).cast("string").alias("key_value"),
                F.col("n_over").alias("n_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
