"""Tables of the small test data, as Spark frames and as rows."""

import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(name, columns="*", where="true"):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet' WHERE {where}").fetchall()


def frame(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def clashing(df):
    """The frame with further columns whose names operators may use themselves."""
    from pyspark.sql import functions as F

    names = [n for n in ("node", "a", "b", "key", "hits", "score", "times", "of", "gone", "words") if n not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in names])
