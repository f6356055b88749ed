"""Contact list without personal data, and the e-mail check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.text import email_is_valid, email_matches, person_name
from tarmac.functions.time import age_band, age_years, date_lit, timestamp_lit


def marketing_leads(customers: DataFrame, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    """One row per customer, only with columns that may be passed on. Bad e-mails are marked, not dropped."""
    born, today = F.col("date_of_birth"), date_lit(as_of)
    return customers.select(
        "customer_id",
        person_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        F.lower("email").alias("email"),
        "city",
        "state",
        age_years(born, today).alias("age"),
        age_band(born, today).alias("age_band"),
        email_is_valid(F.col("email")).alias("email_is_valid"),
        timestamp_lit(run_ts).alias("loaded_at"),
    )


def invalid_email(customers: DataFrame) -> DataFrame:
    """Customers whose e-mail is present but malformed, as written in the source."""
    email = F.col("email")
    return customers.filter(email.isNotNull() & ~email_matches(email)).select(
        "email", "customer_id", "last_name", "first_name"
    )


def email_validity(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Every blank-separated token with an ``@`` in a text column, with the result of the e-mail check."""
    tokens = F.filter(F.split(F.col(text), r"[ \t\r\n]+"), lambda token: token.contains("@"))
    return (
        texts.filter(F.col(text).contains("@"))
        .select(key, F.explode(tokens).alias("token"))
        .withColumn("is_valid", email_is_valid(F.col("token")))
    )
