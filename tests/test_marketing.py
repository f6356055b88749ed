import datetime as dt

from tarmac import schemas
from tarmac.operators import marketing
from tests import fixtures as fx
from tests.test_functions import band, lived


def test_leads_and_invalid_email(spark):
    customers = fx.customers(spark)
    leads = marketing.marketing_leads(customers, fx.AS_OF, fx.RUN_TS)
    assert leads.columns == schemas.MARKETING_LEADS.names
    assert not set(leads.columns) & set(schemas.PERSONAL_COLUMNS)
    got = {r["customer_id"]: r for r in leads.collect()}
    assert len(got) == 102 and sum(r["email_is_valid"] for r in got.values()) == 100
    for row in fx.customer_rows():
        lead = got[row[0]]
        assert lead["full_name"] == f"{row[1]} {row[2]}" and lead["email"] == row[5].lower()
        assert (lead["age"], lead["age_band"]) == (lived(row[4], fx.AS_OF)[0] // 12, band(row[4], fx.AS_OF))

    bad = marketing.invalid_email(customers)
    assert bad.columns == ["email", "customer_id", "last_name", "first_name"]
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("milo.thorneexample.com", 2, "Thorne", "Milo"),
        ("vera.quillexample.com", 57, "Quill", "Vera"),
    ]


def test_every_customer_is_valid_invalid_or_without_email(spark):
    rest = ("900", dt.date(1990, 1, 1))
    rows = [
        (i, "a", "b", rest[0], rest[1], email, *["x"] * 3, "town", "TX", "1")
        for i, email in enumerate(["A@B.COM", None, "a@b.com\n", "bad", "ok@x.org"])
    ]
    customers = fx.customers(spark, rows)
    leads = marketing.marketing_leads(customers, fx.AS_OF, fx.RUN_TS)
    valid = leads.filter("email_is_valid").count()
    missing = customers.filter("email IS NULL").count()
    assert (valid, missing, marketing.invalid_email(customers).count()) == (2, 1, 2)
    assert leads.filter("email_is_valid IS NULL").count() == 0


def test_tokens_of_texts(spark):
    texts = spark.createDataFrame([(1, "write a@b.com, or\tx@y.org\nnow"), (2, "none"), (3, None)], "id int, body string")
    got = sorted(tuple(r) for r in marketing.email_validity(texts, "id", "body").collect())
    assert got == [(1, "a@b.com,", False), (1, "x@y.org", True)]
