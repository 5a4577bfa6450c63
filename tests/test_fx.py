from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions import fx


@pytest.mark.parametrize("book", list(fx.BOOKS.values()), ids=list(fx.BOOKS))
def test_lookup_equals_case_chain(spark, book):
    currencies = [*book.multiply, *book.divide, "Doubloon", None]
    df = spark.createDataFrame(
        [(currency, Decimal(amount)) for currency in currencies for amount in ("1234.56", "0.01", "-7.00")] + [("Euro", None)],
        "currency string, amount decimal(18,2)",
    )
    case = F.lit(None).cast(fx.UNIFIED_TYPE) if book.unknown == "null" else F.col("amount").cast(fx.UNIFIED_TYPE)
    for currency, rate in book.multiply.items():
        value = (F.col("amount") * F.lit(rate).cast(fx.RATE_TYPE)).cast(fx.UNIFIED_TYPE)
        case = F.when(F.col("currency") == currency, value).otherwise(case)
    for currency, rate in book.divide.items():
        value = (F.col("amount") / F.lit(rate).cast(fx.RATE_TYPE)).cast(fx.UNIFIED_TYPE)
        case = F.when(F.col("currency") == currency, value).otherwise(case)
    both = fx.convert(df, "amount", "currency", book).withColumn("expected", case)
    assert both.count() == df.count()
    assert both.where(~F.col("unified_amount").eqNullSafe(F.col("expected"))).count() == 0


def test_book_sizes():
    assert [len(b.multiply) + len(b.divide) for b in fx.BOOKS.values()] == [56, 25, 4, 6]


def test_to_usd(spark, rows):
    df = spark.createDataFrame(
        [(2500, "EUR"), (2500, "usd"), (1000, "jpy"), (1000, "chf"), (None, "usd"), (125, None)],
        "cents bigint, currency string",
    )
    usd = rows(fx.to_usd(df, "cents", "currency"), "currency", "amount_usd")
    assert usd == sorted(
        [("EUR", Decimal("27.00")), ("usd", Decimal("25.00")), ("jpy", Decimal("0.07")), ("chf", Decimal("10.00")),
         ("usd", None), (None, Decimal("1.25"))], key=repr)
    whole = fx.to_usd(df, "cents", "currency", zero_decimal=("jpy",)).where("currency = 'jpy'").first()
    assert whole["amount_usd"] == Decimal("6.70")


def test_coverage_counts_null_currency(spark, rows):
    df = spark.createDataFrame([("Euro", 1), ("Doubloon", 2), ("Doubloon", 3), (None, 4)], "currency string, amount int")
    assert rows(fx.coverage(df, "amount", "currency", fx.NOTEBOOK_BOOK)) == [("Doubloon", 2, 5), (None, 1, 4)]
