"""Currency books and conversion by broadcast lookup.

A book is a fixed table of at most a few dozen rows, so broadcasting it is
bounded by construction. The books disagree with each other on purpose: each
one reproduces a different source of rates and they must never be merged.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RATE_TYPE = "decimal(13,8)"
UNIFIED_TYPE = "decimal(28,8)"


@dataclass(frozen=True)
class FxBook:
    """``multiply``/``divide``: currency -> rate. ``unknown``: ``null`` or ``keep``."""

    name: str
    multiply: Mapping[str, str] = field(default_factory=dict)
    divide: Mapping[str, str] = field(default_factory=dict)
    unknown: str = "keep"

    def table(self, spark: SparkSession) -> DataFrame:
        """The book as rows ``(fx_currency, fx_rate, fx_divides)``."""
        rows = [(currency, rate, "false") for currency, rate in self.multiply.items()]
        rows += [(currency, rate, "true") for currency, rate in self.divide.items()]
        values = ", ".join(f"('{currency}', CAST('{rate}' AS {RATE_TYPE}), {divides})" for currency, rate, divides in rows)
        return spark.sql(f"SELECT * FROM VALUES {values} AS book(fx_currency, fx_rate, fx_divides)")


# Order-currency names, amount is multiplied, unknown becomes NULL.
NOTEBOOK_BOOK = FxBook(
    name="notebook_static",
    unknown="null",
    multiply={
        "Yuan Renminbi": "0.1465", "Euro": "1.08", "GBP": "1.25", "USD": "1", "Zloty": "0.25",
        "Yen": "0.0067", "Won": "0.00075", "Tugrik": "0.00029", "Tenge": "0.0022", "Tala": "0.37",
        "Taka": "0.0091", "Som": "0.011", "Sol": "0.27", "Shilling": "0.027", "Shekel": "0.27",
        "Rupiah": "0.000063", "Rupee": "0.012", "Ruble": "0.011", "Ringgit": "0.21", "Rial": "0.0026",
        "Real": "0.20", "Rand": "0.054", "Quetzal": "0.13", "Pula": "0.073", "Pound": "1.25",
        "Peso": "0.055", "Nakfa": "0.066", "Naira": "0.00067", "Metical": "0.016", "Litas": "0.29",
        "Lev": "0.56", "Leone": "0.000052", "Lempira": "0.040", "Lek": "0.011", "Kwacha": "0.055",
        "Kuna": "0.14", "Krone": "0.091", "Krona": "0.091", "Koruna": "0.043", "Hryvnia": "0.027",
        "Guarani": "0.00014", "Gourde": "0.0077", "Franc": "0.0011", "Escudo": "0.0098", "Dram": "0.0026",
        "Dong": "0.000040", "Dollar": "1", "Dirham": "0.27", "Dinar": "3.25", "Dalasi": "0.016",
        "Boliviano": "0.14", "Bolivar": "0.000028", "Balboa": "1", "Baht": "0.027", "Ariary": "0.00022",
        "Afghani": "0.014",
    },
)

# Order-currency names, mostly divided, unknown passes through.
DECLARATIVE_BOOK = FxBook(
    name="declarative_static",
    multiply={"Peso Convertible": "1", "Dollar": "1", "Euro": "1.1"},
    divide={
        "Peso Uruguayo": "39.57", "Yuan Renminbi": "6.825", "Rupiah": "14250.0", "Ruble": "75.0",
        "Peso": "4100.0", "Som": "85.0", "Real": "5.0", "Baht": "33.0", "Afghani": "75.0",
        "Tugrik": "2800.0", "Yen": "110.0", "Kwacha": "820.0", "Escudo": "100.0", "Krona": "8.5",
        "Koruna": "22.0", "Dinar": "3.0", "Pound": "450.0", "Naira": "410.0", "Kuna": "6.5",
        "Franc": "900.0", "Tolar": "200.0", "Zloty": "4.0",
    },
)

# The four-currency subset used by the bundle form.
BUNDLE_BOOK = FxBook(
    name="bundle_static",
    multiply={"Euro": "1.1"},
    divide={"Yuan Renminbi": "6.825", "Pound": "450.0", "Yen": "110.0"},
)

# ISO codes of the payment export, lower case, unknown counts as 1.0.
PAYMENT_BOOK = FxBook(
    name="payment_iso",
    multiply={"usd": "1.0", "eur": "1.08", "gbp": "1.25", "cad": "0.71", "aud": "0.64", "jpy": "0.0067"},
)

BOOKS = {book.name: book for book in (NOTEBOOK_BOOK, DECLARATIVE_BOOK, BUNDLE_BOOK, PAYMENT_BOOK)}


def _with_rate(df: DataFrame, currency: Column, book: FxBook) -> DataFrame:
    table = book.table(df.sparkSession)
    return df.join(F.broadcast(table), currency == table["fx_currency"], "left")


def convert(df: DataFrame, amount: str, currency: str, book: FxBook, out: str = "unified_amount") -> DataFrame:
    """Add ``out``: ``amount`` in USD under ``book``, exact decimal arithmetic to 8 places.

    An amount whose currency the book does not list becomes NULL or passes
    through unchanged, as the book says.
    """
    unlisted = F.lit(None) if book.unknown == "null" else F.col(amount)
    value = (
        F.when(F.col("fx_rate").isNull(), unlisted.cast(UNIFIED_TYPE))
        .when(F.col("fx_divides"), (F.col(amount) / F.col("fx_rate")).cast(UNIFIED_TYPE))
        .otherwise((F.col(amount) * F.col("fx_rate")).cast(UNIFIED_TYPE))
    )
    return (
        _with_rate(df, df[currency], book)
        .withColumn(out, value)
        .drop("fx_currency", "fx_rate", "fx_divides")
    )


def to_usd(
    df: DataFrame,
    minor_units: str,
    currency: str,
    book: FxBook = PAYMENT_BOOK,
    out: str = "amount_usd",
    zero_decimal: tuple[str, ...] = (),
) -> DataFrame:
    """Minor units -> USD with two decimals; unknown currencies use rate 1.

    Every currency is divided by 100 unless listed in ``zero_decimal`` (the
    default reproduces the plain division, also for yen). What does not fit
    ``decimal(18,2)`` becomes NULL, so one record cannot stop a batch.
    """
    rate = F.coalesce(F.col("fx_rate"), F.lit(1).cast(RATE_TYPE))
    cents = F.col(minor_units).cast("decimal(19,0)")
    unit = F.lit("0.01").cast("decimal(3,2)")
    if zero_decimal:
        whole = F.lit(1).cast("decimal(3,2)")
        unit = F.when(F.lower(F.col(currency)).isin(*zero_decimal), whole).otherwise(unit)
    usd = (cents * unit * rate).try_cast("decimal(18,2)")
    return (
        _with_rate(df, F.lower(df[currency]), book)
        .withColumn(out, usd)
        .drop("fx_currency", "fx_rate", "fx_divides")
    )


def rates_used(df: DataFrame, currency: Column, book: FxBook = PAYMENT_BOOK) -> DataFrame:
    """Distinct lower-cased currencies with the rate applied to them, sorted."""
    used = df.select(F.lower(currency).alias("currency")).distinct()
    return (
        _with_rate(used, used["currency"], book)
        .select("currency", F.coalesce("fx_rate", F.lit(1).cast(RATE_TYPE)).alias("rate"))
        .orderBy("currency")
    )


def coverage(df: DataFrame, amount: str, currency: str, book: FxBook) -> DataFrame:
    """Rows and amount per currency the book does not list (NULL currency included)."""
    table = F.broadcast(book.table(df.sparkSession))
    return (
        df.join(table, df[currency] == table["fx_currency"], "left_anti")
        .groupBy(F.col(currency).alias("currency"))
        .agg(F.count("*").alias("row_count"), F.sum(amount).alias("amount"))
    )
