"""Silver tables: joined and cleaned, one builder per table, variants by config.

Dimension joins carry no broadcast hint: Spark broadcasts a dimension when its
measured size is under the session threshold and otherwise shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import fx
from stratamart.plans.variants import BUNDLE, DECLARATIVE, NOTEBOOK, PG, Variant

PRODUCT_PG = ("product_id", "product_name", "price", "is_active", "category_name", "brand_name")
PRODUCT_BUNDLE = ("product_id", "product_name", "price", "category_name", "brand_name")
ORDER_PG = (
    "order_id", "customer_id", "order_date", "total_amount", "currency", "order_status",
    "discount_amount", "order_item_id", "product_id", "quantity",
)
ORDER_HEADER = (
    "order_id", "customer_id", "shipping_address_id", "order_date", "order_status",
    "subtotal", "discount_amount", "total_amount", "currency",
)
PAYMENT_PG = (
    "payment_id", "amount", "payment_date", "order_id", "method_name",
    "stripe_payment_id", "stripe_status", "stripe_currency",
)
PAYMENT_DECLARATIVE = (
    *PAYMENT_PG, "stripe_customer_id", "stripe_amount_cents", "stripe_amount_usd",
    "stripe_created_timestamp", "stripe_description", "stripe_metadata",
)


def drop_rescued(df: DataFrame) -> DataFrame:
    """All columns but the malformed-input column; fine when it is absent."""
    return df.drop("_rescued_data")


def product(
    product: DataFrame,
    category: DataFrame | None = None,
    brand: DataFrame | None = None,
    variant: Variant = DECLARATIVE,
) -> DataFrame:
    """Products with category and brand names.

    The bundle form reads a product source that already carries the names, so
    ``category`` and ``brand`` stay None there.
    """
    named = drop_rescued(product)
    if category is not None:
        named = named.join(category.select("product_category_id", "category_name"), "product_category_id")
    if brand is not None:
        named = named.join(brand.select("brand_id", "brand_name"), "brand_id")
    if variant.active_only:
        named = named.where(F.col("is_active"))
    if variant == PG:
        return named.select(*PRODUCT_PG)
    if variant == BUNDLE:
        return named.select(*PRODUCT_BUNDLE)
    own = [name for name in product.columns if name != "_rescued_data"]
    return named.select(*own, "category_name", "brand_name")


def active_status_is_correct(is_active: str = "is_active", type_name: str = "type_name") -> Column:
    """False where the flag contradicts the customer type; NULL flags contradict nothing."""
    active, kind = F.col(is_active), F.col(type_name)
    return (
        F.when(active.eqNullSafe(True) & (kind == "inactive"), False)
        .when(active.eqNullSafe(False) & (kind == "active"), False)
        .otherwise(True)
    )


def full_name(first: str, last: str) -> Column:
    """First and last name joined by a space; a NULL part counts as empty."""
    return F.concat(F.coalesce(F.col(first), F.lit("")), F.lit(" "), F.coalesce(F.col(last), F.lit("")))


def customer(
    customer: DataFrame, customer_type: DataFrame, address: DataFrame, variant: Variant = DECLARATIVE
) -> DataFrame:
    """Customers with type, every address (a customer with two appears twice) and the status flag."""
    located = drop_rescued(customer).join(address.select("customer_id", "city", "country"), "customer_id", "left")
    typed = located.join(customer_type.select("customer_type_id", "type_name"), "customer_type_id")
    flagged = typed.withColumn("active_status_is_correct", active_status_is_correct())
    added = ("type_name", "city", "country", "active_status_is_correct")
    if variant == PG:
        return flagged.select(
            "customer_id", full_name("first_name", "last_name").alias("customer_name"), "email", "is_active", *added
        )
    own = [name for name in customer.columns if name != "_rescued_data"]
    return flagged.select(*own, *added)


def order(
    orders: DataFrame,
    items: DataFrame | None = None,
    payments: DataFrame | None = None,
    product_silver: DataFrame | None = None,
    variant: Variant = DECLARATIVE,
) -> DataFrame:
    """Orders at line grain, with the amount in USD where the variant converts.

    pg: orders and items. notebook: adds the product name and converts the
    order total. declarative: adds every payment (lines x payments) and converts
    the payment amount by the order's currency. bundle: the same without items,
    for an order source that is already at line grain.
    """
    lines = orders if variant == BUNDLE else orders.join(items, "order_id", "left")
    if variant == PG:
        return lines.select(*ORDER_PG)
    usd = F.lit("USD").alias("unified_currency")
    if variant == NOTEBOOK:
        names = product_silver.select("product_id", "product_name")
        named = lines.join(names, "product_id", "left")
        converted = fx.convert(named, "total_amount", "currency", variant.book)
        return converted.select(*ORDER_HEADER, "product_id", "product_name", "quantity", "unified_amount", usd)
    paid = lines.join(payments.select("order_id", "amount"), "order_id", "left")
    converted = fx.convert(paid, "amount", "currency", variant.book)
    if variant == BUNDLE:
        return converted.select(
            "order_id", "customer_id", "order_date", "order_status", "quantity", "product_id", "unified_amount", usd
        )
    return converted.select(*ORDER_HEADER, "product_id", "quantity", "amount", "unified_amount", usd)


def within_tolerance(amount: str = "amount", usd: str = "stripe_amount_usd") -> Column:
    """Amount within one percent of its USD conversion."""
    low, high = (F.lit(bound).cast("decimal(3,2)") for bound in ("0.99", "1.01"))
    return (F.col(amount) >= F.col(usd) * low) & (F.col(amount) <= F.col(usd) * high)


def payment(
    payment: DataFrame, method: DataFrame, variant: Variant = DECLARATIVE, keep_unmatched: bool = False
) -> DataFrame:
    """Payments with the method name; declarative adds source and conversion status.

    The inner join loses payments without a method; ``keep_unmatched`` keeps them.
    """
    methods = method.select("payment_method_id", "method_name")
    named = payment.join(methods, "payment_method_id", "left" if keep_unmatched else "inner")
    if variant == PG:
        return named.select(*PAYMENT_PG)
    if variant == NOTEBOOK:
        return named.select(*payment.columns, "method_name")
    external = F.col("stripe_payment_id").isNotNull()
    status = (
        F.when(~external, "N/A")
        .when(F.col("stripe_amount_usd").isNull(), "no_conversion_data")
        .when(within_tolerance(), "valid")
        .otherwise("conversion_mismatch")
    )
    return named.select(
        *PAYMENT_DECLARATIVE,
        F.when(external, "Stripe").otherwise("Legacy").alias("payment_source"),
        status.alias("conversion_validation_status"),
    )
