"""Loading payment exports into the payment table, as set operations.

The steps are the ones a row-by-row loader would take (map, skip known ids,
isolate bad records, number, append), each expressed once over the whole
batch. ``position`` is a BIGINT giving the file order.

Classifying and numbering read the mapped batch several times. Pass a staged
batch (``sinks.stage``), so that the JSON is parsed once.

``amount_received`` and ``created`` are whole numbers; a fraction is
quarantined rather than cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import fx
from stratamart.functions.clock import from_epoch
from stratamart.functions.ordering import consecutive_ids
from stratamart.sources import sinks

INSERTED, SKIPPED, ERROR = "inserted", "skipped", "error"

# Columns added to the payment table.
STRIPE_COLUMNS = {
    "stripe_payment_id": "string",
    "stripe_status": "string",
    "stripe_currency": "string",
    "stripe_customer_id": "string",
    "stripe_amount_cents": "bigint",
    "stripe_amount_usd": "decimal(18,2)",
    "stripe_created_timestamp": "bigint",
    "stripe_description": "string",
    "stripe_metadata": "string",
}
# Length limits of the text columns, and the amount's decimal(10,2) limit.
TEXT_LIMITS = {"stripe_payment_id": 255, "stripe_status": 50, "stripe_currency": 3, "stripe_customer_id": 255}
AMOUNT_LIMIT = 100_000_000

LOADED_COLUMNS = ("amount", "payment_date", *STRIPE_COLUMNS)

Lookup = Callable[[DataFrame], DataFrame]


def evolve(target: DataFrame, columns: dict[str, str] = STRIPE_COLUMNS) -> DataFrame:
    """Add the missing columns as typed NULLs; existing columns stay as they are."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in target.columns}
    return target.withColumns(missing) if missing else target


def _given(name: str, default) -> Column:
    """The field's value; the default where its key is absent.

    An explicit null stays NULL, and an element that is no object has no values.
    """
    absent = F.col("present_keys").isNotNull() & ~F.array_contains("present_keys", name)
    return F.when(absent, F.lit(default)).otherwise(F.col(name))


def map_payments(parsed: DataFrame, zero_decimal: tuple[str, ...] = ()) -> DataFrame:
    """Export fields -> payment columns, with defaults for absent keys.

    Needs ``present_keys`` as made by ``parse_payments``; keeps ``position``
    and, if there, ``raw``.
    """
    named = parsed.withColumns(
        {
            "stripe_payment_id": F.col("id"),
            "stripe_status": F.col("status"),
            "stripe_currency": F.lower(_given("currency", "usd")),
            "stripe_customer_id": F.col("customer"),
            "stripe_amount_cents": _given("amount_received", 0).cast("bigint"),
            "stripe_created_timestamp": _given("created", 0).cast("bigint"),
            "stripe_description": F.col("description"),
            # NULL only where the element is no JSON object at all.
            "stripe_metadata": F.when(
                F.col("present_keys").isNotNull(), F.coalesce(_given("metadata", "{}"), F.lit("null"))
            ),
        }
    )
    priced = fx.to_usd(named, "stripe_amount_cents", "stripe_currency", out="stripe_amount_usd", zero_decimal=zero_decimal)
    loaded = priced.withColumns(
        {
            "amount": F.col("stripe_amount_usd"),
            "payment_date": from_epoch(F.col("stripe_created_timestamp")),
        }
    )
    extra = [name for name in ("raw",) if name in parsed.columns]
    return loaded.select("position", *LOADED_COLUMNS, *extra)


def error_reason(text_limits: dict[str, int] | None = None, amount_limit: int = AMOUNT_LIMIT) -> Column:
    """Why a mapped row cannot be stored, NULL if it can.

    The limits are those of the columns loaded into; pass others for a wider
    target. Rows beyond them are quarantined, never cut.
    """
    checks = [
        (F.col("stripe_metadata").isNull(), "not a JSON object"),
        (F.col("stripe_currency").isNull(), "currency is null"),
        (F.col("stripe_amount_cents").isNull(), "amount_received is null or not a number"),
        (F.col("stripe_created_timestamp").isNull(), "created is null or not a number"),
        (F.col("payment_date").isNull(), "created is out of range"),
        (F.col("stripe_amount_usd").isNull(), "amount_received is out of range"),
        (F.abs("stripe_amount_usd") >= amount_limit, "numeric field overflow in stripe_amount_usd"),
    ]
    checks += [
        (F.length(name) > limit, f"value too long for {name} ({limit})") for name, limit in (TEXT_LIMITS if text_limits is None else text_limits).items()
    ]
    reasons = [F.when(failed, F.lit(text)) for failed, text in checks]
    return F.coalesce(*reasons)


def split_valid(mapped: DataFrame, **limits) -> tuple[DataFrame, DataFrame]:
    """Storable rows, and the quarantine with an ``error_reason``; ``limits`` as for ``error_reason``."""
    judged = mapped.withColumn("error_reason", error_reason(**limits))
    good = judged.where(F.col("error_reason").isNull()).drop("error_reason")
    return good, judged.where(F.col("error_reason").isNotNull())


def classify(mapped: DataFrame, target: DataFrame | Lookup, **limits) -> DataFrame:
    """Add ``load_status`` and ``error_reason`` to every mapped row.

    A known id is skipped. Otherwise the first storable row of an id, in file
    order, is inserted, rows before it are errors and rows after it are
    skipped. Rows without id match nothing, so each storable one is inserted.
    The decision per id is an aggregate, so a much-repeated id collapses before
    the shuffle; joining it back splits on the row side if that id is hot.

    ``target`` is the table loaded into, or a function that returns those of
    the given ids which are known (``KnownIds.matching``).
    """
    judged = mapped.withColumn("error_reason", error_reason(**limits))
    storable = F.col("error_reason").isNull()
    with_id = judged.where(F.col("stripe_payment_id").isNotNull())
    per_id = with_id.groupBy("stripe_payment_id").agg(F.min(F.when(storable, F.col("position"))).alias("first_storable"))
    # Only target ids the batch mentions matter: a batch far smaller than the
    # target is broadcast and the target is scanned without being shuffled.
    ids = mapped.select("stripe_payment_id").where(F.col("stripe_payment_id").isNotNull()).distinct()
    matching = target(ids) if callable(target) else target.join(ids, "stripe_payment_id", "left_semi")
    known = matching.select("stripe_payment_id").distinct().withColumn("known", F.lit(True))
    per_id = per_id.join(known, "stripe_payment_id", "left")
    status = (
        F.when(F.col("stripe_payment_id").isNull(), F.when(storable, INSERTED).otherwise(ERROR))
        .when(F.col("known") | (F.col("position") > F.col("first_storable")), SKIPPED)
        .when(F.col("position") == F.col("first_storable"), INSERTED)
        .otherwise(ERROR)
    )
    return (
        judged.join(per_id, "stripe_payment_id", "left")
        .withColumn("load_status", status)
        .drop("first_storable", "known")
    )


def new_payments(mapped: DataFrame, target: DataFrame | Lookup) -> DataFrame:
    """The rows an idempotent load inserts; running it again on the result inserts none."""
    accepted = classify(mapped, target).where(F.col("load_status") == INSERTED)
    return accepted.select(*mapped.columns)


def assign_ids(accepted: DataFrame, target: DataFrame) -> DataFrame:
    """Add ``payment_id``: consecutive after the target's largest id, in file order."""
    start = target.agg((F.coalesce(F.max("payment_id"), F.lit(0)) + 1).alias("_start"))
    numbered = consecutive_ids(accepted, "position", "payment_id")
    return (
        numbered.crossJoin(F.broadcast(start))
        .withColumn("payment_id", F.col("payment_id") + F.col("_start"))
        .drop("_start")
    )


def append_rows(target: DataFrame, numbered: DataFrame) -> DataFrame:
    """Target plus numbered rows, in the evolved schema; columns the export lacks are NULL."""
    evolved = evolve(target)
    added = numbered.select("payment_id", *LOADED_COLUMNS)
    return evolved.unionByName(added, allowMissingColumns=True).select(*evolved.columns)


def load(mapped: DataFrame, target: DataFrame) -> DataFrame:
    """The payment table after the load.

    The accepted rows are written once, since numbering reads them twice.
    """
    known = evolve(target)
    accepted = sinks.stage(new_payments(mapped, known), "accepted_payments")
    return append_rows(known, assign_ids(accepted, known))


def load_summary(mapped: DataFrame, target: DataFrame) -> DataFrame:
    """One row: payments read, inserted, skipped and in error."""
    return summarise(classify(mapped, target))


def summarise(classified: DataFrame) -> DataFrame:
    """The load summary of rows that ``classify`` has judged."""
    status = F.col("load_status")
    return classified.agg(
        F.count("*").alias("payments_read"),
        F.count_if(status == INSERTED).alias("payments_inserted"),
        F.count_if(status == SKIPPED).alias("payments_skipped"),
        F.count_if(status == ERROR).alias("errors"),
    )


def rates_used(parsed: DataFrame) -> DataFrame:
    """Rates applied in this load, per distinct lower-cased currency."""
    return fx.rates_used(parsed, _given("currency", "usd"))
