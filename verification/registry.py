"""Every registered query: engine operators over the source tables of one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions import fx
from stratamart.functions.geography import map_region
from stratamart.operators import analysis, expectations as expect, gold, ingest, monitor, quality, silver
from stratamart.operators.quarantine import Quarantine
from stratamart.operators.sketches import RANK_ERROR, DailySketches, relative_error
from stratamart.plans import direct, medallion
from stratamart.plans.variants import BUNDLE, DECLARATIVE, NOTEBOOK, PG
from stratamart.session import configure, shared_folder
from stratamart.sources import csv, payment_export, semi_structured, sinks
from stratamart.sources.known_ids import KnownIds
from stratamart.streaming import bronze, payments as payment_stream, schema_log
from stratamart.streaming.keyed import KeyedTable, stream_latest
from verification.fixtures import Sources


class Tables(Sources):
    """Source tables plus the Silver tables of each variant, after expectations."""

    def scratch(self, name: str) -> str:
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def product_silver(self, variant) -> DataFrame:
        if variant == BUNDLE:
            return silver.product(self.product_named(), variant=BUNDLE)
        return silver.product(self.product(), self.product_category(), self.brand(), variant)

    def customer_raw(self, variant) -> DataFrame:
        return silver.customer(self.customer(), self.customer_type(), self.address(), variant)

    def customer_silver(self, variant) -> DataFrame:
        rows = self.customer_raw(variant)
        return expect.keep(rows, expect.CUSTOMER_RULES) if variant == DECLARATIVE else rows

    def order_raw(self, variant) -> DataFrame:
        if variant == BUNDLE:
            return silver.order(self.order_lines(), payments=self.payment(), variant=BUNDLE)
        named = self.product_silver(NOTEBOOK) if variant == NOTEBOOK else None
        paid = self.payment() if variant == DECLARATIVE else None
        return silver.order(self.orders(), self.order_item(), paid, named, variant)

    def order_silver(self, variant) -> DataFrame:
        rows = self.order_raw(variant)
        return expect.keep(rows, expect.ORDER_RULES) if variant in (DECLARATIVE, BUNDLE) else rows

    def payment_raw(self, variant=DECLARATIVE, keep_unmatched: bool = False) -> DataFrame:
        return silver.payment(self.payment(), self.payment_method(), variant, keep_unmatched)

    def payment_silver(self) -> DataFrame:
        return expect.keep(self.payment_raw(), expect.PAYMENT_RULES)

    def order_totals(self, variant) -> DataFrame:
        paid = self.payment() if variant == DECLARATIVE else None
        return direct.order_totals(self.orders(), self.order_item(), paid, variant)

    def lines_per_product(self, variant) -> DataFrame:
        paid = self.payment() if variant == DECLARATIVE else None
        return direct.lines_per_product(self.orders(), self.order_item(), paid, variant)

    def sales_region(self, variant) -> DataFrame:
        return gold.sales_region_from_totals(
            self.order_totals(variant), self.customer_silver(variant), variant, keyed=True
        )

    def sales_country(self, variant) -> DataFrame:
        return gold.sales_country_from_totals(self.order_totals(variant), self.customer_silver(variant), keyed=True)

    def product_revenue(self, variant) -> DataFrame:
        return gold.finish_product_revenue(self.product_silver(variant), self.lines_per_product(variant), variant)

    def product_profit(self) -> DataFrame:
        return gold.finish_product_profit(
            self.product_silver(DECLARATIVE), self.lines_per_product(DECLARATIVE), DECLARATIVE
        )

    def cancelled_product(self, variant=PG) -> DataFrame:
        return gold.cancelled_product(self.product_silver(variant), self.order_silver(variant))

    def payments_parsed(self) -> DataFrame:
        return payment_export.parse_payments(self.export_elements())

    def payments_mapped(self) -> DataFrame:
        return ingest.map_payments(self.payments_parsed())

    def payments_staged(self) -> DataFrame:
        """The mapped batch written once, for the steps that read it repeatedly."""
        return sinks.stage(self.payments_mapped().drop("raw"), "payments_mapped")


class FannedTables(Tables):
    """The same with no, one or three payments an order."""

    def payment(self) -> DataFrame:
        return self.payment_fanned()


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame, money: int = 2, ratios: int = 6) -> DataFrame:
    """Decimals and doubles rounded to doubles, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column, money).cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, ratios)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Callable[[Tables], DataFrame] | None = None, *, money: int = 2, ratios: int = 6):
    """Register ``build`` under its function name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(configure(spark), folder)), money, ratios)

        run.__doc__ = build.__doc__
        REGISTRY[build.__name__] = run
        return build

    return register if build is None else register(build)


# --- sources --------------------------------------------------------------------


@query
def s1_csv_bronze(t):
    """CSV round trip of the product table with inferred types."""
    path = t.scratch("product_csv")
    t.product().write.option("header", True).csv(path)
    return silver.drop_rescued(csv.read_csv_bronze(t.spark, path))


@query
def s2_csv_rescued(t):
    """Order items with a malformed quantity on every seventh line: kept, rescued and counted."""
    path = t.scratch("order_item_csv")
    quantity = F.when(F.col("order_item_id") % 10 == 7, "n/a").otherwise(F.col("quantity").cast("string"))
    items = t.order_item()
    items.withColumn("quantity", quantity).write.option("header", True).csv(path)
    rows = csv.read_csv_bronze(t.spark, path, items.schema)
    return rows.groupBy(F.col(csv.RESCUED).isNotNull().alias("rescued")).agg(
        F.count("*").alias("row_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("product_id").alias("product_ids"),
    )


@query
def s2_rescued_cells(t):
    """Order items with up to two malformed cells a row: the others stay typed, the misfits are named."""
    path = t.scratch("order_item_cells")
    line, items = F.col("order_item_id") % 10, t.order_item()
    bad = {
        "quantity": F.when(line == 7, "n/a").otherwise(F.col("quantity").cast("string")),
        "product_id": F.when((line == 7) | (line == 2), F.concat(F.lit("p"), F.col("product_id").cast("string"))).otherwise(F.col("product_id").cast("string")),
    }
    items.withColumns(bad).write.option("header", True).csv(path)
    return csv.read_csv_cells(t.spark, path, items.schema).withColumnRenamed(csv.RESCUED, "rescued")


def _export(t) -> DataFrame:
    """Events written as one export document per hundred events, and read back."""
    path = t.scratch("payment_export")
    elements = t.export_elements().groupBy(F.floor(F.col("position") / 100).alias("chunk")).agg(
        F.concat(F.lit('{"data":['), F.concat_ws(",", F.collect_list("raw")), F.lit("]}")).alias("value")
    )
    elements.select("value").write.text(path)
    return payment_export.read_payment_export(t.spark, path, multiline=False)


@query
def s3_payment_export(t):
    return _export(t).select("id", "amount_received", "currency", "created", "status", "customer", "description")


@query
def s4_export_documents(t):
    """Readable, broken, keyless and misshapen documents, one per line, told apart."""
    path = t.scratch("payment_documents")
    chunk = F.floor(F.col("position") / 100).alias("chunk")
    texts = t.export_elements().groupBy(chunk).agg(F.concat_ws(",", F.collect_list("raw")).alias("raw"))
    kind, raw = F.col("chunk") % 4, F.col("raw")
    document = (
        F.when(kind == 0, F.concat(F.lit('{"data":['), raw, F.lit("]}")))
        .when(kind == 1, F.concat(F.lit('{"data":['), raw))
        .when(kind == 2, F.lit('{"other":1}'))
        .otherwise(F.lit('{"data":{"id":"x"}}'))
    )
    texts.select(document.alias("value")).write.text(path)
    documents = payment_export.read_documents(t.spark, path, multiline=False)
    payments = F.sum(F.when(F.col("error").isNull(), F.coalesce(F.size("data"), F.lit(0))).otherwise(0))
    return documents.groupBy(F.col("error").isNull().alias("readable")).agg(
        F.count("*").alias("documents"), payments.cast("bigint").alias("payments")
    )


@query
def s5_raw_payload(t):
    raw = F.col("raw")
    return _export(t).select(
        "id",
        "created",
        F.get_json_object(raw, "$.metadata.k").alias("metadata_k"),
        F.size("present_keys").alias("keys"),
    )


def _orders_stream(t) -> DataFrame:
    return bronze.bronze_stream(t.spark, f"{t.folder}/orders*.parquet", t.raw("orders").schema)


@query
def s7_bronze_stream(t):
    """The orders file ingested as a stream."""
    path = t.scratch("orders_bronze")
    bronze.run_available_now(_orders_stream(t), path, t.scratch("checkpoint"))
    return bronze.read_bronze(t.spark, path, t.raw("orders").schema)


@query
def s8_table_stream(t):
    """Order items read as a stream from a catalog table."""
    name = f"order_item_{uuid.uuid4().hex}"
    path = t.scratch("order_item_bronze")
    t.order_item().write.option("path", t.scratch("order_item")).saveAsTable(name)
    bronze.run_available_now(bronze.table_stream(t.spark, name), path, t.scratch("checkpoint"))
    t.spark.sql(f"DROP TABLE {name}")
    return bronze.read_bronze(t.spark, path, t.order_item().schema)


@query
def s9_table_row_counts(t):
    tables = {
        "product": t.product(), "product_category": t.product_category(), "brand": t.brand(),
        "customer": t.customer(), "customer_type": t.customer_type(), "address": t.address(),
        "orders": t.orders(), "order_item": t.order_item(), "payment": t.payment(),
    }
    return quality.table_row_counts(tables)


# --- sinks ----------------------------------------------------------------------


@query
def k1_replace(t):
    """A refresh replaces the earlier version."""
    path = t.scratch("orders_table")
    sinks.replace(t.orders().withColumn("order_status", F.lit("outdated")), path)
    return sinks.replace(t.orders(), path)


@query
def k2_create_if_absent(t):
    """The second create finds the table and leaves it."""
    path = t.scratch("customer_type_table")
    sinks.create_if_absent(t.customer(), path)
    return sinks.create_if_absent(t.customer().withColumn("email", F.lit("changed")), path)


@query
def k3_append_new_files_only(t):
    """Two triggered runs over the same file: the second adds nothing."""
    path, checkpoint = t.scratch("orders_bronze"), t.scratch("checkpoint")
    bronze.run_available_now(_orders_stream(t), path, checkpoint)
    bronze.run_available_now(_orders_stream(t), path, checkpoint)
    return bronze.read_bronze(t.spark, path, t.raw("orders").schema).groupBy("o_orderstatus").agg(F.count("*").alias("row_count"))


@query
def k4_publish(t):
    """Customers published with their expectations enforced."""
    path = t.scratch("customer_silver")
    kept, observation = expect.apply(t.customer_raw(DECLARATIVE), "customer_silver", expect.CUSTOMER_RULES)
    sinks.publish(kept, observation, expect.CUSTOMER_RULES, "customer_silver", path)
    return sinks.read(t.spark, path)


@query
def k4_publish_failed(t):
    """A violated FAIL rule leaves the earlier version in place."""
    path = t.scratch("customer_silver")
    kept, observation = expect.apply(t.customer_raw(DECLARATIVE), "customer_silver", expect.CUSTOMER_RULES)
    sinks.publish(kept, observation, expect.CUSTOMER_RULES, "customer_silver", path)
    rules = (expect.Expectation("never_holds", "customer_id < 0", expect.FAIL),)
    kept, observation = expect.apply(t.customer_raw(DECLARATIVE), "customer_silver", rules)
    try:
        sinks.publish(kept, observation, rules, "customer_silver", path)
    except expect.ExpectationFailed:
        return sinks.read(t.spark, path)
    raise AssertionError("the violated rule was not noticed")


# --- payment ingest -------------------------------------------------------------


@query
def i1_map_payments(t):
    return t.payments_mapped().drop("raw")


@query
def i3_new_payments(t):
    return ingest.new_payments(t.payments_staged(), t.payment()).select("position", "stripe_payment_id", "amount")


@query
def i3_known_ids(t):
    """As ``i3_new_payments``, with the known ids looked up in their index."""
    known = KnownIds(t.spark, t.scratch("known_ids"))
    known.add(t.payment().select("stripe_payment_id", F.lit("base").alias("run"), F.lit(0).alias("batch_id")))
    return ingest.new_payments(t.payments_staged(), known.matching).select("position", "stripe_payment_id", "amount")


@query
def i4_assign_ids(t):
    accepted = sinks.stage(ingest.new_payments(t.payments_staged(), t.payment()), "accepted_payments")
    return ingest.assign_ids(accepted, t.payment()).select("position", "payment_id", "stripe_payment_id")


@query
def i4_export_to_payments(t):
    """From written export files, in their order, to numbered payments."""
    path = t.scratch("payment_export")
    chunk = F.floor(F.col("position") / 100).alias("chunk")
    texts = t.export_elements().groupBy(chunk).agg(F.array_sort(F.collect_list(F.struct("position", "raw"))).alias("rows"))
    document = F.concat(F.lit('{"data":['), F.array_join(F.col("rows.raw"), ","), F.lit("]}"))
    texts.repartitionByRange(4, "chunk").sortWithinPartitions("chunk").select(document.alias("value")).write.text(path)
    documents = payment_export.read_documents(t.spark, path, multiline=False)
    mapped = sinks.stage(ingest.map_payments(payment_export.positioned_payments(documents, keep_raw=False)), "payments_mapped")
    accepted = sinks.stage(ingest.new_payments(mapped, t.payment()), "accepted_payments")
    return ingest.assign_ids(accepted, t.payment()).select("payment_id", "stripe_payment_id")


@query
def i5_to_usd(t):
    return fx.to_usd(t.payments_parsed(), "amount_received", "currency").select(
        "position", "currency", "amount_received", "amount_usd"
    )


@query
def i5_to_usd_zero_decimal(t):
    return fx.to_usd(t.payments_parsed(), "amount_received", "currency", zero_decimal=("jpy",)).select(
        "position", "currency", "amount_received", "amount_usd"
    )


@query
def i6_evolved_load(t):
    """A payment table without the external columns, evolved and loaded."""
    legacy = t.payment().select("payment_id", "order_id", "amount", "payment_date", "payment_method_id")
    return ingest.load(t.payments_staged(), legacy)


@query
def i7_quarantine(t):
    return ingest.split_valid(t.payments_mapped())[1].select("position", "stripe_payment_id", "error_reason")


@query
def i7_quarantine_replay(t):
    """A load that keeps its bad records, their repair, and the replay, which is run twice."""
    table, quarantine = t.scratch("payments"), Quarantine(t.spark, t.scratch("quarantine"))
    sinks.replace(t.payment(), table)
    mapped = sinks.stage(t.payments_mapped(), "payments_mapped")
    quarantine.load(mapped, table)
    text = F.replace(F.replace("raw", F.lit('"amount_received":null'), F.lit('"amount_received":0')), F.lit('"currency":null'), F.lit('"currency":"usd"'))
    repaired = quarantine.entries().select("content_key", text.alias("raw"))
    quarantine.replay(repaired, table)
    loaded = quarantine.replay(repaired, table)
    still_open = quarantine.open(table).agg(F.count("*").alias("open_entries"))
    before = t.payment().agg(F.max("payment_id").alias("before"))
    added = loaded.crossJoin(F.broadcast(before)).where(F.col("payment_id") > F.col("before"))
    return added.select("payment_id", "stripe_payment_id", "amount").crossJoin(F.broadcast(still_open))


@query
def x16_metadata_variant(t):
    """Payments by a path of their metadata, which is parsed once, when it is written."""
    parsed = semi_structured.as_variant(t.payments_mapped().select("amount", "stripe_metadata"), "stripe_metadata")
    stored = sinks.stage(parsed, "payment_metadata")
    found = semi_structured.paths(stored, "stripe_metadata", {"k": ("$.k", "bigint"), "absent": ("$.k.below", "string")})
    return found.groupBy("k").agg(
        F.count("*").alias("payments"), F.sum("amount").alias("amount"),
        F.count("absent").alias("absent"), F.count(semi_structured.INVALID).alias("invalid"),
    )


@query
def i8_load_summary(t):
    return ingest.load_summary(t.payments_staged(), t.payment())


@query
def i8_load_status(t):
    return ingest.classify(t.payments_staged(), t.payment()).select("position", "stripe_payment_id", "load_status")


@query(money=8)
def i9_rates_used(t):
    return ingest.rates_used(t.payments_parsed())


@query
def i10_stripe_loaded(t):
    return quality.stripe_loaded_count(t.payment())


# --- currency books -------------------------------------------------------------


@query(money=6)
def fx1_notebook_book(t):
    return fx.convert(t.orders(), "total_amount", "currency", fx.NOTEBOOK_BOOK).select("order_id", "unified_amount")


@query(money=6)
def fx2_declarative_book(t):
    return fx.convert(t.orders(), "total_amount", "currency", fx.DECLARATIVE_BOOK).select("order_id", "unified_amount")


@query(money=6)
def fx3_bundle_book(t):
    return fx.convert(t.orders(), "total_amount", "currency", fx.BUNDLE_BOOK).select("order_id", "unified_amount")


@query
def fx4_payment_book(t):
    rows = t.payment().where(F.col("stripe_payment_id").isNotNull())
    return fx.to_usd(rows, "stripe_amount_cents", "stripe_currency").select("payment_id", "amount_usd")


@query
def fx5_coverage(t):
    books = [fx.NOTEBOOK_BOOK, fx.DECLARATIVE_BOOK, fx.BUNDLE_BOOK]
    parts = [
        fx.coverage(t.orders(), "total_amount", "currency", book).select(F.lit(book.name).alias("book"), "*")
        for book in books
    ]
    return reduce(DataFrame.unionByName, parts)


# --- silver ---------------------------------------------------------------------


@query
def v1_product_pg(t):
    return t.product_silver(PG)


@query
def v1_product_notebook(t):
    return t.product_silver(NOTEBOOK)


@query
def v1_product_declarative(t):
    return t.product_silver(DECLARATIVE)


@query
def v1_product_bundle(t):
    return t.product_silver(BUNDLE)


@query
def v2_customer_pg(t):
    return t.customer_silver(PG)


@query
def v2_customer_notebook(t):
    return t.customer_silver(NOTEBOOK)


@query
def v2_customer_declarative(t):
    return t.customer_silver(DECLARATIVE)


@query
def v3_order_pg(t):
    return t.order_silver(PG)


@query(money=6)
def v3_order_notebook(t):
    return t.order_silver(NOTEBOOK)


@query(money=6)
def v3_order_declarative(t):
    return t.order_silver(DECLARATIVE)


@query(money=6)
def v3_order_bundle(t):
    return t.order_silver(BUNDLE)


@query
def v4_payment_pg(t):
    return t.payment_raw(PG)


@query
def v4_payment_notebook(t):
    return t.payment_raw(NOTEBOOK)


@query
def v4_payment_declarative(t):
    return t.payment_silver()


@query
def v4b_payment_keep_unmatched(t):
    return t.payment_raw(keep_unmatched=True)


# --- expectations ---------------------------------------------------------------


def _silver_with_rules(t):
    return {
        "product_silver": (t.product_silver(DECLARATIVE), expect.PRODUCT_RULES),
        "customer_silver": (t.customer_raw(DECLARATIVE), expect.CUSTOMER_RULES),
        "order_silver": (t.order_raw(DECLARATIVE), expect.ORDER_RULES),
        "payment_silver": (t.payment_raw(), expect.PAYMENT_RULES),
    }


@query
def q1_apply_payment(t):
    """Payments through the observed filter: dropped rows are gone, warned rows stay."""
    return expect.apply(t.payment_raw(), "payment_silver", expect.PAYMENT_RULES)[0].select("payment_id", "amount")


@query
def q2_expectation_results(t):
    """Pass and fail counts of all fourteen expectations."""
    parts = [expect.results(df, table, rules) for table, (df, rules) in _silver_with_rules(t).items()]
    return reduce(DataFrame.unionByName, parts)


@query
def q2_fail_rules(t):
    """Every FAIL rule on tables that violate it."""
    faults = {
        "product_silver": {
            "product_id": "CASE WHEN product_id % 11 <> 3 THEN product_id END",
            "price": "CASE WHEN product_id % 13 = 5 THEN -price ELSE price END",
            "sell_price": "CASE WHEN product_id % 17 <> 7 THEN sell_price END",
        },
        "customer_silver": {"customer_id": "CASE WHEN customer_id % 19 <> 4 THEN customer_id END"},
        "order_silver": {"order_id": "CASE WHEN order_id % 23 <> 6 THEN order_id END"},
        "payment_silver": {
            "payment_id": "CASE WHEN payment_id % 29 <> 8 THEN payment_id END",
            "amount": "CASE WHEN payment_id % 31 = 9 THEN -amount WHEN payment_id % 31 <> 10 THEN amount END",
            "stripe_status": "CASE WHEN payment_id % 37 <> 10 THEN stripe_status END",
        },
    }
    parts = []
    for table, (df, rules) in _silver_with_rules(t).items():
        broken = df.withColumns({name: F.expr(text) for name, text in faults[table].items()})
        parts.append(expect.results(broken, table, [rule for rule in rules if rule.action == expect.FAIL]))
    return reduce(DataFrame.unionByName, parts)


def _fanned(t) -> FannedTables:
    return FannedTables(t.spark, t.folder)


@query(money=6)
def j7_order_fan_out(t):
    """Order lines by payments: none, one or three an order, here and below."""
    return _fanned(t).order_silver(DECLARATIVE)


@query
def j7_profit_fan_out(t):
    return _fanned(t).product_profit()


@query
def j7_region_fan_out(t):
    return _fanned(t).sales_region(DECLARATIVE)


@query
def j7_country_fan_out(t):
    return _fanned(t).sales_country(DECLARATIVE)


@query
def ag2_sketched_customers(t):
    """Customers per order status from daily sketches: the exact count, and whether the estimate is within its error."""
    orders = t.orders()
    sketches = DailySketches(t.spark, t.scratch("order_sketches"), ["order_status"], distinct=["customer_id"])
    sketches.refresh(orders, F.col("order_date"))
    exact = orders.groupBy("order_status").agg(F.count("*").alias("orders"), F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("customer_id_count") - F.col("customers")) <= F.col("customers") * relative_error()
    return sketches.estimate().join(exact, "order_status").select("order_status", "orders", "customers", (off & (F.col("rows") == F.col("orders"))).alias("within_error"))


@query
def ag10_sketched_median(t):
    """Median payment per source from daily sketches: whether the estimate's exact rank is within the error."""
    payments = t.payment_silver().select("payment_source", F.col("amount").cast("double").alias("amount"), "payment_date")
    sketches = DailySketches(t.spark, t.scratch("payment_sketches"), ["payment_source"], quantiles=["amount"])
    sketches.refresh(payments, F.col("payment_date"))
    below, upto = F.col("amount") < F.col("amount_median"), F.col("amount") <= F.col("amount_median")
    ranked = payments.join(F.broadcast(sketches.estimate().drop("rows")), "payment_source").groupBy("payment_source").agg(
        F.count("*").alias("payments"), (F.count_if(below) / F.count("*")).alias("low"), (F.count_if(upto) / F.count("*")).alias("high")
    )
    near = (F.col("low") <= 0.5 + RANK_ERROR) & (F.col("high") >= 0.5 - RANK_ERROR)
    return ranked.select("payment_source", "payments", near.alias("within_error"))


@query
def q3_violations_customer(t):
    rows = expect.violations(t.customer_raw(DECLARATIVE), expect.CUSTOMER_RULES)
    return rows.select("customer_id", F.concat_ws(",", "violated_rules").alias("violated_rules"))


@query
def q3_violations_payment(t):
    rows = expect.violations(t.payment_raw(), expect.PAYMENT_RULES)
    return rows.select("payment_id", F.concat_ws(",", "violated_rules").alias("violated_rules"))


@query
def q4_stream_expectations(t):
    """Order rules enforced on a stream of order lines."""
    path, source = t.scratch("order_silver"), t.scratch("order_lines")
    t.order_item().write.parquet(source)
    stream = bronze.bronze_stream(t.spark, source, t.order_item().schema)
    payment_stream.apply_stream(stream, "order_silver", expect.ORDER_RULES, path, t.scratch("checkpoint"))
    return payment_stream.read_loaded(t.spark, path)


@query
def q4_stream_rule_counts(t):
    """The rule counts that the streamed expectations leave behind."""
    path, source = t.scratch("order_silver"), t.scratch("order_lines")
    t.order_item().write.parquet(source)
    stream = bronze.bronze_stream(t.spark, source, t.order_item().schema)
    payment_stream.apply_stream(stream, "order_silver", expect.ORDER_RULES, path, t.scratch("checkpoint"))
    counts = [F.sum(name).alias(name) for name in ("input_records", *(rule.name for rule in expect.ORDER_RULES))]
    return payment_stream.read_summary(t.spark, path).agg(*counts)


# --- gold -----------------------------------------------------------------------


@query
def g1_product_revenue_pg(t):
    return t.product_revenue(PG)


@query
def g2_product_revenue_notebook(t):
    return t.product_revenue(NOTEBOOK)


@query(ratios=2)
def g2b_product_revenue_allocated(t):
    lines = t.order_item().join(t.orders(), "order_id")
    return gold.product_revenue_allocated(t.product_silver(NOTEBOOK), lines, "total_amount")


@query
def g3_product_profit_declarative(t):
    return t.product_profit()


@query
def g4_product_profit_bundle(t):
    return gold.product_profit(t.product_silver(BUNDLE), t.order_silver(BUNDLE), BUNDLE)


@query
def g5_cancelled_product_pg(t):
    return t.cancelled_product(PG)


@query
def g5_cancelled_product_declarative(t):
    return t.cancelled_product(DECLARATIVE)


@query
def g5b_cancelled_product_orders(t):
    return gold.cancelled_product_orders(t.product_silver(PG), t.order_silver(PG))


@query
def g6_sales_region_pg(t):
    return t.sales_region(PG)


@query
def g6_sales_region_notebook(t):
    return t.sales_region(NOTEBOOK)


@query
def g6_sales_region_declarative(t):
    return t.sales_region(DECLARATIVE)


@query
def g6_sales_region_from_silver(t):
    """The same table built over line-grain Silver, orders counted by distinct id."""
    return gold.sales_region(t.order_silver(DECLARATIVE), t.customer_silver(DECLARATIVE), DECLARATIVE)


@query
def g6b_sales_region_order_grain(t):
    return gold.sales_region_order_grain(t.orders(), t.customer_silver(PG))


@query
def g7_sales_country_pg(t):
    return t.sales_country(PG)


@query
def g7_sales_country_notebook(t):
    return t.sales_country(NOTEBOOK)


@query
def g7_sales_country_declarative(t):
    return t.sales_country(DECLARATIVE)


@query
def g8_stripe_payment(t):
    return gold.stripe_payment(t.payment_silver())


@query(ratios=4)
def g9_payment_source(t):
    return gold.payment_source(t.payment_silver())


@query(ratios=4)
def g10_currency_distribution(t):
    return gold.currency_distribution(t.payment_silver())


@query(ratios=4)
def g10_currency_distribution_raw(t):
    return gold.currency_distribution(t.payment_raw())


@query
def r1_region_narrow(t):
    rows = t.customer_silver(PG).withColumn("region", map_region(F.col("country"), "narrow"))
    return rows.groupBy("country", "region").agg(F.count("*").alias("customers"))


@query
def r2_region_wide(t):
    rows = t.customer_silver(PG).withColumn("region", map_region(F.col("country"), "wide", "Other (null)"))
    return rows.groupBy("country", "region").agg(F.count("*").alias("customers"))


# --- analysis -------------------------------------------------------------------


@query
def a1_category_quantity(t):
    return analysis.category_quantity(t.product_revenue(NOTEBOOK))


@query
def a2_bucket_category(t):
    """Categories under 17 percent of all units folded together."""
    return analysis.bucket_small(
        analysis.category_quantity(t.product_revenue(NOTEBOOK)), "category_name", "total_quantity", 0.17
    )


@query
def a2_bucket_order_quantity(t):
    return analysis.bucket_small(
        analysis.order_quantity_distribution(t.order_silver(NOTEBOOK)), "quantity", "order_count", 0.02
    )


@query
def a3_top_products_revenue(t):
    return analysis.top_products_revenue(t.product_revenue(NOTEBOOK), 10)


@query
def a3_top5_products_revenue_pg(t):
    return analysis.top_products_revenue(t.product_revenue(PG), 5, "total_revenue")


@query
def a4_order_quantity_distribution(t):
    return analysis.order_quantity_distribution(t.order_silver(NOTEBOOK))


@query
def a5_discount_effect(t):
    return analysis.discount_effect(t.order_silver(NOTEBOOK))


@query
def a6_customer_order_frequency(t):
    return analysis.customer_order_frequency(t.order_silver(NOTEBOOK))


@query
def a6_order_frequency_histogram(t):
    return analysis.customer_order_frequency_histogram(t.order_silver(NOTEBOOK))


@query
def a7_top_products_quantity(t):
    return analysis.top_products_quantity(t.order_silver(NOTEBOOK), 10)


@query
def a8_cancellation_top(t):
    return analysis.cancellation_top(t.cancelled_product(), 10, 5)


@query
def a8_cancellation_summary(t):
    return analysis.cancellation_summary(t.cancelled_product())


@query
def a8_cancellation_histogram(t):
    return analysis.cancellation_histogram(t.cancelled_product(), 20)


@query
def a9_country_sales_named(t):
    return analysis.country_sales_named(t.sales_country(NOTEBOOK), 10)


@query
def a10_region_ranking(t):
    return analysis.region_ranking(t.sales_region(DECLARATIVE)).select("region", "total_sales", "order_count")


@query
def a10_region_aov(t):
    return analysis.region_aov(t.sales_region(PG))


@query
def a11_top_profit(t):
    return analysis.profit_top(t.product_profit(), 20).select("product_id", "product_name", "total_profit")


@query
def a11_profit_summary(t):
    return analysis.profit_summary(t.product_profit(), 20)


@query
def a11_profit_summary_all(t):
    return analysis.profit_summary(t.product_profit(), None)


@query
def a12_region_summary(t):
    return analysis.region_summary(t.sales_region(DECLARATIVE))


@query
def a13_region_share(t):
    return analysis.region_share(t.sales_region(DECLARATIVE))


@query
def a14_profit_distribution(t):
    return analysis.profit_distribution(t.product_profit())


@query
def a15_order_status(t):
    return analysis.order_status_distribution(t.orders())


@query
def a15_payment_trend(t):
    return analysis.payment_trend(t.payment(), "month")


@query
def t4k_preview(t):
    return analysis.preview(t.product_silver(DECLARATIVE), 10, "product_id")


# --- data quality ---------------------------------------------------------------


@query
def d1_country_coverage(t):
    return quality.country_coverage(t.sales_country(PG))


@query
def d1_country_count_with_null(t):
    return quality.country_count(t.sales_country(NOTEBOOK), count_null=True)


@query
def d2_date_range(t):
    return quality.date_range(t.orders())


@query
def d3_missing_country(t):
    return quality.missing_country(t.customer_silver(NOTEBOOK))


@query
def d4_status_conflicts(t):
    return quality.status_conflicts(t.customer_silver(NOTEBOOK))


@query
def d5_unattributed_sales(t):
    return quality.unattributed_sales(t.orders(), t.customer_silver(PG))


@query
def d6_column_checks(t):
    return quality.run_checks(
        t.payment(),
        {
            "payment_method_present": (quality.null_count("payment_method_id"), "null values in payment_method_id"),
            "stripe_currency_present": (quality.null_count("stripe_currency"), "null values in stripe_currency"),
            "amount_positive": (quality.non_positive_count("amount"), "non-positive amounts"),
        },
    )


@query
def d8_product_checks(t):
    return quality.product_checks(t.product())


@query
def d9_freshness(t):
    return quality.freshness(t.orders(), "order_date", 60, t.as_of())


# --- monitoring -----------------------------------------------------------------


@query
def m1_run_history(t):
    return monitor.run_history(t.run_log(), t.as_of())


@query
def m2_expectation_summary(t):
    return monitor.expectation_summary(t.run_log(), t.as_of())


@query
def m3_row_count_deltas(t):
    return monitor.row_count_deltas(t.run_log(), t.as_of(), "7 DAYS")


@query
def m3_row_count_deltas_paired(t):
    pairs = {"orders_bronze": "order_silver", "payment_postgres_bronze": "payment_silver"}
    return monitor.row_count_deltas(t.run_log(), t.as_of(), "7 DAYS", pairs)


@query
def m4_latest_run(t):
    return monitor.latest_run(t.run_log())


@query
def m5_duration_anomaly(t):
    return monitor.duration_anomaly(t.run_log(), t.as_of())


@query
def m6_cdc_lag(t):
    return monitor.cdc_lag(t.changes(), t.as_of(), 2)


@query
def m7_alerts(t):
    log, changes, as_of = t.run_log(), t.changes(), t.as_of()
    return monitor.alerts(monitor.alert_metrics(log, changes, as_of, gold.currency_distribution(t.payment_raw())))


@query
def m8_failed_runs(t):
    return monitor.failed_runs(t.run_log(), t.as_of())


@query(ratios=4)
def m9_conversion_accuracy(t):
    return monitor.conversion_accuracy(gold.currency_distribution(t.payment_raw()))


@query
def m10_record_run(t):
    """A full run over all layers, and what it logged about every table it touched."""
    log_path = t.scratch("run_log")
    medallion.run(t.spark, t.bronze(), t.scratch("tables"), log_path)
    log = monitor.read_log(t.spark, log_path).where(F.col("event_type") == monitor.FLOW)
    return log.select(
        F.col("origin.dataset").alias("dataset"),
        "num_output_rows",
        F.aggregate("expectations", F.lit(0).cast("bigint"), lambda total, e: total + e.failed_records).alias("failed"),
    )


def _dated_log(t) -> DataFrame:
    """The run log as appended to a folder by date."""
    path = t.scratch("run_log")
    monitor.record_run(t.run_log(), path)
    return monitor.read_log(t.spark, path)


@query
def m2_dated_log(t):
    """Pass rates of the latest run, from the dates it was logged under."""
    return monitor.expectation_summary(_dated_log(t), t.as_of())


@query
def m4_dated_log(t):
    """The latest run, from its own date."""
    return monitor.latest_run(_dated_log(t))


def _full_run(t, variant, bronze, name) -> DataFrame:
    """A full run of one form, its log read for success, and one of its published tables."""
    log_path = t.scratch("run_log")
    tables = medallion.run(t.spark, bronze, t.scratch("tables"), log_path, variant=variant)
    if monitor.read_log(t.spark, log_path).where(F.col("event_type") == monitor.FLOW).isEmpty():
        raise AssertionError("the run left no log")
    return tables[name]


@query
def m10_run_pg(t):
    return _full_run(t, PG, t.bronze(), "product_revenue_gold")


@query
def m10_run_notebook(t):
    return _full_run(t, NOTEBOOK, t.bronze(), "product_revenue_gold")


@query
def m10_run_bundle(t):
    bronze = {"product": t.product_named(), "orders": t.order_lines(), "payment_postgres": t.payment()}
    return _full_run(t, BUNDLE, bronze, "product_profit_gold")


# --- streaming ------------------------------------------------------------------


@query
def st1_bronze_ingest(t):
    """All ten Bronze tables ingested as streams, with their row counts."""
    landing, target = t.scratch("landing"), t.scratch("bronze")
    tables = t.bronze()
    for name, df in tables.items():
        df.write.parquet(f"{landing}/{name}")
    schemas = {name: df.schema for name, df in tables.items()}
    bronze.ingest_all(t.spark, schemas, landing, target, t.scratch("checkpoints"))
    written = {f"{name}_bronze": bronze.read_bronze(t.spark, f"{target}/{name}_bronze", schemas[name]) for name in tables}
    return quality.table_row_counts(written)


@query
def st2_schema_evolution(t):
    """Orders arrive without currency, then with it: the ingest notices the column by itself."""
    landing, target, checkpoint = t.scratch("landing"), t.scratch("orders_bronze"), t.scratch("checkpoint")
    log = schema_log.SchemaLog(t.spark, t.scratch("orders_schema"))
    for arriving in (t.orders().drop("currency"), t.orders()):
        arriving.write.mode("append").parquet(landing)
        schema_log.ingest_evolving(t.spark, landing, log, target, checkpoint)
    return schema_log.read_evolved(t.spark, log, target).groupBy("currency").agg(
        F.count("*").alias("row_count"), F.sum("total_amount").alias("total_amount")
    )


@query
def st4_gold_after_trigger(t):
    """Gold recomputed over what the last trigger ingested."""
    landing, target = t.scratch("landing"), t.scratch("bronze")
    tables = {name: df for name, df in t.bronze().items() if name in ("orders", "order_item")}
    for name, df in tables.items():
        df.write.parquet(f"{landing}/{name}")
    schemas = {name: df.schema for name, df in tables.items()}
    bronze.ingest_all(t.spark, schemas, landing, target, t.scratch("checkpoints"))
    orders, items = (bronze.read_bronze(t.spark, f"{target}/{name}_bronze", schemas[name]) for name in tables)
    totals = direct.order_totals(orders, items, variant=PG)
    return gold.sales_region_from_totals(totals, t.customer_silver(PG), PG, keyed=True)


@query
def st5_streaming_payment_load(t):
    """All events streamed as payments into the payment table's folder."""
    events = bronze.bronze_stream(t.spark, f"{t.folder}/events*.parquet", t.raw("events").schema)
    mapped = ingest.map_payments(payment_export.parse_payments(t.export_elements(events)))
    path = t.scratch("payment_loaded")
    payment_stream.stream_payments(mapped, t.payment(), path, t.scratch("checkpoint"))
    return payment_stream.read_loaded(t.spark, path).select("payment_id", "stripe_payment_id", "amount")


def _payments_in_files(t) -> tuple[str, DataFrame]:
    """The export elements in several files, as a stream of one file a batch."""
    source = t.scratch("payment_elements")
    t.export_elements().repartitionByRange(3, "position").write.parquet(source)
    stream = bronze.bronze_stream(t.spark, source, t.export_elements().schema, max_files=1)
    return t.scratch("payment_loaded"), ingest.map_payments(payment_export.parse_payments(stream))


@query
def st5_restarted_load(t):
    """Several batches, then all of them again on a new checkpoint: nothing is lost, doubled or renumbered."""
    path, mapped = _payments_in_files(t)
    payment_stream.stream_payments(mapped, t.payment(), path, t.scratch("checkpoint"))
    payment_stream.stream_payments(mapped, t.payment(), path, t.scratch("checkpoint"))
    return payment_stream.read_loaded(t.spark, path).agg(
        F.count("*").alias("loaded"), F.countDistinct("stripe_payment_id").alias("payments"),
        F.countDistinct("payment_id").alias("ids"), F.min("payment_id").alias("first_id"), F.max("payment_id").alias("last_id"),
    )


@query
def st5_quarantine(t):
    """What the streamed load could not store."""
    events = bronze.bronze_stream(t.spark, f"{t.folder}/events*.parquet", t.raw("events").schema)
    mapped = ingest.map_payments(payment_export.parse_payments(t.export_elements(events)))
    path = t.scratch("payment_loaded")
    payment_stream.stream_payments(mapped, t.payment(), path, t.scratch("checkpoint"))
    return payment_stream.read_quarantine(t.spark, path).select("position", "stripe_payment_id", "error_reason")


@query
def st6_continuous_ingest(t):
    """A continuous ingest, stopped once it has caught up."""
    path = t.scratch("orders_bronze")
    running = bronze.start_continuous(_orders_stream(t), path, t.scratch("checkpoint"), "1 second")
    running.processAllAvailable()
    running.stop()
    return bronze.read_bronze(t.spark, path, t.raw("orders").schema)


@query
def st7_latest_by_key(t):
    """The newest event of every user, from the event feed as a change log."""
    feed = t.raw("events").select("user_id", "ts", "event_id", "event_type", "value")
    return bronze.latest_by_key(feed, ["user_id"], "ts")


@query
def st7_latest_stream(t):
    """The same feed as a stream of three batches with late versions: state per user, upserts into buckets."""
    feed = t.raw("events").select("user_id", "ts", "event_id", "event_type", "value")
    source = t.scratch("changes")
    # Newest first, so that later batches bring late versions.
    feed.repartitionByRange(3, F.desc("ts"), F.desc("event_id")).write.parquet(source)
    stream = bronze.bronze_stream(t.spark, source, feed.schema, max_files=1)
    table = KeyedTable(t.spark, t.scratch("latest"), feed.schema, ["user_id"], 16)
    stream_latest(stream, table, "ts", t.scratch("checkpoint"))
    return table.read()
