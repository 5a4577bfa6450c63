"""The test tables mapped onto the engine's source schemas, as DataFrames.

Every source is derived from the whole of a given table: nothing is sampled,
filtered by id or capped. Gaps (missing addresses, NULL flags) are injected by
expressions so that each rule and outer join has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.clock import epoch_seconds

# Nation key -> ISO-2 country.
NATION_COUNTRY = (
    "US", "CA", "DO", "CO", "PE", "BR", "JP", "CN", "ID", "TH", "PT", "NO", "FR",
    "PL", "RU", "ES", "SE", "ZW", "NG", "AF", "VE", "AR", "KZ", "DE", "GB",
)
# Run-log slot -> dataset; slot 0 is the run itself.
DATASETS = (
    "product_bronze", "brand_bronze", "product_category_bronze", "customer_bronze", "customer_type_bronze",
    "address_bronze", "orders_bronze", "order_item_bronze", "payment_postgres_bronze", "payment_method_bronze",
    "product_silver", "customer_silver", "order_silver", "payment_silver", "product_profit_gold",
    "cancelled_product_gold", "sales_region_gold", "sales_country_gold", "stripe_payment_gold",
)
MONEY = "decimal(18,2)"
# Schemas of the given tables, so that opening one starts no inference job.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _one_of(values, position: Column) -> Column:
    """The value at a zero-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(value) for value in values]), (position + 1).cast("int"))


class Sources:
    """Source tables over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- catalogue ---

    def product_category(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_type").alias("product_category_id"), F.col("p_type").alias("category_name")
        ).distinct()

    def brand(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_brand").alias("brand_id"), F.col("p_brand").alias("brand_name")
        ).distinct()

    def product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("product_name"),
            (F.col("p_retailprice") * 0.6).cast(MONEY).alias("price"),
            F.col("p_retailprice").cast(MONEY).alias("sell_price"),
            (F.col("p_size") % 10 != 0).alias("is_active"),
            F.col("p_type").alias("product_category_id"),
            F.col("p_brand").alias("brand_id"),
        )

    def product_named(self) -> DataFrame:
        """The bundle form's product source: names already on the row."""
        return self.product().select(
            "*", F.col("product_category_id").alias("category_name"), F.col("brand_id").alias("brand_name")
        )

    # --- customers ---

    def customer_type(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_mktsegment").alias("customer_type_id"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "inactive").otherwise("active").alias("type_name"),
        ).distinct()

    def customer(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("customer_id"),
            F.when(key % 30 != 0, "Customer").alias("first_name"),
            F.substring("c_name", 10, F.length("c_name")).alias("last_name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(key % 50 != 0, F.col("c_acctbal") >= 0).alias("is_active"),
            F.col("c_mktsegment").alias("customer_type_id"),
        )

    def address(self) -> DataFrame:
        """No address for every fourth customer, a second one for every fortieth."""
        key = F.col("c_custkey")
        home = F.struct(F.col("n_name").alias("city"), F.col("iso").alias("country"))
        second = F.struct(F.lit("SECOND").alias("city"), F.lit("CN").alias("country"))
        addresses = F.when(key % 40 == 1, F.array(home, second)).when(key % 4 != 0, F.array(home))
        nations = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name", _one_of(NATION_COUNTRY, F.col("n_nationkey")).alias("iso")
        )
        return (
            self.raw("customer")
            .join(nations, "c_nationkey")
            .select(key.alias("customer_id"), F.inline(addresses))
        )

    # --- orders ---

    def orders(self) -> DataFrame:
        key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
        total = F.col("o_totalprice").cast(MONEY)
        status = (
            F.when(F.col("o_orderstatus") == "P", "cancelled")
            .when(F.col("o_orderstatus") == "F", "completed")
            .otherwise("pending")
        )
        currency = (
            F.when(priority == "1-URGENT", "Euro")
            .when(priority == "2-HIGH", "Yuan Renminbi")
            .when(priority == "3-MEDIUM", "Yen")
            .when(priority == "4-NOT SPECIFIED", "Dollar")
            .otherwise("Doubloon")
        )
        return self.raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_custkey").alias("shipping_address_id"),
            F.col("o_orderdate").alias("order_date"),
            status.alias("order_status"),
            total.alias("subtotal"),
            F.when(key % 3 == 0, 10).when(key % 3 == 1, 0).cast(MONEY).alias("discount_amount"),
            total.alias("total_amount"),
            currency.alias("currency"),
        )

    def order_item(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.floor("l_quantity").cast("int").alias("quantity"),
        )

    def order_lines(self) -> DataFrame:
        """The bundle form's order source: product and quantity on the order row."""
        return self.orders().join(self.order_item().drop("order_item_id"), "order_id")

    # --- payments ---

    def payment_method(self) -> DataFrame:
        return self.spark.sql(
            "SELECT * FROM VALUES (0L, 'card'), (1L, 'bank_transfer'), (2L, 'wallet') AS m(payment_method_id, method_name)"
        )

    def payment(self) -> DataFrame:
        key = F.col("o_orderkey")
        amount = F.col("o_totalprice").cast(MONEY)
        external = key % 2 == 0
        currency = F.when(key % 3 == 0, "eur").when(key % 3 == 1, "usd").otherwise("gbp")
        drift = F.when(key % 34 == 0, F.lit("1.05")).otherwise("1.00").cast("decimal(3,2)")
        return self.raw("orders").select(
            key.alias("payment_id"),
            key.alias("order_id"),
            amount.alias("amount"),
            F.col("o_orderdate").alias("payment_date"),
            F.when(key % 7 != 0, key % 3).alias("payment_method_id"),
            F.when(external, F.concat(F.lit("pi_"), key.cast("string"))).alias("stripe_payment_id"),
            F.when(external, F.when(key % 5 == 0, "requires_payment_method").otherwise("succeeded")).alias("stripe_status"),
            F.when(external & (key % 22 != 0), currency).alias("stripe_currency"),
            F.when(external, F.concat(F.lit("cus_"), F.col("o_custkey").cast("string"))).alias("stripe_customer_id"),
            F.when(external, F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("stripe_amount_cents"),
            F.when(external & (key % 26 != 0), (amount * drift).cast(MONEY)).alias("stripe_amount_usd"),
            F.when(external, 1700000000 + key * 60).alias("stripe_created_timestamp"),
            F.when(key % 6 == 0, "order payment").alias("stripe_description"),
            F.when(external, F.concat(F.lit('{"order":'), key.cast("string"), F.lit("}"))).alias("stripe_metadata"),
        )

    def payment_fanned(self) -> DataFrame:
        """The payments again, with none for every fifth order and three for a third of the others."""
        key = F.col("order_id")
        copies = F.when(key % 5 == 0, 0).when(key % 3 == 1, 3).otherwise(1)
        split = Sources.payment(self).select("*", F.explode(F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), 1, copies)).alias("part"))
        amount = F.when(F.col("part") == 1, F.col("amount")).otherwise((F.col("part") * 10).cast(MONEY))
        return split.withColumns({"payment_id": F.col("payment_id") * 4 + F.col("part"), "amount": amount}).drop("part")

    def export_elements(self, events: DataFrame | None = None) -> DataFrame:
        """``(position, raw)``: every event as one payment of an export, as JSON text.

        Four consecutive events share an id, half of the ids are already in the
        payment table. The amount is an explicit null for every 97th event; the
        currency is absent for every eighth user and an explicit null for every
        eighth of the others.
        """
        event, user = F.col("event_id"), F.col("user_id")
        events = self.raw("events") if events is None else events
        currency = _one_of(("USD", "eur", "gbp", "cad", "aud", "jpy", "chf"), user % 7)
        currency_part = (
            F.when(user % 8 == 7, "")
            .when(user % 64 == 3, '"currency":null,')
            .otherwise(F.concat(F.lit('"currency":"'), currency, F.lit('",')))
        )
        cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
        amount = F.when(event % 97 == 0, "null").otherwise(cents)
        seconds = epoch_seconds(F.col("ts"))
        status = F.when(event % 4 == 0, "processing").when(event % 4 == 1, "canceled").otherwise("succeeded")
        raw = F.concat(
            F.lit('{"id":"pi_'), F.floor(event / 4).cast("string"),
            F.lit('","amount_received":'), amount,
            F.lit(","), currency_part,
            F.lit('"created":'), seconds.cast("string"),
            F.lit(',"status":"'), status,
            F.lit('","customer":"cus_'), user.cast("string"),
            F.lit('","metadata":'), F.col("props"), F.lit("}"),
        )
        return events.select(event.alias("position"), raw.alias("raw"))

    def bronze(self) -> dict[str, DataFrame]:
        """The ten Bronze tables."""
        return {
            "product": self.product(), "brand": self.brand(), "product_category": self.product_category(),
            "customer": self.customer(), "customer_type": self.customer_type(), "address": self.address(),
            "orders": self.orders(), "order_item": self.order_item(),
            "payment_postgres": self.payment(), "payment_method": self.payment_method(),
        }

    # --- run log and change feed ---

    def run_log(self) -> DataFrame:
        """Every event is one log row: a run update where its slot is 0, else a dataset flow."""
        event, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
        slot = event % 20
        is_run = slot == 0
        dataset = _one_of(("",) + DATASETS, slot)
        written = F.when(dataset.endswith("_silver"), 500 + event % 500).otherwise(1000 + event % 100)
        expectations = F.array(
            F.struct(dataset.alias("dataset"), F.lit("valid_key").alias("name"),
                     written.alias("passed_records"), F.lit(0).cast("bigint").alias("failed_records")),
            F.struct(dataset.alias("dataset"), F.lit("soft_rule").alias("name"),
                     written.alias("passed_records"), (written % 90).alias("failed_records")),
        )
        state = F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").otherwise("COMPLETED")
        cause = F.when(user % 3 == 0, "USER_ACTION").when(user % 3 == 1, "SCHEDULE").otherwise("RETRY")
        end = F.timestamp_add("SECOND", F.floor(F.col("value") * 6).cast("int"), F.col("ts"))
        return self.raw("events").select(
            F.concat(F.lit("u"), F.lpad((event - slot).cast("string"), 12, "0")).alias("update_id"),
            F.when(is_run, "update_progress").otherwise("flow_progress").alias("event_type"),
            F.col("ts").alias("timestamp"),
            F.when(is_run, state).alias("state"),
            F.when(is_run, F.col("ts")).alias("start_time"),
            F.when(is_run, end).alias("end_time"),
            F.when(is_run, cause).alias("cause"),
            F.when(is_run & (kind == "error"), "boom").alias("error_message"),
            F.when(~is_run, F.struct(dataset.alias("dataset"))).alias("origin"),
            F.when(~is_run, written).alias("num_output_rows"),
            F.when(dataset.endswith("_silver"), expectations).alias("expectations"),
        )

    def as_of(self) -> Column:
        """The newest event time as a literal."""
        newest = self.raw("events").agg(F.max("ts").cast("string").alias("ts")).first()["ts"]
        return F.lit(newest).cast("timestamp_ntz")

    def changes(self) -> DataFrame:
        """A change feed: the event type stands for the source table."""
        return self.raw("events").select(
            F.col("event_type").alias("table_name"), F.col("ts").alias("_commit_timestamp"), "user_id", "event_id", "value"
        )
