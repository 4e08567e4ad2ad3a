"""A seeded shop data set of five related tables, generated where it is written: no row passes the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = 1_767_225_600  # 2026-01-01 UTC
DAY = 86_400
STATES, CITIES = ["AC", "BA", "CE", "DF", "ES", "GO"], ["rio", "recife", "belem", "manaus", "natal", "santos"]
STATUSES, CATEGORIES = ["delivered", "delivered", "delivered", "shipped", "invoiced", "processing", "created", "canceled"], ["toys", "garden", "books", "kitchen", "sports"]


class Seed:
    def __init__(self, spark: SparkSession, rows: int, seed: int = 42, nulls: float = 0.03, duplicates: float = 0.015, late: float = 0.02, days: int = 540):
        self.spark, self.rows, self.seed, self.nulls, self.duplicates, self.late, self.days = spark, rows, seed, nulls, duplicates, late, days
        size = lambda n: max(1, rows // n)
        self.sizes = {"customers": size(10), "orders": size(2), "products": size(100), "sellers": size(500), "order_items": max(1, rows)}

    def _u(self, name: str) -> Column:
        """A uniform number of a row and a purpose, the same on every run and partitioning."""
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(name), "id"), F.lit(1 << 30)) / (1 << 30)

    def _pick(self, name: str, items: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, items)), F.floor(self._u(name) * len(items)).cast("int") + 1)

    def _ref(self, name: str, table: str, prefix: str) -> Column:
        return F.format_string(prefix + "_%08d", F.floor(self._u(name) * self.sizes[table]).cast("bigint"))

    def _gap(self, name: str, c: Column) -> Column:
        return F.when(self._u(f"null-{name}") >= self.nulls, c)

    def _time(self) -> Column:
        return (F.lit(EPOCH) + F.floor(self._u("time") * self.days * DAY)).cast("bigint")

    def _updated(self, at: Column) -> Column:
        after, before = at + F.floor(self._u("lag") * 7200), at - DAY - F.floor(self._u("lag") * 29 * DAY)
        return F.when(self._u("late") < self.late, before).otherwise(after).cast("bigint")

    def table(self, name: str) -> DataFrame:
        base = self.spark.range(self.sizes[name]).withColumn("at", self._time())
        own = lambda p: F.format_string(p + "_%08d", "id")
        digits = lambda n, k: F.lpad(F.floor(self._u(n) * 10**k).cast("string"), k, "0")
        updated = self._updated(F.col("at")).alias("updated_at")
        columns = {
            "customers": lambda: [
                own("cust").alias("customer_id"), F.concat(F.lit("Customer "), "id").alias("customer_name"), F.concat(F.lit("c"), "id", F.lit("@example.com")).alias("customer_email"),
                self._gap("phone", F.concat(F.lit("+55 "), digits("phone", 9))).alias("customer_phone"),
                F.concat(digits("d1", 3), F.lit("."), digits("d2", 3), F.lit("."), digits("d3", 3), F.lit("-"), digits("d4", 2)).alias("customer_document"),
                self._gap("city", self._pick("city", CITIES)).alias("customer_city"), self._pick("state", STATES).alias("customer_state"), (F.floor(self._u("zip") * 90000) + 10000).cast("int").alias("customer_zip_prefix"), updated,
            ],
            "products": lambda: [own("prod").alias("product_id"), self._pick("category", CATEGORIES).alias("product_category"), self._gap("weight", F.round(self._u("weight") * 5000 + 50, 1)).alias("product_weight_g"), updated],
            "sellers": lambda: [own("sell").alias("seller_id"), self._pick("city", CITIES).alias("seller_city"), self._pick("state", STATES).alias("seller_state"), updated],
            "orders": lambda: [
                own("ord").alias("order_id"), self._ref("customer", "customers", "cust").alias("customer_id"), self._pick("status", STATUSES).alias("order_status"), F.col("at").alias("purchased_at"),
                F.when(self._pick("status", STATUSES) == "delivered", F.col("at") + DAY + F.floor(self._u("delivery") * 20 * DAY)).cast("bigint").alias("delivered_at"), updated,
            ],
            "order_items": lambda: [
                own("item").alias("order_item_id"), self._ref("order", "orders", "ord").alias("order_id"), self._ref("product", "products", "prod").alias("product_id"), self._ref("seller", "sellers", "sell").alias("seller_id"),
                F.round(self._u("price") * 500 + 5, 2).alias("price"), F.round(self._u("freight") * 50, 2).alias("freight_value"), updated,
            ],
        }[name]()
        if name in ("orders", "order_items"):  # a share of fact rows comes twice
            base = base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(self._u("twice") < self.duplicates, 1).otherwise(0)))).drop("copy")
        return base.select(*columns)

    def write(self, root: str) -> None:
        for name in self.sizes:
            self.table(name).write.mode("overwrite").parquet(f"{root}/{name}.parquet")
