"""Table registry: bronze schemas and the silver policy of every retail table.

One ``TableSpec`` per table tells every operator what it needs: the typed
bronze schema (schema-on-read, projected by name, never positionally), the
business key, the change-tracked columns, the quarantine rule, how the
source is extracted and how silver is maintained.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SCD2 = "scd2"
FULL_REFRESH = "full_refresh"

FULL = "full"
INCREMENTAL = "incremental"

# Columns silver adds on top of bronze.
IS_QUARANTINED = "is_quarantined"
EFFECTIVE_START = "effective_start_date"
EFFECTIVE_END = "effective_end_date"
IS_ACTIVE = "is_active"
SCD2_COLUMNS = (EFFECTIVE_START, EFFECTIVE_END, IS_ACTIVE)


def _schema(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(","):
        name, typ = part.strip().split()
        fields.append(T.StructField(name, _TYPES[typ](), True))
    return T.StructType(fields)


_TYPES = {"bigint": T.LongType, "string": T.StringType, "double": T.DoubleType,
          "boolean": T.BooleanType, "timestamp": T.TimestampType, "date": T.DateType}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    tracked: tuple[str, ...] = ()
    quarantine_if_null: tuple[str, ...] = ()
    silver_policy: str = FULL_REFRESH
    dedup: bool = False
    load_type: str = FULL
    watermark_col: str | None = None
    source: str = "retailer"
    landing_format: str = "json"
    extra: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def has_quarantine(self) -> bool:
        return bool(self.quarantine_if_null)

    def silver_schema(self) -> T.StructType:
        fields = list(self.schema.fields)
        if self.has_quarantine:
            fields.append(T.StructField(IS_QUARANTINED, T.BooleanType(), True))
        if self.silver_policy == SCD2:
            fields += [T.StructField(EFFECTIVE_START, T.TimestampType(), True),
                       T.StructField(EFFECTIVE_END, T.TimestampType(), True),
                       T.StructField(IS_ACTIVE, T.BooleanType(), True)]
        return T.StructType(fields)


# The bronze schemas, keys, tracked columns, quarantine rules,
# load types and watermark columns of the eight retail tables.
CUSTOMERS = TableSpec(
    "customers", _schema("customer_id bigint, name string, email string, updated_at string"),
    keys=("customer_id",), tracked=("name", "email", "updated_at"),
    quarantine_if_null=("customer_id", "email", "name"),
    silver_policy=SCD2, dedup=True, load_type=INCREMENTAL, watermark_col="updated_at")

ORDERS = TableSpec(
    "orders", _schema("order_id bigint, customer_id bigint, order_date string, "
                      "total_amount double, updated_at string"),
    keys=("order_id",), tracked=("customer_id", "order_date", "total_amount", "updated_at"),
    silver_policy=SCD2, dedup=True, load_type=INCREMENTAL, watermark_col="updated_at")

ORDER_ITEMS = TableSpec(
    "order_items", _schema("order_item_id bigint, order_id bigint, product_id bigint, "
                           "quantity bigint, price double, updated_at string"),
    keys=("order_item_id",), tracked=("order_id", "product_id", "quantity", "price", "updated_at"),
    silver_policy=SCD2, dedup=True, load_type=INCREMENTAL, watermark_col="updated_at")

PRODUCT_SUPPLIERS = TableSpec(
    "product_suppliers", _schema("supplier_id bigint, product_id bigint, supply_price double, "
                                 "last_updated string"),
    keys=("supplier_id", "product_id"), tracked=("supply_price", "last_updated"),
    silver_policy=SCD2, dedup=False, load_type=INCREMENTAL, watermark_col="last_updated",
    source="supplier")

CUSTOMER_REVIEWS = TableSpec(
    "customer_reviews", _schema("id string, customer_id bigint, product_id bigint, rating bigint, "
                                "review_text string, review_date string"),
    keys=("id",), tracked=("customer_id", "product_id", "rating", "review_text", "review_date"),
    silver_policy=SCD2, dedup=False, load_type=FULL, source="reviews", landing_format="parquet")

CATEGORIES = TableSpec(
    "categories", _schema("category_id bigint, name string, updated_at string"),
    quarantine_if_null=("category_id", "name"), load_type=FULL)

PRODUCTS = TableSpec(
    "products", _schema("product_id bigint, name string, category_id bigint, price double, "
                        "updated_at string"),
    # product_id is deliberately not part of the rule (as in the reference).
    quarantine_if_null=("category_id", "name"), load_type=FULL)

SUPPLIERS = TableSpec(
    "suppliers", _schema("supplier_id bigint, supplier_name string, contact_name string, "
                         "phone string, email string, address string, city string, "
                         "country string, created_at string"),
    quarantine_if_null=("supplier_id", "supplier_name"), load_type=FULL, source="supplier")

REGISTRY: dict[str, TableSpec] = {s.name: s for s in (
    CUSTOMERS, ORDERS, ORDER_ITEMS, PRODUCT_SUPPLIERS, CUSTOMER_REVIEWS,
    CATEGORIES, PRODUCTS, SUPPLIERS)}

SCD2_TABLES = tuple(n for n, s in REGISTRY.items() if s.silver_policy == SCD2)
FULL_REFRESH_TABLES = tuple(n for n, s in REGISTRY.items() if s.silver_policy == FULL_REFRESH)

# Audit and log tables. ``last_id`` (as text) is the greatest id extracted at the
# watermark, the tie breaker of keyset extracts; other extracts leave it NULL.
AUDIT_SCHEMA = _schema("run_id string, load_date date, table_name string, load_type string, "
                       "rows_loaded bigint, watermark_col_name string, watermark timestamp, last_id string")
AUDIT_V1_SCHEMA = _schema("tablename string, load_type string, record_count bigint, "
                          "load_timestamp timestamp, status string")
LOG_SCHEMA = _schema("timestamp string, event_type string, message string, table string")
CONFIG_CSV_SCHEMA = _schema("database string, datasource string, tablename string, "
                            "loadtype string, watermark string, is_active string, targetpath string")
