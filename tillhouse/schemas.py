"""Declared schemas of the branch, warehouse and showcase tables, and their rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, DAY, MOMENT, FLAG = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()

AUDIT = ["created_at", "modified_at"]

# Fixed value: the card keys of store k lie in [k * CARD_RANGE, (k + 1) * CARD_RANGE).
CARD_RANGE = 10_000_000


@dataclass(frozen=True)
class Table:
    """Columns as (name, type, nullable), key, foreign keys, text limits, domains and defaults."""

    name: str
    columns: tuple[tuple[str, T.DataType, bool], ...]
    key: tuple[str, ...]
    references: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    domains: dict[str, tuple] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in self.columns])

    @property
    def names(self) -> list[str]:
        return [n for n, _, _ in self.columns]

    @property
    def required(self) -> list[str]:
        return [n for n, _, nullable in self.columns if not nullable]

    def with_audit(self) -> "Table":
        stamps = tuple((n, T.TimestampType(), False) for n in AUDIT)
        return Table(self.name, self.columns + stamps, self.key, self.references,
                     self.lengths, self.domains, self.defaults)


CARD = Table(
    "card",
    (("card_id", LONG, False), ("number", TEXT, False), ("first_name", TEXT, False),
     ("middle_name", TEXT, True), ("last_name", TEXT, False), ("birth_date", DAY, False)),
    ("card_id",),
    lengths={"number": 19, "first_name": 50, "middle_name": 50, "last_name": 50},
)
SUPPLIER = Table(
    "supplier",
    (("supplier_id", LONG, False), ("name", TEXT, False), ("inn", TEXT, False)),
    ("supplier_id",),
    lengths={"name": 50, "inn": 30},
)
PRODUCT = Table(
    "product",
    (("product_id", LONG, False), ("name", TEXT, False), ("vendor_code", TEXT, False),
     ("supplier_id", LONG, False)),
    ("product_id",),
    references={"supplier_id": "supplier"},
    lengths={"name": 50, "vendor_code": 30},
)
PRICE = Table(
    "price",
    (("price_id", LONG, False), ("product_id", LONG, False), ("cost", DOUBLE, False),
     ("cost_sale", DOUBLE, False), ("set_date", MOMENT, False)),
    ("price_id",),
    references={"product_id": "product"},
)
CHECK = Table(
    "check",
    (("check_id", LONG, False), ("card_id", LONG, False), ("check_date", MOMENT, False),
     ("payed", FLAG, False), ("payment_form", INT, True)),
    ("check_id",),
    references={"card_id": "card"},
    domains={"payment_form": (1, 2)},
    defaults={"payed": False},
)
LINE = Table(
    "line",
    (("product_id", LONG, False), ("check_id", LONG, False), ("price", DOUBLE, False),
     ("cnt", DOUBLE, False)),
    ("product_id", "check_id"),
    references={"product_id": "product", "check_id": "check"},
    defaults={"cnt": 0.0},
)
STORE = Table(
    "store",
    (("store_id", LONG, False), ("name", TEXT, False), ("address", TEXT, False),
     ("db_name", TEXT, False)),
    ("store_id",),
    lengths={"name": 50, "address": 50, "db_name": 50},
)
DATE = Table(
    "date",
    (("date_id", LONG, False), ("year", INT, False), ("month", INT, False), ("day", INT, False),
     ("day_of_week", INT, False), ("hour", INT, False), ("minute", INT, False),
     ("second", INT, False), ("date", MOMENT, False)),
    ("date_id",),
)
SALE_FACT = Table(
    "sale_fact",
    (("product_id", LONG, False), ("card_id", LONG, False), ("supplier_id", LONG, False),
     ("check_id", LONG, False), ("payed", FLAG, False), ("payment_form", INT, True),
     ("store_id", LONG, False), ("date_id", LONG, False), ("price", DOUBLE, False),
     ("cnt", DOUBLE, False)),
    ("product_id", "check_id", "store_id"),
    references={"product_id": "product", "card_id": "card", "supplier_id": "supplier",
                "store_id": "store", "date_id": "date"},
    domains={"payment_form": (1, 2)},
    defaults={"payed": False},
)
PRODUCT_PAIRS = Table(
    "product_pairs",
    (("amount", LONG, True), ("product_id", LONG, True), ("product_name", TEXT, True),
     ("vendor_code", TEXT, True), ("supplier_name", TEXT, True), ("product_id_2", LONG, True),
     ("product_name_2", TEXT, True), ("vendor_code_2", TEXT, True), ("supplier_name_2", TEXT, True)),
    (),
)

PAIR_COUNTS = Table(
    "pair_counts",
    (("product_id", LONG, False), ("supplier_id", LONG, False), ("sub_product_id", LONG, False), ("sub_supplier_id", LONG, False),
     ("amount", LONG, False)),
    ("product_id", "supplier_id", "sub_product_id", "sub_supplier_id"),
)
PULLED = Table(
    "pulled",
    (("db_name", TEXT, False), ("entity", TEXT, False), ("mark", T.TimestampType(), False)),
    ("db_name", "entity"),
)

BRANCH_TABLES = {t.name: t.with_audit() for t in (CARD, CHECK, SUPPLIER, PRODUCT, PRICE, LINE)}
WAREHOUSE_TABLES = {t.name: t for t in (CARD, SUPPLIER, PRODUCT, PRICE, STORE, DATE, SALE_FACT, PULLED)}
SHOWCASE_TABLES = {t.name: t for t in (PRODUCT_PAIRS, PAIR_COUNTS)}

# What a branch hands out for its products, cards and receipts.
PRODUCT_EXTRACT = T.StructType([
    T.StructField("price_id", LONG), T.StructField("cost", DOUBLE), T.StructField("cost_sale", DOUBLE),
    T.StructField("set_date", MOMENT), T.StructField("product_id", LONG), T.StructField("name", TEXT),
    T.StructField("vendor_code", TEXT), T.StructField("supplier_id", LONG),
    T.StructField("supplier_name", TEXT), T.StructField("inn", TEXT)])
CARD_EXTRACT = T.StructType([T.StructField(n, t) for n, t, _ in CARD.columns])
CHECK_EXTRACT = T.StructType([
    T.StructField("check_id", LONG), T.StructField("card_id", LONG), T.StructField("check_date", MOMENT),
    T.StructField("payed", FLAG), T.StructField("payment_form", INT), T.StructField("price", DOUBLE),
    T.StructField("cnt", DOUBLE), T.StructField("product_id", LONG), T.StructField("supplier_id", LONG)])
