"""Table specifications: one frozen description per replicated table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """What the engine needs to know about one system-versioned table.

    name          main table name as it appears in ``payload.source.table``
    archive       history table name (``<name>_archive`` by convention)
    key           business key field inside the row image
    row_schema    DDL of the row image carried in ``before``/``after``
    schema_name   ``payload.source.schema``
    topic         stream topic for the main table (archive topic derived)
    projection    select list turning the parsed image into table columns
    archive_projection  the same for the archive table (default: the main one's)
    date_key      column used for the as-of cut-off on the main table
    has_deleted   whether the archive table has the ``deleted`` flag

    Keys are whole numbers: the journal has one key column for all tables.
    """

    name: str
    key: str
    row_schema: str
    archive: str | None = None
    schema_name: str = "dbo"
    topic: str | None = None
    archive_topic: str | None = None
    projection: tuple[str, ...] = field(default_factory=tuple)
    archive_projection: tuple[str, ...] = field(default_factory=tuple)
    date_key: str = "valid_from"
    has_deleted: bool = True

    def __post_init__(self):
        kinds = {f.split()[0]: f.split()[1].upper() for f in self.row_schema.split(", ")}
        if kinds.get(self.key) not in ("BIGINT", "LONG", "INT", "INTEGER", "SMALLINT", "TINYINT"):
            raise ValueError(f"{self.name}: the key {self.key} must be a whole number, not {kinds.get(self.key)}")
        missing = [c for c in ("valid_from", "valid_to", self.date_key) if c not in kinds]
        if missing:
            raise ValueError(f"{self.name}: the row image has no {', '.join(missing)}")

    @property
    def archive_name(self) -> str:
        return self.archive or f"{self.name}_archive"

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.row_schema)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.struct.fields]

    @property
    def select_list(self) -> list[str]:
        return list(self.projection) or self.columns

    @property
    def archive_select_list(self) -> list[str]:
        return list(self.archive_projection) or self.select_list

    @staticmethod
    def from_json(text: str) -> "TableSpec":
        raw = json.loads(text)
        for name in ("projection", "archive_projection"):
            raw[name] = tuple(raw.get(name, ()))
        return TableSpec(**raw)

    @staticmethod
    def load(path: str) -> list["TableSpec"]:
        with open(path) as fh:
            return [TableSpec.from_json(json.dumps(item)) for item in json.load(fh)]


# The reference's source tables, for users replicating that schema.
# Table names, key fields and row-image fields as the reference declares them.
CUSTOMERS = TableSpec(
    name="customers", key="id",
    row_schema="id INT, first_name STRING, last_name STRING, email STRING, valid_from BIGINT, valid_to BIGINT")
PRODUCTS = TableSpec(
    name="products", key="id",
    row_schema="id INT, name STRING, description STRING, weight DOUBLE, valid_from BIGINT, valid_to BIGINT")
PRODUCTS_ON_HAND = TableSpec(
    name="products_on_hand", key="product_id",
    row_schema="product_id INT, quantity INT, valid_from BIGINT, valid_to BIGINT")
ORDERS = TableSpec(
    name="orders", key="id",
    row_schema="id INT, order_date INT, purchaser INT, quantity INT, product_id INT, valid_from BIGINT, valid_to BIGINT",
    projection=("id", "date_from_unix_date(order_date) AS order_date", "purchaser", "quantity", "product_id",
                "valid_from", "valid_to"))
REFERENCE_TABLES = (CUSTOMERS, PRODUCTS, PRODUCTS_ON_HAND, ORDERS)
