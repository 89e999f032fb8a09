"""Table contracts: schemas, keys, relationships and run constants.

Spark does not enforce NOT NULL, lengths, primary or foreign keys on files,
so they live here and are checked by the quality operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Tables produced by the data generator; one parquet file each.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Declared primary keys of the relational driver tables.
PRIMARY_KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    child_cols: tuple
    parent: str
    parent_cols: tuple


# Relationship graph of the driver tables (child -> parent).
FOREIGN_KEYS = (
    ForeignKey("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
)

# The ten customer fields of the bronze/silver customer flow, in source order.
CUSTOMER_FIELDS = (
    "customer_id", "store_id", "first_name", "last_name", "email",
    "address_id", "activebool", "create_date", "last_update", "active",
)


@dataclass(frozen=True)
class TypedColumn:
    name: str
    sql_type: str
    default: object = None
    rename: str | None = None


@dataclass(frozen=True)
class TypedContract:
    """Contract of a typed bronze table: target type, default, rename."""
    table: str
    columns: tuple = field(default_factory=tuple)


# Typed bronze contract for orders (stands in for the rental/film models:
# source types kept, defaults for missing values, the change timestamp
# renamed with a source_ prefix).
ORDERS_TYPED = TypedContract("orders", (
    TypedColumn("o_orderkey", "bigint"),
    TypedColumn("o_custkey", "bigint"),
    TypedColumn("o_orderstatus", "string", "O"),
    TypedColumn("o_totalprice", "decimal(12,2)", "0.00"),
    TypedColumn("o_orderdate", "timestamp_ntz", None, "source_o_orderdate"),
    TypedColumn("o_orderpriority", "string", "5-LOW"),
))

# Where the registry's tables come from, as a connection text with a secret in it.
CONNECTION_TEXT = "Driver=parquet;Server=local;UID=reader;PWD=s3cret;"

# Longest name that the customer tables hold.
NAME_CHARS = 45

# Fixed run parameters used by registered queries so that results are
# reproducible (never now() or uuid() inside a query).
BATCH_ID = "batch_001"
NEXT_BATCH_ID = "batch_002"
LOAD_TS = "2024-01-01 00:00:00"
NEXT_LOAD_TS = "2024-02-01 00:00:00"
LAST_LOAD_TS = "2024-03-01 00:00:00"
AS_OF_DATE = "2024-06-30"
