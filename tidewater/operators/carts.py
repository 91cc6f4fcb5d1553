"""Cart additions from change rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.contract import CART_COLUMNS, CART_TABLE
from tidewater.operators.scale import BROADCAST_ROWS, lookup_side


def cart_adds(
    changes: DataFrame, database: str, scoped: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows put into a cart: inserts, and updates that raised the quantity.

    The quantity is the number added, so for updates the difference. As in SQL
    without parentheses, where AND binds before OR, database and table restrict
    inserts only; ``scoped`` makes them restrict updates too. ``keep`` names columns of the
    changes that are passed on.
    """
    new, old = _quantity("data"), _quantity("old")
    in_cart = (F.col("database") == database) & (F.col("table") == CART_TABLE)
    inserted = F.col("type") == "insert"
    raised = (F.col("type") == "update") & F.col("old")["sku_num"].isNotNull() & (new > old)
    kept = in_cart & (inserted | raised) if scoped else (in_cart & inserted) | raised
    columns = {name: F.col("data")[name] for name in CART_COLUMNS}
    columns["sku_num"] = F.when(inserted, columns["sku_num"]).otherwise(
        F.try_subtract(new, old).cast("string")
    )
    extra = [name for name in ("pt", *keep) if name in changes.columns]
    return changes.where(kept).select(
        *[column.alias(name) for name, column in columns.items()], *extra
    )


def _quantity(side: str) -> Column:
    return F.col(side)["sku_num"].try_cast("int")


def with_source_type_name(
    cart: DataFrame, dictionary: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``source_type_name`` from the dictionary; NULL if the code is unknown."""
    names = dictionary.select(
        F.col("dic_code").alias("source_type"), F.col("dic_name").alias("source_type_name")
    )
    joined = cart.join(lookup_side(names, max_rows), "source_type", "left")
    return joined.select(*cart.columns, "source_type_name")
