"""Running stock per product and store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.skew import running_sums


def running_stock(batch: Batch) -> DataFrame:
    """Every movement with the stock after it, ordered by time and then movement id."""
    return running_sums(
        batch["inventory_movements"],
        ["product_id", "store_id"],
        ["movement_ts", "movement_id"],
        {"stock": F.col("quantity_delta")},
        batch.hot("inventory_movements", "product_id", "store_id"),
        batch.tasks("inventory_movements"),
    )
