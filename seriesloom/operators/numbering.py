"""Dense numbering of a large frame without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.session import cut_lineage

ROW_BITS = 33


def number_in_order(df: DataFrame, order: list[str], name: str = "position", start_after: int = 0) -> DataFrame:
    """Number rows 1..N in the given order.

    Rows are range-partitioned and sorted; each partition then needs only the count of
    the partitions before it. The sorted rows are checkpointed, so both passes see the same order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_slot", F.monotonically_increasing_id())
    placed = cut_lineage(ranged)
    part = F.shiftright("_slot", ROW_BITS)
    offset = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offset = offset.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))  # one row per partition
    row_in_part = F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (placed.withColumn("_part", part).join(offset, "_part")
            .withColumn(name, F.col("_before") + row_in_part + 1 + start_after)
            .drop("_slot", "_part", "_before"))
