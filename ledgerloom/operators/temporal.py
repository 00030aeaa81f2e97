"""Order lines against product versions: valid time, knowledge time, exactly one match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.batch import Batch
from ledgerloom.functions.predicates import valid_at
from ledgerloom.operators.aggregates import order_times
from ledgerloom.skew import lookup_join

LINE = ["order_id", "line_id", "product_id"]
EVENT = [*LINE, "order_ts"]
VERSION = ["category", "effective_from", "effective_to", "loaded_at"]

#: Segments of one product that stand in one row.
SEGMENTS_PER_ROW = 128


def known_versions(products: DataFrame, knowledge_time: int) -> DataFrame:
    return products.filter(F.col("loaded_at") <= knowledge_time)


def line_events(batch: Batch, *measures: Column) -> DataFrame:
    """One row per distinct line of a known order, with its order time and optional measures.

    Grouping after the join needs no exchange of its own: the join already placed the rows by order.
    """
    joined = lookup_join(
        batch["order_lines"],
        order_times(batch["orders"]),
        ["order_id"],
        "inner",
        batch.hot("order_lines", "order_id"),
        batch.tasks("order_lines"),
    )
    if measures:
        return joined.groupBy(*EVENT).agg(*measures)
    return joined.select(*EVENT).distinct()


def temporal_match(events: DataFrame, batch: Batch) -> DataFrame:
    """Every event with each known version valid at its time, or with nulls when there is none."""
    versions = known_versions(batch["products"], batch.knowledge_time).select(
        F.col("product_id").alias("matched_product_id"), *VERSION
    )
    condition = (F.col("product_id") == F.col("matched_product_id")) & valid_at(
        F.col("effective_from"), F.col("effective_to"), F.col("order_ts")
    )
    return events.join(versions, condition, "left").drop("matched_product_id")


def segments(batch: Batch) -> DataFrame:
    """Each product's time line cut where a known version begins or ends, without overlaps.

    (segment_product, segment_from, segment_to, dimension_matches, version columns): how many versions
    are in force from segment_from up to segment_to (null: for good), and the version where it is one.
    Versions become +1 / -1 steps whose running sums count those in force; with exactly one in force the
    sums of its own columns are that version. All of this is work on the dimension alone.
    """
    versions = known_versions(batch["products"], batch.knowledge_time).filter(
        F.col("product_id").isNotNull()
        & F.col("effective_from").isNotNull()
        & (F.col("effective_to").isNull() | (F.col("effective_from") < F.col("effective_to")))
    )

    def step(sign: int, moment: str) -> list[Column]:
        return [
            F.col("product_id").alias("segment_product"),
            F.col(moment).alias("segment_from"),
            F.lit(sign).cast("bigint").alias("d_count"),
            (F.col("effective_from") * sign).alias("d_from"),
            (F.coalesce(F.col("effective_to"), F.lit(0)) * sign).alias("d_to"),
            F.when(F.col("effective_to").isNull(), sign).otherwise(0).cast("bigint").alias("d_open"),
            (F.coalesce(F.col("loaded_at"), F.lit(0)) * sign).alias("d_loaded"),
        ]

    steps = versions.select(*step(1, "effective_from")).unionByName(
        versions.filter(F.col("effective_to").isNotNull()).select(*step(-1, "effective_to"))
    )
    moments = steps.groupBy("segment_product", "segment_from").agg(
        *[F.sum(name).alias(name) for name in ("d_count", "d_from", "d_to", "d_open", "d_loaded")]
    )
    line = Window.partitionBy("segment_product").orderBy("segment_from")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = moments.select(
        "segment_product",
        "segment_from",
        F.lead("segment_from").over(line).alias("segment_to"),
        F.sum("d_count").over(so_far).alias("dimension_matches"),
        F.sum("d_from").over(so_far).alias("at_from"),
        F.sum("d_to").over(so_far).alias("at_to"),
        F.sum("d_open").over(so_far).alias("at_open"),
        F.sum("d_loaded").over(so_far).alias("at_loaded"),
    )
    unique = F.col("dimension_matches") == 1
    described = versions.select(F.col("product_id").alias("v_product"), *VERSION)
    same = (
        unique
        & (F.col("segment_product") == F.col("v_product"))
        & (F.col("at_from") == F.col("effective_from"))
        & ((F.col("at_open") == 1) == F.col("effective_to").isNull())
        & (F.col("at_to") == F.coalesce(F.col("effective_to"), F.lit(0)))
        & (F.col("at_loaded") == F.col("loaded_at"))
    )
    return summed.join(described, same, "left").select(
        "segment_product", "segment_from", "segment_to", "dimension_matches", *VERSION
    )


def search(starts: str, moment: str) -> Column:
    """Place of the last of sorted starts that is not after the moment, -1 if there is none.

    A binary search as one expression: from the largest power of two downwards, a step is taken where the start
    it leads to is not too late.
    """
    starts, moment = F.col(starts), F.col(moment)
    powers = F.sequence(F.ceil(F.log2(F.size(starts) + 1)).cast("int"), F.lit(0), F.lit(-1))
    return F.aggregate(
        F.transform(powers, lambda power: F.pow(F.lit(2), power).cast("int")),
        F.lit(-1),
        lambda place, step: place
        + F.when(F.get(starts, place + step) <= moment, step).otherwise(F.lit(0)),
    )


def segment_rows(batch: Batch) -> DataFrame:
    """Segments as sorted arrays: (segment_product, chunk, starts, items), SEGMENTS_PER_ROW at most in a row.

    Chunks are runs of a product's segments in time, numbered from 0. Written once per batch.
    """

    def build() -> DataFrame:
        line = Window.partitionBy("segment_product").orderBy("segment_from")
        item = F.struct("segment_from", "dimension_matches", *VERSION)
        place = F.row_number().over(line) - 1
        return (
            segments(batch)
            .select(
                "segment_product",
                item.alias("item"),
                F.floor(place / SEGMENTS_PER_ROW).cast("int").alias("chunk"),
                "segment_from",
            )
            .groupBy("segment_product", "chunk")
            .agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select("segment_product", "chunk", F.col("items.segment_from").alias("starts"), "items")
        )

    return batch.kept("segments", build)


def dimension_matches(events: DataFrame, batch: Batch) -> DataFrame:
    """Events with `dimension_matches` and the version columns, set where the match is unique.

    An equi join on the product brings each event its product's sorted segments, and a binary search finds
    the one the event lies in, so the time does not depend on the versions of a product. A product with more
    segments than a row holds has a directory instead: the starts of its chunks. A binary search there gives
    the chunk, which is a second key of a second equi join. One row comes out for each event, repeated events
    included. Events are the left side: whichever join Spark takes for the size it meets, it can split the
    events of a hot product.
    """
    rows = segment_rows(batch)
    long_products = (
        rows.groupBy("segment_product")
        .agg(F.sort_array(F.collect_list(F.get("starts", F.lit(0)))).alias("heads"))
        .filter(F.size("heads") > 1)
    )
    if rows.filter("chunk > 0").isEmpty():
        found = _found(events, rows.drop("chunk"), F.lit(True))
    else:
        # Chunk 0 of every product, and the directory of the long ones.
        first = rows.filter("chunk = 0").drop("chunk").join(long_products, "segment_product", "left")
        shallow = _found(events, first, F.col("heads").isNull(), "heads").withColumn(
            "chunk", F.when(F.col("heads").isNotNull(), search("heads", "order_ts"))
        )
        deeper = rows.filter("chunk >= 0").join(
            long_products.select("segment_product"), "segment_product", "left_semi"
        )
        kept = [*events.columns, "item"]
        found = _found(
            shallow.select(*kept, "chunk").withColumnRenamed("item", "shallow_item"),
            deeper.withColumnRenamed("chunk", "of_chunk"),
            F.lit(True),
            on=F.col("chunk") == F.col("of_chunk"),
        ).withColumn("item", F.coalesce("shallow_item", "item"))
    return found.select(
        *events.columns,
        F.coalesce("item.dimension_matches", F.lit(0).cast("bigint")).alias("dimension_matches"),
        *[F.col(f"item.{name}").alias(name) for name in VERSION],
    )


def _found(
    events: DataFrame, rows: DataFrame, is_whole: Column, *carried: str, on: Column | None = None
) -> DataFrame:
    """Events with the item of their product's row that they lie in, where the row is whole."""
    same = F.col("product_id") == F.col("segment_product")
    joined = events.join(rows, same if on is None else same & on, "left")
    # Before the first start the place is -1, and nothing is there.
    item = F.when(is_whole, F.get(F.col("items"), search("starts", "order_ts")))
    return joined.select(*events.columns, *carried, item.alias("item"))


def resolve_product(batch: Batch) -> DataFrame:
    """Each line with its product version, null columns unless exactly one version matches."""
    return dimension_matches(line_events(batch), batch)


def resolved_sales(batch: Batch) -> DataFrame:
    """Revenue by category over lines whose product version is unique."""
    events = line_events(
        batch,
        F.sum("line_total_cents").alias("line_total_cents"),
        F.sum("quantity").alias("quantity"),
    )
    return (
        dimension_matches(events, batch)
        .filter(F.col("dimension_matches") == 1)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("line_total_cents").alias("revenue_cents"),
        )
    )
