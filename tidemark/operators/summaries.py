"""Sales summaries by dimension.

The fact is aggregated by the dimension's key before the join. Every group then arrives at
the join as one row, so a customer or product with a third of all lines costs nothing
extra. The final grouping by key and attributes reuses that partitioning; it merges the
partial results should the dimension repeat a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_summary(
    fact: DataFrame,
    customers: DataFrame,
    on: Sequence[str],
    attributes: Sequence[str],
    order: str = "order_number",
    amount: str = "sales_amount",
    quantity: str = "quantity",
    ordered: str = "order_date",
) -> DataFrame:
    """Lines, sales, quantity, average line, first and last order day per customer.

    ``total_orders`` counts lines with an order number, not distinct orders. Facts without
    a customer drop out.
    """
    per_key = fact.groupBy(*on).agg(
        F.count(order).alias("lines"),
        F.sum(amount).alias("sales"),
        F.count(amount).alias("sales_known"),
        F.sum(quantity).alias("quantity"),
        F.min(ordered).alias("first_day"),
        F.max(ordered).alias("last_day"),
    )
    joined = per_key.join(customers.select(*on, *attributes), list(on))
    return joined.groupBy(*on, *attributes).agg(
        F.sum("lines").alias("total_orders"),
        F.sum("sales").alias("total_sales"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.try_divide(F.sum("sales"), F.sum("sales_known")).alias("avg_order_value"),
        F.min("first_day").alias("first_order_date"),
        F.max("last_day").alias("last_order_date"),
        F.datediff(F.max("last_day"), F.min("first_day"))
        .cast("bigint")
        .alias("days_since_first_order"),
    )


def product_summary(
    fact: DataFrame,
    products: DataFrame,
    on: Sequence[str],
    attributes: Sequence[str],
    cost: str = "cost",
    order: str = "order_number",
    amount: str = "sales_amount",
    quantity: str = "quantity",
    price: str = "sls_price",
    ordered: str = "order_date",
) -> DataFrame:
    """Lines, sales, quantity, averages, cost and profit per product.

    ``cost`` is one of ``attributes``: it is constant within a group, so cost totals follow
    from quantity totals. Profit only counts lines on which amount and quantity are known.
    """
    both_known = F.col(amount).isNotNull() & F.col(quantity).isNotNull()
    per_key = fact.groupBy(*on).agg(
        F.count(order).alias("lines"),
        F.sum(amount).alias("sales"),
        F.count(amount).alias("sales_known"),
        F.sum(quantity).alias("quantity"),
        F.sum(price).alias("prices"),
        F.count(price).alias("prices_known"),
        F.sum(F.when(both_known, F.col(amount))).alias("margin_sales"),
        F.sum(F.when(both_known, F.col(quantity))).alias("margin_quantity"),
        F.min(ordered).alias("first_day"),
        F.max(ordered).alias("last_day"),
    )
    joined = per_key.join(products.select(*on, *attributes), list(on))
    unit_cost = F.col(cost).cast("bigint")
    return joined.groupBy(*on, *attributes).agg(
        F.sum("lines").alias("total_orders"),
        F.sum("sales").alias("total_sales"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.try_divide(F.sum("sales"), F.sum("sales_known")).alias("avg_sales_per_order"),
        F.try_divide(F.sum("prices"), F.sum("prices_known")).alias("avg_unit_price"),
        F.sum(F.col("quantity") * unit_cost).alias("total_cost"),
        F.sum(F.col("margin_sales") - F.col("margin_quantity") * unit_cost).alias("total_profit"),
        F.min("first_day").alias("first_sale_date"),
        F.max("last_day").alias("last_sale_date"),
    )


def top_rows(df: DataFrame, by: str, tiebreak: Sequence[str], n: int) -> DataFrame:
    """The ``n`` greatest rows by one column, ties settled by other columns."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]).limit(n)


def load_stats(df: DataFrame, day: str, entity: str, flag) -> DataFrame:
    """Rows, distinct entities, share and number of flagged rows per partition."""
    marked = df.select(
        F.col(day).alias("day"), F.col(entity).alias("entity"), flag.cast("int").alias("flagged")
    )
    # One row per day and entity first, so that counting entities needs no distinct set.
    per_entity = marked.groupBy("day", "entity").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("flagged").alias("flagged"),
        F.count("flagged").alias("known"),
    )
    return per_entity.groupBy("day").agg(
        F.sum("rows").alias("row_count"),
        F.count("entity").alias("entities"),
        F.try_divide(F.sum("flagged"), F.sum("known")).alias("flagged_rate"),
        F.sum("flagged").alias("flagged_count"),
    )
