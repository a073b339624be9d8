"""Retail source tables viewed over the star-schema test tables.

Each view keeps every row of the table it reads. With ``dirty`` the views also carry the faults a
cleaning run has to find: padded or wrong status words, missing ids, copies, negative numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.retail import MONEY, line_amount, shared_id
from shelfwise.sources.schemas import SOURCES

STORES = 25

# The first key column of each star-schema table.
TABLE_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
}


def _line_ref(prefix: str) -> Column:
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(p).cast("string") for p in parts]))


def _store_of(column: str) -> Column:
    return shared_id("S", F.col(column) % STORES)


def _days_after(column: str, days: int) -> Column:
    return F.col(column) + F.expr(f"INTERVAL {days} DAY")


def retail_sources(spark: SparkSession, folder: str, dirty: bool = True) -> dict[str, DataFrame]:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    fault = lambda condition: condition & F.lit(dirty)
    part, nation, region = read("part"), read("nation"), read("region")
    customer, orders, lineitem, events = read("customer"), read("orders"), read("lineitem"), read("events")

    product = part.select(
        F.when(~fault(F.col("p_size") >= 49), shared_id("P", "p_partkey")).alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        (F.col("p_size") <= 40).alias("active_flag"),
    )
    store = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.when(~fault(F.col("n_nationkey") == STORES - 1), shared_id("S", "n_nationkey")).alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("r_name").alias("location"),
        F.lit(True).alias("active_flag"),
    )

    buyers = customer.select(
        F.when(~fault(F.col("c_acctbal") < -900), shared_id("C", "c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@example.test")).alias("email"),
        F.when(fault((F.col("c_acctbal") > 9000) | (F.col("c_acctbal") < -950)), 2).otherwise(1).alias("copies"),
    )
    buyer = buyers.select(
        "customer_id", "customer_name", "email", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    ).drop("copy")

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    if dirty:
        order_status = (
            F.when((status == "F") & (priority == "1-URGENT"), "shipped")
            .when(status == "F", "collected")
            .when(status == "P", "READY_FOR_COLLECTION")
            .when(priority == "5-LOW", " cancelled")
            .otherwise("Confirmed ")
        )
    else:
        order_status = (
            F.when(status == "F", "COLLECTED")
            .when(status == "P", "READY_FOR_COLLECTION")
            .when(priority == "5-LOW", "CANCELLED")
            .otherwise("CONFIRMED")
        )
    online_order = orders.select(
        shared_id("O", "o_orderkey").alias("order_id"),
        shared_id("C", "o_custkey").alias("customer_id"),
        _store_of("o_custkey").alias("fulfilment_store_id"),
        order_status.alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
        F.col("o_orderdate").alias("created_at"),
        _days_after("o_orderdate", 1).alias("updated_at"),
    )

    quantity = F.col("l_quantity").cast("int")
    order_item = lineitem.select(
        _line_ref("OI").alias("order_item_id"),
        shared_id("O", "l_orderkey").alias("order_id"),
        shared_id("P", "l_partkey").alias("product_id"),
        F.when(fault((F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08)), -quantity)
        .otherwise(quantity)
        .alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("unit_price"),
    ).withColumn("line_amount", F.col("unit_price") if dirty else line_amount())

    flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
    if dirty:
        hold_status = (
            F.when((flag == "A") & (line_status == "F"), "active ")
            .when(flag == "A", "ACTIVE")
            .when(flag == "R", "Cancelled")
            .when(line_status == "F", "collected")
            .when(F.col("l_tax") >= 0.08, "lapsed")
            .otherwise("EXPIRED")
        )
    else:
        hold_status = (
            F.when(flag == "A", "ACTIVE")
            .when(flag == "R", "CANCELLED")
            .when(line_status == "F", "COLLECTED")
            .otherwise("EXPIRED")
        )
    reservation = lineitem.select(
        _line_ref("R").alias("reservation_id"),
        shared_id("O", "l_orderkey").alias("order_id"),
        shared_id("P", "l_partkey").alias("product_id"),
        _store_of("l_suppkey").alias("store_id"),
        quantity.alias("quantity"),
        hold_status.alias("reservation_status"),
        F.col("l_shipdate").alias("created_at"),
        _days_after("l_shipdate", 1).alias("expires_at"),
        F.when(flag == "R", _days_after("l_shipdate", 1)).alias("released_at"),
    )

    stock = lineitem.groupBy("l_partkey", (F.col("l_suppkey") % STORES).alias("store_no")).agg(
        F.sum(F.when(flag == "A", quantity).otherwise(0)).cast("int").alias("held"),
        F.sum(F.when(flag == "N", quantity).otherwise(0)).cast("int").alias("free"),
        F.min("l_discount").alias("low_discount"),
        F.max("l_tax").alias("high_tax"),
        F.max("l_shipdate").alias("last_ship"),
    )
    on_hand = F.col("held") + F.col("free")
    inventory = stock.select(
        F.concat(F.lit("I"), F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("store_no").cast("string"))).alias(
            "inventory_id"
        ),
        shared_id("P", "l_partkey").alias("product_id"),
        shared_id("S", "store_no").alias("store_id"),
        F.when(fault(F.col("low_discount") >= 0.1), F.lit(-1)).otherwise(on_hand).alias("on_hand_quantity"),
        F.col("held").alias("reserved_quantity"),
        F.when(fault(F.col("high_tax") <= 0), on_hand).otherwise(F.col("free")).alias("available_to_sell"),
        F.col("last_ship").cast("timestamp").alias("updated_at"),
    )

    kind, product_no = F.col("event_type"), F.regexp_extract("props", r"\d+", 0).cast("int")
    if dirty:
        sale_status = (
            F.when(kind == "purchase", "approved ")
            .when(kind == "error", "REJECTED")
            .when(kind == "signup", " blocked")
            .when(kind == "click", "pending")
            .otherwise("COMPLETED")
        )
        reason = (
            F.when((kind == "error") & (F.col("value") < 2), " none ")
            .when((kind == "error") & (F.col("value") < 5), "out_of_stock ")
            .when((kind == "signup") & (F.col("value") < 1), "held")
            .when(kind.isin("error", "signup"), "RESERVED_STOCK")
            .when(kind == "view", "")
        )
    else:
        sale_status = F.when(kind.isin("error", "signup"), "BLOCKED").otherwise("COMPLETED")
        reason = F.when(kind.isin("error", "signup"), "RESERVED_STOCK").otherwise("NONE")
    price = F.col("value").cast(MONEY)
    units = (1 + F.col("event_id") % 3).cast("int")
    pos_transaction = events.select(
        shared_id("T", "event_id").alias("transaction_id"),
        _store_of("user_id").alias("store_id"),
        F.col("ts").alias("transaction_timestamp"),
        sale_status.alias("transaction_status"),
        reason.alias("rejection_reason"),
        F.when(kind.isin("error", "signup"), F.lit(0)).otherwise(units * price).cast(MONEY).alias("total_amount"),
    )
    pos_item = events.select(
        shared_id("TI", "event_id").alias("transaction_item_id"),
        shared_id("T", "event_id").alias("transaction_id"),
        shared_id("P", product_no).alias("product_id"),
        units.alias("quantity"),
        F.when(fault(F.col("value") > 150), -price).otherwise(price).alias("unit_price"),
    ).withColumn("line_amount", line_amount())

    sold = ["purchase", "view"] if dirty else ["purchase", "view", "click"]
    holds = lineitem.select(
        _line_ref("R").alias("ref"),
        shared_id("P", "l_partkey").alias("product_id"),
        _store_of("l_suppkey").alias("store_id"),
        F.explode(
            F.array_compact(
                F.array(
                    _ledger_row("STOCK_RECEIVED", quantity, "WAREHOUSE", -1),
                    _ledger_row("ONLINE_RESERVATION", -quantity, "ECOMMERCE", 0),
                    F.when(flag == "R", _ledger_row("RESERVATION_RELEASE", quantity, "ECOMMERCE", 1)),
                    F.when(
                        (flag == "N") & (line_status == "F"),
                        _ledger_row("RESERVATION_COLLECTION", -quantity, "ECOMMERCE", 2),
                    ),
                )
            )
        ).alias("move"),
    ).select("product_id", "store_id", "ref", "move.*")
    sales = events.where(kind.isin(*sold)).select(
        shared_id("P", product_no).alias("product_id"),
        _store_of("user_id").alias("store_id"),
        shared_id("T", "event_id").alias("ref"),
        F.lit("POS_SALE").alias("movement_type"),
        (-units).alias("quantity_change"),
        F.lit("POS").alias("source_system"),
        F.col("ts").cast("timestamp").alias("movement_timestamp"),
    )
    movement = holds.unionByName(sales).select(
        F.concat_ws("-", F.lit("M"), "movement_type", "ref").alias("movement_id"),
        "product_id",
        "store_id",
        "movement_type",
        "quantity_change",
        "source_system",
        F.col("ref").alias("source_reference_id"),
        "movement_timestamp",
    )

    tables = {
        "inventory.product": product,
        "inventory.store": store,
        "inventory.inventory": inventory,
        "inventory.inventory_movement": movement,
        "ecommerce.customer": buyer,
        "ecommerce.online_order": online_order,
        "ecommerce.order_item": order_item,
        "ecommerce.reservation": reservation,
        "pos.pos_transaction": pos_transaction,
        "pos.pos_transaction_item": pos_item,
    }
    return {
        name: df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCES[name].fields])
        for name, df in tables.items()
    }


def _ledger_row(movement_type: str, change: Column, system: str, days: int) -> Column:
    return F.struct(
        F.lit(movement_type).alias("movement_type"),
        change.alias("quantity_change"),
        F.lit(system).alias("source_system"),
        _days_after("l_shipdate", days).cast("timestamp").alias("movement_timestamp"),
    )
