"""Adapter: order tables read as airline bookings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import path_size

#: Bytes of Parquet a dealt-out partition is meant to hold: joins keep these partitions and sort them.
DEALT_BYTES = 16 << 20
#: Bytes of the order file from which on Catalyst no longer broadcasts its columns in use.
ORDER_BYTES = 16 << 20

# In this mapping these origins count as domestic.
DOMESTIC = tuple(f"N{i:02d}" for i in range(8))

FIELDS = [
    "airline", "source_code", "source_name", "destination_code", "destination_name",
    "departure_datetime", "arrival_datetime", "duration_hrs", "stopovers", "aircraft_type",
    "travel_class", "booking_source", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt",
    "seasonality", "days_before_departure",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_scan(df: DataFrame, key: str, size: int = 0) -> DataFrame:
    """Files with fewer splits than there are cores are dealt out by key; larger ones stay as they are. ``size`` is theirs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, size // DEALT_BYTES), key) if df.rdd.getNumPartitions() < cores else df


def broadcast_by_size(df: DataFrame) -> bool:
    """Whether Catalyst takes the frame for small enough to be broadcast."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as bookings.

    The joined tables grow with the data, so there are no broadcast hints: Catalyst broadcasts
    those below the threshold, and AQE splits hot keys of the others. Customers are joined to large
    orders, of which there are fewer than items, so that items are shuffled by part (if that table is large) and by order alone.
    A part table that will be broadcast comes after the orders: its texts are not shuffled then.
    Each side is cut to the columns in use, and amounts in whole cents are worked out after the joins.
    """
    item = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate", "l_tax",
    )
    order = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate", "left(o_orderpriority, 1) AS priority"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    item = spread_scan(item, "l_orderkey", path_size(spark, f"{sf_dir}/lineitem.parquet"))
    item_order, order_customer = F.expr("l_orderkey = o_orderkey"), F.expr("o_custkey = c_custkey")
    item_supplier, item_part = F.expr("l_suppkey = s_suppkey"), F.expr("l_partkey = p_partkey")
    if path_size(spark, f"{sf_dir}/orders.parquet") < ORDER_BYTES:
        joined = item.join(order, item_order).join(part, item_part).join(supplier, item_supplier).join(customer, order_customer)
    else:
        order = order.join(customer, order_customer).drop("o_custkey", "c_custkey")
        if broadcast_by_size(part):
            joined = item.join(order, item_order).join(part, item_part).join(supplier, item_supplier)
        else:
            joined = item.join(supplier, item_supplier).join(part, item_part).join(order, item_order)
    joined = (
        joined
        .selectExpr("*", "CAST(l_extendedprice * 100 + 0.5 AS bigint) AS cents", "CAST(l_tax * 100 + 0.5 AS bigint) AS tax_pct")
        .selectExpr("*", "(cents * tax_pct + 50) DIV 100 AS tax_cents")
    )
    return joined.selectExpr(
        # the first four keys alone are not quite unique
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cents) AS id",
        "p_brand AS airline",
        "concat('N', lpad(CAST(s_nationkey AS string), 2, '0')) AS source_code",
        "concat('NATION_', s_nationkey) AS source_name",
        "concat('N', lpad(CAST(c_nationkey AS string), 2, '0')) AS destination_code",
        "concat('NATION_', c_nationkey) AS destination_name",
        "l_shipdate AS departure_datetime",
        "l_shipdate + make_dt_interval(0, CAST(l_quantity AS int)) AS arrival_datetime",
        "l_quantity AS duration_hrs",
        "CASE WHEN l_linenumber <= 3 THEN 'Direct' WHEN l_linenumber <= 5 THEN '1 Stop'"
        " ELSE '2 Stops' END AS stopovers",
        "p_type AS aircraft_type",
        "CASE priority WHEN '1' THEN 'First Class' WHEN '2' THEN 'biz'"
        " WHEN '3' THEN 'Premium' WHEN '4' THEN 'economy' ELSE ' coach ' END AS travel_class",
        "CASE l_returnflag WHEN 'A' THEN 'Direct Booking' WHEN 'N' THEN 'Travel Agency'"
        " ELSE 'Online Website' END AS booking_source",
        "l_extendedprice AS base_fare_bdt",
        "tax_cents / 100.0D AS tax_surcharge_bdt",
        "(cents + tax_cents) / 100.0D AS total_fare_bdt",
        "CASE WHEN month(l_shipdate) IN (12, 1) THEN 'Winter Holidays' WHEN month(l_shipdate) = 4 THEN 'Eid'"
        " WHEN month(l_shipdate) = 6 THEN 'Hajj' ELSE 'Regular' END AS seasonality",
        "datediff(l_shipdate, o_orderdate) AS days_before_departure",
    )
