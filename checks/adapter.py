"""Trip stops and a stop-order sheet read out of the ``lineitem`` table: an order is a trip."""

from pyspark.sql import functions as F

from tripgrid.fixed_values import ROUTE_GROUPS
from tripgrid.schemas import STOP_KEY, STOP_ORDER, TRIP_STOPS
from tripgrid.sources import Staging

ROUTES = ["1", "1L", "24", "18", "51", "52", "7", "99", "Car", None]
# Every route that is printed, one that is not, and none.
ALL_ROUTES = [*(route for routes in ROUTE_GROUPS.values() for route in routes), "Car", None]
DIRECTIONS = ["North", "East", "West", "East", "West"]
OP_DAYS = ["Weekday", "Saturday", "Sunday"]


def _pick(values, index):
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def trip_stops(spark, sf_dir, routes=ROUTES):
    """One row per line item; ``id`` is the name of the file it came from."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    minute = 270 + key * 37 % 1380 + 4 * line + F.when(part % 40 == 7, 2).otherwise(0)
    hour = F.expr("_minute div 60")
    clock_hour = F.when(hour % 12 == 0, 12).otherwise(hour % 12)
    meridian = F.when(hour < 12, "a").when(hour < 24, "p").otherwise("x")
    clock = F.concat(clock_hour.cast("string"), F.lpad((F.col("_minute") % 60).cast("string"), 2, "0"), meridian)
    columns = {
        "trp_number_trim": key.cast("string"),
        "route": _pick(routes, key % len(routes)),
        "direction": _pick(DIRECTIONS, F.expr("l_orderkey div 10") % 5),
        "place": F.concat(F.lit("P"), line),
        "stop": (100 * line + F.col("l_suppkey") % 2).cast("string"),
        "stop_name": F.concat(F.lit("St. "), line, F.lit(", N")),
        "op_day": _pick(OP_DAYS, key % 3),
        "departure": F.when(part % 50 == 0, "5:30p").when(part % 50 == 1, None).otherwise(clock),
        "evt_sta": F.when(key % 17 == 0, "School"),
    }
    return items.withColumn("_minute", minute).select(
        F.col("_metadata.file_name").alias("id"), *[columns[c].alias(c) for c in TRIP_STOPS]
    )


def stop_order(spark, sf_dir, routes=ROUTES):
    """The sheet lists every served stop but those of the seventh line; staged, as it is small."""
    served = (
        trip_stops(spark, sf_dir, routes).filter("route is not null and not startswith(stop, '7')")
        .select(*STOP_KEY).distinct()
    )
    tenths = F.concat(F.expr("cast(stop as int) div 10"), F.lit("."), F.expr("cast(stop as int) % 10"))
    return Staging(spark).table(served.withColumn("stop_order", tenths).select(*STOP_ORDER), "stop_order")
