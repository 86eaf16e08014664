"""Earnings reports over completed bookings.

Each report filters and aggregates bookings once; names are joined to the aggregate, one
row per driver, never to the bookings. So a driver with a third of all bookings costs the
partial aggregates nothing extra.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.columns import app_status, ascending, descending, exact_mean, instant, ratio
from fareloom.schemas import TOTAL


def completed_in_window(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Bookings completed on the days from ``start`` to ``end``, both included.

    Written as a half-open range on the raw timestamp, which reaches the Parquet scan.
    """
    done = F.col("completed_at")
    return bookings.filter(
        (F.col("status") == "completed")
        & done.isNotNull()
        & (done >= instant(bookings, "completed_at", start))
        & (done < instant(bookings, "completed_at", end + dt.timedelta(days=1)))
    )


def _sum(column: str) -> Column:
    return F.sum(column).cast(TOTAL)


def _per_driver(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        completed_in_window(bookings, start, end)
        .filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(
            _sum("driver_earning").alias("total_earnings"),
            F.count(F.lit(1)).alias("total_orders"),
            F.count("driver_earning").alias("_paid"),
        )
    )


def _with_mean(per_driver: DataFrame) -> DataFrame:
    return per_driver.withColumn("average_earnings", exact_mean(F.col("total_earnings"), F.col("_paid"))).drop("_paid")


# --- per driver -------------------------------------------------------------------------


def driver_earnings_daily(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Earnings and orders per driver and day."""
    return (
        completed_in_window(bookings, start, end)
        .filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id", F.to_date("completed_at").alias("date"))
        .agg(_sum("driver_earning").alias("earnings"), F.count(F.lit(1)).alias("orders"))
    )


def driver_earnings(bookings: DataFrame, drivers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Total, count and mean for each driver of ``drivers`` (column ``driver_id``); zeros without bookings."""
    found = _with_mean(_per_driver(bookings, start, end))
    money_zero = F.lit(0).cast(TOTAL)
    return drivers.select("driver_id").join(found, "driver_id", "left").select(
        "driver_id",
        F.coalesce("total_earnings", money_zero).alias("total_earnings"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("average_earnings", money_zero).alias("average_earnings"),
    )


def driver_earnings_json(bookings: DataFrame, drivers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``driver_earnings`` with the daily rows as one JSON document per driver.

    Bookings are summed to (driver, day) once; totals and the array come from those rows. The
    array holds at most one entry per day of the window; it is NULL without bookings.
    """
    days = (
        completed_in_window(bookings, start, end)
        .filter(F.col("driver_id").isNotNull())
        .groupBy("driver_id", F.to_date("completed_at").alias("date"))
        .agg(
            _sum("driver_earning").alias("earnings"),
            F.count(F.lit(1)).alias("orders"),
            F.count("driver_earning").alias("paid"),
        )
    )
    totals = days.groupBy("driver_id").agg(
        _sum("earnings").alias("total"),
        F.sum("orders").alias("orders"),
        F.sum("paid").alias("paid"),
        F.sort_array(F.collect_list(F.struct("date", "earnings", "orders"))).alias("dailyEarnings"),
    )
    zero = F.lit(0).cast(TOTAL)
    document = F.struct(
        F.coalesce("total", zero).alias("totalEarnings"),
        F.coalesce("orders", F.lit(0)).alias("totalOrders"),
        F.coalesce(exact_mean(F.col("total"), F.col("paid")), zero).alias("averageEarnings"),
        "dailyEarnings",
    )
    rows = drivers.select("driver_id").join(totals, "driver_id", "left")
    return rows.select("driver_id", F.to_json(document, {"ignoreNullFields": "false"}).alias("report"))


# --- ranking ----------------------------------------------------------------------------


def driver_earnings_ranking(
    bookings: DataFrame, users: DataFrame, start: dt.date, end: dt.date, limit: int = 10, how: str = "inner"
) -> DataFrame:
    """The ``limit`` best earning drivers.

    ``how="left"`` keeps drivers without a user record. The top rows come from a distributed
    top-k; only those few are numbered, so no window runs over all drivers.
    """
    names = users.select(
        F.col("id").alias("driver_id"),
        (F.coalesce("name", "email") if how == "inner" else F.col("name")).alias("driver_name"),
        F.col("email").alias("driver_email"),
    )
    order = [descending("total_earnings"), F.col("driver_id").asc()]
    top = _with_mean(_per_driver(bookings, start, end)).join(names, "driver_id", how).orderBy(*order).limit(limit)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        "driver_id",
        "driver_name",
        "driver_email",
        "total_earnings",
        "total_orders",
        "average_earnings",
    )


# --- paged list -------------------------------------------------------------------------

SORT_COLUMNS = {"earnings": "total_earnings", "orders": "total_orders", "average": "average_earnings"}


def _page_order(sort_by: str, sort_order: str) -> list[Column]:
    tie = F.col("driver_id").asc()
    column = SORT_COLUMNS.get(sort_by)
    if column is None or sort_order not in ("asc", "desc"):
        return [tie]
    return [descending(column) if sort_order == "desc" else ascending(column), tie]


#: Parts in which the list is put in order; each passes on no more rows than the page may need.
LIST_PARTS = 64


def _listed(
    bookings: DataFrame, users: DataFrame, start: dt.date, end: dt.date, page: int, limit: int,
    sort_by: str, sort_order: str, how: str,
) -> DataFrame:
    """The rows that may be on the page, numbered over the whole list (``_place``), and sums over all
    drivers, from one aggregate of the bookings.

    Drivers are dealt to parts; a part puts its drivers in order and keeps as many as the page may
    need. Its first row carries its sums over all its drivers, listed or not. So what is left is
    bounded by the parts and the page, and only that is numbered as a whole.
    """
    names = users.select(
        F.col("id").alias("driver_id"),
        (F.coalesce("name", "email") if how == "inner" else F.col("name")).alias("driver_name"),
        F.col("email").alias("driver_email"),
        F.lit(True).alias("_named"),
    )
    per_driver = _per_driver(bookings, start, end).withColumn("average_earnings", exact_mean(F.col("total_earnings"), F.col("_paid")))
    rows = per_driver.join(names, "driver_id", "left")
    rows = rows.withColumn("_listed", F.coalesce("_named", F.lit(False)) if how == "inner" else F.lit(True))
    part = Window.partitionBy(F.pmod(F.xxhash64("driver_id"), F.lit(LIST_PARTS)))
    order = [F.desc("_listed"), *_page_order(sort_by, sort_order)]
    sums = {"_drivers": F.count(F.lit(1)), "_earnings": F.sum("total_earnings"), "_orders": F.sum("total_orders"), "_payments": F.sum("_paid")}
    rows = rows.withColumns({**{n: c.over(part) for n, c in sums.items()}, "_n": F.row_number().over(part.orderBy(*order))})
    rows = rows.filter(F.col("_n") <= max(1, page * limit))
    rows = rows.withColumns({n: F.when(F.col("_n") == 1, F.col(n)) for n in sums})
    return rows.withColumn("_place", F.row_number().over(Window.orderBy(*order)))


def _on_page(page: int, limit: int) -> Column:
    return F.col("_listed") & (F.col("_place") > (page - 1) * limit) & (F.col("_place") <= page * limit)


def drivers_earnings_page(
    bookings: DataFrame,
    users: DataFrame,
    start: dt.date,
    end: dt.date,
    page: int = 1,
    limit: int = 10,
    sort_by: str = "earnings",
    sort_order: str = "desc",
    how: str = "inner",
) -> DataFrame:
    """One page of the driver list, each row with the page count of the whole list.

    ``total`` counts drivers with completed bookings, whether or not they have a user
    record; the listed rows need one unless ``how="left"``.
    """
    rows = _listed(bookings, users, start, end, page, limit, sort_by, sort_order, how)
    rows = rows.withColumn("total", F.sum("_drivers").over(Window.partitionBy())).filter(_on_page(page, limit))
    return rows.orderBy("_place").select(
        "driver_id", "driver_name", "driver_email", "total_earnings", "total_orders", "average_earnings",
        F.lit(page).alias("page"),
        F.lit(limit).alias("page_limit"),
        "total",
        F.ceil(F.col("total") / F.lit(limit)).cast("bigint").alias("total_pages"),
    )


def drivers_earnings_after(
    bookings: DataFrame,
    users: DataFrame,
    start: dt.date,
    end: dt.date,
    last_value: object,
    last_driver: str,
    limit: int = 10,
    sort_by: str = "earnings",
    sort_order: str = "desc",
) -> DataFrame:
    """The page after the row ``(last_value, last_driver)``: deep paging without skipping rows."""
    column = SORT_COLUMNS[sort_by]
    value, tie = F.col(column), F.col("driver_id") > last_driver
    if last_value is None:
        # NULLs come first when descending and last when ascending
        behind = (value.isNull() & tie) | (value.isNotNull() if sort_order == "desc" else F.lit(False))
    elif sort_order == "desc":
        behind = (value < F.lit(last_value)) | ((value == F.lit(last_value)) & tie)
    else:
        behind = (value > F.lit(last_value)) | ((value == F.lit(last_value)) & tie) | value.isNull()
    names = users.select(
        F.col("id").alias("driver_id"), F.coalesce("name", "email").alias("driver_name"), F.col("email").alias("driver_email")
    )
    return (
        _with_mean(_per_driver(bookings, start, end))
        .filter(behind)
        .join(names, "driver_id")
        .orderBy(*_page_order(sort_by, sort_order))
        .limit(limit)
        .select("driver_id", "driver_name", "driver_email", "total_earnings", "total_orders", "average_earnings")
    )


def drivers_earnings_summary(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row over all drivers of the window, from the per-driver aggregate."""
    sums = _per_driver(bookings, start, end).agg(
        F.sum("total_earnings").cast(TOTAL).alias("earnings"),
        F.sum("total_orders").alias("orders"),
        F.sum("_paid").alias("paid"),
        F.count(F.lit(1)).alias("drivers"),
    )
    zero = F.lit(0).cast(TOTAL)
    return sums.select(
        F.coalesce("earnings", zero).alias("total_earnings"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce(exact_mean(F.col("earnings"), F.col("paid")), zero).alias("average_earnings"),
        F.col("drivers").alias("active_drivers"),
    )


def drivers_page_json(
    bookings: DataFrame,
    users: DataFrame,
    start: dt.date,
    end: dt.date,
    page: int = 1,
    limit: int = 10,
    sort_by: str = "earnings",
    sort_order: str = "desc",
    how: str = "inner",
) -> DataFrame:
    """Page, pagination and summary as one JSON document, from one aggregate of the bookings.

    The list holds one page of rows, no more; a page past the end is empty but has its pagination.
    """
    rows = _listed(bookings, users, start, end, page, limit, sort_by, sort_order, how)
    entry = F.struct(
        F.col("driver_id").alias("driverId"),
        F.col("driver_name").alias("driverName"),
        F.col("driver_email").alias("driverEmail"),
        F.col("total_earnings").alias("totalEarnings"),
        F.col("total_orders").alias("totalOrders"),
        F.col("average_earnings").alias("averageEarnings"),
    )
    placed = F.when(_on_page(page, limit), F.struct("_place", entry.alias("d")))
    sums = rows.agg(
        F.transform(F.sort_array(F.collect_list(placed)), lambda x: x["d"]).alias("drivers"),
        F.sum("_earnings").cast(TOTAL).alias("earnings"),
        F.sum("_orders").alias("orders"),
        F.sum("_payments").alias("paid"),
        F.coalesce(F.sum("_drivers"), F.lit(0)).alias("active"),
    )
    zero = F.lit(0).cast(TOTAL)
    summary = F.struct(
        F.coalesce("earnings", zero).alias("totalEarnings"),
        F.coalesce("orders", F.lit(0)).alias("totalOrders"),
        F.coalesce(exact_mean(F.col("earnings"), F.col("paid")), zero).alias("averageEarnings"),
        F.col("active").alias("activeDrivers"),
    )
    paging = F.struct(
        F.lit(page).alias("page"),
        F.lit(limit).alias("limit"),
        F.col("active").alias("total"),
        F.ceil(F.col("active") / F.lit(limit)).cast("bigint").alias("totalPages"),
    )
    data = F.struct("drivers", summary.alias("summary"), paging.alias("pagination"))
    document = F.struct(F.lit(True).alias("success"), data.alias("data"))
    return sums.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("report"))


# --- platform ---------------------------------------------------------------------------


def _rate_mean(total: str, n: str) -> Column:
    return F.round(F.col(total) / F.nullif(n, F.lit(0)), 4).cast("decimal(10,4)")


def _platform_sums() -> list[Column]:
    rate = ratio("platform_fee", "total_amount")
    return [
        _sum("platform_fee").alias("platform_fee"),
        _sum("total_amount").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(rate).alias("rates"),
        F.count(rate).alias("rated"),
    ]


def platform_row(sums: DataFrame, *also: str) -> DataFrame:
    zero = F.lit(0).cast(TOTAL)
    return sums.select(
        F.coalesce("platform_fee", zero).alias("total_platform_fee"),
        F.coalesce("revenue", zero).alias("total_revenue"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce(_rate_mean("rates", "rated"), F.lit(0).cast("decimal(10,4)")).alias("average_commission_rate"),
        *also,
    )


def platform_earnings(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Fee, revenue, orders and the mean of the per-order fee rate (orders of zero total left out)."""
    return platform_row(completed_in_window(bookings, start, end).agg(*_platform_sums()))


def platform_earnings_daily(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return (
        completed_in_window(bookings, start, end)
        .groupBy(F.to_date("completed_at").alias("date"))
        .agg(
            _sum("platform_fee").alias("platform_fee"),
            _sum("total_amount").alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
        )
    )


def platform_earnings_json(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``platform_earnings`` with its daily rows (one per day of the window) as one document.

    Bookings are summed to days once; the totals are sums of those.
    """
    days = completed_in_window(bookings, start, end).groupBy(F.to_date("completed_at").alias("date")).agg(*_platform_sums())
    listed = F.sort_array(F.collect_list(F.struct("date", "platform_fee", "revenue", "orders")))
    sums = days.agg(
        _sum("platform_fee").alias("platform_fee"),
        _sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.sum("rates").alias("rates"),
        F.sum("rated").alias("rated"),
        F.when(F.count(F.lit(1)) > 0, listed).alias("days"),
    )
    document = F.struct(
        F.col("total_platform_fee").alias("totalPlatformFee"),
        F.col("total_revenue").alias("totalRevenue"),
        F.col("total_orders").alias("totalOrders"),
        F.col("average_commission_rate").alias("averageCommissionRate"),
        F.col("days").alias("dailyEarnings"),
    )
    return platform_row(sums, "days").select(F.to_json(document, {"ignoreNullFields": "false"}).alias("report"))


def daily_earnings_summary(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Revenue, shares, orders and distinct drivers per day.

    Summed to (day, driver) first: an exact distinct count beside sums would expand every row.
    """
    per_driver_day = (
        completed_in_window(bookings, start, end)
        .groupBy(F.to_date("completed_at").alias("date"), "driver_id")
        .agg(
            _sum("total_amount").alias("total_revenue"),
            _sum("driver_earning").alias("driver_earnings"),
            _sum("platform_fee").alias("platform_fee"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    return per_driver_day.groupBy("date").agg(
        _sum("total_revenue").alias("total_revenue"),
        _sum("driver_earnings").alias("driver_earnings"),
        _sum("platform_fee").alias("platform_fee"),
        F.sum("orders").alias("orders"),
        F.count("driver_id").alias("drivers_count"),
    )


def daily_summary_json(bookings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The daily summary as one JSON array, ``[]`` over an empty window; bounded by the days asked for."""
    row = F.struct("date", "total_revenue", "driver_earnings", "platform_fee", "orders", "drivers_count")
    days = daily_earnings_summary(bookings, start, end).agg(F.sort_array(F.collect_list(row)).alias("days"))
    return days.select(F.to_json("days", {"ignoreNullFields": "false"}).alias("report"))


# --- counts -----------------------------------------------------------------------------


def deposit_by_status(bookings: DataFrame) -> DataFrame:
    """Bookings per status with paid and unpaid deposits; an unknown deposit counts in neither."""
    return bookings.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_bookings"),
        F.count_if(F.col("deposit_paid")).alias("paid_count"),
        F.count_if(~F.col("deposit_paid")).alias("unpaid_count"),
    )


def fee_statistics(bookings: DataFrame) -> DataFrame:
    """How many bookings carry fee columns, and the mean rates."""
    fee, earning = ratio("platform_fee", "total_amount"), ratio("driver_earning", "total_amount")
    return (
        bookings.filter(F.col("total_amount").isNotNull())
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count("platform_fee").alias("orders_with_platform_fee"),
            F.count("driver_earning").alias("orders_with_driver_earning"),
            F.sum(fee).alias("_fee"),
            F.count(fee).alias("_fee_n"),
            F.sum(earning).alias("_earning"),
            F.count(earning).alias("_earning_n"),
        )
        .select(
            "total_orders",
            "orders_with_platform_fee",
            "orders_with_driver_earning",
            _rate_mean("_fee", "_fee_n").alias("avg_platform_fee_rate"),
            _rate_mean("_earning", "_earning_n").alias("avg_driver_earning_rate"),
        )
    )


def orders_by_status(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("status").agg(F.count(F.lit(1)).alias("orders")).select(
        "status", app_status().alias("app_status"), "orders"
    )


def dimension_fill(bookings: DataFrame) -> DataFrame:
    return bookings.agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.count("country").alias("with_country"),
        F.count("service_type").alias("with_service_type"),
    )


def recent(df: DataFrame, order: str, tie: str, limit: int = 10) -> DataFrame:
    """The newest rows: a per-partition top-k, merged."""
    return df.orderBy(F.col(order).desc_nulls_last(), F.col(tie).desc()).limit(limit)
