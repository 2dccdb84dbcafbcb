"""Read-backs: the first rows of a result in its customary order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemill.operators.ranking import top_k

# Order of each read-back, "-" for falling. Later columns only settle ties.
ORDERS = {
    "user_consumption_day_aggr": ["customer_id", "-total_amount", "year", "month", "day"],
    "city_consumption_day_aggr": ["-total_count", "-total_amount", "city_name", "year", "month"],
    "province_consumption_day_aggr": ["-total_count", "-total_amount", "-province_id", "year", "month"],
    "cityavgcmpprovince": ["-cityavgconsumption", "-provinceavgconsumption", "cityname"],
    "citymidcmpprovince": ["-citymidconsumption", "-provincemidconsumption", "cityname"],
    "regiontopthree": ["provincename"],
    "topten": ["sequence"],
    "userrepurchasedrate": ["purchaseduser"],
    "accumulateconsumption": ["consumptiontime"],
    "slidewindowconsumption": ["consumptiontime"],
}

# Results whose amount is shown as a whole number.
WHOLE_AMOUNTS = ("city_consumption_day_aggr", "province_consumption_day_aggr")


def read_back(result: DataFrame, name: str, n: int = 5) -> DataFrame:
    """Top ``n`` rows of a result table; whole amounts are cut, not rounded."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in ORDERS[name]]
    top = top_k(result, order, n)
    if name in WHOLE_AMOUNTS:
        top = top.withColumn("total_amount", F.col("total_amount").cast("bigint"))
    return top
