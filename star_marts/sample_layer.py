"""A raw layer derived from the order-processing test tables, with realistic dirt.

See FIXTURES.md part B.  All columns are text, as a CSV landing would give them; every
expression is integer or decimal, so that another engine derives the same text.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts import schemas
from star_marts.operators import lookup_join
from star_marts.plans.marts import Settings
from star_marts.schemas import conform
from star_marts.sources import apply_types

# Calendar, thresholds and regions that suit the derived data.
SAMPLE_SETTINGS = Settings(
    calendar_first=dt.date(1995, 1, 1),
    calendar_last=dt.date(2001, 12, 31),
    bridged_first=dt.date(1996, 1, 1),
    bridged_last=dt.date(2001, 12, 31),
    demand_first=1995,
    demand_last=2001,
    registered_since=dt.date(1996, 7, 1),
    regions={
        "North": ["NATION_0", "NATION_1", "NATION_2", "NATION_3"],
        "East": ["NATION_4", "NATION_5", "NATION_6"],
        "South": ["NATION_10", "NATION_11", "NATION_12", "NATION_13", "NATION_14"],
    },
)


def _text(c: Column) -> Column:
    return c.cast("string")


class SampleLayer:
    """The tables of `RawLayer`, each derived when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, oversized: bool = False):
        """`oversized` gives some sessions measures beyond their declared types, and some a date
        with the name of its month."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.oversized = oversized

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def stations(self) -> DataFrame:
        k = F.col("p_partkey")
        city = F.concat(F.lit("CITY "), _text(k % 60))
        opened = F.date_add(F.lit(dt.date(1994, 1, 1)), (k * 37 % 2900).cast("int"))
        used = self._table("part").select(
            _text(k).alias("id"),
            F.col("p_name").alias("station_name"),
            F.when(k % 7 != 0, F.col("p_brand")).alias("ev_network"),
            F.when(k % 3 == 0, F.concat(F.lower(city), F.lit(" "))).otherwise(city).alias("city"),
            F.lit("NY").alias("state"),
            _text(k % 230 + 10000).alias("zip"),
            F.when(k % 13 != 0, _text(F.col("p_size") % 3)).alias("ev_level1_evse_num"),
            F.when(k % 17 == 0, "n/a").otherwise(_text(F.col("p_size") % 9)).alias("ev_level2_evse_num"),
            _text(F.col("p_size") % 5).alias("ev_dc_fast_count"),
            F.concat(F.lit("40."), F.lpad(_text(k % 1000), 3, "0")).alias("latitude"),
            F.concat(F.lit("-73."), F.lpad(_text(k % 997), 3, "0")).alias("longitude"),
            F.when(k % 10 == 0, "P").otherwise("E").alias("status_code"),
            F.when(k % 6 == 0, "LPG").otherwise("ELEC").alias("fuel_type_code"),
            F.when(k % 29 == 0, "unknown").otherwise(_text(opened)).alias("open_date"),
        )
        return conform(used, schemas.RAW_STATIONS)

    @cached_property
    def station_feed(self) -> DataFrame:
        return self.stations.select(
            F.col("id").alias("ID"),
            F.col("station_name").alias("STATIONNAME"),
            F.col("ev_network").alias("EVNETWORK"),
            F.col("zip").alias("ZIP"),
            F.col("city").alias("CITY"),
            F.col("state").alias("STATE"),
            F.col("ev_level1_evse_num").alias("EVLEVEL1EVSENUM"),
            F.col("ev_level2_evse_num").alias("EVLEVEL2EVSENUM"),
            F.col("ev_dc_fast_count").alias("EVDCFASTCOUNT"),
            F.col("latitude").alias("LATITUDE"),
            F.col("longitude").alias("LONGITUDE"),
            F.col("status_code").alias("STATUSCODE"),
            F.col("open_date").alias("OPENDATE"),
        )

    @cached_property
    def registrations(self) -> DataFrame:
        owners = self._table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        nations = self._table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        orders = self._table("orders").withColumnRenamed("o_custkey", "c_custkey").select(
            "c_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"
        )
        owned = lookup_join(orders, owners, "c_custkey", "inner").join(nations, "c_nationkey")
        o, k = F.col("o_orderkey"), F.col("c_custkey")
        zip5 = _text(k % 200 + 10000)
        rows = owned.select(
            _text(o).alias("vin"),
            F.concat(F.lit("CITY "), _text(k % 60)).alias("city"),
            F.when(o % 19 == 0, "NJ").otherwise("NY").alias("state"),
            F.when(o % 11 == 0, F.concat(zip5, F.lit("-1234"))).otherwise(zip5).alias("zip"),
            F.when(o % 50 == 0, "  ")
            .when(o % 3 == 0, F.concat(F.lower("n_name"), F.lit(" ")))
            .otherwise(F.col("n_name")).alias("county"),
            F.when(o % 41 == 0, "UNK").otherwise(_text(F.year("o_orderdate"))).alias("model_year"),
            F.col("c_mktsegment").alias("make"),
            F.when(F.col("o_orderstatus") == "P", "GAS").otherwise("ELECTRIC").alias("fuel_type"),
            F.date_format("o_orderdate", "MM/dd/yyyy").alias("reg_valid_date"),
        )
        return conform(rows, schemas.RAW_REGISTRATIONS)

    @cached_property
    def registrations_positional(self) -> DataFrame:
        return self.registrations.toDF(*schemas.RAW_REGISTRATIONS_POSITIONAL.fieldNames())

    def _census_zips(self) -> DataFrame:
        z = (F.col("c_custkey") % 200 + 10000).alias("z")
        return self._table("customer").select(z).distinct()

    @cached_property
    def census_population(self) -> DataFrame:
        z = F.col("z")
        rows = self._census_zips().select(
            F.concat(F.lit("8600000US"), _text(z)).alias("geo_id"),
            F.concat(F.lit("ZCTA5 "), _text(z)).alias("name"),
            F.when(z % 23 == 0, "-").otherwise(_text(z * 37 % 5000 + 100)).alias("population_estimate"),
        )
        return conform(rows, schemas.RAW_CENSUS_POPULATION)

    @cached_property
    def census_income(self) -> DataFrame:
        z = F.col("z")
        rows = self._census_zips().filter(z % 9 != 0).select(
            F.concat(F.lit("8600000US"), _text(z)).alias("geo_id"),
            F.concat(F.lit("ZCTA5 "), _text(z)).alias("name"),
            F.when(z % 31 == 0, "-").otherwise(_text(z * 71 % 90000 + 30000)).alias("median_income"),
        )
        return conform(rows, schemas.RAW_CENSUS_INCOME)

    def _sessions(self, session_id: Column) -> DataFrame:
        o, line = F.col("l_orderkey"), F.col("l_linenumber")
        shipped = F.col("l_shipdate").cast("date")

        def beyond(every: int, value: str, else_: Column) -> Column:
            return F.when(o % every == 0, value).otherwise(else_) if self.oversized else else_

        date = _text(shipped)
        if self.oversized:
            named = F.upper(F.date_format(shipped, "dd-MMM-yyyy"))
            date = F.when(o % 29 == 0, named).otherwise(date)
        return self._table("lineitem").select(
            session_id.alias("session_id"),
            _text(F.col("l_partkey")).alias("station_id"),
            F.when(o % 101 == 0, "bad")
            .otherwise(date).alias("session_date"),
            F.when(o % 97 == 0, "")
            .otherwise(beyond(31, "12345678.5", _text(F.col("l_quantity").cast("decimal(10,2)"))))
            .alias("kwh_delivered"),
            beyond(37, "3000000000", _text(F.col("l_quantity").cast("int") * line * 4))
            .alias("duration_minutes"),
            beyond(41, "123456789.00", _text(F.col("l_extendedprice").cast("decimal(12,2)")))
            .alias("revenue_usd"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        """Text sessions; the id repeats."""
        return self._sessions(F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber"))))

    @cached_property
    def numbered_sessions(self) -> DataFrame:
        """The same sessions with ids that are whole numbers, still as text."""
        return self._sessions(_text(F.col("l_orderkey") * 10 + F.col("l_linenumber")))

    @cached_property
    def typed_sessions(self) -> DataFrame:
        return apply_types(self.numbered_sessions, schemas.TYPED_SESSIONS).good

