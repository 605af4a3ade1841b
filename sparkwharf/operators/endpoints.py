"""The feeds' endpoints as SQL functions of a session: tables by parameters with defaults, over daily tables that prune by day.

A function is made for each daily table that is given and can be called by name from SQL, also for each row of another
table (``LATERAL``). Bodies are plain SQL, so Catalyst inlines them: a call with a day reads that day's files.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Daily tables, the functions over each: parameters, result, what is selected.
FUNCTIONS = {
    "ship_trails_daily": [("get_ship_trails", "target_date DATE", "mmsi STRING, ship_type STRING, trail STRING", "mmsi, ship_type, trail FROM {t} WHERE day = target_date")],
    "ship_trails_days_summary": [("get_ship_dates", "", "date STRING, records BIGINT, ships BIGINT", "CAST(day AS STRING), records, ships FROM {t} ORDER BY day")],
    "flight_trails_daily": [
        (
            "get_flight_trails", "target_date DATE", "flight_id STRING, callsign STRING, aircraft_type STRING, origin STRING, destination STRING, trail STRING",
            "flight_id, callsign, aircraft_type, origin, destination, trail FROM {t} WHERE day = target_date",
        )
    ],
    "flight_trails_days_summary": [("get_flight_dates", "", "date STRING, records BIGINT, flights BIGINT", "CAST(day AS STRING), records, flights FROM {t} ORDER BY day")],
    "freeway_congestion_daily": [
        (
            "get_freeway_congestion_day", "target_date DATE", "section_id STRING, section_name STRING, road_name STRING, direction_label STRING, geom STRING, timeline STRING",
            "section_id, section_name, road_name, direction_label, geom, timeline FROM {t} WHERE day = target_date",
        )
    ],
    "bike_cells_daily": [("get_youbike_h3_snapshots", "target_date DATE, h3_resolution INT DEFAULT 7", "time_key STRING, cells STRING", "time_key, cells FROM {t} WHERE day = target_date AND resolution = h3_resolution")],
    "temperature_frames_daily": [("get_temperature_frames", "target_date DATE DEFAULT CURRENT_DATE()", "observed_at TIMESTAMP_NTZ, cell_count INT, temps STRING", "observed_at, cell_count, temps FROM {t} WHERE day = target_date")],
    "temperature_dates": [("get_temperature_dates", "", "date STRING, frames BIGINT, cells BIGINT", "date, frames, cells FROM {t} ORDER BY date")],
    "temperature_grid_cells": [("get_temperature_grid_info", "target_date DATE DEFAULT CURRENT_DATE()", "grid_lat DOUBLE, grid_lng DOUBLE", "grid_lat, grid_lng FROM {t} ORDER BY grid_lat, grid_lng")],
    "disaster_alerts_daily": [("get_disaster_alerts_day", "target_date DATE", "identifier STRING, area_desc STRING, effective_ts BIGINT, geom STRING", "identifier, area_desc, effective_ts, geom FROM {t} WHERE day = target_date")],
}


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Make the functions of the given daily tables in this session; their names."""
    made = []
    for name, rows in tables.items():
        if name not in FUNCTIONS:
            raise ValueError(f"no endpoint reads a table {name}")
        rows.createOrReplaceTempView(name)
        for function, parameters, result, body in FUNCTIONS[name]:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({parameters}) RETURNS TABLE({result}) RETURN SELECT {body.format(t=name)}")
            made.append(function)
    spark.udtf.register("trip_legs", F.udtf(TripLegs))
    return made


class TripLegs:
    """``trip_legs(TABLE(points), gap)``: the legs of each entity, of points at most ``gap`` seconds (900 by default) apart.

    ``points(entity, at)`` is partitioned by entity and sorted by time by Spark, whatever the call says; a leg is all that is held.
    """

    @staticmethod
    def analyze(points: AnalyzeArgument, gap: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not points.isTable or [f.name for f in points.dataType.fields] != ["entity", "at"]:
            raise ValueError("trip_legs takes TABLE(SELECT entity, at ...) and the seconds of a gap")
        schema = T.StructType().add("entity", points.dataType["entity"].dataType).add("leg", T.IntegerType()).add("first", T.LongType()).add("last", T.LongType()).add("points", T.IntegerType())
        return AnalyzeResult(schema=schema, partitionBy=[PartitioningColumn("entity")], orderBy=[OrderingColumn("at")])

    def __init__(self):
        self.entity, self.leg, self.first, self.last, self.n = None, 0, None, None, 0

    def eval(self, point: Row, gap: int = 900) -> Iterator[tuple]:
        at = point["at"]
        if at is None:
            return
        if self.n and at - self.last > gap:
            yield self.entity, self.leg, self.first, self.last, self.n
            self.leg, self.n = self.leg + 1, 0
        self.entity, self.first, self.last, self.n = point["entity"], self.first if self.n else at, at, self.n + 1

    def terminate(self) -> Iterator[tuple]:
        if self.n:
            yield self.entity, self.leg, self.first, self.last, self.n
