"""Fixed column lists and schemas of the tables read and written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attribute lists of the map layers.
_ADMIN = ["osm_id", "name", "admin_level", "boundary", "type", "other_tags"]
_ROADS = ["osm_id", "name", "highway", "barrier", "man_made", "railway", "waterway", "z_order", "other_tags"]
_CHARGING = ["osm_id", "name", "ref", "other_tags"]
_POINTS = ["osm_id", "name", "barrier", "highway", "is_in", "ref", "man_made", "place", "other_tags"]
_PT_LINES = [
    "osm_id", "name", "aerialway", "highway", "waterway", "barrier", "man_made", "railway", "z_order",
    "other_tags",
]
_AREAS = [
    "osm_id", "osm_way_id", "name", "type", "aeroway", "amenity", "admin_level", "barrier", "boundary",
    "building", "craft", "historic", "landuse", "leisure", "man_made", "military", "natural", "office",
    "place", "shop", "sport", "tourism", "other_tags",
]

# Attribute lists of the statistical layers.
_NUTS = ["NUTS_ID", "CNTR_CODE", "NAME_LATN", "LEVL_CODE"]
_LAU = ["GISCO_ID", "CNTR_CODE", "LAU_ID", "LAU_NAME", "DGURBA"]
GRID_COUNTS = [
    "T", "M", "F", "Y_LT15", "Y_1564", "Y_GE65", "EMP", "NAT", "EU_OTH", "OTH", "SAME", "CHG_IN", "CHG_OUT",
]
_GRID = ["GRD_ID", *GRID_COUNTS, *[f"{c}_CI" for c in GRID_COUNTS], "LAND_SURFACE", "POPULATED"]

_INT_COLUMNS = {"z_order", "LEVL_CODE", "DGURBA", "POPULATED"}
_LONG_COLUMNS = {*GRID_COUNTS, *[f"{c}_CI" for c in GRID_COUNTS]}

# Admin levels kept when a caller names none.
DEFAULT_ADMIN_LEVELS = ["2", "4", "6"]


@dataclass(frozen=True)
class LayerSpec:
    """One output dataset: the source layer, its attributes and its row filter."""

    name: str
    layer: str
    columns: tuple[str, ...]
    where: str | None = None

    def column_type(self, column: str) -> T.DataType:
        if column in _INT_COLUMNS:
            return T.IntegerType()
        if column in _LONG_COLUMNS:
            return T.LongType()
        return T.DoubleType() if column == "LAND_SURFACE" else T.StringType()

    def predicate(self, mode: str = "text") -> Column | None:
        """Row filter.  For charging, ``tags`` looks the tag up instead of matching text."""
        if self.name == "charging" and mode == "tags":
            from voltatlas.functions.tags import tags_decode

            tags = tags_decode("other_tags")
            return (F.try_element_at(tags, F.lit("amenity")) == "charging_station") | (
                F.try_element_at(tags, F.lit("charging")) == "yes"
            )
        return F.expr(self.where) if self.where else None


LAYERS = {
    s.name: s
    for s in [
        LayerSpec("admin", "multipolygons", tuple(_ADMIN)),
        LayerSpec("roads", "lines", tuple(_ROADS), "highway IS NOT NULL"),
        LayerSpec(
            "charging", "points", tuple(_CHARGING),
            "other_tags LIKE '%charging_station%' OR other_tags LIKE '%charging=>yes%'",
        ),
        LayerSpec("poi_points", "points", tuple(_POINTS)),
        LayerSpec("poi_polygons", "multipolygons", tuple(_AREAS)),
        LayerSpec("pt_points", "points", tuple(_POINTS)),
        LayerSpec("pt_lines", "lines", tuple(_PT_LINES)),
        LayerSpec("buildings_activity", "multipolygons", tuple(_AREAS)),
        LayerSpec("nuts", "nuts", tuple(_NUTS)),
        LayerSpec("lau", "lau", tuple(_LAU)),
        LayerSpec("census_grid", "grid", tuple(_GRID)),
    ]
}

MAP_DATASETS = [
    "admin", "roads", "charging", "poi_points", "poi_polygons", "pt_points", "pt_lines", "buildings_activity",
]


def struct(schema: T.StructType | str) -> T.StructType:
    """A schema from its text.

    The schemas below stay text until they are used: reading the text takes a
    driver, and Python workers import this module too.
    """
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


CANDIDATE_CELL = (
    "region_code string, region string, h3_r7 string, cell_center_wkt_4326 string, "
    "kring_area_m2 double, macro_score double, degurba string"
)

ROAD_COLUMNS = (
    "region_code string, region string, h3_r7 string, degurba int, macro_score double, "
    "traffic_scope string, near_ev_station boolean, ev_station_id string, road_feature_id string, "
    "road_osm_id string, highway string, maxspeed_kph double, lanes double, road_len_m double, "
    "road_centroid_wkt_4326 string"
)
CANDIDATE_ROAD = ROAD_COLUMNS

RESPONSE = "request_key string, http_status int, error_message string, body string"

POI_ITEM = (
    "id string, dist double, score double, "
    "poi struct<name:string, brands:array<struct<name:string>>, categories:array<string>>, "
    "address struct<countryCode:string, countrySubdivisionName:string, municipality:string, "
    "streetName:string, streetNumber:string, postalCode:string, freeformAddress:string>, "
    "position struct<lat:double, lon:double>, "
    "dataSources struct<chargingAvailability:struct<id:string>>, "
    "chargingPark struct<connectors:string>"
)

_COUNTS = "available:int, occupied:int, reserved:int, unknown:int, outOfService:int"
AVAILABILITY = (
    "connectors array<struct<type:string, total:int, availability:struct<"
    f"current:struct<{_COUNTS}>, perPowerLevel:array<struct<powerKW:double, {_COUNTS}>>>>>"
)

FLOW = (
    "flowSegmentData struct<frc:string, currentSpeed:string, freeFlowSpeed:string, "
    "currentTravelTime:string, freeFlowTravelTime:string, confidence:double, roadClosure:string, "
    "coordinates:struct<coordinate:string>>"
)
COORDINATES = "array<struct<latitude:string,longitude:string>>"

STATION_ENVELOPE = (
    "event_id string, run_id string, snapshot_ts string, source string, http_status int, "
    "error_message string, region_code string, region string, h3_r7 string, degurba int, "
    "request_point_lat double, request_point_lon double, radius_m int, poi_json string, "
    "availability_snapshots array<struct<chargingAvailabilityId:string, ok:boolean, status_code:int, "
    "error:string, avail_json:string>>, cand_ord bigint"
)

TRAFFIC_ENVELOPE = (
    "event_id string, run_id string, snapshot_ts string, source string, tomtom_zoom int, "
    "tomtom_version string, request_point_lat double, request_point_lon double, "
    f"request_point_key string, {ROAD_COLUMNS}, http_status int, error_message string, raw_json string"
)

DIM_STATIONS = (
    "tomtom_poi_id string, charging_availability_id string, name string, brand string, category string, "
    "country_code string, country_subdivision string, municipality string, street string, "
    "street_number string, postal_code string, freeform_address string, lat double, lon double, "
    "connectors_static_json string, raw_poi_json string, updated_at timestamp_ntz"
)
# The appended DIM also keeps what decides between rows of one run.
DIM_HISTORY = DIM_STATIONS + ", cand_ord bigint, rank_by_dist int"
MAP_STATIONS = (
    "region_code string, region string, h3_r7 string, degurba int, query_lat double, query_lon double, "
    "radius_m int, tomtom_poi_id string, dist_m double, score double, rank_by_dist int, "
    "load_ts timestamp_ntz, raw_search_json string"
)
FACT_AVAILABILITY = (
    "charging_availability_id string, snapshot_ts timestamp_ntz, connector_type string, power_kw double, "
    "total int, available int, occupied int, reserved int, unknown int, out_of_service int, "
    "raw_avail_json string"
)
FACT_TRAFFIC = (
    "run_id string, snapshot_ts timestamp_ntz, request_point_key string, request_point_lat double, "
    "request_point_lon double, tomtom_zoom int, tomtom_version string, region_code string, region string, "
    "h3_r7 string, degurba int, macro_score double, traffic_scope string, near_ev_station boolean, "
    "ev_station_id string, road_feature_id string, road_osm_id string, highway string, maxspeed_kph double, "
    "lanes double, road_len_m double, road_centroid_wkt_4326 string, frc string, current_speed bigint, "
    "free_flow_speed bigint, current_travel_time bigint, free_flow_travel_time bigint, confidence double, "
    "road_closure boolean, segment_linestring_wkt_4326 string, segment_coords_json string, "
    "speed_ratio double, delay_sec bigint, delay_ratio double, http_status int, error_message string, "
    "raw_json string, load_ts timestamp_ntz"
)
LANDING_RAW = "record_metadata string, record_content variant, inserted_at timestamp_ntz"

# What each traffic request asked for.
TRAFFIC_ZOOM = 10
TRAFFIC_VERSION = "4"
EVENT_SOURCE = "TOMTOM"
