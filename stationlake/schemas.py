"""Raw layouts, clean names, types and code lists of the observation data."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# They must equal the source data and the published model.
# ---------------------------------------------------------------------------

# Daily climate files: header cell (as published, with its leading spaces)
# and the Spark type of the cleaned column.
MEASUREMENT_COLUMNS = {
    "STATIONS_ID": "string",
    "MESS_DATUM": "string",
    "QN_3": "short",
    "  FX": "double",
    "  FM": "double",
    "QN_4": "short",
    " RSK": "double",
    "RSKF": "short",
    " SDK": "double",
    "SHK_TAG": "int",
    "  NM": "string",
    " VPM": "double",
    "  PM": "double",
    " TMK": "double",
    " UPM": "double",
    " TXK": "double",
    " TNK": "double",
    " TGK": "double",
}

# Station location history (latin-1 text).
GEO_COLUMNS = {
    "Stations_id": "string",
    "Stationshoehe": "double",
    "Geogr.Breite": "double",
    "Geogr.Laenge": "double",
    "von_datum": "string",
    "bis_datum": "string",
    "Stationsname": "string",
}
GEO_RENAMES = {"geogr.breite": "geogr_breite", "geogr.laenge": "geogr_laenge"}

# Station operator history: the table starts after this marker and its last
# line is a footer.
OPERATOR_MARKER = "\n\nStations_ID;Betreibername;Von_Datum;Bis_Datum\n "
OPERATOR_COLUMNS = ["stations_id", "betreibername", "betrieb_von_datum", "betrieb_bis_datum"]

# File selection.
MEASUREMENT_FILE_TOKEN = "produkt_klima_tag"
METADATA_FILE_TOKEN = "Metadaten"
GEO_FILE_GLOB = "Metadaten_Geographie*"
OPERATOR_FILE_GLOB = "Metadaten_Stationsname_Betreibername*"
LISTING_KEEP = ".pdf$|.txt$|.zip$"
CATEGORIES = ("historical", "recent")

MISSING = "-999"
STATION_ID_WIDTH = 5
LOCAL_ZONE = "Europe/Brussels"
DATE_FORMAT = "yyyyMMdd"

# Accepted codes.
QUALITY_LEVELS = [1, 2, 3, 5, 7, 8, 9, 10]
PRECIPITATION_FORMS = [0, 1, 4, 6, 7, 8, 9]

# Staging names: clean raw name -> (staging name, kind). Kinds: "key",
# "ts", "int" (rounded), "round2" (float, 2 decimals), "string".
STAGING_COLUMNS = {
    "stations_id": ("station_id", "string"),
    "mess_datum": ("dt_measurement_utc", "ts"),
    "qn_3": ("quality_niveau_3", "int"),
    "qn_4": ("quality_niveau_4", "int"),
    "fx": ("max_wind_gust_mps_qn3", "round2"),
    "fm": ("mean_wind_velocity_mps_qn3", "round2"),
    "rsk": ("precipitation_heigt_mm_qn4", "round2"),
    "rskf": ("precipitation_type_qn4", "int"),
    "sdk": ("sunshine_duration_h_qn4", "int"),
    "shk_tag": ("snow_depth_cm_qn4", "int"),
    "nm": ("mean_cloud_coverage_qn4", "string"),
    "vpm": ("mean_vapour_pressure_hpa_qn4", "round2"),
    "pm": ("mean_pressure_hpa_qn4", "round2"),
    "tmk": ("mean_temperature_2m_c_qn4", "round2"),
    "upm": ("mean_rel_humidity_qn4", "round2"),
    "txk": ("max_temperature_2m_c_qn4", "round2"),
    "tnk": ("min_temperature_2m_c_qn4", "round2"),
    "tgk": ("mean_temperature_5cm_c_qn4", "round2"),
}

# Published names and types of the two dims, by raw column. Fixed values.
GEO_DIM_COLUMNS = {
    "stations_id": ("station_id", "string"),
    "stationshoehe": ("station_height_m", "double"),
    "geogr_breite": ("latitude", "string"),
    "geogr_laenge": ("longitude", "string"),
    "von_datum": ("dt_geo_start", "timestamp_ntz"),
    "bis_datum": ("dt_geo_end", "timestamp_ntz"),
    "stationsname": ("station_name", "string"),
}

OPERATOR_DIM_COLUMNS = {
    "stations_id": ("station_id", "string"),
    "betreibername": ("operator_name", "string"),
    "betrieb_von_datum": ("dt_op_start", "timestamp_ntz"),
    "betrieb_bis_datum": ("dt_op_end", "timestamp_ntz"),
}

MEASURES = [
    name
    for raw, (name, _) in STAGING_COLUMNS.items()
    if raw not in ("stations_id", "mess_datum", "qn_3", "qn_4")
]

FACT_COLUMNS = [
    "measurement_id",
    "station_id",
    "dt_measurement_utc",
    "station_name",
    "operator_name",
    "station_height_m",
    "lat_long",
    "quality_niveau_3",
    "quality_niveau_4",
    *MEASURES,
]


def clean_name(raw: str) -> str:
    """Header cell -> column name: spaces removed, lower case."""
    return raw.replace(" ", "").lower()
