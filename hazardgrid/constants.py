"""Fixed values the results depend on.

Everything here is data rather than logic: lookup tables, thresholds, weights,
field lists and error texts. They are kept together so that a change of
business rule is a change of one line in one file.
"""

# --- Fixed values: score -----------------------------------------------------
WEATHER_WEIGHT = 0.45
AIR_WEIGHT = 0.35
LOGISTICS_WEIGHT = 0.20
PM25_FULL_RISK = 75.0

# Fixed values: (exclusive upper bound, band), last band is open ended.
BAND_EDGES = [(25, "LOW"), (50, "MODERATE"), (75, "HIGH")]
TOP_BAND = "CRITICAL"
NO_DATA_BAND = "INSUFFICIENT_DATA"
RISK_BANDS = ["LOW", "MODERATE", "HIGH", "CRITICAL", "INSUFFICIENT_DATA"]
ALERTING_BANDS = ["HIGH", "CRITICAL"]

# --- Fixed values: weather ---------------------------------------------------
SEVERITY_RISK = {
    "minor": 25.0,
    "moderate": 50.0,
    "severe": 80.0,
    "extreme": 100.0,
}

PROVINCE_CITY = {
    "DKI Jakarta": "Jakarta",
    "Jakarta": "Jakarta",
    "Jawa Barat": "Bandung",
    "Jawa Timur": "Surabaya",
    "Jawa Tengah": "Semarang",
    "DI Yogyakarta": "Yogyakarta",
    "Daerah Istimewa Yogyakarta": "Yogyakarta",
    "Sumatera Utara": "Medan",
}

AREA_ALIASES = {
    "Kep. Riau": "Kepulauan Riau",
    "Kep. Bangka Belitung": "Kepulauan Bangka Belitung",
}

CAP_NAMESPACE = "urn:oasis:names:tc:emergency:cap:1.2"
CAP_FILE_SUFFIX = "_alert.xml"
INGESTION_DATE_PATTERN = r"ingestion_date=(\d{4}-\d{2}-\d{2})"

# --- Fixed values: air-quality events ---------------------------------------
FRESHNESS_HOURS = 24
PM25_NAME = "pm25"
PM25_ID = 2

LAT_MIN, LAT_MAX = -11.0, 6.0
LON_MIN, LON_MAX = 95.0, 141.0
COUNTRY_CODE = "ID"
EVENT_SOURCE = "openaq"

STRICT_REQUIRED_FIELDS = [
    "source",
    "ingestion_timestamp",
    "location_id",
    "latitude",
    "longitude",
    "parameter",
    "value",
    "measurement_datetime",
]

INGEST_AGE_REQUIRED_FIELDS = [
    "source",
    "ingestion_timestamp",
    "location_id",
    "value",
    "measurement_datetime",
]

STREAM_WINDOW = "60 seconds"
STREAM_EARLY_TRIGGER = "30 seconds"

# Monitoring stations mapped to operating cities
# (location_id, city, mapping_method, notes).
STATION_SEED = [
    (2537, "Jakarta", "explicit_location", "US Diplomatic Post: Jakarta South"),
    (2538, "Jakarta", "explicit_location", "US Diplomatic Post: Jakarta Central"),
    (8320, "Jakarta", "explicit_location", "Jakarta South"),
    (8637, "Jakarta", "explicit_location", "Jakarta Central"),
    (223262, "Jakarta", "explicit_location", "Cilandek"),
    (223824, "Jakarta", "explicit_location", "Cilandek"),
    (1776543, "Jakarta", "explicit_location", "Jakarta location"),
    (1894639, "Jakarta", "explicit_location", "Jakarta location"),
    (2071976, "Jakarta", "explicit_location", "Krukut"),
    (3276989, "Jakarta", "explicit_location", "Cipete Jakarta"),
    (3280117, "Jakarta", "explicit_location", "Cipete Jakarta"),
    (3294802, "Jakarta", "explicit_location", "Cipete Dec"),
    (6051931, "Jakarta", "explicit_location", "West Jakarta Mayor Office"),
    (6051932, "Jakarta", "explicit_location", "East Jakarta Mayor Office"),
    (6051933, "Jakarta", "explicit_location", "Rusunawa Marunda"),
    (6409860, "Jakarta", "explicit_location", "Jakarta home open storage room"),
    (6455006, "Jakarta", "explicit_location", "BMKG 1"),
    (1285347, "Bandung", "explicit_location", "SPARTAN - ITB Bandung"),
    (3056210, "Bandung", "explicit_location", "Pasteur Gateway Apartment"),
    (3037147, "Yogyakarta", "explicit_location", "Wedomartani"),
    (4047633, "Yogyakarta", "explicit_location", "Yogyakarta"),
    (5586536, "Medan", "explicit_location", "USU"),
]

# The four layers data moves through.
LAYERS = ["bronze", "silver", "gold", "audit"]
