"""Codes, limits and formats that results depend on."""

# --- Fixed values: species ---------------------------------------------------
NATIVE_SPECIES = ["CS", "RZ", "HB", "BT", "FM", "BH", "RT", "SD", "CH"]
COMMON_SPECIES = [
    "CS", "RZ", "HB", "BT", "SD", "FM", "BH", "RT", "SM", "BC", "LG",
    "BG", "GS", "GC", "BB", "YB", "WE", "GZ", "NP", "WS", "CH",
]
LARGE_BODIED_SPECIES = ["CC", "GC", "NP"]
LIFESTAGE_SPECIES = ["SM", "NP", "WE"]
UNIDENTIFIED_SPECIES = "UI"

# --- Fixed values: plausibility limits used by the quality flags --------------
REACH_LIMITS = {  # reach code: lowest and highest river mile, both inclusive
    "ECHO": (319.9, 344.4),
    "DESO": (128.5, 215.8),
    "LGR": (0.0, 128.5),
    "LCO": (0.0, 110.5),
    "WW": (110.5, 127.6),
    "LSJ": (0.0, 53.0),
}
MAX_SITE_MILES = 5
MIN_EFFORT_SECONDS = 1000
MAX_EFFORT_SECONDS = 7200
MAX_LENGTH_MM = 1000
MAX_WEIGHT_G = 2800
PIT_NUMBER_LENGTHS = {"134": 14, "400": 9}  # tag type: digits of a valid number
FLAG = "FLAG"

# --- Fixed values: river-mile correction, by reach ------------------------------
MILE_OFFSETS = {"DESO": 120, "ECHO": 120}

# --- Fixed values: study phases, first match wins --------------------------------
# study, river, lowest mile, highest mile (None: no upper bound), phase
STUDY_PHASES = [
    ("123a", "GR", 132, 250, "123a-DESO"),
    ("123a", "GR", 250, None, "123a-ECHO"),
    ("123d", "GR", 130, 150, "123d-GRAY"),
]

# --- Fixed values: report reaches, first match wins -------------------------------
LOWER_COLORADO = ("LCO", "Lower Colorado River")
TUSHER = ("LGR", "Tusher")
LOWER_GRAY = ("DESO", "Lower Gray Canyon")
TUSHER_MILES = (100, 129.5)

# --- Fixed values: target species by study -----------------------------------------
RAZORBACK_STUDY_PREFIX = "160"
RAZORBACK_TARGET = "RZ"
DEFAULT_TARGET = "CS"

# --- Fixed values: gauging stations -------------------------------------------------
STATIONS = [  # station id, station name, river, reach
    ("09261000", "Jensen, Utah", "GR", "MGR"),
    ("09315000", "Green River, Utah", "GR", "LGR"),
    ("09180500", "Near Cisco, Utah (Dewey)", "CO", "LCO"),
]
DISCHARGE_PARAMETER = "00060"
TEMPERATURE_PARAMETER = "00010"

# --- Fixed values: coordinate systems ------------------------------------------------
EPSG_UTM_12N = 32612
EPSG_WGS84 = 4326
WGS84_SEMI_MAJOR = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_12_CENTRAL_MERIDIAN = -111.0

# --- Fixed values: text formats and markers -------------------------------------------
MISSING_TEXT = "Z"
NO_RAYS_TEXT = "N"
DISPLAY_DATE = "dd MMMM yyyy"
LOCAL_ZONE = "America/Denver"
FLAG_OR_INDEX_COLUMNS = "_flg$|_index$"
HELPER_COLUMNS = "_flg$|_index$|^key_"
SECCHI_NOTE = ".*[Ss]ecchi.*"
RIPE_TEXT = "^EXP"
NOT_RIPE_TEXT = "^INT|NOT"
REPORT_FILE = r"([^/_]+)_([0-9]{4})_ar-([a-z]+)\.csv"
REPORT_SEASON_END = (10, 1)  # month and day; report hydrology stops before it
