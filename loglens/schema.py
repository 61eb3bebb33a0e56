"""Table schemas, sentinels and the fixed values of the log domain."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These have to be exactly these for results to be right.
# ---------------------------------------------------------------------------

# Sentinels that stand for a missing field.
MISSING_CASE = "Unknown"
MISSING_NODE = "Unknown"
MISSING_PLATFORM = "Unknown"
MISSING_GRID = "Unknown"
MISSING_CATEGORY = "other"
MISSING_TIME_SPAN = "Unknown-Unknown"
MISSING_VERSION = -1

# Names and marks looked for in a support bundle.
PRODUCT_TOKEN = "bycast"
MARKER_FILE = "lumberjack.log"
VERSION_SIDECAR = "system_commands"
PLATFORM_SIDECAR = "os/etc/user_data"
RELEASE_MARK = "storage-grid-release-"
PLATFORM_KEY = "HV_ENV"
KNOWN_PLATFORMS = ["vSphere", "SGA"]

# File name rules.
LOG_EXTENSIONS = [".txt", ".log"]
LOG_STEMS = ["syslog", "messages", "system_commands"]
ARCHIVE_EXTENSIONS = [".gz", ".tgz", ".tar", ".zip", ".7z"]

# File categories, tried in this order.
CATEGORY_PATTERNS = {
    "audit": ".*audit.*",
    "base_os_commands": ".*base[/_-]*os[/_-]*.*command.*",
    "bycast": ".*bycast.*",
    "cassandra_commands": ".*cassandra[/_-]*command.*",
    "cassandra_gc": ".*cassandra[/_-]*gc.*",
    "cassandra_system": ".*cassandra[/_-]*system.*",
    "dmesg": ".*dmesg.*",
    "gdu_server": ".*gdu[/_-]*server.*",
    "init_sg": ".*init[/_-]*sg.*",
    "install": ".*install.*",
    "kern": ".*kern.*",
    "messages": ".*messages.*",
    "pge_image_updater": ".*pge[/_-]*image[/_-]*updater.*",
    "pge_mgmt_api": ".*pge[/_-]*mgmt[/_-]*api.*",
    "server_manager": ".*server[/_-]*manager.*",
    "sg_fw_update": ".*sg[/_-]*fw[/_-]*update.*",
    "storagegrid_node": ".*storagegrid.*node.*",
    "storagegrid_daemon": ".*storagegrid.*daemon.*",
    "syslog": ".*syslog.*",
    "system_commands": ".*system[/_-]*commands.*",
    "upgrade": ".*upgrade.*",
}

# Choices offered to whoever asks an occurrence question.
ALL_VERSIONS = "All Versions"
ALL_PLATFORMS = "All Platforms"
PRE_10 = "Pre-10"
UNKNOWN = "Unknown"
PLATFORM_CHOICES = ["vSphere", "Container", "StorageGRID appliance", "Unknown"]
VERSION_CHOICES = ["Pre-10", "10.0", "10.1", "10.2", "10.3", "10.4",
                   "11.0", "11.1", "11.2", "11.3", "11.4", "Unknown"]
PLATFORM_ALIASES = {"StorageGRID appliance": "SGA"}

# Result titles and labels.
CHART_TOTAL = "Occurances"
CHART_VERSION = "Occurances by Version"
CHART_PLATFORM = "Occurances by Platform"
LABEL_OCCURS = "Occurs"
LABEL_ABSENT = "Does not occur"

# Numbers.
MATCH_PERCENT = 75
LONGEST_TOKEN = 255
DOC_ID_LIMIT = 512
OUTER_BUCKETS = 10000
INNER_BUCKETS = 10
PAGE_SIZE = 10
SAFETY_LAG_S = 360
FIRST_WINDOW_START = -70 * 365 * 24 * 60 * 60

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------


_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
          "TIMESTAMP": T.TimestampType(), "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType(),
          "ARRAY<STRING>": T.ArrayType(T.StringType())}


def _schema(columns: str) -> T.StructType:
    # Not parsed as DDL: that needs a session, and tasks import this module without one.
    pairs = (c.split(" ") for c in columns.replace("`", "").split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCOPE_FIELDS = ("node_name", "grid_id", "time_span", "category", "platform",
                "major_version", "minor_version")

FILES = _schema("relpath STRING, uri STRING, mtime TIMESTAMP, length BIGINT, is_archive BOOLEAN")

MEMBERS = _schema("archive STRING, relpath STRING, mtime TIMESTAMP, chunk_no INT, "
                  "first_line BIGINT, content BINARY, error STRING")

SCOPES = _schema("dir STRING, depth INT, node_name STRING, grid_id STRING, time_span STRING, "
                 "category STRING, platform STRING, major_version INT, minor_version INT")

LOG_LINES = _schema("doc_id STRING, relpath STRING, line_no BIGINT, `case` STRING, node_name STRING, "
                    "major_version INT, minor_version INT, platform STRING, categorize_time TIMESTAMP, "
                    "message STRING, tokens ARRAY<STRING>, category STRING, time_span STRING, "
                    "grid_id STRING")

INGEST_REPORT = _schema("relpath STRING, `case` STRING, categorize_time TIMESTAMP, "
                        "lines BIGINT, expected BIGINT, ok BOOLEAN")

ARCHIVE_ERRORS = _schema("archive STRING, error STRING")

# Batches of a stream that keeps scopes begin with this; only they have corrections.
SCOPED_BATCH = "s"

CORRECTIONS = _schema("dir STRING, node_name STRING, grid_id STRING, time_span STRING, category STRING, platform STRING, "
                      "major_version INT, minor_version INT, categorize_time TIMESTAMP")

LEDGER = _schema("seq BIGINT, start BIGINT, stop BIGINT, input_dir STRING, last_path STRING, "
                 "`case` STRING, batch STRING")

REQUESTS = _schema("query_id BIGINT, log_text STRING, version STRING, platform STRING")
