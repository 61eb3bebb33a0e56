"""Log-shaped views derived from the check tables.

Unless a view says otherwise its text is valid unchanged in Spark SQL and in the SQL of the checking engine,
so that both sides start from the same rows. ``{name}`` stands for the table ``name``.
"""

from loglens import schema as S
from checks.tables import DOC_FILES


def text(number: str) -> str:
    return f"CAST({number} AS VARCHAR(20))"


# One request per benchmark item, with filters that vary.
REQUESTS = f"""
SELECT item_id AS query_id, text AS log_text,
  CASE item_id % 5 WHEN 0 THEN 'All Versions' WHEN 1 THEN 'Pre-10' WHEN 2 THEN '10.4' WHEN 3 THEN 'Unknown'
    ELSE 'All Versions' END AS version,
  CASE item_id % 3 WHEN 0 THEN 'All Platforms' WHEN 1 THEN 'vSphere' ELSE 'StorageGRID appliance' END AS platform
FROM {{benchmark}}
UNION ALL
SELECT 1000000 + turn AS query_id, min(text) AS log_text, 'All Versions' AS version, 'All Platforms' AS platform
FROM {{conversations}} WHERE text <> '' GROUP BY turn
UNION ALL
SELECT DISTINCT 2000000 AS query_id, 'and the of with error' AS log_text, 'All Versions' AS version,
  'All Platforms' AS platform FROM {{benchmark}}"""

PAGE_PATHS = "SELECT page_id, regexp_replace(url, '^[a-z]+://', '/') AS path FROM {pages}"

ARCHIVE_NAMES = f"""
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN path || '/.zip' ELSE path || 'b' ||
  CASE page_id % 6 WHEN 0 THEN '.tar.gz' WHEN 1 THEN '.zip' WHEN 2 THEN '.tgz.zip.7z' WHEN 3 THEN '.log.gz'
    WHEN 4 THEN '' ELSE '.zip.log' END END AS path
FROM ({PAGE_PATHS}) p"""

DIRTY_PATHS = f"SELECT page_id, path || '/./a/../b//c/..' AS path FROM ({PAGE_PATHS}) p"

_LOG_NAMES = ["audit.log", "base-os/x_command.txt", "bycast.log", "cassandra_commands", "cassandra/gc.log",
              "cassandra-system.log", "dmesg.txt", "gdu-server.log", "initSG.log", "init_sg.log", "install.log",
              "kern.log", "messages", "pge_image_updater.log", "pge-mgmt-api.log", "servermanager.log",
              "sg_fw_update", "storagegrid-node.log", "storagegrid_daemon", "syslog.1", "system_commands",
              "upgrade.log", "random.txt", "server/manager"]
_NAME_CASE = (f"CASE doc_id % {len(_LOG_NAMES)} "
              + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_LOG_NAMES)) + " END")

LOG_PATHS = f"SELECT doc_id, case_num || '/' || grid_id || '/' || node_name || '/' || {_NAME_CASE} AS path FROM ({DOC_FILES}) f"

BUNDLE_DIRS = f"""
SELECT doc_id,
  CASE WHEN doc_id % 11 = 0 THEN 'in/' || {text('doc_id')} ELSE 'in/' || case_num END AS case_dir,
  '/in/' || grid_id || '/' || node_name || '/' ||
    CASE doc_id % 4 WHEN 0 THEN '2018-2019' WHEN 1 THEN '2018' WHEN 2 THEN {text('doc_id')} || '-' || {text('doc_id + 1')}
      ELSE 'ABC-ABC' END AS abs_dir
FROM ({DOC_FILES}) f"""

# Lines of all events; directories 'n...' have none that says anything.
VERSION_LINES = f"""
SELECT 'd' || {text('user_id')} AS dir, event_id,
  CASE event_id % 9
    WHEN 0 THEN 'storage-grid-release-' || {text('event_id % 12')} || '.' || {text('event_id % 5')} || '.0-1'
    WHEN 1 THEN 'storage-grid-release-x.y' WHEN 2 THEN 'storage-grid-release-11'
    WHEN 3 THEN 'a storage-grid-release- 10. 4 .storage-grid-release-' ELSE event_type END AS line
FROM {{events}}
UNION ALL
SELECT 'n' || {text('user_id')} AS dir, event_id * 9 + 4 AS event_id, event_type AS line FROM {{events}}"""

PLATFORM_LINES = f"""
SELECT 'd' || {text('user_id')} AS dir, event_id,
  CASE event_id % 11 WHEN 0 THEN ' HV_ENV = ''"SGA"'';' WHEN 1 THEN 'HV_ENV=vSphere'
    WHEN 2 THEN 'HV_ENV = "mainframe" ;' WHEN 3 THEN 'HV_ENV : SGA' ELSE event_type || '=SGA' END AS line
FROM {{events}}
UNION ALL
SELECT 'n' || {text('user_id')} AS dir, event_id * 11 + 5 AS event_id, event_type || '=SGA' AS line FROM {{events}}"""

TREE_DIRS = f"""
SELECT DISTINCT case_num || '/' || grid_id || '/' || node_name || '/' || 's' || {text('doc_id % 10')} AS dir
FROM ({DOC_FILES}) f"""

TREE_SCOPES = f"""
SELECT DISTINCT case_num || '/' || grid_id AS dir, CAST(2 AS INTEGER) AS depth, 'Unknown' AS node_name, grid_id,
  '2018-2019' AS time_span, 'other' AS category, 'SGA' AS platform, CAST(10 AS INTEGER) AS major_version,
  CAST(1 AS INTEGER) AS minor_version FROM ({DOC_FILES}) f WHERE doc_id % 3 <> 0
UNION ALL
SELECT DISTINCT case_num || '/' || grid_id || '/' || node_name AS dir, CAST(3 AS INTEGER) AS depth, node_name,
  'Unknown' AS grid_id, 'Unknown-Unknown' AS time_span, 'kern' AS category, 'Unknown' AS platform,
  CAST(-1 AS INTEGER) AS major_version, CAST(-1 AS INTEGER) AS minor_version FROM ({DOC_FILES}) f WHERE doc_id % 2 = 0
UNION ALL
SELECT DISTINCT case_num || '/' || grid_id || '/' || node_name || '/' || 's' || {text('doc_id % 10')} AS dir,
  CAST(4 AS INTEGER) AS depth, 'deep' AS node_name, 'Unknown' AS grid_id, 'Unknown-Unknown' AS time_span,
  'other' AS category, 'vSphere' AS platform, CAST(11 AS INTEGER) AS major_version,
  CAST(-1 AS INTEGER) AS minor_version FROM ({DOC_FILES}) f WHERE doc_id % 10 = 7"""

# Files with and without a node, whose lines mention the product token in some documents only.
NAMED_FILES = f"""
SELECT doc_id, 'f/' || CASE WHEN doc_id % 17 = 0 THEN 'bycast/' ELSE '' END || {text('doc_id')} ||
    CASE doc_id % 4 WHEN 0 THEN '.log' WHEN 1 THEN '.txt' WHEN 2 THEN '/syslog.1' ELSE '.bin' END AS relpath,
  node_name, CASE WHEN doc_id % 3 = 0 THEN replace(text, ' the ', ' bycast ') ELSE text END AS text
FROM ({DOC_FILES}) f"""

ARCHIVES = f"""
SELECT case_num || '/a' || {text('doc_id')} || CASE doc_id % 3 WHEN 0 THEN '.zip' WHEN 1 THEN '.tar.gz' ELSE '.gz' END
  AS relpath FROM ({DOC_FILES}) f"""
UNPACKED = f"""
SELECT case_num || '/a' || {text('doc_id')} || CASE WHEN doc_id % 8 = 0 THEN '/x/y.log' ELSE '' END AS relpath
FROM ({DOC_FILES}) f WHERE doc_id % 4 = 0"""

EVENT_FILES = f"SELECT event_type || '/' || {text('event_id')} || '.log' AS relpath, CAST(ts AS TIMESTAMP) AS mtime, event_id FROM {{events}}"

SCAN_RECORDS = f"""
SELECT event_id AS seq, event_id * 10 AS start, event_id * 10 + 100 AS stop, 'in' AS input_dir,
  CASE WHEN event_type = 'click' THEN '' ELSE event_type || '/' || {text('event_id')} END AS last_path
FROM {{events}}"""

LEDGER_LINES = f'''
SELECT event_id, CASE event_id % 7
    WHEN 0 THEN '9 3 "in" ""' WHEN 1 THEN '59"in"""' WHEN 2 THEN {text('event_id')} || ' 99999999 /in file.txt'
    ELSE {text('event_id')} || ' ' || {text('event_id + 5')} || ' "/my logs/' || event_type || '" "' ||
      CASE event_id % 2 WHEN 0 THEN '' ELSE 'host/a.log' END || '"' END AS value
FROM {{events}}'''

EVENT_DOCUMENTS = f"""
SELECT event_type || '/' || {text('user_id')} AS doc_id, event_id, ts AS categorize_time, props AS message FROM {{events}}"""

EVENT_REPORT = f"""
SELECT event_type || '/' || {text('user_id')} AS relpath, {text('event_id')} AS batch, ts AS categorize_time FROM {{events}}"""

# How the documents are packed into archives and put into a tree; the bytes are made in checks.trees.
ARCHIVE_KINDS = 6
TREE_CASES = 40
PRODUCT = S.PRODUCT_TOKEN
