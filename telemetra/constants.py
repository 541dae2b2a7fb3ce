"""Values that must equal the behaviour being reproduced.

Fixed values — kept verbatim, in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Columns of the long readings table, in insert order.
READINGS_COLUMNS = ["company_id", "tag_id", "value", "ts"]
# Columns of the long projections table, in insert order.
PROJECTIONS_COLUMNS = ["company_id", "process_id", "tag_id", "value", "ts"]
# Columns of the predictions table, in insert order.
PREDICTIONS_COLUMNS = ["company_id", "process_id", "ts", "index", "threshold"]
# Item keys that are headers and never become tags.
HEADER_KEYS = ["process_id", "timestamp", "ts", "company_id", "model"]
# Rejection reasons, in the order the rules are applied.
REASON_BAD_VALUE = "bad_value"
REASON_FUTURE = "timestamp_future"
REASON_TOO_OLD = "timestamp_too_old"
# Default clock offset and the offset for override processes, in hours.
HOURS_OFFSET = 3
ALT_HOURS_OFFSET = 4
# Process ids (hyphens removed, lower case) that use the alternative offset.
ALT_PROCESSES = [
    "668dfaa49d19463e9fb0082f8ae52c2f",
    "2e7fa9dccd574a1494a95b43ca76d5f2",
    "567b3498d5d9469681fe1586591fbd9e",
    "f0c7130974924b70a34b7b9516b1036c",
    "b2fd0a766acd40819d8e34df4ba81c48",
    "ef41b354e25948b49667f948694a0957",
]
# Age limit for readings, in hours.
MAX_PAST_HOURS = 4320
# Extraction look-back, in days.
DAYS_BACK = 180
# Row cap of one source range query.
SOURCE_ROW_CAP = 500_000
# Hierarchy depth cap and the level marking a root process.
MAX_DEPTH = 100
ROOT_LEVEL = "root"
# Default model-config type scanned by the backfill.
MODEL_CONFIG_TYPE = "PREDICTION_TRIGGER"
# Words read as true in boolean settings.
TRUE_WORDS = ["1", "true", "yes", "sim"]
# Accepted period-bound formats (Spark datetime patterns), tried in order.
PERIOD_FORMATS = [
    "yyyy-MM-dd-HH:mm:ss",
    "yyyy-MM-dd-HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
]
# Display format of the wide export's first column (seconds dropped).
EXPORT_TS_FORMAT = "yyyy-MM-dd HH:mm"
# First column of the wide export.
EXPORT_TS_COLUMN = "TIMESTAMP"
# Prefix of export manifests that discovery skips.
MANIFEST_PREFIX = "manifest-"
# Interchange CSV name pattern: processo_<id>[-parteN].csv, and the two name formats.
CSV_NAME_PATTERN = r"processo_(.+?)(?:-parte(\d+))?\.csv$"
CSV_SINGLE_NAME = "processo_%s.csv"
CSV_PART_NAME = "processo_%s-parte%d.csv"
# Wide export file name: <company>_<start>_a_<end>.csv, stamps as below.
EXPORT_NAME = "%s_%s_a_%s.csv"
EXPORT_NAME_STAMP = "yyyy-MM-dd_HHmmss"
# Period label: "<start> → <end>", second precision.
PERIOD_LABEL_SEP = " → "
PERIOD_LABEL_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Backfill outcomes.
OUTCOME_UPDATED = "updated"
OUTCOME_SKIPPED = "skipped"
OUTCOME_ERROR = "error"
# ----------------------------------------------------------------------------
