"""Names and constants of the data model."""

# Metadata columns of file streams and child streams.
KEY = "_s3_key"
LAST_MODIFIED = "_s3_last_modified"
ROW_NUMBER = "_row_number"
PARENT_ROW = "_parent_row"
INDEX = "_index"
ROW_KEY = "_row_key"
PARENT_PREFIX = "_parent__"
ROOT_METADATA = (KEY, LAST_MODIFIED, ROW_NUMBER)
CHILD_METADATA = (KEY, LAST_MODIFIED, PARENT_ROW, INDEX, ROW_KEY)
ROOT_KEYS = (KEY, ROW_NUMBER)
CHILD_KEYS = (KEY, ROW_KEY)

# Nesting cap, sample size, limits and lookback.
SEPARATOR = "__"
MAX_DEPTH = 10
SAMPLE_OBJECTS = 5
SAMPLE_ROWS = 1000
LIMITED_MAX_OBJECTS = 20
LOOKBACK_MINUTES = 60
MAX_REPORTED_KEYS = 100
SNIFF_CHARS = 16 * 1024

# File extension to reader family.
DELIMITED, JSON, JSONL, PARQUET = "delimited", "json", "jsonl", "parquet"
KIND_BY_EXTENSION = {
    "csv": DELIMITED,
    "tsv": DELIMITED,
    "txt": DELIMITED,
    "json": JSON,
    "jsonl": JSONL,
    "ndjson": JSONL,
    "parquet": PARQUET,
}

LISTING_SCHEMA = "key string, path string, last_modified timestamp, size bigint, etag string"


class LoadError(Exception):
    """An object can't be read as its format, or breaks its catalog schema."""


class ObjectChanged(LoadError):
    """An object no longer has the version that was listed."""


class CommitConflict(Exception):
    """Another run has committed since the state was loaded."""
