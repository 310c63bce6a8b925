"""Turn a folder or bucket of mixed files into clean, typed, linked tables on Spark."""

from lakeloader.model import CommitConflict, LoadError, ObjectChanged
from lakeloader.plans.catalog import Catalog, Column, Stream
from lakeloader.plans.discover import Discovery, discover
from lakeloader.plans.state import Sink, state_from_json, state_to_json
from lakeloader.plans.sync import Settings, SyncResult, sync
from lakeloader.plans.tables import Tables, read_tables
from lakeloader.session import prepare
from lakeloader.sources.layout import build_layout
from lakeloader.sources.listing import list_objects

__all__ = [
    "Catalog", "Column", "CommitConflict", "Discovery", "LoadError", "ObjectChanged", "Settings", "Sink",
    "Stream", "SyncResult", "Tables", "build_layout", "discover", "list_objects", "prepare", "read_tables",
    "state_from_json", "state_to_json", "sync",
]
