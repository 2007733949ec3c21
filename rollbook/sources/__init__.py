"""Reading, staging and refreshing tables."""
from rollbook.sources.headers import HEADERS, with_headers
from rollbook.sources.history import since, snapshot, union_years, with_snapshot
from rollbook.sources.schemas import CODES, SOURCES, TARGETS
from rollbook.sources.landing import land_checked, land_days
from rollbook.sources.stages import Stages
from rollbook.sources.tables import land, load, refresh, release, scratch, shared_folder, stage, tidy
from rollbook.sources.versions import publish, publish_table

__all__ = ["CODES", "HEADERS", "SOURCES", "Stages", "TARGETS", "land", "land_checked", "land_days", "load", "publish", "publish_table", "refresh", "release", "scratch", "shared_folder", "since", "snapshot", "stage", "tidy",
           "union_years", "with_headers", "with_snapshot"]
