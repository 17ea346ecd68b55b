"""Library-services reports (inventory, circulation, course reserves) as Spark jobs."""

from biblioscope.plans.catalog import REPORTS, register_views, reports_catalog, run
from biblioscope.plans.upkeep import refresh_daily, refresh_derived, store_daily, store_derived, stored
from biblioscope.sources.layout import store_histories, store_lookups
from biblioscope.sources.staging import release
from biblioscope.sources.tables import Tables

__all__ = [
    "REPORTS",
    "Tables",
    "refresh_daily",
    "refresh_derived",
    "register_views",
    "release",
    "reports_catalog",
    "run",
    "store_daily",
    "store_derived",
    "store_histories",
    "store_lookups",
    "stored",
]
