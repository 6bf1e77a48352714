"""All queries of the engine's own operators, and the SQL that each is held against."""

from tidewatch.functions import scalars
from tidewatch.operators import centerline, instances, migration, overlays, polygons, raster, records, reprojection, statistics, surface, trajectory, tuning, workflow
from tidewatch.plans import catalogue
from tidewatch.streaming import notifications, retries

MODULES = (scalars, centerline, instances, migration, overlays, polygons, raster, records, reprojection, statistics, surface, trajectory, tuning, workflow)


def queries() -> dict:
    out = catalogue.queries() | notifications.QUERIES | retries.QUERIES
    for m in MODULES:
        out |= m.QUERIES
    return out


def oracles() -> dict[str, str]:
    out = catalogue.oracles() | notifications.ORACLES | retries.ORACLES
    for m in MODULES:
        out |= m.ORACLES
    return out
