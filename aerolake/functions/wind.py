"""Eight-way compass bucket of a wind direction in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compass sectors in clockwise order starting at north; each
# sector is 45 degrees wide and the first boundary is at 22.5 degrees.
SECTORS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
SECTOR_WIDTH = 45.0
FIRST_BOUNDARY = 22.5


def wind_bucket(direction: Column) -> Column:
    """Sector of ``direction``; sectors are closed below and open above.

    Values in [22.5, 337.5) fall in NE..NW by their 45-degree slot; all else
    (north, out-of-range values and NULL) is 'N'.
    """
    d = direction.cast("double")
    inside = (d >= F.lit(FIRST_BOUNDARY)) & (d < F.lit(FIRST_BOUNDARY + 7 * SECTOR_WIDTH))
    slot = F.floor((d - F.lit(FIRST_BOUNDARY)) / F.lit(SECTOR_WIDTH)).cast("int") + 2
    names = F.array(*[F.lit(s) for s in SECTORS])
    return F.when(F.coalesce(inside, F.lit(False)), F.element_at(names, slot)).otherwise(F.lit("N"))
