"""Geographic roll-up through the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_boroughs(trips: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """``trips`` with ``PUBorough`` and ``DOBorough``.

    ``left`` keeps trips of unknown zones with a null borough; ``inner`` drops
    them. The zone side is left to the optimiser, which broadcasts it while its
    size stays under the session's threshold. Zone ids are unique; a repeated id
    keeps the first borough by name.
    """
    dim = zones.groupBy("LocationID").agg(F.min("Borough").alias("Borough"))
    pick = dim.select(F.col("LocationID").alias("_pu"), F.col("Borough").alias("PUBorough"))
    drop = dim.select(F.col("LocationID").alias("_do"), F.col("Borough").alias("DOBorough"))
    out = trips.drop("PUBorough", "DOBorough")
    return out.join(pick, out["PULocationID"] == F.col("_pu"), how).join(drop, out["DOLocationID"] == F.col("_do"), how).drop("_pu", "_do")
