"""Clean trip frames made inline."""

import random
from datetime import datetime, timedelta

from quietfare import schemas as S

SCHEMA = (
    "hvfhs_license_num string, dispatching_base_num string, originating_base_num string, request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "PULocationID int, DOLocationID int, trip_miles double, trip_time bigint, " + ", ".join(f"{c} double" for c in S.MONEY_COLUMNS) + ", " + ", ".join(f"{c} string" for c in S.FLAG_COLUMNS)
)


def clean(n=200, seed=7):
    random.seed(seed)
    rows = []
    for i in range(n):
        start, length = datetime(2026, 4, 1) + timedelta(seconds=i), random.randint(120, 3599)
        row = {
            "hvfhs_license_num": "HV0003", "dispatching_base_num": "B03404", "originating_base_num": "B03404", "request_datetime": start - timedelta(seconds=60), "on_scene_datetime": start - timedelta(seconds=30),
            "pickup_datetime": start, "dropoff_datetime": start + timedelta(seconds=length), "PULocationID": random.randint(1, 265), "DOLocationID": random.randint(1, 265), "trip_miles": round(random.uniform(0.2, 25), 3), "trip_time": length,
        }
        row |= {c: round(random.uniform(1, 30), 2) for c in S.MONEY_COLUMNS} | {c: random.choice("YN") for c in S.FLAG_COLUMNS}
        rows.append(row)
    return rows


def frame(spark, rows):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], SCHEMA)
