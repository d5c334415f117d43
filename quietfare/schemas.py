"""Column groups of a trip record and the struct of a text span."""

from __future__ import annotations

# The contract's column groups.
REAL_COLUMNS = [
    "hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime",
    "PULocationID", "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay",
    "shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag", "cbd_congestion_fee",
]
MONEY_COLUMNS = ["base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay", "cbd_congestion_fee"]
FLAG_COLUMNS = ["shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag"]
NULLABLE_COLUMNS = ["originating_base_num", "on_scene_datetime", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "cbd_congestion_fee"]
REQUIRED_COLUMNS = [c for c in REAL_COLUMNS if c not in NULLABLE_COLUMNS]
IDENTITY_COLUMNS = ["trip_id", "rider_id", "rider_phone", "rider_email", "device_id", "payment_token", "driver_license_num", "driver_name", "vehicle_plate", "vehicle_vin"]
CONTRACT_TYPES = {c: "timestamp_ntz" if c.endswith("datetime") else "bigint" if c in ("PULocationID", "DOLocationID", "trip_time") else "double" if c in (*MONEY_COLUMNS, "trip_miles") else "string" for c in REAL_COLUMNS}
ZONES = (1, 265)
LICENSE = "HV0003"

# Privacy tier of each column.
TIERS = {
    "direct": IDENTITY_COLUMNS,
    "quasi": ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time"],
    "sensitive": ["support_note", "access_a_ride_flag", "wav_request_flag", "wav_match_flag"],
    "safe": ["hvfhs_license_num", "dispatching_base_num", "originating_base_num", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay", "cbd_congestion_fee", "shared_request_flag", "shared_match_flag"],
}

SPAN = "struct<entity_type:string,start:int,end:int,score:double>"
SPANS = f"array<{SPAN}>"
