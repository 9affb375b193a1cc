"""Values that the oracles expect, written out here and imported from nowhere.

A wrong code name, key, table name or rule in the engine therefore turns a query red.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# The source system's code lists, table names and rules.
# ---------------------------------------------------------------------------

PRODUCTION_TYPES = {
    "B01": "Biomass",
    "B02": "Fossil Brown coal/Lignite",
    "B03": "Fossil Coal-derived gas",
    "B04": "Fossil Gas",
    "B05": "Fossil Hard coal",
    "B06": "Fossil Oil",
    "B07": "Fossil Oil shale",
    "B08": "Fossil Peat",
    "B09": "Geothermal",
    "B10": "Hydro Pumped Storage",
    "B11": "Hydro Run-of-river and poundage",
    "B12": "Hydro Water Reservoir",
    "B13": "Marine",
    "B14": "Nuclear",
    "B15": "Other renewable",
    "B16": "Solar",
    "B17": "Waste",
    "B18": "Wind Offshore",
    "B19": "Wind Onshore",
    "B20": "Other",
    "B25": "Energy storage",
}

WEATHER_CODES = {
    0: ("Clear", "clear sky"),
    1: ("Clouds", "mainly clear"),
    2: ("Clouds", "partly cloudy"),
    3: ("Clouds", "overcast"),
    45: ("Fog", "fog"),
    48: ("Fog", "depositing rime fog"),
    51: ("Drizzle", "light drizzle"),
    53: ("Drizzle", "moderate drizzle"),
    55: ("Drizzle", "dense drizzle"),
    56: ("Drizzle", "light freezing drizzle"),
    57: ("Drizzle", "dense freezing drizzle"),
    61: ("Rain", "slight rain"),
    63: ("Rain", "moderate rain"),
    65: ("Rain", "heavy rain"),
    66: ("Rain", "light freezing rain"),
    67: ("Rain", "heavy freezing rain"),
    71: ("Snow", "slight snow fall"),
    73: ("Snow", "moderate snow fall"),
    75: ("Snow", "heavy snow fall"),
    77: ("Snow", "snow grains"),
    80: ("Rain", "slight rain showers"),
    81: ("Rain", "moderate rain showers"),
    82: ("Rain", "violent rain showers"),
    85: ("Snow", "slight snow showers"),
    86: ("Snow", "heavy snow showers"),
    95: ("Thunderstorm", "thunderstorm"),
    96: ("Thunderstorm", "thunderstorm with slight hail"),
    99: ("Thunderstorm", "thunderstorm with heavy hail"),
}

LINEITEM_RULES = {
    "valid_orderkey": "l_orderkey IS NOT NULL",
    "positive_quantity": "l_quantity > 0",
    "plausible_discount": "l_discount BETWEEN 0 AND 0.08",
    "plausible_price": "l_extendedprice <= 100000",
}
ORDERS_RULES = {
    "valid_orderdate": "o_orderdate IS NOT NULL",
    "plausible_total": "o_totalprice <= 450000",
}
CUSTOMER_RULES = {
    "non_negative_balance": "c_acctbal >= 0",
    "valid_segment": "c_mktsegment IS NOT NULL",
}


@dataclass(frozen=True)
class Expected:
    """What the oracles expect of a domain."""
    pipeline: str
    bronze_table: str
    silver_table: str
    column_names: tuple
    keys: tuple
    order_column: str
    tiebreak: tuple
    bronze_rules: dict
    silver_rules: dict
    silver_drop_rules: dict


PRICES = Expected(
    pipeline="entsoe",
    bronze_table="bronze_entsoe_day_ahead_prices",
    silver_table="silver_entsoe_day_ahead_prices",
    column_names=("delivery_start", "delivery_end", "price_gbp_per_mwh", "currency",
                  "bidding_zone", "fetched_at"),
    keys=("bidding_zone", "delivery_start"),
    order_column="fetched_at",
    tiebreak=("delivery_end", "price_gbp_per_mwh", "currency"),
    bronze_rules={
        "no_rescued_data": "_rescued_data IS NULL",
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_bidding_zone": "bidding_zone IS NOT NULL",
    },
    silver_rules={
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_bidding_zone": "bidding_zone IS NOT NULL",
        "valid_price": "price_gbp_per_mwh IS NOT NULL",
        "non_negative_price": "price_gbp_per_mwh >= 0",
        "plausible_price": "price_gbp_per_mwh <= 500",
    },
    silver_drop_rules={
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_bidding_zone": "bidding_zone IS NOT NULL",
        "valid_price": "price_gbp_per_mwh IS NOT NULL",
    },
)

GENERATION = Expected(
    pipeline="entsoe_generation",
    bronze_table="bronze_entsoe_actual_generation",
    silver_table="silver_entsoe_actual_generation",
    column_names=("delivery_start", "delivery_end", "production_type_code", "production_type",
                  "quantity_mw", "bidding_zone", "fetched_at"),
    keys=("bidding_zone", "production_type_code", "delivery_start"),
    order_column="fetched_at",
    tiebreak=("delivery_end", "production_type", "quantity_mw"),
    bronze_rules={
        "no_rescued_data": "_rescued_data IS NULL",
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_production_type_code": "production_type_code IS NOT NULL",
    },
    silver_rules={
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_production_type_code": "production_type_code IS NOT NULL",
        "valid_quantity": "quantity_mw IS NOT NULL",
        "non_negative_quantity": "quantity_mw >= 0",
        "plausible_quantity": "quantity_mw <= 50000",
    },
    silver_drop_rules={
        "valid_delivery_start": "delivery_start IS NOT NULL",
        "valid_production_type_code": "production_type_code IS NOT NULL",
        "valid_quantity": "quantity_mw IS NOT NULL",
    },
)

WEATHER = Expected(
    pipeline="openmeteo",
    bronze_table="bronze_openmeteo_hourly_weather",
    silver_table="silver_openmeteo_hourly_weather",
    column_names=("observation_time", "location", "latitude", "longitude", "temp_celsius",
                  "feels_like_celsius", "humidity_pct", "clouds_pct", "wind_speed_ms",
                  "weather_main", "weather_description", "fetched_at"),
    keys=("location", "observation_time"),
    order_column="fetched_at",
    tiebreak=("latitude", "longitude", "temp_celsius", "feels_like_celsius", "humidity_pct",
                  "clouds_pct", "wind_speed_ms", "weather_main", "weather_description"),
    bronze_rules={
        "no_rescued_data": "_rescued_data IS NULL",
        "valid_observation_time": "observation_time IS NOT NULL",
        "valid_location": "location IS NOT NULL",
    },
    silver_rules={
        "valid_observation_time": "observation_time IS NOT NULL",
        "valid_location": "location IS NOT NULL",
        "valid_temp": "temp_celsius IS NOT NULL",
        "plausible_temp": "temp_celsius BETWEEN -60 AND 60",
        "valid_humidity": "humidity_pct BETWEEN 0 AND 100",
        "non_negative_wind": "wind_speed_ms >= 0",
    },
    silver_drop_rules={
        "valid_observation_time": "observation_time IS NOT NULL",
        "valid_location": "location IS NOT NULL",
        "valid_temp": "temp_celsius IS NOT NULL",
    },
)
