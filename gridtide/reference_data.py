"""Reference data: code lists, areas, sites, datasets and plausibility limits.

Everything here is data, not logic.  Operators take these values as parameters,
so another market only needs other values.
"""

# ---------------------------------------------------------------------------
# They must equal the published code lists for results to be right.
# ---------------------------------------------------------------------------

PRODUCTION_TYPES = {
    "B01": "biomass",
    "B02": "fossil_brown_coal",
    "B03": "fossil_coal_derived_gas",
    "B04": "fossil_gas",
    "B05": "hard_coal",
    "B06": "fossil_hard_coal",
    "B07": "fossil_oil",
    "B08": "fossil_oil_shale",
    "B09": "geothermal",
    "B10": "hydro_pumped_storage",
    "B11": "hydro_run_of_river",
    "B12": "hydro_reservoir",
    "B13": "hydro_pumped_storage_consumption",
    "B14": "nuclear",
    "B15": "other_renewable",
    "B16": "solar",
    "B17": "waste",
    "B18": "wind_offshore",
    "B19": "wind_onshore",
    "B20": "other",
}

BUSINESS_TYPES = {
    "A01": "production",
    "A04": "consumption",
    "A93": "wind_generation",
    "A94": "solar_generation",
}

PROCESS_TYPES = {
    "A01": "day_ahead",
    "A02": "intra_day",
    "A16": "realised",
    "A18": "production",
}

RESOLUTION_MINUTES = {
    "PT15M": 15,
    "PT30M": 30,
    "PT60M": 60,
    "PT1H": 60,
    "P1D": 1440,
    "P7D": 10080,
}

MARKET_DATASETS = [
    "actual_total_load",
    "day_ahead_total_load_forecast",
    "day_ahead_energy_prices",
    "day_ahead_aggregated_generation",
    "generation_forecast_wind_solar",
    "actual_generation_per_production_type",
]

GENERATION_DATASETS = ["actual_generation_per_production_type"]
LOAD_DATASETS = ["actual_total_load", "day_ahead_total_load_forecast"]
PRICE_DATASETS = ["day_ahead_energy_prices"]
FORECAST_DATASETS = ["day_ahead_aggregated_generation", "generation_forecast_wind_solar"]
ACTUAL_LOAD = "actual_total_load"

EVERY_DATASET = "all_main_market_datasets"

# Technology labels: generation tables use an underscore, weather tables a hyphen.
SOLAR = "solar"
GENERATION_WIND = ["wind_onshore", "wind_offshore"]
WEATHER_WIND = ["wind-onshore", "wind-offshore"]
WEATHER_DRIVEN = ["solar", "wind_onshore", "wind_offshore"]

RENEWABLE_GENERATION = [
    "solar",
    "wind_onshore",
    "wind_offshore",
    "hydro_run_of_river",
    "hydro_reservoir",
    "hydro_pumped_storage",
    "geothermal",
    "biomass",
    "other_renewable",
]

RENEWABLE_WEATHER = ["solar", "wind-onshore", "wind-offshore"]

# Plausible limits of weather measures, both ends included.
WEATHER_LIMITS = {
    "temperature_2m": (-60.0, 60.0),
    "relative_humidity_2m": (0.0, 100.0),
    "precipitation": (0.0, 500.0),
    "surface_pressure": (850.0, 1100.0),
    "cloud_cover": (0.0, 100.0),
    "shortwave_radiation": (0.0, 1500.0),
    "direct_radiation": (0.0, 1500.0),
    "diffuse_radiation": (0.0, 1000.0),
    "global_tilted_irradiance": (0.0, 1500.0),
    "wind_speed_100m": (0.0, 120.0),
    "wind_direction_100m": (0.0, 360.0),
    "wind_gusts_10m": (0.0, 200.0),
}

# Report buckets: (upper bound, excluded; label), then the label of the rest.
IRRADIANCE_BUCKETS = [
    (50, "0-50   W/m²  very low"),
    (200, "50-200 W/m²  low"),
    (500, "200-500 W/m² moderate"),
    (800, "500-800 W/m² high"),
]
IRRADIANCE_TOP = "800+   W/m²  peak"

WIND_BUCKETS = [
    (5, "00-05 m/s  calm"),
    (10, "05-10 m/s  light"),
    (15, "10-15 m/s  moderate"),
    (20, "15-20 m/s  strong"),
    (25, "20-25 m/s  very strong"),
]
WIND_TOP = "25+   m/s  storm"

# Values written into the envelope and status columns of landed records.
MARKET_SOURCE = "entsoe"
READINGS_ROOT = "GL_MarketDocument"
ACKNOWLEDGEMENT_ROOT = "Acknowledgement_MarketDocument"
STATUS_OK = "ok"
STATUS_EMPTY = "ok_but_empty_points"
STATUS_NO_DATA = "no_data"
STATUS_UNKNOWN = "unknown_response_type"
STATUS_FAILED = "request_failed"
PREVIEW_LENGTH = 1000
