"""Domain constants.

FIXED VALUES — these must equal the values of the warehouse being rebuilt so
that results agree. They are stated here plainly, in their natural order.
"""

# --- FIXED VALUES: production type -> energy category ---------------------
RENEWABLE_TYPES = [
    "Wind Onshore", "Wind Offshore",
    "Solar", "Hydro Run-of-river and poundage",
    "Hydro Water Reservoir", "Geothermal",
    "Marine", "Other renewable",
]
FOSSIL_TYPES = [
    "Fossil Gas", "Fossil Hard coal", "Fossil Brown coal/Lignite",
    "Fossil Oil", "Fossil Coal-derived gas", "Fossil Peat",
]
NUCLEAR_TYPES = ["Nuclear"]
WIND_TYPES = ["Wind Onshore", "Wind Offshore"]
SOLAR_TYPES = ["Solar"]
# Ordered: first matching category wins, anything else is OTHER_CATEGORY.
CATEGORY_MAP = {
    "renewable": RENEWABLE_TYPES,
    "fossil": FOSSIL_TYPES,
    "nuclear": NUCLEAR_TYPES,
}
OTHER_CATEGORY = "other"
CATEGORIES = ["renewable", "fossil", "nuclear", "other"]

# --- FIXED VALUES: seasons by calendar month -------------------------------
SEASON_MONTHS = {
    "winter": [12, 1, 2],
    "spring": [3, 4, 5],
    "summer": [6, 7, 8],
    "autumn": [9, 10, 11],
}

# --- FIXED VALUES: countries in scope --------------------------------------
COUNTRIES_ISO3 = ["DEU", "FRA", "ESP", "POL", "AUT", "HUN",
                  "NOR", "SVK", "LTU", "EST", "LVA"]
COUNTRIES_ISO2 = ["DE", "FR", "ES", "PL", "AT", "HU",
                  "NO", "SK", "LT", "EE", "LV"]
# ISO2 <-> ISO3 crosswalk, paired by position of the two lists above.
CROSSWALK = list(zip(COUNTRIES_ISO2, COUNTRIES_ISO3))
START_YEAR = 2020
END_YEAR = 2025
WEATHER_START = "2023-01-01"
WEATHER_END = "2025-12-31"

# --- FIXED VALUES: groups and the event study ------------------------------
GROUPS = ["core", "geopolitical", "baltic"]
CORE_COUNTRIES = ["DE", "FR", "ES", "PL", "AT", "HU"]
BALTIC_COUNTRIES = ["EE", "LV", "LT"]
EVENT_DATE = "2025-02-01"
EVENT_LABELS = ("pre_brell", "post_brell")

# --- FIXED VALUES: raw column lists ----------------------------------------
OWID_COLUMNS = [
    "iso_code",
    "country",
    "year",
    "renewables_share_elec",
    "low_carbon_share_elec",
    "solar_share_elec",
    "wind_share_elec",
    "hydro_share_elec",
    "nuclear_share_elec",
    "fossil_share_elec",
    "solar_electricity",
    "wind_electricity",
    "carbon_intensity_elec",
]
WEATHER_FIELDS = [
    "wind_speed_10m_max",
    "sunshine_duration",
    "temperature_2m_mean",
    "precipitation_sum",
    "cloud_cover_mean",
]

# --- FIXED VALUES: thresholds and weights ----------------------------------
ROLLING_ROWS = 90              # 89 preceding rows + current row
ANOMALY_Z = 2.5                # strict: abs(z) > 2.5 on the rounded z
INDEPENDENCE_SHARE = 80        # strict: share > 80 on the rounded share
CO2_BASELINE_G_KWH = 300       # EU average intensity used as the baseline
CO2_DIVISOR = 1_000_000
RESILIENCE_WEIGHTS = (0.5, 0.3, 0.2)   # renewable share, low fossil, target progress
LOOKBACK_DAYS = 3
DEV_DAYS = 30
LOAD_RATIO = 1.5
MIN_ROWS_PER_DAY = 4
SHARE_RANGE = (0, 100)

# Source freshness limits in days: (warn_after, error_after).
FRESHNESS_DAYS = {
    "owid_energy": (7, 14),
    "weather_daily": (1, 2),
    "entsoe_generation": (1, 2),
}
