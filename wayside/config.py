"""Business constants, keyword rule sets and data-quality rule sets.

Everything here is a fixed value: thresholds, weights, labels and word lists
that decide the results. Operators take them as arguments and never hard-code
one of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------- column names

# Names of the source table's columns.
SENSOR_COLS = ("Temperature(F)", "Visibility(mi)", "Precipitation(in)")
PLACE_COLS = ("Street", "City", "County", "State", "Timezone")
FLAG_COLS = ("Amenity", "Crossing", "Junction", "Railway", "Station", "Stop", "Traffic_Signal")

# Feature weights. The order decides ties for the dominant feature.
INFRA_WEIGHTS = (
    ("Junction", 3),
    ("Traffic_Signal", 2),
    ("Crossing", 2),
    ("Stop", 1),
    ("Amenity", 1),
)
INFRA_COLS = tuple(name for name, _ in INFRA_WEIGHTS)

# The seven-flag score of the exploratory variant.
INFRA_COLS_WIDE = FLAG_COLS

# ---------------------------------------------------------------- weather texts

# Fixed values: (category, keywords), first match wins, so order matters.
WEATHER_RULES_AGGREGATE = (
    ("Foggy", ("fog", "mist", "haze")),
    ("Snowy", ("snow", "ice", "sleet", "freezing")),
    ("Rainy", ("rain", "drizzle", "shower")),
    ("Windy", ("wind", "storm", "thunder")),
    ("Cloudy", ("cloud", "overcast")),
)
WEATHER_RULES_CLEANING = (
    ("Rainy", ("rain", "drizzle", "shower")),
    ("Snowy", ("snow", "ice", "sleet", "freezing")),
    ("Foggy", ("fog", "mist", "haze")),
    ("Cloudy", ("cloud", "overcast")),
    ("Windy", ("wind", "storm", "thunder")),
)
WEATHER_RULES_CHECKING = (
    ("Fog", ("fog", "mist", "haze")),
    ("Snow", ("snow", "ice", "sleet", "freezing")),
    ("Rain", ("rain", "drizzle", "shower")),
    ("Cloudy", ("cloud", "overcast")),
    ("Windy", ("wind", "storm", "thunder")),
)
WEATHER_RULES_BROAD = (
    ("Clear", ("clear", "fair")),
    ("Rain", ("rain", "drizzle", "shower")),
    ("Snow", ("snow", "sleet", "ice", "freezing")),
    ("Fog", ("fog", "mist", "haze")),
    ("Cloudy", ("cloud", "overcast")),
    ("Storm", ("thunder", "storm")),
    ("Windy", ("wind",)),
)

# Words behind the binary weather flags.
RAIN_WORDS = ("rain", "drizzle")
SNOW_WORDS = ("snow", "ice", "sleet")
FOG_WORDS = ("fog", "mist", "haze")
SNOW_WORDS_SHORT = ("snow", "ice")
FOG_WORDS_SHORT = ("fog", "mist")

# Base risk per weather category, and the display order.
WEATHER_BASE_RISK = (
    ("Clear", 0),
    ("Cloudy", 1),
    ("Windy", 2),
    ("Rainy", 3),
    ("Snowy", 4),
    ("Foggy", 5),
)
WEATHER_ORDER = ("Clear", "Cloudy", "Rainy", "Snowy", "Foggy", "Windy")

# ---------------------------------------------------------------- clock and calendar


@dataclass(frozen=True)
class HourScheme:
    """Left-closed hour ranges with a label each, and a label for the rest."""

    ranges: tuple[tuple[int, int, str], ...]
    otherwise: str


# The four hour schemes.
HOURS_CLEANING = HourScheme(
    (
        (6, 9, "Morning_Rush"),
        (9, 12, "Late_Morning"),
        (12, 14, "Lunch"),
        (14, 17, "Afternoon"),
        (17, 20, "Evening_Rush"),
    ),
    "Night",
)
HOURS_DASHBOARD = HourScheme(
    (
        (6, 9, "Morning_Rush"),
        (9, 12, "Morning"),
        (12, 14, "Lunch"),
        (14, 17, "Afternoon"),
        (17, 20, "Evening_Rush"),
    ),
    "Night",
)
HOURS_BROAD = HourScheme(
    (
        (0, 6, "Night"),
        (6, 9, "Morning_Rush"),
        (9, 12, "Late_Morning"),
        (12, 15, "Afternoon"),
        (15, 18, "Evening_Rush"),
        (18, 21, "Evening"),
    ),
    "Late_Night",
)
HOURS_EXPLORATORY = HourScheme(
    (
        (6, 9, "Morning_Rush"),
        (9, 17, "Day"),
        (17, 20, "Evening_Rush"),
    ),
    "Night",
)
# Rush hours and day names, Monday first.
RUSH_HOURS = (7, 8, 9, 16, 17, 18)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# ---------------------------------------------------------------- labels

# Temperature bins, left-closed, and their labels.
TEMP_EDGES = (-100, 0, 32, 50, 75, 95, 200)
TEMP_LABELS = (
    "Rất Lạnh (<0)",
    "Đóng Băng (0-32)",
    "Lạnh (32-50)",
    "Ôn Hoà (50-75)",
    "Nóng (75-95)",
    "Rất Nóng (>95)",
)

# Labels, and from which value each risk step counts.
SEVERITY_LABELS = ((1, "Minor"), (2, "Moderate"), (3, "Serious"), (4, "Severe"))
ANOMALY_LABELS = ("Critical", "High", "Elevated", "Normal")
RISK_LABELS = ("Extreme", "High", "Moderate", "Low")
RISK_STEPS_SEVERITY = ((15, 3), (10, 2), (5, 1))
RISK_STEPS_DURATION = ((30, 2), (15, 1))
RISK_MOST = 10
# A total of shares, and how far a recount may lie from an aggregate.
SHARES_TOTAL = (99, 101)
SHARE_TOLERANCE = 0.1
INCREASE_TOLERANCE = 1

# The exploratory variant of filling missing values.
EXPLORATORY_FILLS = {
    "Weather_Condition": "Unknown",
    "City": "Unknown",
    "Wind_Direction": "Unknown",
    "Sunrise_Sunset": "Unknown",
    "Civil_Twilight": "Unknown",
    "Nautical_Twilight": "Unknown",
    "Astronomical_Twilight": "Unknown",
    "Precipitation(in)": 0.0,
}
EXPLORATORY_MEDIANS = (
    "Temperature(F)", "Distance(mi)", "Humidity(%)", "Pressure(in)", "Visibility(mi)",
    "Wind_Speed(mph)",
)
EXPLORATORY_SIBLINGS = (
    ("Wind_Chill(F)", "Temperature(F)"),
    ("Weather_Timestamp", "Start_Time"),
)

# Columns whose range is looked at after every stage.
SANITY_COLS = (
    "Duration_min", "Severity", "severity_impact_pct", "duration_impact_pct", "pct_of_national",
    "pct_of_state",
)

# Allowed wind directions.
WIND_DIRECTIONS = (
    "N", "S", "E", "W", "NE", "NW", "SE", "SW",
    "Calm", "Variable", "North", "South", "East", "West",
)

# Sample groups that the reconciliation looks at by default in a report.
SAMPLE_CITIES = (("CA", "Los Angeles"), ("TX", "Houston"), ("FL", "Miami"))
SAMPLE_STATES = ("CA", "TX")


# ---------------------------------------------------------------- settings


@dataclass(frozen=True)
class Settings:
    """Thresholds of one run. The defaults are the published ones."""

    start_year: int = 2019
    end_year: int = 2022
    temp_min: float = -20.0
    temp_max: float = 120.0
    visibility_min: float = 0.0
    visibility_max: float = 10.0
    duration_max_min: float = 1440.0
    severities: tuple[int, ...] = (1, 2, 3, 4)
    high_severity: int = 3
    pareto_threshold: float = 0.8
    z_thresholds: tuple[float, float, float] = (2.0, 1.0, 0.0)
    risk_thresholds: tuple[int, int, int] = (8, 6, 4)
    low_visibility: float = 1.0
    location_cols: tuple[str, ...] = ("Street", "City")
    location_sep: str = "_"
    weather_rules_clean: tuple = WEATHER_RULES_CLEANING
    weather_rules_agg: tuple = WEATHER_RULES_AGGREGATE
    fill_values: dict[str, Any] = field(
        default_factory=lambda: {
            **{c: False for c in FLAG_COLS},
            "Weather_Condition": "Clear",
            "City": "Unknown",
            "County": "Unknown",
            "Street": "Unknown",
        },
        hash=False,
    )


DEFAULT = Settings()


# ---------------------------------------------------------------- data-quality rules

Rules = dict[str, dict[str, Any]]


def loader_rules(s: Settings = DEFAULT) -> Rules:
    return {
        "ID": {"null_pct_max": 0, "unique": True},
        "Severity": {"min": min(s.severities), "max": max(s.severities), "null_pct_max": 0},
        "Start_Time": {"null_pct_max": 0.01},
        "End_Time": {"null_pct_max": 0.01},
        "State": {"null_pct_max": 0.01},
    }


def cleaner_rules(s: Settings = DEFAULT) -> Rules:
    return {
        "ID": {"null_pct_max": 0, "unique": True},
        "Severity": {"min": min(s.severities), "max": max(s.severities), "null_pct_max": 0},
        "Duration_min": {"min": 0, "max": s.duration_max_min, "null_pct_max": 0.05},
        "Temperature(F)": {"min": s.temp_min, "max": s.temp_max},
        "Visibility(mi)": {"min": s.visibility_min, "max": s.visibility_max},
        "Year": {"min": s.start_year, "max": s.end_year},
    }


def cleaner_gate_rules(s: Settings = DEFAULT) -> Rules:
    """The subset that the cleaning job enforces on its own output."""
    return {
        "Severity": {"min": min(s.severities), "max": max(s.severities), "null_pct_max": 0},
        "Duration_min": {"min": 0, "max": s.duration_max_min, "null_pct_max": 0.05},
        "Year": {"min": s.start_year, "max": s.end_year},
        "Temperature(F)": {"min": s.temp_min, "max": s.temp_max},
        "Visibility(mi)": {"min": s.visibility_min, "max": s.visibility_max},
    }


def star_rules(s: Settings = DEFAULT) -> dict[str, Rules]:
    return {
        "accident_detail": {
            "ID": {"null_pct_max": 0, "unique": True},
            "Location_id": {"null_pct_max": 0},
            "weather_id": {"null_pct_max": 0},
            "full_date": {"null_pct_max": 0},
            "Severity": {"min": min(s.severities), "max": max(s.severities)},
            "Duration_min": {"min": 0, "max": s.duration_max_min},
        },
        "dim_time": {
            "Date": {"null_pct_max": 0, "unique": True},
            "Year": {"min": s.start_year, "max": s.end_year},
        },
        "dim_location": {
            "Location_id": {"null_pct_max": 0, "unique": True},
            "State": {"null_pct_max": 0},
        },
        "dim_weather": {"weather_id": {"null_pct_max": 0, "unique": True}},
    }


def aggregate_rules(s: Settings = DEFAULT) -> dict[str, Rules]:
    sev = {"min": min(s.severities), "max": max(s.severities)}
    return {
        "agg_federal": {
            "Year": {"min": s.start_year, "max": s.end_year},
            "total_accidents": {"min": 1},
            "avg_severity": sev,
        },
        "agg_state_anomaly": {
            "total_accidents": {"min": 1},
            "avg_severity": sev,
            "pct_of_national": {"min": 0, "max": 100},
            "severity_zscore": {"min": -10, "max": 10},
        },
        "agg_weather_by_state": {
            "total_accidents": {"min": 1},
            "avg_severity": sev,
            "severity_increase_pct": {"min": -50, "max": 100},
            "duration_increase_pct": {"min": -50, "max": 200},
        },
        "agg_city_by_state": {
            "total_accidents": {"min": 1},
            "pct_of_state": {"min": 0, "max": 100},
        },
    }
