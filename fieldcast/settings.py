"""Run parameters and the fixed values of the scoring model."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values.
CROPS = (1, 2, 3)
CROP_NAMES = {1: "wine grape", 2: "chickpea", 3: "potato"}
BASE_YEAR = 2024
HORIZONS = (2054, 2084, 2100)
SEASON_MONTHS = (4, 5, 6, 7, 8)
HISTORY_YEARS = (2010, 2025)
LAST_TRAINING_YEAR = 2022
SUN_DIVISOR = 3.6
NEW_AREA_FACTOR = 0.5
MODEL_VERSION = "random_forest_v1"
MIN_MODEL_ROWS = 50
MIN_VALIDATION_ROWS = 10
SCORE_WEIGHTS = {"yield": 0.15, "temp": 0.35, "rain": 0.20, "sun": 0.15, "soil": 0.15}
DEFAULT_HEAT_THRESHOLD = 30.0
HEAT_MARGIN = 2.0
UNKNOWN_SOIL = "unknown"
SOURCE_BOX = {"north": 51.5, "west": -5.5, "south": 41.0, "east": 9.8}
STATUSES = ("kept", "lost", "new", "hidden")


@dataclass(frozen=True)
class Settings:
    """Everything a run may vary; the defaults are the production values."""

    crops: tuple[int, ...] = CROPS
    base_year: int = BASE_YEAR
    horizons: tuple[int, ...] = HORIZONS
    history_years: tuple[int, int] = HISTORY_YEARS
    last_training_year: int = LAST_TRAINING_YEAR
    sun_divisor: float = SUN_DIVISOR
    new_area_factor: float = NEW_AREA_FACTOR
    model_version: str = MODEL_VERSION

    def __post_init__(self):
        try:
            divisor = float(self.sun_divisor)
        except (TypeError, ValueError):
            raise ValueError(f"sun_divisor must be a number, got {self.sun_divisor!r}") from None
        if not divisor > 0:
            raise ValueError(f"sun_divisor must be above zero, got {divisor}")
        object.__setattr__(self, "sun_divisor", divisor)
        object.__setattr__(self, "new_area_factor", float(self.new_area_factor))
        for field in ("crops", "horizons"):
            values = tuple(int(v) for v in getattr(self, field))
            if not values or len(set(values)) != len(values):
                raise ValueError(f"{field} must be a non-empty list without repeats")
            object.__setattr__(self, field, values)

    def narrowed(self, crops=None, horizons=None) -> "Settings":
        """The same run on some of its crops and horizons; both domains are closed."""
        picked_crops = tuple(self.crops if crops is None else crops)
        picked_horizons = tuple(self.horizons if horizons is None else horizons)
        outside = set(picked_crops) - set(self.crops)
        if outside:
            raise ValueError(f"unknown crops: {sorted(outside)}")
        outside = set(picked_horizons) - set(self.horizons)
        if outside:
            raise ValueError(f"unknown horizons: {sorted(outside)}")
        return replace(self, crops=picked_crops, horizons=picked_horizons)
