"""Feature contract: which columns a model reads, and eager checks on names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Contract:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    drop: tuple[str, ...] = ()
    defaults: Mapping[str, float | str] = field(default_factory=dict)
    aliases: Mapping[str, str] = field(default_factory=dict)
    labels: Mapping[str, str] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def training_columns(self) -> tuple[str, ...]:
        return self.features + (self.target,)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c for c in self.features if c not in self.defaults)


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Fail before any job runs, naming the absent columns."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing {what}: {missing}. Available: {sorted(df.columns)}")


# The listing table's column names, defaults and domains.
LISTINGS = Contract(
    numeric=(
        "bedrooms",
        "bathrooms",
        "living_area",
        "latitude",
        "longitude",
        "normalized_lot_area_value",
    ),
    categorical=("property_type", "vegas_district"),
    target="price",
    drop=(
        "property_id",
        "snapshot_date",
        "street_address",
        "city",
        "state",
        "zip_code",
        "zestimate",
        "rentzestimate",
        "listing_status",
        "normalized_lot_area_unit",
        "days_on_zillow",
        "price_per_sqft",
    ),
    defaults={"normalized_lot_area_value": 5000.0},
    aliases={"livingarea": "living_area", "propertytype": "property_type"},
    labels={
        "bedrooms": "Bedrooms",
        "bathrooms": "Bathrooms",
        "living_area": "Living Area (sqft)",
        "latitude": "Latitude",
        "longitude": "Longitude",
        "normalized_lot_area_value": "Lot Size (sqft)",
        "property_type": "Property Type",
        "vegas_district": "District",
    },
    domains={
        "property_type": ("SINGLE_FAMILY", "TOWNHOUSE", "CONDO"),
        "vegas_district": (
            "Summerlin",
            "Centennial",
            "Winchester",
            "Spring Valley",
            "Enterprise",
            "Mountains Edge",
            "Downtown Las Vegas",
            "Paradise",
            "Green Valley",
            "North Las Vegas",
            "The Strip",
            "Anthem",
        ),
    },
)

# One centre point per district.
DISTRICT_CENTRES = (
    ("Summerlin", 36.1699, -115.3378),
    ("Green Valley", 36.0417, -115.0833),
    ("Henderson", 36.0395, -114.9817),
    ("Downtown Las Vegas", 36.1699, -115.1398),
    ("North Las Vegas", 36.1989, -115.1175),
    ("Spring Valley", 36.1021, -115.2450),
    ("Paradise", 36.0972, -115.1467),
    ("Enterprise", 36.0253, -115.2419),
    ("Centennial", 36.2839, -115.2710),
    ("Mountains Edge", 36.0089, -115.2747),
    ("The Strip", 36.1147, -115.1728),
    ("Winchester", 36.1420, -115.0987),
    ("Anthem", 35.9853, -115.1017),
)
