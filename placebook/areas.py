"""The area registry: discs, corridors, polygons, or a name alone."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

KM_PER_DEG_LAT = 110.57
KM_PER_DEG_LNG = 110.32      # at the equator


@dataclass(frozen=True)
class Area:
    name: str
    lat: float | None = None
    lng: float | None = None
    radius_km: float | None = None
    corridor: tuple[tuple[float, float], tuple[float, float], float] | None = None   # from, to, width
    polygon: tuple[tuple[float, float], ...] | None = None
    aliases: tuple[str, ...] = field(default_factory=tuple)
    derived_from: str | None = None
    low_confidence: bool = False

    def __post_init__(self) -> None:
        disc = self.lat is not None and self.lng is not None and self.radius_km is not None
        if (self.lat is None) != (self.lng is None):
            raise ValueError(f"{self.name}: lat and lng go together")
        if disc + (self.corridor is not None) + (self.polygon is not None) > 1:
            raise ValueError(f"{self.name}: an area takes one geometry")

    @property
    def kind(self) -> str:
        if self.lat is not None and self.radius_km is not None:
            return "disc"
        return "corridor" if self.corridor else "polygon" if self.polygon else "name"

    @property
    def names(self) -> list[str]:
        """The texts by which an address may name the area, longest first."""
        parts = [p.strip() for p in self.name.split("/") if p.strip()]
        return sorted(set(parts) | set(self.aliases), key=lambda t: (-len(t), t))

    @property
    def centre(self) -> tuple[float, float] | None:
        if self.lat is not None:
            return self.lat, self.lng
        points = self.corridor[:2] if self.corridor else self.polygon
        if not points:
            return None
        return sum(p[0] for p in points) / len(points), sum(p[1] for p in points) / len(points)

    @property
    def extremes(self) -> list[tuple[float, float]]:
        """Points that span the area's bounding box."""
        if self.kind == "disc":
            dlat = self.radius_km / KM_PER_DEG_LAT
            dlng = self.radius_km / (KM_PER_DEG_LNG * math.cos(math.radians(self.lat)))
            return [(self.lat - dlat, self.lng - dlng), (self.lat + dlat, self.lng + dlng)]
        return list(self.corridor[:2] if self.corridor else self.polygon or [])


# fixed values: areas of the census profile, centres taken from listings whose address names the area
CENSUS_AREAS = [
    Area("Anthony / Anthony Village", 6.55982, 3.36915, 1.3),
    Area("Maryland / Mende", 6.57229, 3.36717, 1.3),
    Area("Ilupeju", 6.54548, 3.35989, 1.4),
    Area("Gbagada", 6.55144, 3.38653, 1.6),
    Area("Obanikoro", 6.54773, 3.36824, 1.0),
    Area("Palmgrove", 6.53952, 3.36767, 1.0),
    Area("Ojota", 6.58282, 3.38447, 1.4),
]
CENSUS_CORE = ["Anthony / Anthony Village", "Maryland / Mende"]

# fixed values: areas of the prospects profile
PROSPECT_AREAS = [
    Area("Lekki Phase 1", 6.44514, 3.47071, 1.8, aliases=("Lekki Phase One", "Lekki Ph 1")),
    Area("Lekki-Epe Corridor to Ajah",
         polygon=((6.4505, 3.495), (6.4505, 3.53), (6.4575, 3.55), (6.4675, 3.56), (6.4805, 3.575),
                  (6.4835, 3.585), (6.4565, 3.585), (6.4535, 3.575), (6.4405, 3.56), (6.4305, 3.55),
                  (6.4235, 3.53), (6.4235, 3.495)),
         aliases=("Ajah", "Sangotedo", "Abraham Adesanya", "Chevron", "Ikota", "Osapa", "Agungi", "Jakande",
                  "Lekki-Epe", "Lekki Epe")),
    Area("Victoria Island", 6.43121, 3.42567, 1.8, aliases=("Victoria Island Annex",)),
    Area("Ikoyi", 6.44986, 3.41929, 1.8),
    Area("Yaba", 6.50837, 3.37916, 1.8, aliases=("Sabo", "Akoka", "Onike")),
    Area("Surulere", 6.49605, 3.35644, 1.8,
         aliases=("Aguda", "Ojuelegba", "Bode Thomas", "Adeniran Ogunsanya")),
]

def load_areas(text: str) -> list[Area]:
    """Areas from JSON: {"name": {"lat":…, "lng":…, "radius_km":…} | {"corridor":…} | {"polygon":…}, …}."""
    out = []
    for name, spec in json.loads(text).items():
        spec = dict(spec)
        corridor = spec.pop("corridor", None)
        polygon = spec.pop("polygon", None)
        out.append(Area(
            name,
            corridor=(tuple(corridor["from"]), tuple(corridor["to"]), corridor["width_km"]) if corridor else None,
            polygon=tuple(tuple(p) for p in polygon) if polygon else None,
            aliases=tuple(spec.pop("aliases", None) or ()), **spec))
    return out


def areas_df(spark: SparkSession, areas: list[Area], core: list[str]) -> DataFrame:
    """The registry as a dimension: one row per area, in registry order."""
    from placebook.schema import CORE_ZONE, RING_ZONE

    rows = []
    for i, a in enumerate(areas):
        lat, lng = a.centre or (None, None)
        rows.append((i, a.name, CORE_ZONE if a.name in core else RING_ZONE, a.kind, lat, lng, a.radius_km,
                     list(a.aliases)))
    return spark.createDataFrame(rows, "area_ord int, area string, zone string, kind string, lat double, "
                                       "lng double, radius_km double, aliases array<string>")


def with_centres(areas: list[Area], derived: list[dict], default_radius_km: float = 1.3) -> list[Area]:
    """The registry with derived centres written in; an area keeps its radius, drawn shapes stay."""
    found = {d["area"]: d for d in derived if d["n"] > 0}
    out = []
    for a in areas:
        d = found.get(a.name)
        if d is None or a.kind in ("corridor", "polygon"):
            out.append(a)
        else:
            out.append(replace(a, lat=d["lat"], lng=d["lng"], radius_km=a.radius_km or default_radius_km,
                               derived_from=f"{d['n']} records", low_confidence=d["low_confidence"]))
    return out
