"""Job parameters (S22): paths, regions and days as one frozen value."""

from __future__ import annotations

import os
from dataclasses import dataclass


def parse_regions(text: str | None, default: str = "US") -> tuple[str, ...]:
    """Comma-separated list: split, trim, drop empty entries; ``default`` where it is unset."""
    raw = default if text is None else text
    return tuple(r.strip() for r in raw.split(",") if r.strip())


#: In place of a list of regions: all that have landed.
ALL_REGIONS = "*"


@dataclass(frozen=True)
class JobConfig:
    """Locations of every layer, and what part of the landing zone a run reads.

    ``raw_root`` holds ``trending/region=R/date=D/*.json`` and
    ``comments/region=R/date=D/*.json``; curated tables live under
    ``curated_root``; models under ``model_root``. ``regions`` and ``days`` (ISO dates)
    prune the landing's directories; None reads all.
    """

    raw_root: str
    curated_root: str
    model_root: str
    regions: tuple[str, ...] | None = None
    days: tuple[str, ...] | None = None
    dedup_keys: tuple[str, ...] = ("region", "trending_date", "video_id")

    @property
    def raw_trending(self) -> str:
        return os.path.join(self.raw_root, "trending")

    @property
    def raw_comments(self) -> str:
        return os.path.join(self.raw_root, "comments")

    def curated(self, table: str) -> str:
        return os.path.join(self.curated_root, table)

    def model(self, name: str) -> str:
        return os.path.join(self.model_root, name)

    @classmethod
    def from_env(cls, env: dict | None = None) -> "JobConfig":
        """``REGIONS`` is a list, ``*`` for all landed regions, or unset for the one default region."""
        e = os.environ if env is None else env
        regions = parse_regions(e.get("REGIONS"))
        return cls(
            raw_root=e["RAW_PATH"],
            curated_root=e["CURATED_PATH"],
            model_root=e.get("MODEL_PATH", os.path.join(e["CURATED_PATH"], "..", "models")),
            regions=None if regions == (ALL_REGIONS,) else regions,
            days=parse_regions(e["DAYS"]) if e.get("DAYS") else None,
        )
