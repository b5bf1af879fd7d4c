"""Settings of a run; plan builders take them as an argument and read no environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

TRUE_WORDS = ("1", "true", "yes", "y", "on")


def _int(value: str | None, default: int) -> int:
    try:
        return int(value) if value else default
    except ValueError:
        return default


def _float(value: str | None, default: float) -> float:
    try:
        return float(value) if value else default
    except ValueError:
        return default


@dataclass(frozen=True)
class Settings:
    raw_root: str = "data/raw_guidelines"
    project_root: str = ""
    include_reviews: bool = False
    include_backfill: bool = True
    min_chars: int = 500
    page_batch: int = 8
    render_dpi: int = 220
    crop_padding: int = 12
    timeout_seconds: float = 360.0
    ocr_languages: tuple[str, ...] = ("uz", "ru", "en")

    def __post_init__(self) -> None:
        for name, least in (("page_batch", 1), ("render_dpi", 96), ("crop_padding", 0)):
            object.__setattr__(self, name, max(least, getattr(self, name)))

    @staticmethod
    def environment(prefix: str = "CORVANE_") -> dict[str, str]:
        """Texts for from_mapping from the driver's environment, <prefix><NAME>; the command line takes them before its own."""
        return {k[len(prefix) :].lower(): v for k, v in os.environ.items() if k.startswith(prefix)}

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> Settings:
        """Settings from texts; a text that cannot be read leaves the default."""
        out = {}
        for f in fields(cls):
            text = values.get(f.name)
            if text is None:
                continue
            if isinstance(f.default, bool):
                out[f.name] = text.strip().lower() in TRUE_WORDS
            elif isinstance(f.default, float):
                out[f.name] = _float(text, f.default)
            elif isinstance(f.default, int):
                out[f.name] = _int(text, f.default)
            elif isinstance(f.default, tuple):
                out[f.name] = tuple(x.strip() for x in text.split(",") if x.strip()) or f.default
            else:
                out[f.name] = text
        return cls(**out)
