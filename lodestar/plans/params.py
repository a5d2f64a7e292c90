"""Parameters of a run, checked before any plan is built, and the run's context."""

from __future__ import annotations

import os
import re
import secrets
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime
from pathlib import Path

SECRET = re.compile("key|token|secret|password", re.IGNORECASE)


@dataclass(frozen=True)
class Params:
    """Defaults are those of a library call; PRESETS has those of the other entries."""

    title: str
    target_author: str | None = None
    cited_by_top: int = 30
    recent_years: int | None = None
    recent_cap: int | None = None
    min_max_h_index: int = 0
    fellow_top_authors: int = 5
    fallback_top: int = 10
    window: int = 512
    match_threshold: float = 0.6
    entry_threshold: float = 0.8
    max_pages: int = 30
    max_contexts: int | None = None
    ignore_authors: tuple[str, ...] = ()
    dry_run: bool = True
    as_of_year: int = field(default_factory=lambda: datetime.now(UTC).year)

    def __post_init__(self) -> None:
        if not self.title.strip():
            raise ValueError("a title is needed")
        for name in ("cited_by_top", "fellow_top_authors", "fallback_top", "window", "max_pages"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("recent_cap", "min_max_h_index", "max_contexts"):
            if (value := getattr(self, name)) is not None and value < 0:
                raise ValueError(f"{name} must not be negative")
        if self.recent_years is not None and self.recent_years <= 0:
            raise ValueError("recent_years must be positive")
        for name in ("match_threshold", "entry_threshold"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in 0..1")


PRESETS = {
    "library": {},
    "command": {"cited_by_top": 20, "fellow_top_authors": 2, "fallback_top": 3, "window": 688, "max_pages": 50},
    "script": {"cited_by_top": 20, "recent_years": 3, "min_max_h_index": 30, "fallback_top": 5},
    "contexts": {"max_pages": 20, "match_threshold": 0.0},
}


def preset(name: str, title: str, **own: object) -> Params:
    return replace(Params(title), **{**PRESETS[name], **own})


def run_id(now: datetime | None = None) -> str:
    return f"{(now or datetime.now(UTC)):%Y%m%d_%H%M%S}_{secrets.token_hex(4)}"


def redacted(env: dict[str, str], prefixes: tuple[str, ...]) -> dict[str, str]:
    """The variables of some prefixes; secrets hidden."""
    return {k: "***" if SECRET.search(k) else v for k, v in sorted(env.items()) if k.startswith(prefixes)}


def jsonable(value: object) -> object:
    if isinstance(value, dict):
        return {str(k): jsonable(v) for k, v in value.items()}
    if isinstance(value, list | tuple | set):
        return [jsonable(v) for v in value]
    return value if value is None or isinstance(value, str | int | float | bool) else str(value)


@dataclass(frozen=True)
class RunContext:
    run_id: str
    created_at: str
    params: dict
    env: dict
    res_dir: str
    log_dir: str

    @classmethod
    def create(cls, params: Params, root: str, prefixes: tuple[str, ...] = ("LODESTAR_",), own_id: str | None = None, create_dirs: bool = True) -> RunContext:
        rid = own_id or run_id()
        dirs = [f"{root}/{rid}/{d}" for d in ("res", "log")]
        if create_dirs:
            for d in dirs:
                Path(d).mkdir(parents=True, exist_ok=True)
        return cls(rid, datetime.now(UTC).isoformat(), jsonable(asdict(params)), redacted(dict(os.environ), prefixes), *dirs)
