"""Settings from the environment, typed by their defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import fields, replace
from typing import TypeVar

P = TypeVar("P")


def from_environment(defaults: P, prefix: str, environment: Mapping[str, str] = os.environ) -> P:
    """A frozen dataclass with those fields replaced that PREFIX_FIELD sets; 1, true and yes are true."""
    changes = {}
    for f in fields(defaults):
        text = environment.get(f"{prefix}_{f.name}".upper())
        if text is not None:
            now = getattr(defaults, f.name)
            changes[f.name] = text.strip().lower() in ("1", "true", "yes") if isinstance(now, bool) else type(now)(text)
    return replace(defaults, **changes)
