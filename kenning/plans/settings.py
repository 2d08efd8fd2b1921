"""Layered settings: defaults, then design, then user files, then the environment."""

from __future__ import annotations

import json
import os

DEFAULTS = {"lookback_turns": 3, "fusion": {"least_members": 3, "decay": True}, "conflict": {"skip_below": 0.20, "conflict_from": 0.50, "neighbours": 20}, "gaps": {"most_documents": 5, "most_bytes": 100_000}}


def merged(base: dict, over: dict) -> dict:
    """base with over's values; dicts merge at every depth."""
    out = dict(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load(*paths: str, environ: dict[str, str] | None = None, prefix: str = "KENNING_") -> dict:
    """DEFAULTS under each JSON file in turn (missing ones are skipped), then PREFIX_A__B=value as a.b."""
    out = DEFAULTS
    for path in paths:
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                out = merged(out, json.load(f))
    for name, raw in (os.environ if environ is None else environ).items():
        if name.startswith(prefix):
            try:
                value = json.loads(raw)
            except ValueError:
                value = raw
            for part in reversed(name.removeprefix(prefix).lower().split("__")):
                value = {part: value}
            out = merged(out, value)
    return out
