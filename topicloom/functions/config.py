"""Settings as trees: flattening, differences, checks; run ids; paging links."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit


def flatten(tree, path: str = "") -> dict[str, object]:
    """Dotted paths to leaves; lists are leaves."""
    if not isinstance(tree, dict):
        return {path: tree}
    out: dict[str, object] = {}
    for key, value in tree.items():
        out |= flatten(value, f"{path}.{key}" if path else str(key))
    return out


def difference(old: dict, new: dict) -> dict[str, tuple[object, object]]:
    """Paths whose leaves differ, with both sides; a missing one is None."""
    a, b = flatten(old), flatten(new)
    return {k: (a.get(k), b.get(k)) for k in sorted(a.keys() | b.keys()) if a.get(k) != b.get(k)}


def snapshot(tree: dict) -> str:
    return json.dumps(tree, sort_keys=True, default=str)


def check_weights(weights: dict[str, float], tolerance: float = 1e-3) -> None:
    if any(w < 0 for w in weights.values()) or abs(sum(weights.values()) - 1) > tolerance:
        raise ValueError(f"weights must be positive and sum to one: {weights}")


def check_open_unit(**values: float) -> None:
    for name, value in values.items():
        if not 0 < value < 1:
            raise ValueError(f"{name} must lie between 0 and 1: {value}")


def by_backend(setting, backend: str) -> float | None:
    """A threshold for one backend: a plain number serves all, a table must have the backend (None: match nothing)."""
    if isinstance(setting, dict):
        if backend not in setting:
            raise ValueError(f"no threshold for {backend}; thresholds don't carry over between backends")
        setting = setting[backend]
    return None if setting is None else float(setting)


def run_id(now: datetime | None = None) -> str:
    """UTC date and time to the minute."""
    return (now or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H%M")


def with_parameter(url: str, name: str, value) -> str:
    """The url with one parameter set; repeated other parameters stay, in order."""
    parts = urlsplit(url)
    pairs = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k != name]
    return urlunsplit(parts._replace(query=urlencode([*pairs, (name, str(value))])))
