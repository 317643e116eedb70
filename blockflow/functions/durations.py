"""Durations as texts (1h2m3.5s, 200ms), and rates."""

from __future__ import annotations

import re

#: The units of a duration, in seconds.
UNITS = {"ns": 1e-9, "us": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}


def parse_duration(text: str) -> float:
    """Seconds; ValueError if the text isn't a duration."""
    t = text.strip()
    sign, t = (-1.0, t[1:]) if t.startswith("-") else (1.0, t.removeprefix("+"))
    if t == "0":
        return 0.0
    parts = re.findall(r"(\d+\.?\d*|\.\d+)(ns|us|ms|s|m|h)", t)
    if not parts or "".join(n + u for n, u in parts) != t:
        raise ValueError(f"invalid duration {text!r}")
    return sign * sum(float(n) * UNITS[u] for n, u in parts)


def format_duration(seconds: float) -> str:
    """As 1h2m3.5s; below a second in ms, us or ns."""
    if not seconds:
        return "0s"
    sign, s = ("-", -seconds) if seconds < 0 else ("", seconds)
    if s < 1:
        unit = next(u for u in ("ms", "us", "ns") if s >= UNITS[u] or u == "ns")
        return f"{sign}{round(s / UNITS[unit], 6):g}{unit}"
    hours, rest = divmod(round(s, 9), 3600)
    minutes, rest = divmod(rest, 60)
    out = f"{int(hours)}h" if hours else ""
    out += f"{int(minutes)}m" if hours or minutes else ""
    return f"{sign}{out}{round(rest, 9):.9f}".rstrip("0").rstrip(".") + "s"


def per_second(count: int, seconds: float) -> float:
    return count / seconds if seconds > 0 else 0.0
