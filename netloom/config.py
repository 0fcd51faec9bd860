"""Parameters of the operators, with the ranges in which they make sense."""

from __future__ import annotations

from dataclasses import dataclass, fields


def _check(params, **ranges) -> None:
    wrong = [f"{f.name}={getattr(params, f.name)} is outside {ranges[f.name]}" for f in fields(params) if f.name in ranges and not ranges[f.name][0] <= getattr(params, f.name) <= ranges[f.name][1]]
    if wrong:
        raise ValueError("; ".join(wrong))


@dataclass(frozen=True)
class FlowParams:
    """Flow assembly.  ``idle_mode``: ``exact`` splits at gaps of the idle timeout, ``none`` never."""

    active_timeout_s: float = 300.0
    idle_timeout_s: float = 60.0
    burst_gap_s: float = 1.0
    max_packets_per_flow: int = 20_000  # 0: no cap
    min_packets_per_flow: int = 1
    close_on_teardown: bool = True
    idle_mode: str = "exact"

    def __post_init__(self):
        _check(self, active_timeout_s=(1, 1e9), idle_timeout_s=(1, 1e9), burst_gap_s=(0.001, 3600), max_packets_per_flow=(0, 10_000_000), min_packets_per_flow=(1, 1000))
        if self.idle_mode not in ("exact", "none"):
            raise ValueError(f"idle_mode={self.idle_mode} is not exact or none")


@dataclass(frozen=True)
class ProfileParams:
    """Host profiles; counts above ``cardinality_cap`` are cut to it and flagged."""

    window_minutes: int = 10
    cardinality_cap: int = 20_000
    window_ports_cap: int = 80_000

    def __post_init__(self):
        _check(self, window_minutes=(1, 1440))

    @property
    def seconds(self) -> int:
        return max(60, 60 * self.window_minutes)


@dataclass(frozen=True)
class SeriesParams:
    """The network time series; longer spans than ``max_gap_buckets`` are not gap-filled."""

    bucket_seconds: int = 60
    fill_gaps: bool = True
    max_gap_buckets: int = 200_000

    def __post_init__(self):
        _check(self, bucket_seconds=(1, 3600))


OFFLINE = (FlowParams(active_timeout_s=86_400, idle_timeout_s=3600), ProfileParams(window_minutes=5), SeriesParams(bucket_seconds=10))
