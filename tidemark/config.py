"""One small parameter object instead of environment variables."""

from __future__ import annotations

from dataclasses import dataclass, replace

ENTITIES = ("restaurants", "customers", "orders")


@dataclass(frozen=True)
class WarehouseConfig:
    """Where the layers live and the knobs of a run.

    ``root`` may be any Hadoop file system URI (local path, HDFS, object store).
    """

    root: str
    late_arrival_days: int = 3
    freshness_warn_hours: int = 26
    freshness_error_hours: int = 50
    # A dimension is broadcast into the point-in-time join only when its
    # measured size is below this; larger ones use the bucketed join.
    broadcast_max_bytes: int = 64 * 1024 * 1024
    # Orders share one target file per fact partition per this many rows.
    fact_max_records_per_file: int = 5_000_000
    # Open sets of so many days stay stored, for re-runs of these days.
    history_days: int = 7
    # Increments of the order index are merged when there are more of them.
    index_runs: int = 16
    # Published states that stay readable after a run.
    keep_manifests: int = 3

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def marts(self) -> str:
        """Store of history, dimensions, fact and marts."""
        return f"{self.root}/marts"

    def with_(self, **changes) -> "WarehouseConfig":
        return replace(self, **changes)
