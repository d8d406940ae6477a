"""Run settings: what a job or an export is asked to do, never data."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

# The environments, levels and defaults users of the jobs rely on.
ENVIRONMENTS = ("local", "dev", "staging", "prod")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR")
DATE_FILTERS = ("today", "yesterday", "last_week")
DEFAULT_TABLE = "dev_customers_silver"
BATCH_SIZE = 100


def _local_run_id() -> str:
    return f"local-{datetime.now(timezone.utc).isoformat()}"


@dataclass(frozen=True)
class JobConfig:
    """Settings of one job run; `bucket` and `object_key` together mean "this one file"."""

    job_name: str
    job_run_id: str = field(default_factory=_local_run_id)
    env: str = "local"
    log_level: str = "INFO"
    bucket: str | None = None
    object_key: str | None = None
    enable_report: bool = True

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, not {self.env!r}")
        if self.log_level not in LOG_LEVELS:
            raise ValueError(f"log_level must be one of {LOG_LEVELS}, not {self.log_level!r}")

    @property
    def is_event_triggered(self) -> bool:
        return bool(self.bucket) and bool(self.object_key)

    @property
    def trigger_type(self) -> str:
        return "s3_event" if self.is_event_triggered else "scheduled"

    def with_(self, **changes) -> JobConfig:
        return replace(self, **changes)

    @classmethod
    def from_args(cls, argv: list[str]) -> JobConfig:
        """Read `--JOB_NAME x [--JOB_RUN_ID x] [--env x] ...`; arguments of others are ignored."""
        parser = argparse.ArgumentParser(allow_abbrev=False)
        parser.add_argument("--JOB_NAME", dest="job_name", required=True)
        parser.add_argument("--JOB_RUN_ID", dest="job_run_id", default=None)
        parser.add_argument("--env", default="local")
        parser.add_argument("--LOG_LEVEL", dest="log_level", default="INFO")
        parser.add_argument("--bucket")
        parser.add_argument("--object_key")
        parser.add_argument("--enable_notifications", dest="enable_report", default="true")
        known, _ = parser.parse_known_args(argv)
        values = vars(known)
        values["enable_report"] = values["enable_report"].lower() == "true"
        values["job_run_id"] = values["job_run_id"] or _local_run_id()
        return cls(**values)


@dataclass(frozen=True)
class ExportRequest:
    """Which rows of which table to deliver, in what batches.

    All selected rows are delivered unless the caller sets a `limit` or `max_records`; the smaller one counts.
    """

    table: str
    date_filter: str | None = "yesterday"
    where: str | None = None
    limit: int | None = None
    max_records: int | None = None
    batch_size: int = BATCH_SIZE
    as_of: date | str | None = None

    @classmethod
    def scheduled(
        cls, table: str = DEFAULT_TABLE, date_filter: str = "yesterday", where: str | None = None, **rest
    ) -> ExportRequest:
        """The nightly export: everything of one date filter."""
        if date_filter not in DATE_FILTERS:
            raise ValueError(f"date_filter must be one of {DATE_FILTERS}, not {date_filter!r}")
        return cls(table, date_filter, where, **rest)

    @classmethod
    def object_event(cls, object_key: str, env: str = "dev", **rest) -> ExportRequest:
        """A file has landed: export today's rows of the table its key names."""
        from lakejobs.sinks.tables import table_for_key

        return cls(table_for_key(object_key, env), "today", **rest)

    @classmethod
    def on_demand(
        cls, table: str = DEFAULT_TABLE, limit: int | None = None, where: str | None = None, **rest
    ) -> ExportRequest:
        """A caller asks for rows; the date filter stays at yesterday."""
        return cls(table, where=where, limit=limit, **rest)
