"""Run identity: one id + timestamp per run, made on the driver once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunInfo:
    """One run: its unique, time-sortable id and its start time (UTC)."""

    run_id: str
    started: datetime

    @property
    def dt(self) -> str:
        return self.started.strftime("%Y-%m-%d")

    def stamp(self, df: DataFrame) -> DataFrame:
        """Add ``run_id`` and ``run_ts`` literal columns."""
        return df.withColumns({
            "run_id": F.lit(self.run_id),
            "run_ts": F.lit(self.started.replace(tzinfo=None)).cast("timestamp_ntz"),
        })


def new_run(now: datetime | None = None) -> RunInfo:
    """A unique run id that sorts by start time to the microsecond:
    ``20240905T101500123456Z-<uuid4 hex>``.  Object stores keep modification
    times to the second, so runs written within one second tie on time; the
    newest-file choice then breaks the tie by path, i.e. by this id."""
    started = now or datetime.now(timezone.utc)
    return RunInfo(f"{started:%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex}", started)
