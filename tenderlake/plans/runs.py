"""Run records: parameters, metrics and training window of the current run of each type."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from tenderlake.schemas import SERVING
from tenderlake.sources.tables import Tables


def new_run_id() -> str:
    return uuid.uuid4().hex


def record_run(
    tables: Tables,
    run_id: str,
    run_type: str,
    algorithm: str,
    params: dict,
    metrics: dict,
    window: tuple[str | None, str | None] = (None, None),
) -> None:
    """Writes the one row of this run type, in place of any before it."""
    executed = datetime.now(timezone.utc).replace(tzinfo=None)
    row = (run_id, run_type, algorithm, json.dumps(params), json.dumps(metrics), *window, executed)
    df = tables.spark.createDataFrame([row], SERVING["model_run"])
    tables.replace_partitions("model_run", df, "run_type")
