"""Write metrics gathered with the write itself (no second scan)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Attach counters that arrive when the frame is computed."""
    obs = Observation(f"publish_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, *[c.alias(n) for n, c in counters.items()]), obs


def sent_counters(value: str = "value") -> dict[str, Column]:
    return {"sent": F.count(F.lit(1)), "bytes": F.coalesce(F.sum(F.octet_length(value)), F.lit(0))}


def throughput(counts: dict, started: float) -> dict:
    """Counters with seconds and records/s.  A failed write raises: there is no partial success to count."""
    secs = max(time.time() - started, 1e-9)
    return {**{k: int(v) for k, v in counts.items()}, "seconds": secs, "records_per_sec": counts["sent"] / secs}
