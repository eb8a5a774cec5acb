"""Helpers for running SQL text over DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def temp_views(frames: dict[str, DataFrame]) -> dict[str, str]:
    """Register each frame as a uniquely named temp view; return the names."""
    tag = uuid.uuid4().hex[:8]
    out = {}
    for key, df in frames.items():
        name = f"v_{key}_{tag}"
        df.createOrReplaceTempView(name)
        out[key] = name
    return out
