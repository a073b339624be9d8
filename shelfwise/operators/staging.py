"""Staging: source rows plus load metadata, without constraints."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from shelfwise.sources.schemas import STAGED, STAGED_RENAMES


def stage(linked: dict[str, DataFrame], name: str, extracted_at: datetime) -> DataFrame:
    source, system = STAGED[name]
    return (
        linked[source]
        .withColumnsRenamed(STAGED_RENAMES.get(name, {}))
        .withColumn("source_system", F.lit(system))
        .withColumn("extracted_at", F.lit(extracted_at).cast("timestamp"))
    )


def stage_all(linked: dict[str, DataFrame], extracted_at: datetime) -> dict[str, DataFrame]:
    return {name: stage(linked, name, extracted_at) for name in STAGED}
