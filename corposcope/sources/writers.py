"""Sinks: certified tables with manifests, one-row documents, event logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def table_fingerprint(df: DataFrame) -> str:
    """Of all rows, their order aside: a sum of row hashes with the count, so it is a partial aggregate."""
    row = F.xxhash64(*df.columns).cast("decimal(38,0)")
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(row), F.lit(0))).first()
    return f"{n}:{total}"


def write_certified(df: DataFrame, path: str, kind: str, inputs: dict[str, str], config: dict) -> dict:
    """Writes a table and beside it a manifest with the hash of inputs and configuration. An empty table gets none."""
    df.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    back = spark.read.parquet(path)
    if back.isEmpty():
        return {"type": kind, "certified": False}
    identity = canonical_json({"type": kind, "inputs": inputs, "config": config})
    manifest = {"type": kind, "certified": True, "inputs": inputs, "config": config, "content": table_fingerprint(back)}
    manifest["fingerprint"] = spark.range(1).select(F.sha2(F.lit(identity), 256)).first()[0]
    spark.createDataFrame([(canonical_json(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.manifest")
    return manifest


def is_fresh(spark, path: str, kind: str, inputs: dict[str, str], config: dict) -> bool:
    """Whether the manifest beside a table was made from the same inputs and configuration."""
    try:
        held = json.loads(spark.read.text(f"{path}.manifest").first()[0])
    except Exception:  # noqa: BLE001  no manifest, whatever the store says
        return False
    return (held["type"], held["inputs"], held["config"]) == (kind, inputs, config)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
