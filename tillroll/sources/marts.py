"""Typed marts: contracts, versioned publication, reading."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import UTC, datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import MARTS, Contract


def to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns of the contract in its order and types; a value that does not fit fails the job."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in contract.schema.fields])


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: rows, keys that occur more than once, nulls where none may be, values that do not fit."""
    fields = contract.schema.fields
    required = [f.name for f in fields if f.name not in contract.nullable]
    lost = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in fields]

    def total(conditions: list) -> F.Column:
        return reduce(lambda a, b: a + b, [c.cast("bigint") for c in conditions])

    keys = contract.key or tuple(f.name for f in fields)
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        F.sum(total([F.col(name).isNull() for name in required])).alias("_nulls"),
        F.sum(total(lost)).alias("_lost"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).alias("null_values"),
        F.coalesce(F.sum("_lost"), F.lit(0)).alias("misfits"),
    )


def contract_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Contract check of several marts, one row each."""
    rows = [check_contract(df, MARTS[name]).select(F.lit(name).alias("mart"), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, rows)


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small text file through Spark, so that any file system the cluster knows will do."""
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)


class PublicationConflict(RuntimeError):
    """Another publisher has published after the version that this one started from."""


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, text: str, path: str) -> bool:
    """One small file that must be new; whether it was."""
    target, system = _path(spark, path)
    if system.exists(target):
        return False
    try:
        stream = system.create(target, False)
    except Exception:
        if system.exists(target):  # somebody was quicker
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def _delete(spark: SparkSession, path: str) -> None:
    target, system = _path(spark, path)
    system.delete(target, True)


def versions(spark: SparkSession, folder: str) -> list[dict]:
    """Manifests of the published versions, newest first: each names the one before it as `parent`."""
    if not _exists(spark, f"{folder}/manifests"):
        return []
    found = [json.loads(row["value"]) for row in spark.read.text(f"{folder}/manifests").select("value").collect()]
    by_parent = {manifest["parent"]: manifest for manifest in found}
    chain, last = [], None
    while last in by_parent:
        chain.append(by_parent[last])
        last = chain[-1]["version"]
    return chain[::-1]


def publish_marts(frames: Mapping[str, DataFrame], folder: str, after: str | None = "newest", keep: int = 10) -> dict[str, int]:
    """Replace all marts in one step and return their row counts.

    Everything goes to a new version folder first. The version counts only once its manifest exists, which is written
    last; readers take the newest, so a failed run changes nothing. The manifest's name holds the parent's, and a file is
    made only once: of two publishers that start from the same version, the second fails with `PublicationConflict`
    and takes its files away. `after` names the version that the frames were built from, by default the newest now
    (null: none yet). The tables of all but the newest `keep` versions are deleted; their manifests stay. An empty
    manifest, left by a publisher that died within this last write, blocks the next one until it is deleted.
    """
    unknown = set(frames) - set(MARTS)
    if unknown:
        raise ValueError(f"no contract for {sorted(unknown)}")
    if keep < 1:
        raise ValueError("keep must be at least 1")
    spark = next(iter(frames.values())).sparkSession
    parent = current_version(spark, folder) if after == "newest" else after
    version = new_version()
    counts: dict[str, int] = {}
    for name, df in frames.items():
        path = f"{folder}/versions/{version}/{name}"
        to_contract(df, MARTS[name]).write.parquet(path)
        written = spark.read.schema(MARTS[name].schema).parquet(path)
        report = check_contract(written, MARTS[name]).first()
        if report["duplicate_keys"] or report["null_values"]:
            raise ValueError(f"mart {name} breaks its contract: {report.asDict()}")
        counts[name] = report["row_count"]
    publish_version(spark, folder, {"version": version, "parent": parent, "counts": counts})
    for old in versions(spark, folder)[keep:]:
        delete_version(spark, folder, old["version"])
    return counts


def publish_version(spark: SparkSession, folder: str, manifest: Mapping[str, object]) -> None:
    """Make the tables under the manifest's `version` the newest, unless its `parent` has a successor already."""
    parent = manifest["parent"]
    if not _create(spark, json.dumps(manifest, ensure_ascii=False), f"{folder}/manifests/after-{parent or 'nothing'}.json"):
        delete_version(spark, folder, manifest["version"])
        raise PublicationConflict(f"version {parent or 'none'} has a successor already: {current_version(spark, folder)}")


def delete_version(spark: SparkSession, folder: str, version: str) -> None:
    _delete(spark, f"{folder}/versions/{version}")


def new_version() -> str:
    """Name of a new version; names sort by their start."""
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid4().hex[:8]


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Newest published version."""
    published = versions(spark, folder)
    return published[0]["version"] if published else None


def read_marts(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """Marts of a published version, by default the newest; a mart that was not published is absent."""
    published = versions(spark, folder)
    wanted = [m for m in published if version in (None, m["version"])]
    if not wanted:
        raise ValueError(f"no published version {version or ''} in {folder}")
    base = f"{folder}/versions/{wanted[0]['version']}"
    return {name: spark.read.schema(MARTS[name].schema).parquet(f"{base}/{name}") for name in wanted[0]["counts"]}


def new_run(folder: str) -> str:
    """Folder of a new run under `folder`; run names sort by start."""
    return f"{folder}/runs/{new_version()}"


def store_output(df: DataFrame, run: str, name: str) -> DataFrame:
    """Write one output as Parquet and return it read back, so later steps start from the stored rows."""
    df.write.parquet(f"{run}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{run}/{name}")


def write_manifest(spark: SparkSession, run: str, manifest: Mapping[str, object]) -> None:
    """Write a run's manifest, last of all: a run without one is unfinished and nobody reads it."""
    folder, _, name = run.rpartition("/runs/")
    _write_text(spark, json.dumps(manifest, ensure_ascii=False, default=str), f"{folder}/manifests/run={name}")


def _exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target)


def read_manifest(spark: SparkSession, folder: str, default: dict | None = None) -> dict:
    """Manifest of the newest finished run; `default`, where one is given, before the first."""
    if default is not None and not _exists(spark, f"{folder}/manifests"):
        return default
    return json.loads(spark.read.text(f"{folder}/manifests").orderBy(F.desc("run")).first()["value"])
