"""What the operators share: tables by folder, code for executors, stored intermediate tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.stage import materialise

__all__ = ["batches", "materialise", "ship", "table", "vocabulary"]

_PACKAGE = Path(__file__).resolve().parents[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary's file; executors open their own installed copy there."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors once per session, as `--py-files` would."""
    context = spark.sparkContext
    if getattr(context, "_tillroll_shipped", False):
        return
    with tempfile.NamedTemporaryFile(prefix="tillroll-", suffix=".zip", delete=False) as file, zipfile.ZipFile(file, "w") as archive:
        for path in sorted(_PACKAGE.rglob("*.py")):
            archive.write(path, path.relative_to(_PACKAGE.parent))
    context.addPyFile(file.name)
    context._tillroll_shipped = True


def batches(sizes, limit: int):
    """Index ranges [a, b) over `sizes`, each of about `limit` in total and of one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
