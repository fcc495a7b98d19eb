"""Getting this package to the executors, wherever the session came from."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from marl.plans.scratch import exists, shared_root, write_bytes

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make `marl` importable on every worker, once an application: its sources go to the shared folder as an archive."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    target = f"{shared_root(spark)}/marl-{app}.zip"
    if not exists(spark, target):
        write_bytes(spark, target, data.getvalue())
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
