"""Make the package importable in the Python workers of a session."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    The stemmer and the dense scoring run in Python workers, which know only what
    is installed there. Not needed when the job is submitted with the package in
    ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="foliorank-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
