"""The package on executors that do not have it installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import onsetlab

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules along with the application, once.

    Python workers unpickle functions by module, so they must be able to import
    them wherever they run. The archive is small and goes by Spark's own files.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(onsetlab.__file__).parent
    with tempfile.TemporaryDirectory() as copy:
        shutil.copytree(package, Path(copy) / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(str(Path(tempfile.mkdtemp()) / package.name), "zip", copy)
    context.addPyFile(archive)
    _SENT.add(context.applicationId)
