"""Gives executors the package, as ``--py-files`` would."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tideglass

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's modules to the application's files, once an application.

    Functions that run in tasks are found by module name, so every executor must be able to
    import the package, wherever the driver has it installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tideglass.__file__))
    target = os.path.join(tempfile.mkdtemp(), "tideglass_modules.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
