"""Where intermediate tables go: the shared folder the cluster names; and the code that tasks need."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from surveyqa.session import checkpoint_folder, shared_place
from surveyqa.session import staged as staged_at


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers, once a session: they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "surveyqa_shipped", False):
        return
    root, folder = Path(__file__).resolve().parent.parent, tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it until then
    archive = os.path.join(folder, "surveyqa_tasks.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    context.surveyqa_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; under the warehouse where that is unset."""
    ship(spark)
    root = checkpoint_folder(spark) or shared_place(spark)
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table below ``folder`` and read it back, so that lost executors don't repeat its work."""
    return staged_at(df, f"{folder}/{name}")


def mounted(folder: str) -> str:
    """A shared folder as a path that Python in the tasks can open.

    Formats that Spark has no writer for (memory-mapped arrays, token files) need the shared folder
    mounted at the same path on every host; an object-store address is refused here.
    """
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{folder}: a shared folder mounted on all hosts is needed")
    return unquote(parts.path)


def write_file(path: str, data: bytes) -> None:
    """Write under a temporary name, then rename: a task that runs twice leaves one whole file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as out:
        out.write(data)
    os.replace(temporary, path)
