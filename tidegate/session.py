"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Mapping

from pyspark.sql import SparkSession


def build_session(
    app: str = "tidegate",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library is written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit: adaptive execution
    merges small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.legacy.javaCharsets", "true")
        # The JVM leaves methods of more than 8,000 bytes uncompiled; wide tables would reach that.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Call sites are recorded per column expression; for wide tables that outlasts the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names.

    Only a master of one process may go without the setting; executors of a cluster cannot see the
    driver's temporary folder, so there it is an error. The session's settings stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tidegate-")
    return f"{base.rstrip('/')}/tidegate-{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidegate-"), "tidegate.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
