"""Sessions, and the package's way to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def session(name: str = "toolloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC timestamps; the cluster's own settings hold otherwise."""
    b = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once for a Spark context, for the operators that run Python."""
    sc = spark.sparkContext
    if getattr(sc, "_toolloom_sent", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="toolloom-"), "toolloom_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for d, _, names in os.walk(root):
            for x in names:
                if x.endswith(".py"):
                    at = os.path.join(d, x)
                    out.write(at, os.path.join("toolloom", os.path.relpath(at, root)))
    sc.addPyFile(path)
    sc._toolloom_sent = True
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in spark.checkpoint.dir; where it is unset and all runs on one machine, in a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="toolloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found}/{name}-{uuid.uuid4().hex}"
