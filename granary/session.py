"""Session set-up and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the checkpoint folder that the cluster shares.

    Only a local master may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="granary-")
    return f"{shared.rstrip('/')}/granary/{purpose}-{uuid.uuid4().hex}"
