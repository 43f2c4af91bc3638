"""Session helpers.

On a cluster the session comes from the platform; the library only reads its
settings.  ``local_session`` is for tests, the bench and the smoke entry.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on; applied to local sessions and recommended for
# cluster sessions (see README).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None,
                  app: str = "pitchside", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared file system; if it is unset
    there, this is an error (a machine-local folder would not survive the loss
    of that machine).  Only a local-mode session (tests, bench) gets a scratch
    folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, …)")
        path = tempfile.mkdtemp(prefix="pitchside-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a static conf on some builds; the context dir suffices
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
