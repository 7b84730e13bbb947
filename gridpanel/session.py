"""Session construction and lineage cutting."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "gridpanel", extra: dict | None = None) -> SparkSession:
    """Session for tests and bench: UTC, ANSI on, AQE on, UI off.

    On a cluster the session comes from the platform; only the settings that
    affect results (UTC session zone) matter there.
    """
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # runtime broadcast only for sides measured below 64 MB (sizing.py)
               .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=master.startswith("local"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is only chosen when the setting is unset
    and the session is a local one (tests, bench).
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not allow_local:
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        path = tempfile.mkdtemp(prefix="gridpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the folder of ``spark.checkpoint.dir`` and read it back (survives executor loss).

    A written table instead of ``checkpoint()``: that one first infers all
    constraints of the plan behind it, which takes minutes for wide calendar
    features."""
    spark = df.sparkSession
    master = spark.sparkContext.master or ""
    path = f"{ensure_checkpoint_dir(spark, allow_local=master.startswith('local')).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
