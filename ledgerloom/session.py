"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings the library depends on for correct results. Timestamps are
# interpreted in UTC everywhere, as the ingestion rules normalise to UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for scale; applied only when the caller builds the
# session through ``build_session`` (a cluster keeps its own values).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (idempotent, cheap)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "ledgerloom", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false"))
    for k, v in {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    The library never invents a folder: on a cluster a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(tests set a temporary folder themselves)")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes to the shared checkpoint folder and cuts
    lineage, so later stages see fixed rows (and fixed partition ids) even if
    executors are lost and tasks are re-run."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
