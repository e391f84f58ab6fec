"""Session helpers: a local test session and the lineage cut used by multi-pass operators."""

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "tabwright", checkpoints: str | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own. `checkpoints` names the folder for intermediate tables."""
    builder = SparkSession.builder if checkpoints is None else SparkSession.builder.config("spark.checkpoint.dir", checkpoints)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, else one below the warehouse, if that is set and so shared.

    Without either only a local session has a folder that its tasks share: one below its working folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") and sc.getConf().get("spark.sql.warehouse.dir") is None:
                raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder once so that later passes read it instead of recomputing it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
