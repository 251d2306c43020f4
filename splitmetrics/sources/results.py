"""Saving result frames per experiment, and the run history."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitmetrics.config import ExperimentConfig
from splitmetrics.sources.workspace import remove

# The timed stages of a run, in order.
STAGES = (
    "ordersproc",
    "datapull",
    "datadist",
    "outlier",
    "userentry",
    "summary",
    "cohort",
    "care",
    "daily",
    "cumulative",
    "total_time",
)

RUN_HISTORY = T.StructType(
    [T.StructField(stage, T.DoubleType()) for stage in STAGES]
    + [
        T.StructField("application_id", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("spark_version", T.StringType()),
        T.StructField("test_id", T.IntegerType()),
        T.StructField("test_type_id", T.IntegerType()),
        T.StructField("rundate", T.TimestampType()),
    ]
)


_POINTER, _VERSION = "_current", "version-"


def save_frame(frame: DataFrame, base: str, name: str, config: ExperimentConfig) -> None:
    """Write one result frame as a new version, replacing only this experiment's rows.

    The version becomes the current one by the rename of a pointer file, which either happens or does not. So a
    write that fails anywhere leaves the old rows, and a reader that has begun goes on with the version it found: the one before is
    kept until the next save.
    """
    spark = frame.sparkSession
    folder = f"{base}/{name}/{_partition(config)}"
    before = _current(spark, folder)
    fresh = f"{_VERSION}{uuid4().hex}"
    frame.write.parquet(f"{folder}/{fresh}")
    _point_to(spark, folder, fresh)
    for found in _children(spark, folder):
        if found not in (_POINTER, fresh, before):
            remove(spark, f"{folder}/{found}")


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [f.getPath().getName() for f in _files(spark, folder).listStatus(path)]


def _current(spark: SparkSession, folder: str) -> str | None:
    """The version that the pointer file names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_POINTER}")
    files = _files(spark, folder)
    if not files.exists(path):
        return None
    source = files.open(path)
    try:
        return source.readUTF()
    finally:
        source.close()


def _point_to(spark: SparkSession, folder: str, version: str) -> None:
    """Name the version in a file of its own and rename it to the pointer, over the old one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    written = hadoop.Path(f"{folder}/{_POINTER}-{version}")
    out = _files(spark, folder).create(written, True)
    try:
        out.writeUTF(version)
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(written.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(written, hadoop.Path(f"{folder}/{_POINTER}"), overwrite)


def _partition(config: ExperimentConfig) -> str:
    return f"test_type_id={config.test_type_id}/test_id={config.test_id}"


def save_frames(frames: dict[str, DataFrame], base: str, config: ExperimentConfig) -> None:
    for name, frame in frames.items():
        save_frame(frame, base, name, config)


def load_frame(spark: SparkSession, base: str, name: str, config: ExperimentConfig) -> DataFrame:
    """The current version of one experiment's frame; nothing of the others is listed or read."""
    folder = f"{base}/{name}/{_partition(config)}"
    version = _current(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no saved frame in {folder}")
    return spark.read.parquet(f"{folder}/{version}")


def cutoff_frame(spark: SparkSession, config: ExperimentConfig) -> DataFrame:
    """The cut-offs a run was made with, as a frame to be saved with its results."""
    return spark.createDataFrame(
        [(config.gm_low, config.gm_high, config.bookings_high)],
        "gm_low double, gm_high double, bookings_high double",
    )


def append_run_history(
    spark: SparkSession, path: str, config: ExperimentConfig, timings: dict[str, float]
) -> None:
    """Append one row of stage timings (seconds); earlier rows are never rewritten."""
    times = [float(timings[s]) if s in timings else None for s in STAGES]
    row = spark.createDataFrame(
        [(*times, config.test_id, config.test_type_id)],
        T.StructType(
            [f for f in RUN_HISTORY if f.name in (*STAGES, "test_id", "test_type_id")]
        ),
    )
    complete = row.withColumns(
        {
            "application_id": F.lit(spark.conf.get("spark.app.id", None)),
            "user": F.current_user(),
            "spark_version": F.lit(spark.version),
            "rundate": F.current_timestamp(),
        }
    ).select(RUN_HISTORY.fieldNames())
    complete.write.mode("append").parquet(path)


def read_run_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_HISTORY).parquet(path)
