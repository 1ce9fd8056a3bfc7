"""Intermediate results written once to the folder that driver and executors share.

The folder is the one named in ``spark.checkpoint.dir``. A local master, as in tests, may do without: a
temporary folder of the session takes its place. On a cluster the setting is required. What
:func:`stage` writes lives in a subfolder of the application, which goes when the Python process ends;
:class:`StageArea` removes its files at the end of a block.
"""

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="stalewatch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the application's folder."""
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        _FOLDERS[application] = f"{shared_folder(spark)}/stalewatch-{application}"
        atexit.register(_remove_at_exit, spark, _FOLDERS[application])
    return f"{_FOLDERS[application]}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def clear(spark: SparkSession) -> None:
    """Remove everything the application has staged; frames that are still to be read have no files then."""
    folder = _FOLDERS.get(spark.sparkContext.applicationId)
    if folder:
        remove(spark, folder)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        remove(spark, folder)
    except Exception:  # noqa: BLE001  the gateway to the JVM may already be closed
        pass


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Several branches of a plan can then read the rows without computing them again, a lost executor
    costs no lineage, and the files give the optimizer real sizes.
    """
    return _written(df, scratch_path(df.sparkSession, label))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class StageArea:
    """Stages frames like :func:`stage` and removes their files when the block ends.

    For jobs that write their result inside the block; a frame still unread after it has no files.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> "StageArea":
        return self

    def __call__(self, df: DataFrame, label: str = "stage") -> DataFrame:
        self._paths.append(scratch_path(self._spark, label))
        return _written(df, self._paths[-1])

    def drop_older(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` frames."""
        while len(self._paths) > keep:
            remove(self._spark, self._paths.pop(0))

    def __exit__(self, *_: object) -> None:
        self.drop_older(0)
