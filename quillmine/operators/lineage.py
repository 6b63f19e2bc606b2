"""Cut a lineage with reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make the context write checkpoints to the folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quillmine-checkpoints-")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read from a reliable checkpoint from then on."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store, whatever its scheme."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a checkpoint that :func:`cut` made and nothing reads any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        remove(df.sparkSession, file.get())
