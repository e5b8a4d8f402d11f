"""Intermediate tables in the folder all executors share.

A table used more than once is written once, and read back with only the columns each use needs.
That cuts the lineage (losing an executor never repeats the work before it), and it gives Spark
true sizes to choose joins by.
"""

import atexit
import shutil
import tempfile
import uuid


def shared_folder(spark):
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tripgrid-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


class Staging:
    """Writes tables below the shared folder; they go with ``remove`` or when the driver ends."""

    def __init__(self, spark):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tripgrid-{uuid.uuid4().hex}"
        files, folder = self._folder()
        files.mkdirs(folder)
        files.deleteOnExit(folder)

    def _folder(self):
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.root)
        return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder

    def path(self, label):
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def table(self, df, label):
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self):
        """Delete this object's tables; results that still read them cannot be used afterwards."""
        files, folder = self._folder()
        files.delete(folder, True)
