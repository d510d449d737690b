"""Results are written aside and put in place when complete, so that a failure leaves the earlier ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def published(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Runs ``write`` on a fresh path beside ``path`` and then renames it to ``path``.

    What was there goes only then; if the write fails, it stays as it was, and the unfinished
    one goes. A run that ends between the two renames leaves the earlier result under a
    hidden name, and the next run puts it back first. Renaming is one step on HDFS and
    local disks; stores that copy on rename take as long as copying.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    files, parent, name = place.getFileSystem(conf), place.getParent(), place.getName()

    def beside(kind: str, mark: str):
        return jvm.org.apache.hadoop.fs.Path(parent, f".{name}.{kind}-{mark}")

    def rename(old, new) -> None:
        if not files.rename(old, new):
            raise OSError(f"{old} could not be renamed to {new}")

    left = files.globStatus(beside("earlier", "*")) or []
    if len(left) and not files.exists(place):
        rename(left[0].getPath(), place)
    mark = uuid.uuid4().hex
    made, earlier = beside("made", mark), beside("earlier", mark)
    try:
        write(made.toString())
    except BaseException:
        files.delete(made, True)
        raise
    if files.exists(place):
        rename(place, earlier)
        try:
            rename(made, place)
        except BaseException:
            files.rename(earlier, place)
            files.delete(made, True)
            raise
        files.delete(earlier, True)
    else:
        rename(made, place)
