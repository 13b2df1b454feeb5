"""File-system calls through Hadoop, so that any shared storage works the same way."""

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _resolve(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def modified_at(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _resolve(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the driver's file system closes, that is when the session ends."""
    fs, hadoop_path = _resolve(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0].value


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote; a missing one is fine."""
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)
