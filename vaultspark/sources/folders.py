"""Folders of any file system that Spark can reach, seen from the driver: names only, no data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_of(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = fs_of(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = fs_of(spark, path)
    fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none if it does not exist."""
    fs, hadoop_path = fs_of(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
