"""Small records of which the first writer wins: one file each, created only if absent."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _plain(path: str) -> str:
    """A path of the local file system without its scheme."""
    return urlparse(path).path if path.startswith("file:") else path


def put_if_absent(spark: SparkSession, folder: str, name: str, record: Mapping[str, object]) -> bool:
    """Create ``folder/name.json`` with one record; False if it is there already.

    The file appears complete or not at all. On a file system with links the name is linked,
    elsewhere a finished file is renamed, which HDFS refuses for a name that exists. An object
    store without conditional writes needs a committer that has them.
    """
    line = json.dumps(dict(record)) + "\n"
    base, fs = _file_system(spark, folder)
    fs.mkdirs(base)
    target = f"{folder.rstrip('/')}/{name}.json"
    # Names that begin with an underscore are not read as data.
    scratch = f"{folder.rstrip('/')}/_{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        local, scratch = (_plain(path) for path in (target, scratch))
        with open(scratch, "x") as file:
            file.write(line)
        try:
            os.link(scratch, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(scratch)
        return True
    hadoop_target, _ = _file_system(spark, target)
    hadoop_scratch, _ = _file_system(spark, scratch)
    stream = fs.create(hadoop_scratch, False)
    try:
        stream.write(bytearray(line.encode()))
    finally:
        stream.close()
    if not fs.exists(hadoop_target) and fs.rename(hadoop_scratch, hadoop_target):
        return True
    fs.delete(hadoop_scratch, False)
    return False


def records(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """All records of a folder; None where there is no folder yet."""
    try:
        return spark.read.schema(schema).json(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all in it, if there is one."""
    hadoop, fs = _file_system(spark, path)
    fs.delete(hadoop, True)
