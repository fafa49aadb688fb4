"""Folders on whatever file system a path names, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, folder = _located(spark, path)
    file_system.mkdirs(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    file_system, folder = _located(spark, path)
    file_system.delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog writes it."""
    file_system, folder = _located(spark, path)
    return file_system.makeQualified(folder).toString().rstrip("/")


def swap_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``; what was there goes last."""
    file_system, target = _located(spark, path)
    _, source = _located(spark, staged)
    _, aside = _located(spark, f"{staged}-before")
    file_system.mkdirs(target.getParent())
    had = file_system.exists(target)
    if had and not file_system.rename(target, aside):
        raise OSError(f"{path} can not be moved")
    if not file_system.rename(source, target):
        if had:
            file_system.rename(aside, target)
        raise OSError(f"{staged} can not be moved to {path}")
    if had:
        file_system.delete(aside, True)


def exists(spark: SparkSession, path: str) -> bool:
    file_system, file = _located(spark, path)
    return file_system.exists(file)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    file_system, folder = _located(spark, path)
    if not file_system.exists(folder):
        return []
    return sorted(x.getPath().getName() for x in file_system.listStatus(folder) if x.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is seen whole or not at all."""
    file_system, file = _located(spark, path)
    folder, name = path.rsplit("/", 1)
    _, hidden = _located(spark, f"{folder}/_{name}.tmp")
    file_system.mkdirs(file.getParent())
    stream = file_system.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not file_system.rename(hidden, file):
        raise OSError(f"{path} can not be written")


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without a job."""
    file_system, file = _located(spark, path)
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(file_system.open(file), "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def move_only_file(spark: SparkSession, folder: str, suffix: str, path: str) -> None:
    """Move the one file in ``folder`` whose name ends in ``suffix`` to ``path``."""
    file_system, source = _located(spark, folder)
    _, target = _located(spark, path)
    names = [x.getPath() for x in file_system.listStatus(source) if x.getPath().getName().endswith(suffix)]
    if len(names) != 1:
        raise OSError(f"{len(names)} files in {folder}")
    file_system.mkdirs(target.getParent())
    if not file_system.rename(names[0], target):
        raise OSError(f"{names[0]} can not be moved to {path}")
