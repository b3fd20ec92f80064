"""Tables that are replaced at once: data folders that no writer touches again
and small version files that name them.

A writer puts its rows into a fresh folder ``load=<id>`` through Spark's
committer and then adds the next file of ``_versions``, which lists the folders
that are now the table. Readers take the highest version, so they see the old
table or the new one and never half of either; a writer that fails leaves the
old version. The version file is moved into place only if no other writer made
that version first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wayfare.session import file_system


class ConcurrentWrite(RuntimeError):
    """Another writer committed a version meanwhile."""


def _children(spark: SparkSession, path: str) -> list:
    folder, fs = file_system(spark, path)
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def latest(spark: SparkSession, root: str) -> int:
    """The number of the current version; 0 where there is none yet."""
    names = [st.getPath().getName() for st in _children(spark, f"{root}/_versions")]
    return max((int(n) for n in names if n.isdigit()), default=0)


def contents(spark: SparkSession, root: str, version: int | None = None) -> tuple[str, list[str]]:
    """The schema (JSON, or empty) and the folders, relative to ``root``."""
    version = latest(spark, root) if version is None else version
    if not version:
        return "", []
    path, fs = file_system(spark, f"{root}/_versions/{version:08d}")
    stream = fs.open(path)
    try:
        size = fs.getFileStatus(path).getLen()
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)
    finally:
        stream.close()
    schema, *folders = bytes(raw).decode().split("\n")
    return schema, folders


def commit(spark: SparkSession, root: str, after: int, schema: str, folders: list[str]) -> int:
    """Make ``folders`` the version after ``after``, or raise ConcurrentWrite."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    target, fs = file_system(spark, f"{root}/_versions/{after + 1:08d}")
    staged, _ = file_system(spark, f"{root}/_versions/.{after + 1:08d}-{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    try:
        stream.write(bytearray("\n".join([schema, *folders]).encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:  # without the option to overwrite, so that the first of two writers wins
        context.rename(staged, target, sc._gateway.new_array(option, 0))
    except Exception as e:
        fs.delete(staged, False)
        if fs.exists(target):
            raise ConcurrentWrite(f"version {after + 1} of {root} is there already") from e
        raise
    return after + 1


def publish(spark: SparkSession, root: str, write: Callable[[str], None], mode: str = "overwrite",
            schema: str = "") -> str:
    """Have ``write(folder)`` fill a fresh folder and make it the
    table; returns the table's folder. Where there is a version already,
    ``overwrite`` follows it, ``errorifexists`` raises before anything is
    written, and ``ignore`` keeps it, also when another writer was faster."""
    before = latest(spark, root)
    if before and mode == "errorifexists":
        raise FileExistsError(root)
    if not before or mode != "ignore":
        folder = f"load={uuid.uuid4().hex}"
        write(f"{root}/{folder}")
        try:
            commit(spark, root, before, schema, [folder])
            return f"{root}/{folder}"
        except ConcurrentWrite:
            if mode != "ignore":
                raise
    return f"{root}/{contents(spark, root)[1][0]}"


def replace(df: DataFrame, root: str, mode: str = "overwrite") -> str:
    """``df`` as the Parquet table ``root`` (see ``publish``)."""
    return publish(df.sparkSession, root, df.write.parquet, mode, df.schema.json())


def read(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """The current version as a DataFrame, or only some of its folders."""
    schema, live = contents(spark, root)
    if not schema:
        raise FileNotFoundError(f"{root} has no table version")
    kind = T.StructType.fromJson(json.loads(schema))
    live = live if folders is None else folders
    if not live:
        return spark.createDataFrame([], kind)
    with_load = T.StructType([*kind.fields, T.StructField("load", T.StringType())])
    paths = [f"{root}/{f}" for f in live]
    return spark.read.schema(with_load).option("basePath", root).parquet(*paths).drop("load")


def partitions(spark: SparkSession, root: str, folder: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below ``folder``, relative to ``root``."""
    found = [folder]
    for _ in range(depth):
        found = [f"{f}/{st.getPath().getName()}" for f in found for st in _children(spark, f"{root}/{f}")
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return sorted(found)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete loads that none of the last ``keep`` versions names; call it
    when no reader of an older version and no writer is at work."""
    last = latest(spark, root)
    used = {f.split("/")[0] for v in range(max(1, last - keep + 1), last + 1) for f in contents(spark, root, v)[1]}
    gone = []
    for st in _children(spark, root):
        name = st.getPath().getName()
        if name.startswith("load=") and name not in used:
            file_system(spark, f"{root}/{name}")[1].delete(st.getPath(), True)
            gone.append(name)
    return gone
