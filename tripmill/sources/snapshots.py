"""Partitioned tables whose versions appear whole or not at all.

Below a table lie ``data/commit=<id>/<partition>/`` folders, which never change, and one
small file per version that names the commit each partition is read from. A version is
published by renaming its file to a name that must not exist yet, after its data is
written: a killed write leaves the version before it readable, and of two writers one
fails with ``VersionConflict``. This needs a file system whose rename refuses an existing
target, such as HDFS; elsewhere one writer at a time must be ensured.

A version file has one entry per partition, not per file, so it stays small and is the only
thing that passes the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmill.sources.tables import TRIP_PARTITIONS


class VersionConflict(RuntimeError):
    """Another writer has published the version first."""


@dataclass(frozen=True)
class Version:
    """What one version consists of: the commit that holds each partition's rows."""

    number: int
    keys: tuple[str, ...]
    schema: StructType
    partitions: dict[str, str] = field(default_factory=dict)

    def folders(self, path: str, among: Iterable[str] | None = None) -> list[str]:
        """Where the rows of all partitions, or of those ``among`` them, lie."""
        chosen = self.partitions if among is None else self.partitions.keys() & set(among)
        return [f"{path}/data/commit={self.partitions[p]}/{p}" for p in sorted(chosen)]

    def by_values(self) -> dict[tuple[str | None, ...], str]:
        """Partitions by their values; what Spark escapes in folder names is put back."""
        return {
            tuple(_value(level.partition("=")[2]) for level in p.split("/")): p
            for p in self.partitions
        }


def _value(written: str) -> str | None:
    # Fixed value: the folder name of a null, and of an empty text.
    return None if written == "__HIVE_DEFAULT_PARTITION__" else unquote(written)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    names = _children(spark, f"{path}/versions")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "."]


def load_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The given or the newest version; None where none is published."""
    if number is None:
        number = max(versions(spark, path), default=None)
        if number is None:
            return None
    fs, name = _file_system(spark, f"{path}/versions/{number:010d}.json")
    stream = fs.open(name)
    try:
        told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    schema = StructType.fromJson(told["schema"])
    return Version(number, tuple(told["keys"]), schema, told["partitions"])


def read_partitions(
    spark: SparkSession, path: str, version: Version, among: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a version, or of some of its partitions; only their folders are listed."""
    folders = version.folders(path, among)
    if not folders:
        return spark.createDataFrame([], version.schema)
    reader = spark.read.schema(version.schema).option("basePath", f"{path}/data")
    return reader.parquet(*folders).select(*version.schema.names)


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of a table, or an earlier one that is still kept."""
    version = load_version(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no version of {path} is published")
    return read_partitions(spark, path, version)


def _written(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders a commit has written, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{parent}/{name}".lstrip("/")
            for parent in found
            for name in _children(spark, f"{folder}/{parent}".rstrip("/"))
            if "=" in name
        ]
    return found


def write_commit(df: DataFrame, path: str, keys: Sequence[str]) -> dict[str, str]:
    """Write rows that no version names yet; hands back the partitions they lie in."""
    commit = uuid.uuid4().hex
    folder = f"{path}/data/commit={commit}"
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(folder)
    return dict.fromkeys(_written(df.sparkSession, folder, len(keys)), commit)


def publish(spark: SparkSession, path: str, version: Version) -> int:
    """Make a version the newest; its number must be free."""
    fs, target = _file_system(spark, f"{path}/versions/{version.number:010d}.json")
    _, draft = _file_system(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    told = {
        "keys": list(version.keys),
        "schema": json.loads(version.schema.json()),
        "partitions": version.partitions,
    }
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(told), "utf-8"))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        files.rename(draft, target, spark.sparkContext._gateway.new_array(rename, 0))
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise VersionConflict(f"version {version.number} of {path} exists") from error
        raise
    return version.number


def write_snapshot(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = TRIP_PARTITIONS,
    whole: bool = False,
    base: Version | None = None,
) -> int:
    """Publish ``df`` as the next version: in place of its partitions, or of the ``whole`` table.

    ``base`` is the version it was made from (the newest if not given); should another have
    followed it by now, nothing is published. An empty ``df`` replaces no partition, or
    makes the whole table empty. Columns must be those of the version before unless the
    whole table is replaced.
    """
    spark = df.sparkSession
    base = base or load_version(spark, path)
    if base is None or whole:
        made = write_commit(df, path, keys)
        return publish(spark, path, Version(base.number + 1 if base else 1, tuple(keys), df.schema, made))
    if set(df.dtypes) != {(f.name, f.dataType.simpleString()) for f in base.schema}:
        raise ValueError("columns differ from those of the version before")
    if tuple(keys) != base.keys:
        raise ValueError(f"the table is partitioned by {base.keys}")
    return replace_partitions(df, path, base, ())


def replace_partitions(df: DataFrame, path: str, base: Version, replaced: Iterable[str]) -> int:
    """Publish ``df`` in place of its partitions and of those ``replaced``, which may end up
    without rows."""
    gone = set(replaced)
    kept = {p: c for p, c in base.partitions.items() if p not in gone}
    kept |= write_commit(df.select(*base.schema.names), path, base.keys)
    return publish(df.sparkSession, path, Version(base.number + 1, base.keys, base.schema, kept))


def forget(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest versions and the commits only they name; hands back their numbers.

    Commits without a version, left by killed writes, go too, so no write may be under way.
    """
    if keep < 1:
        raise ValueError("one version at least is kept")
    numbers = versions(spark, path)
    gone, stay = numbers[:-keep], numbers[-keep:]
    for number in gone:
        fs, name = _file_system(spark, f"{path}/versions/{number:010d}.json")
        fs.delete(name, False)
    named = {c for n in stay for c in load_version(spark, path, n).partitions.values()}
    for name in _children(spark, f"{path}/data"):
        if name.removeprefix("commit=") not in named:
            fs, folder = _file_system(spark, f"{path}/data/{name}")
            fs.delete(folder, True)
    return gone
