"""The store: one directory per table, partitioned by `_legislatura=<value>`."""

from __future__ import annotations

import json
import time
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.operators.reshape import union_all

PARTITION = "_legislatura"

_WHOLE = {T.ByteType(): 0, T.ShortType(): 1, T.IntegerType(): 2, T.LongType(): 3}
_REAL = (T.FloatType(), T.DoubleType())
_TIME = (T.DateType(), T.TimestampNTZType(), T.TimestampType())


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: the wider number, a timestamp for dates, text for the rest."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.__getitem__)
    if (a in _WHOLE or a in _REAL) and (b in _WHOLE or b in _REAL):
        return T.DoubleType()
    if a in _TIME and b in _TIME:
        return max(a, b, key=_TIME.index)
    return T.StringType()


def _file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def partition_paths(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition value -> directory, from one listing of the table directory."""
    root, fs = _file_system(spark, path)
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{PARTITION}=*")
    names = sorted(status.getPath().getName() for status in fs.globStatus(pattern) or [])
    return {name.split("=", 1)[1]: f"{path}/{name}" for name in names}


def some_file(spark: SparkSession, directory: str) -> str | None:
    """One data file of a directory, or None."""
    root, fs = _file_system(spark, directory)
    if not fs.exists(root):
        return None
    files = fs.listFiles(root, False)
    while files.hasNext():
        found = files.next().getPath()
        if found.getName().endswith(".parquet"):
            return found.toString()
    return None


#: Files that are renamed at the same time: a rename waits for the file system far longer than it works.
RENAMES = 16


def rename_data_files(spark: SparkSession, path: str, target: Callable[[dict[str, str]], str]) -> None:
    """Give each data file below a folder its place under another name, by the partition values of its folder.

    A folder with one data file moves whole where its new place is free, as making folders is slower than moving them.
    """
    root, fs = _file_system(spark, path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def listed(folder: str) -> tuple[list[str], list[str]]:
        """The folders and the data files in a folder, without the permissions that other listings ask for one by one."""
        folders, files = [], []
        for status in fs.listStatus(at(folder)):
            name = status.getPath().getName()
            if status.isDirectory():
                folders.append(f"{folder}/{name}")
            elif name.startswith("part-"):
                files.append(name)
        return folders, files

    with ThreadPoolExecutor(RENAMES) as several:
        found, moves, folders = {}, [], [root.toString()]
        while folders:
            deeper = []
            for folder, (below, files) in zip(folders, several.map(listed, folders), strict=True):
                deeper += below
                for name in files:
                    to = target(dict(f.split("=", 1) for f in folder.split("/") if "=" in f))
                    if to in found:
                        raise ValueError(f"{found[to]} and {folder}/{name} would both be {to}")
                    found[to] = f"{folder}/{name}"
                    moves.append((folder, name, to, len(files) == 1))
            folders = deeper
        places = [to.rsplit("/", 1)[0] for _, _, to, _ in moves]
        for parent in sorted({place.rsplit("/", 1)[0] for place in places}):
            fs.mkdirs(at(parent))
        shared = {place for place, n in Counter(places).items() if n > 1}

        def move(folder: str, name: str, to: str, alone: bool) -> None:
            place = to.rsplit("/", 1)[0]
            if alone and place not in shared and not fs.exists(at(place)) and fs.rename(at(folder), at(place)):
                folder = place
            else:
                fs.mkdirs(at(place))
            if not fs.rename(at(f"{folder}/{name}"), at(to)):
                raise OSError(f"cannot move {folder}/{name} to {to}")

        list(several.map(move, *zip(*moves, strict=True)) if moves else ())


def exists(spark: SparkSession, path: str) -> bool:
    root, fs = _file_system(spark, path)
    return fs.exists(root)


#: Folder beside the partitions of a table in which each write leaves the schema of the partitions it wrote.
SCHEMAS = "_schemas"
_RECORD = f"{PARTITION} string, schema string, written long"


def partition_files(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the data files of each partition, from one listing."""
    root, fs = _file_system(spark, path)
    found: dict[str, set[str]] = defaultdict(set)
    if not fs.exists(root):
        return found
    files = fs.listFiles(root, True)
    while files.hasNext():
        file = files.next().getPath()
        folder = file.getParent().getName()
        if folder.startswith(f"{PARTITION}=") and not file.getName().startswith(("_", ".")):
            found[folder.split("=", 1)[1]].add(file.getName())
    return found


def record_schemas(spark: SparkSession, path: str, schema: T.StructType, values: Iterable[str]) -> None:
    """Leaves a record that these partitions now have this schema; the latest record of a partition is in force."""
    own = T.StructType([f for f in schema if f.name != PARTITION]).json()
    rows = [(value, own, time.time_ns()) for value in sorted(values)]
    if rows:
        spark.createDataFrame(rows, _RECORD).coalesce(1).write.mode("append").parquet(f"{path}/{SCHEMAS}")


def recorded_schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Partition value -> schema by the records of a table, in one read."""
    if not exists(spark, f"{path}/{SCHEMAS}"):
        return {}
    records = spark.read.schema(_RECORD).parquet(f"{path}/{SCHEMAS}")
    newest = records.groupBy(PARTITION).agg(F.max_by("schema", "written").alias("schema"))
    alike = newest.groupBy("schema").agg(F.collect_list(PARTITION).alias("values"))  # as many rows as there are schemas
    kinds = [(T.StructType.fromJson(json.loads(r["schema"])), r["values"]) for r in alike.collect()]
    return {value: schema for schema, values in kinds for value in values}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with its columns matched by name over all partitions.

    Partition values stay text (`01`). A column missing from a partition is null there. Where
    partitions disagree on a type, each group of partitions that agree is read on its own and
    cast to the wider type; otherwise the table is one scan that prunes partitions as usual. Schemas
    come from the records that writes leave, in one read; only a partition written by others is asked itself.
    """
    parts = partition_paths(spark, path)
    if not parts:
        return spark.read.parquet(path)
    known = recorded_schemas(spark, path)
    schemas = {value: known.get(value) or spark.read.parquet(where).schema for value, where in parts.items()}
    merged: dict[str, T.StructField] = {}
    mixed = False
    for schema in schemas.values():
        for column in schema:
            seen = merged.get(column.name.lower())
            kind = column.dataType if seen is None else wider(seen.dataType, column.dataType)
            mixed |= seen is not None and seen.dataType != column.dataType
            merged[column.name.lower()] = T.StructField(seen.name if seen else column.name, kind)
    by_name = [f for f in merged.values() if f.name != PARTITION]
    if not mixed:
        return spark.read.schema(T.StructType([*by_name, T.StructField(PARTITION, T.StringType())])).parquet(path)
    groups: dict[str, list[str]] = defaultdict(list)
    for value, schema in schemas.items():
        groups[schema.simpleString()].append(value)
    frames = []
    for values in groups.values():
        own = T.StructType([*schemas[values[0]].fields, T.StructField(PARTITION, T.StringType())])
        frame = spark.read.schema(own).option("basePath", path).parquet(*[parts[v] for v in values])
        present = {c.lower(): c for c in frame.columns}
        cells = [
            (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in by_name
        ]
        frames.append(frame.select(*cells, PARTITION))
    return union_all(frames)
