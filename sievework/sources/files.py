"""CSV at the edges, and folder listings that keep empty files.

``binaryFile`` drops files of zero length, so the inventory reads a listing of its own, made by tasks
folder by folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sources.shared import cut

LISTING = "dataset string, root string, folder string, name string, size long"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """RFC-4180 quoting: a backslash is an ordinary character; an empty field is null; a malformed row fails."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', nullValue="", mode="FAILFAST")


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with headered CSV; an empty table still gives a header."""
    kept = df if df.columns else df.select(F.lit(None).cast("string").alias("empty"))
    kept.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="")


def read_csv_apart(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, ``line`` of those that don't), both from one read that is written.

    A line with more or fewer fields or a value of another type is malformed; it is kept as it stands. A quote that
    isn't closed takes the rest of its line into its field, so fields are missing unless it was the last one's.
    """
    corrupt = "_malformed"
    whole = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = spark.read.schema(whole).csv(path, header=header, quote='"', escape='"', nullValue="", mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt)
    rows = cut(rows, "csv")
    return rows.where(F.col(corrupt).isNull()).drop(corrupt), rows.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"))


def open_at(address: str) -> tuple[fs.FileSystem, str]:
    """The file system that an address names, and the path there; a plain path is a local one."""
    scheme, found, rest = address.partition("://")
    if not found and address.startswith("file:/"):
        scheme, found, rest = "file", "://", address[5:]
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}" if found else address)


def list_folders(spark: SparkSession, roots: dict[str, str], suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """Folders (name null) and files below each dataset's root; a missing root gives no rows, an empty file has a row of size 0.

    Tasks look into roots first, then into folders, so the folders of one root are listed side by side, by the
    file system that a root's address names. With ``suffixes`` only files with one of them, in any case, leave the listing.
    """
    rows = spark.createDataFrame(list(roots.items()), "dataset string, root string")
    wide = max(1, spark.sparkContext.defaultParallelism)

    def inside(root: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
        system, path = open_at(root)
        return system, sorted(system.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda f: f.base_name)

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dataset, root in zip(*(c.to_pylist() for c in b.columns), strict=True):
                names = [f.base_name for f in inside(root)[1] if f.type == fs.FileType.Directory]
                yield pa.RecordBatch.from_arrays([pa.array([dataset] * len(names), pa.string()), pa.array([root] * len(names), pa.string()), pa.array(names, pa.string())], ["dataset", "root", "folder"])

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dataset, root, folder in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = [f for f in inside(f"{root.rstrip('/')}/{folder}")[1] if f.type == fs.FileType.File and (suffixes is None or f.base_name.lower().endswith(suffixes))]
                names, sizes = [None, *[f.base_name for f in found]], [None, *[f.size for f in found]]
                n = len(names)
                yield pa.RecordBatch.from_arrays([pa.array([x] * n, pa.string()) for x in (dataset, root, folder)] + [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["dataset", "root", "folder", "name", "size"])

    found = rows.repartition(max(1, min(wide, len(roots)))).mapInArrow(folders, "dataset string, root string, folder string")
    return found.repartition(wide, "root", "folder").mapInArrow(files, LISTING)


def write_files(rows: DataFrame, path: str, content: str) -> int:
    """Write each row's bytes to the address in ``path``, in tasks; how many files that were. A file written again is the same file."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            for where, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system, at = open_at(where)
                system.create_dir(at.rpartition("/")[0], recursive=True)
                with system.open_output_stream(at) as f:
                    f.write(data or b"")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return rows.select(path, F.col(content).cast("binary")).mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
