"""Digests of files that are too large for one value: byte ranges are read in tasks and combined in order.

The digest of a file is a hash tree: its blocks of ``BLOCK`` bytes (an empty file has one empty block) are hashed by SHA-256; the
digests of ``FAN`` neighbours, as bytes in order, are hashed again, at least once and until one is left. It so
depends on the bytes, the block and the fan alone, not on how many blocks a task reads at once or
where.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.sources.files import open_at

BLOCK, FAN = 1 << 20, 4096
#: Blocks that a task's range has.
BLOCKS_AT_ONCE = 64


def block_digests(files: DataFrame, path: str, size: str, block: int = BLOCK, at_once: int = BLOCKS_AT_ONCE) -> DataFrame:
    """``path, block, digest``: ranges of ``at_once`` blocks are dealt out, so one large file keeps many tasks busy."""
    dealt = files.where(F.col(path).isNotNull()).select(F.col(path).alias("_path"), F.coalesce(size, F.lit(0)).cast("long").alias("_size"))
    dealt = dealt.select("_path", "_size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("_size") / block) - 1, F.lit(0)), F.lit(at_once).cast("long"))).alias("_first"))
    parts = max(1, files.sparkSession.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, whole, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                system, at = open_at(where)
                names, digests = [], []
                with system.open_input_file(at) as f:
                    f.seek(first * block)
                    for k in range(first, min(first + at_once, max(1, -(-whole // block)))):
                        data = f.read(min(block, whole - k * block)) if whole else b""
                        if len(data) != min(block, max(0, whole - k * block)):
                            raise OSError(f"{where} ends before its {whole} bytes")
                        names.append(k)
                        digests.append(hashlib.sha256(data).hexdigest())
                yield pa.RecordBatch.from_arrays([pa.array([where] * len(names), pa.string()), pa.array(names, pa.int64()), pa.array(digests, pa.string())], ["path", "block", "digest"])

    return dealt.repartition(parts, "_path", "_first").mapInArrow(read, "path string, block long, digest string")


def file_digests(files: DataFrame, path: str, size: str, block: int = BLOCK, at_once: int = BLOCKS_AT_ONCE, fan: int = FAN) -> DataFrame:
    """``path, blocks, digest`` of each file; ``size`` is its listed size, and a file shorter than that fails the job."""
    listed = files.dropDuplicates([path])
    own = listed.select(F.col(path).alias("_path"), F.greatest(F.ceil(F.coalesce(size, F.lit(0)) / block), F.lit(1)).cast("long").alias("blocks"))
    now = block_digests(listed, path, size, block, at_once).join(own, F.col("path") == F.col("_path")).select("path", "block", "digest", "blocks", F.col("blocks").alias("_left"))
    left = max(1, -(-(listed.agg(F.max(size)).first()[0] or 0) // block))
    level = 0
    while left > 1 or not level:
        # no more than ``fan`` digests meet in one row; a file that is down to one stays as it is
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "digest"))), lambda x: x["digest"]), "")
        made = F.sha2(F.unhex(joined), 256)
        digest = F.when(F.max("_left") == 1, F.max("digest")).otherwise(made) if level else made
        now = now.groupBy("path", "blocks", F.floor(F.col("block") / fan).alias("block")).agg(digest.alias("digest"), F.ceil(F.max("_left") / fan).alias("_left"))
        left, level = -(-left // fan), level + 1
    return now.select("path", "blocks", "digest")
