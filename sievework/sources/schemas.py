"""Schemas of the tables that curation stages exchange, and their enumerations."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


INVENTORY = _of(dataset=_S, breed=_S, image_count=_L, formats=_S, zero_byte_or_suspicious_count=_L)
METADATA = _of(breed=_S, dataset_code=_S, dataset_full_name=_S, original_filename=_S, master_filename=_S, master_path=_S)
VALIDATION = _of(master_path=_S, breed=_S, status=_S, width=_I, height=_I, format=_S, mode=_S, detail=_S)
CLUSTERS = _of(breed=_S, dataset_code=_S, dataset_full_name=_S, original_path=_S, cluster_id=_S, duplicate_type=_S, role=_S, new_path=_S)
LOOSE = _of(breed=_S, path_a=_S, path_b=_S, distance=_I)
MANIFEST = _of(path=_S, breed=_S, role=_S)
MOVES = _of(breed=_S, original_path=_S, new_path=_S, moved=_B)
MASTER = _of(path=_S, breed=_S, dataset_code=_S, source_type=_S, role=_S, width=_I, height=_I, format=_S, mode=_S, is_grayscale=_B, aspect_ratio=_D, resolution_category=_S, file_size_bytes=_L, status=_S, grayscale_detection_method=_S)
SPLITS = _of(path=_S, breed=_S, split=_S, role=_S, is_grayscale=_B, cluster_key=_S)
LEAKAGE = _of(cluster_key=_S, breed=_S, old_split=_S, new_split=_S, old_path=_S, new_path=_S, moved=_B)
CLIENTS = _of(client_id=_I, breed=_S, count=_L)

#: Fixed values.
STATUSES = ("ok", "corrupt", "wrong_format", "too_small", "unreadable")
REJECTED = ("too_small", "corrupt", "unreadable")
SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp")
SPLIT_SHARES = (("train", 0.8), ("val", 0.1), ("test", 0.1))
