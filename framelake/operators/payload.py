"""Frame payloads: text-encoded arrays, their profile and their store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions import keys

# Red, green and blue parts of a grey value, in thousandths.
GREY = (299, 587, 114)


def encode_tensor(data: Column, dtype: str, shape: Column, prefix: str = "original") -> list[Column]:
    """Bytes as the three message fields: base64 text, dtype and shape."""
    return [F.base64(data).alias(f"{prefix}_frame"), F.lit(dtype).alias(f"{prefix}_dtype"),
            shape.cast("array<int>").alias(f"{prefix}_shape")]


def decode_tensor(df: DataFrame, prefix: str = "original") -> DataFrame:
    """Add `data` (bytes) and `intact`: their number is the item size times the shape's product."""
    size = F.regexp_extract(F.col(f"{prefix}_dtype"), "([0-9]+)$", 1).try_cast("long")
    items = F.aggregate(F.col(f"{prefix}_shape"), F.lit(1).cast("long"), lambda a, x: a * x)
    data = F.expr(f"try_to_binary({prefix}_frame, 'base64')")
    return df.withColumn("data", data).withColumn(
        "intact", F.coalesce(F.octet_length("data") == size * items, F.lit(False)))


def _profiles(images: np.ndarray) -> tuple[np.ndarray, ...]:
    """Grey mean, grey sums of the top and bottom ten rows, and degrees to turn of images of one size."""
    turn = 90 if images.shape[1] > images.shape[2] else 0
    if turn:
        images = np.rot90(images, axes=(1, 2))
    # the channels arrive swapped, so the first one is weighted as red
    grey = (images.astype(np.int64) @ np.array(GREY) + 500) // 1000
    top, bottom = grey[:, :10].sum(axis=(1, 2)), grey[:, -10:].sum(axis=(1, 2))
    return grey.mean(axis=(1, 2)), top.astype(float), bottom.astype(float), turn + np.where(top > bottom, 0, 180)


def frame_profile(df: DataFrame, *keep: str, prefix: str = "original") -> DataFrame:
    """Brightness and turning of each intact decoded frame, frames of one size together; the images themselves are not rewritten."""
    wanted = df.filter("intact").select(*keep, "data", F.col(f"{prefix}_dtype").alias("_dtype"), F.col(f"{prefix}_shape").alias("_shape"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name in keep)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cols = pd.DataFrame({"grey_mean": 0.0, "top_sum": 0.0, "bottom_sum": 0.0, "turn": 0}, index=part.index)
            sizes: dict[tuple, list[int]] = {}
            for i, (kind, shape) in enumerate(zip(part["_dtype"], part["_shape"])):
                sizes.setdefault((kind, tuple(shape)), []).append(i)
            data = part["data"].tolist()
            for (kind, shape), at in sizes.items():
                images = np.frombuffer(b"".join(data[i] for i in at), np.dtype(kind)).reshape(len(at), *shape).astype(np.uint8)
                for name, values in zip(cols.columns, _profiles(images)):
                    cols.iloc[at, cols.columns.get_loc(name)] = values
            yield pd.concat([part[list(keep)], cols], axis=1)

    return wanted.mapInPandas(run, f"{kept}, grey_mean double, top_sum double, bottom_sum double, turn int")


def payload_rows(df: DataFrame, store_prefix: str) -> DataFrame:
    """Rows of the payload store: key, day, camera, bytes and their layout."""
    ms, cam = F.col("timestamp"), F.col("camera")
    return decode_tensor(df).select(
        keys.store_key(store_prefix, ms, cam).alias("s3_key"), keys.store_date(ms).alias("store_date"), "camera",
        "data", "original_dtype", "original_shape", "intact")


def url_rows(df: DataFrame, store_prefix: str) -> DataFrame:
    """Messages that name the stored payload instead of carrying it."""
    ms, cam = F.col("timestamp"), F.col("camera")
    return df.select(keys.store_key(store_prefix, ms, cam).alias("s3_key"), "camera", "timestamp", "frame_num", "location")


def store_payload(df: DataFrame, path: str, store_prefix: str, mode: str = "append") -> DataFrame:
    """Write payloads by day and return the messages without them."""
    payload_rows(df, store_prefix).write.mode(mode).partitionBy("store_date").parquet(path)
    return url_rows(df, store_prefix)
