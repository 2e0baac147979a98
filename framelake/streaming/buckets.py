"""Many short sequences in one state key: the cost of a key is paid once for a bucket of them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows after which a processor lets its output go.
CHUNK = 10_000


def in_buckets(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add `_bucket`, to group by, and `_null`, whose bits say which keys are null; null integers become 0, so that pandas keeps the others exact."""
    null = sum((F.col(k).isNull().cast("int") * (1 << i) for i, k in enumerate(keys)), F.lit(0))
    whole = {k: F.coalesce(k, F.lit(0).cast(rows.schema[k].dataType)) for k in keys if isinstance(rows.schema[k].dataType, T.IntegralType)}
    return rows.withColumns({"_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"), "_null": null, **whole})


def key_schema(rows: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(k, rows.schema[k].dataType) for k in keys])


def keys_of(part: pd.DataFrame, keys: Sequence[str]) -> list[tuple]:
    """The keys of each row of a part of a bucket, with None for null."""
    found = list(zip(*(part[k].tolist() for k in keys)))
    null = part["_null"].tolist()
    if not any(null):
        return found
    return [tuple(None if bits >> i & 1 else v for i, v in enumerate(key)) for key, bits in zip(found, null)]


def exact(rows: pd.DataFrame, key: T.StructType, out: Sequence[tuple]) -> pd.DataFrame:
    """`rows` made of `out`, which begins with the keys: beside nulls, large integers would become floats."""
    for i, f in enumerate(key):
        if isinstance(f.dataType, T.IntegralType):
            rows[f.name] = pd.array([r[i] for r in out], dtype="Int64")
    return rows
