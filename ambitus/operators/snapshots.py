"""What changed between consecutive full deliveries of a keyed table."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Keys of one list that are compared in one task, about; a task holds twice as many rows at most.
KEYS_PER_BUCKET = 200_000


def diff_snapshots(
    rows: DataFrame,
    group: str,
    version: str,
    key: str,
    values: Iterable[str] = (),
    sets: Iterable[str] = (),
    numbers: Iterable[str] = (),
    tolerance: float = 1e-7,
    expected: DataFrame | None = None,
    expected_count: str = "expected",
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """(group, version, key, change_kind): keys added, removed or changed in each complete delivery since the last complete one.

    values are compared as they are (null equals null), sets as sets (null is the empty set, nulls inside are left out), numbers
    by ``tolerance`` or more (null differs from any number).  expected: (group, version, expected_count); a delivery with fewer
    distinct keys counts as not delivered; one without a count there, or with a null one, is complete.  The first complete
    delivery of a group gives no rows.  Rows with a null group, version or key are left out; a key repeated within a delivery
    counts once (the row of the smallest hash stands for it).  Other columns are ignored.

    Only (key hash, row hash, numbers) are shuffled, by group and a bucket of the key, so that a group of any size is spread;
    a task sorts its compact arrays in numpy and takes set differences by searchsorted.  Keys are read again only for the
    differing hashes.  Two keys of one delivery with the same 64-bit hash in the same bucket would count as one.
    """
    values, sets, numbers = list(values), list(sets), list(numbers)
    src = rows.where(F.col(group).isNotNull() & F.col(version).isNotNull() & F.col(key).isNotNull())
    parts = []
    for c in values:
        parts += [F.col(c).isNull(), F.col(c)]
    for c in sets:
        parts.append(F.to_json(F.array_sort(F.array_distinct(F.array_compact(F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)))))))
    slim = src.select(
        F.col(group).alias("_g"),
        F.col(version).cast("long").alias("_v"),
        F.xxhash64(F.col(key)).alias("_k"),
        F.hash(F.col(key)).alias("_b"),
        (F.xxhash64(*parts) if parts else F.lit(0).cast("long")).alias("_h"),
        *[F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(numbers)],
    )
    counts = slim.groupBy("_g", "_v").agg(F.count_distinct("_k", "_b").alias("_keys"))
    if expected is not None:
        told = expected.groupBy(F.col(group).alias("_g"), F.col(version).cast("long").alias("_v")).agg(F.max(F.col(expected_count).cast("long")).alias("_told"))
        counts = counts.join(told, ["_g", "_v"], "left").where(F.col("_keys") >= F.coalesce("_told", F.lit(0)))
    found = _spread(slim, counts, keys_per_bucket)
    compare = _compare(len(numbers), tolerance)
    g_type = slim.schema["_g"].dataType.simpleString()
    found = found.groupBy("_g", "_c", "_b").applyInPandas(compare, f"_g {g_type}, _at long, _v long, _k long, change_kind string")
    keys = src.select(F.col(group).alias("_g"), F.col(version).cast("long").alias("_at"), F.xxhash64(F.col(key)).alias("_k"), F.col(key).alias("_key"))
    out = found.join(keys, ["_g", "_at", "_k"])
    return out.select(F.col("_g").alias(group), F.col("_v").alias(version), F.col("_key").alias(key), "change_kind").distinct()


def _spread(slim: DataFrame, counts: DataFrame, keys_per_bucket: int) -> DataFrame:
    """Rows with the run of deliveries (_c) and the bucket of the key (_b) in which they are compared, and the deliveries before
    and after them within that run.

    A run is as many neighbouring deliveries as hold keys_per_bucket keys together, two at least; the delivery between two runs is
    in both.  Deliveries with more keys are cut by the hash of the key.  So a task holds a bounded number of rows, whatever the
    size of a delivery and however many there are."""
    order = Window.partitionBy("_g").orderBy("_v")
    most = F.max("_keys").over(Window.partitionBy("_g"))
    deliveries = counts.select(
        "_g",
        "_v",
        (F.row_number().over(order) - 1).alias("_i"),
        F.lag("_v").over(order).alias("_before"),
        F.lead("_v").over(order).alias("_after"),
        F.greatest(F.ceil(most / F.lit(keys_per_bucket)), F.lit(1)).cast("int").alias("_n"),
        F.greatest(F.floor(F.lit(keys_per_bucket) / F.greatest(most, F.lit(1))), F.lit(1)).cast("int").alias("_run"),
    ).where(F.col("_before").isNotNull() | F.col("_after").isNotNull())
    # with the next delivery in one run, with the one before in the same or in the run before
    as_old, as_new = F.floor(F.col("_i") / F.col("_run")), F.floor((F.col("_i") - 1) / F.col("_run"))
    runs = F.array_compact(F.array_distinct(F.array(F.when(F.col("_after").isNotNull(), as_old), F.when(F.col("_before").isNotNull(), as_new))))
    placed = deliveries.withColumn("_c", F.explode(runs)).select(
        "_g", "_v", "_n", F.col("_c").cast("int").alias("_c"), F.when(as_new == F.col("_c"), F.col("_before")).alias("_prev"), F.when(as_old == F.col("_c"), F.col("_after")).alias("_next")
    )
    return slim.join(placed, ["_g", "_v"]).withColumn("_b", F.pmod(F.col("_b"), F.col("_n"))).drop("_n")


def _compare(numbers: int, tolerance: float):
    columns = [f"_n{i}" for i in range(numbers)]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = pdf["_g"].iloc[0]
        version = pdf["_v"].to_numpy()
        k, h = pdf["_k"].to_numpy(), pdf["_h"].to_numpy()
        values = pdf[columns].to_numpy(dtype=float) if columns else np.empty((len(pdf), 0))
        order = np.lexsort([*(values[:, i] for i in range(values.shape[1])), h, k, version])
        version, k, h, values = version[order], k[order], h[order], values[order]
        first = np.r_[True, (version[1:] != version[:-1]) | (k[1:] != k[:-1])]
        prev = pdf["_prev"].to_numpy(dtype=float, na_value=np.nan)[order][first]
        following = pdf["_next"].to_numpy(dtype=float, na_value=np.nan)[order][first]
        version, k, h, values = version[first], k[first], h[first], values[first]
        starts = np.flatnonzero(np.r_[True, version[1:] != version[:-1]])
        ends = np.r_[starts[1:], len(version)]
        at = {int(version[s]): (s, e) for s, e in zip(starts, ends)}
        out: list[tuple[int, int, np.ndarray, str]] = []
        for v, (s, e) in at.items():
            if not np.isnan(prev[s]):
                a, b = at.get(int(prev[s]), (0, 0))
                hit = np.searchsorted(k[a:b], k[s:e])
                safe = np.minimum(hit, max(b - a - 1, 0)) + a
                both = (hit < b - a) & (k[safe] == k[s:e])
                out.append((v, v, k[s:e][~both], "added"))
                mine, theirs = np.arange(s, e)[both], safe[both]
                gone = np.isnan(values[mine]) != np.isnan(values[theirs])
                moved = np.round(np.abs(values[mine] - values[theirs]), 12) >= tolerance
                differs = (h[mine] != h[theirs]) | (gone | moved).any(axis=1)
                out.append((v, v, k[mine][differs], "changed"))
            if not np.isnan(following[s]):
                a, b = at.get(int(following[s]), (0, 0))
                hit = np.searchsorted(k[a:b], k[s:e])
                safe = np.minimum(hit, max(b - a - 1, 0)) + a
                both = (hit < b - a) & (k[safe] == k[s:e])
                out.append((v, int(following[s]), k[s:e][~both], "removed"))
        out = [x for x in out if len(x[2])]
        n = [len(x[2]) for x in out]
        return pd.DataFrame({
            "_g": pd.Series([group] * sum(n), dtype=object),
            "_at": np.repeat(np.array([x[0] for x in out], np.int64), n),
            "_v": np.repeat(np.array([x[1] for x in out], np.int64), n),
            "_k": np.concatenate([np.empty(0, np.int64), *(x[2] for x in out)]),
            "change_kind": pd.Series([x[3] for x, m in zip(out, n) for _ in range(m)], dtype=object),
        })

    return run
