"""Vectors in packed blocks, and how blocks of those that ask meet groups of those that are there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, prefix_sums, stored

#: Bytes of packed vectors that one task holds while others pass by, at most.
GROUP_BYTES = 1 << 25
_PACKED = "block long, ids binary, labels binary, places binary, vectors binary, kind string, width int, rows int, held array<long>"


def placed(rows: DataFrame, name: str) -> DataFrame:
    """rows (vec_id, label, v) with place: their number from 0 in order of label and id, so that a label's rows are neighbours."""
    made = rows.withColumns({"one": F.lit(1), "hash": F.xxhash64("v")})
    return prefix_sums(made, [], ["label", "vec_id", "hash"], "one", "place", name).drop("one", "hash")


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """rows (place, vec_id, label, v) in blocks of `size` by place, a row for each, stored: vectors in order of their ids, in the
    narrowest kind of number that holds them; held: the labels of a block."""

    def run(batches):
        for batch in batches:
            for block, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, labels, places, v = (held.values.field(n) for n in ("vec_id", "label", "place", "v"))
                lengths = np.diff(v.offsets.to_numpy())
                m = np.zeros((len(lengths), max(1, int(lengths.max(initial=1)))), np.int64)
                m[np.arange(m.shape[1])[None, :] < lengths[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                kind = next(k for k in ("<i2", "<i4", "<i8") if m.min() >= np.iinfo(k).min and m.max() <= np.iinfo(k).max)
                labels = labels.to_numpy()
                row = (block, ids.to_numpy().tobytes(), labels.tobytes(), places.to_numpy().tobytes(), m.astype(kind).tobytes(), kind, m.shape[1], len(lengths), np.unique(labels).tolist())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), *[pa.binary()] * 4, pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())), strict=True)], [c.split()[0] for c in _PACKED.split(", ")])

    held = rows.groupBy(F.floor(F.col("place") / size).cast("long").alias("block")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "place", "label", "v"))).alias("held"))
    with batches_of(rows.sparkSession, 4):
        return stored(held.mapInArrow(run, _PACKED), name)


def unpacked(row: dict, width: int) -> np.ndarray:
    """A block's vectors as int64, zeros where they are shorter than width."""
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["rows"], -1)
    out = np.zeros((row["rows"], width), np.int64)
    out[:, : vectors.shape[1]] = vectors
    return out


def blocks_of_a_group(blocks: DataFrame) -> tuple[int, int, int]:
    """(blocks, the widest vector, blocks that a task holds): by bytes, and fewer where there would be fewer tasks than cores."""
    spark = blocks.sparkSession
    n, width, most = blocks.agg(F.count(F.lit(1)), F.max("width"), F.max(F.length("vectors"))).first()
    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return n, width or 1, max(1, min(GROUP_BYTES // most, n // tasks)) if n else 1


def meetings(held: DataFrame, asking: DataFrame, schema: str, build: Callable[[dict], object], meet: Callable[[dict, list], Iterator[pa.RecordBatch]], per_group: int) -> DataFrame:
    """meet(row, blocks) for each row of `asking` (a packed block, group, extra) with the blocks of the group it goes to. A task
    gets a group's blocks first and builds each once, then those that ask pass by: what is held moves once."""
    group = F.floor(F.col("block") / per_group)
    blocks = held.select(group.alias("group"), F.lit(0).alias("asks"), F.struct(*held.columns).alias("r"), F.lit(None).cast(dict(asking.dtypes)["extra"]).alias("extra"))
    visits = asking.select("group", F.lit(1).alias("asks"), F.struct(*held.columns).alias("r"), "extra")

    def run(batches):
        at, there = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != at:
                    at, there = row["group"], []
                if row["asks"]:
                    yield from meet(row, there)
                else:
                    there.append(build(row["r"]))

    return blocks.unionByName(visits).repartition("group").sortWithinPartitions("group", "asks").mapInArrow(run, schema)
