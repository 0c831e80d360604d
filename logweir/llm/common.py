"""What several corpus operators share: scratch tables, prefix sums, row keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than a share of one in so many of all rows is hot; there can't be more hot keys than that.
HOT_KEYS = 10_000
#: Rows that are broadcast whole, at most; beyond that a filter of at most FILTER_BITS bits is (8 MB).
BROADCAST_ROWS, FILTER_BITS = 200_000, 1 << 26


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session (spark.checkpoint.dir). Only where none is set and the session is local, as in
    tests, a local one is made."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = getattr(spark, "_corpus_scratch", None)
        if not root and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        if not root:
            root = f"file://{tempfile.mkdtemp(prefix='spark-corpus-')}"
            spark._corpus_scratch = root
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand Python at most so many rows at a time, so that long texts need little memory there."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def forget(df: DataFrame) -> None:
    """Deletes what stored() wrote for df, if it did."""
    path = getattr(df, "_stored_at", None)
    if path:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """name, or with underscores in front until no column of df has it (names compare without case, as Spark's do)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(df: DataFrame, column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(df[column], F.lit(""))


def held_out(df: DataFrame, column: str = "doc_id"):
    """True for the quarter of rows that no model may learn from. A null id counts as the text ''."""
    return (F.crc32(F.coalesce(df[column].cast("string"), F.lit(""))) % 4) == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """docs joined to at most `rows` labels: those of the smallest hash of their id. Ids and labels alone are sorted, and what is
    broadcast is bounded by `rows`, so texts don't move. Labels with a null id are left out; a repeated label counts once."""
    rest = [c for c in labels.columns if c != id_col]
    key = free_name(docs, "label_id")
    few = labels.filter(F.col(id_col).isNotNull()).dropDuplicates().orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col, *rest).limit(rows)
    few = few.select(F.col(id_col).alias(key), *rest)
    return docs.drop(*rest).join(F.broadcast(few), F.col(id_col) == F.col(key)).drop(key)


def bounded(df: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """df, or about `rows` of it by a hash of the id where it has more."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < int((1 << 20) * rows / n))


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows (stored ones, `total` in all, each with its key in table) joined to table (stored too), which has a row for each
    key with the number of its rows as `size`. Hot keys are few by their size, so they are broadcast and their rows stay where
    they are; no other key fills a task."""
    hot = F.col(size) > total / HOT_KEYS
    large = F.broadcast(table.filter(hot))
    return rows.join(large, keys).unionByName(rows.join(large, keys, "left_anti").join(table.filter(~hot), keys))


class Filter:
    """A Bloom filter over 64-bit hashes, as one broadcast row of words. Its size is bounded; beyond what it can hold apart it
    lets more rows through, never fewer."""

    def __init__(self, keys: DataFrame, hashed, count: int):
        self.bits = 64
        while self.bits < min(16 * count, FILTER_BITS):
            self.bits *= 2
        slots = keys.select(F.explode(F.array(*self._slots(hashed))).alias("slot"))
        words = slots.groupBy(F.floor(F.col("slot") / 64).alias("id")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("word"))
        all_words = keys.sparkSession.range(self.bits // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
        line = F.transform(F.sort_array(F.collect_list(F.struct("id", "word"))), lambda w: w["word"])
        self.row = F.broadcast(stored(all_words.agg(line.alias("filter_words")), "filter"))

    def _slots(self, hashed):
        return F.pmod(hashed, F.lit(self.bits)), F.pmod(F.shiftright(hashed, 32), F.lit(self.bits))

    def _hit(self, hashed):
        one, two = (F.getbit(F.get(F.col("filter_words"), F.floor(slot / 64).cast("int")), (slot % 64).cast("int")) == 1 for slot in self._slots(hashed))
        return one & two

    def maybe(self, rows: DataFrame, hashed) -> DataFrame:
        """Rows that may be among the keys; rows without a hash aren't."""
        return rows.join(self.row, self._hit(hashed), "left_semi")

    def never(self, rows: DataFrame, hashed) -> DataFrame:
        """The other rows."""
        return rows.join(self.row, self._hit(hashed), "left_anti")


def text_mark(df: DataFrame, text_col: str = "text"):
    """A hash of the text as it stands (null as empty): with the id it names rows that are alike."""
    return F.xxhash64(text_of(df, text_col))


def drop_cells(docs: DataFrame, cells: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all rows but one of each group. cells: doc_id, mark (text_mark), n rows of both, kept (one cell of a group,
    with one of its rows). Cells that stay whole needn't be there. Null ids are ids.

    Few cells are broadcast. Of more, a filter is, so that only rows which it lets through are shuffled; the others stay
    where they lie."""
    doc, mark, again = (free_name(docs, n) for n in ("gone_doc", "gone_mark", "gone_again"))
    gone = stored(cells.filter("not kept or n > 1").select(F.col("doc_id").alias(doc), F.col("mark").alias(mark), F.col("kept").alias(again)), "gone")
    count = gone.count()
    own = text_mark(docs, text_col)
    on = docs[id_col].eqNullSafe(F.col(doc)) & (own == F.col(mark))
    if count <= BROADCAST_ROWS:
        out, held, dealt = docs.join(F.broadcast(gone), on, "left_anti"), docs, F.broadcast
    else:
        seen, of_row = Filter(gone, F.xxhash64(doc, mark), count), F.xxhash64(docs[id_col], own)
        held, dealt = seen.maybe(docs, of_row), lambda t: t
        out = seen.never(docs, of_row).unionByName(held.join(gone, on, "left_anti"))
    back = gone.filter(again).drop(again)
    if back.limit(1).count():  # of rows alike one comes back
        key = free_name(docs, "text_mark")
        twice = held.join(dealt(back), on, "left_semi").withColumn(key, own)
        out = out.unionByName(twice.dropDuplicates([id_col, key]).drop(key))
    return out


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, name: str) -> DataFrame:
    """Adds column out: the sum of value over the rows of the same keys that stand before in the given order.

    The order must be total within keys. Rows are dealt by range over (keys, order), so a hot key is cut into many
    ranges; each range sums its own rows, and one small table with a row for each range and key carries the offsets.
    The ranges are stored before they are numbered, for a range partitioner samples anew in each job.
    """
    pid, before, total = (free_name(df, n) for n in ("pid", "before", "total"))
    cols = [F.col(c).asc_nulls_first() for c in keys + order]
    ranged = stored(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn(pid, F.spark_partition_id()), name)
    quoted = lambda names: ", ".join(f"`{c}`" for c in names)
    by = ", ".join(f"`{c}` asc nulls first" for c in order)
    upto = "rows between unbounded preceding and 1 preceding"
    running = ranged.withColumn(out, F.expr(f"coalesce(sum(`{value}`) over (partition by {quoted([pid, *keys])} order by {by} {upto}), 0)"))
    totals = ranged.groupBy(pid, *keys).agg(F.sum(value).alias(total))
    over = f"partition by {quoted(keys)} " if keys else ""
    offsets = totals.withColumn(before, F.expr(f"coalesce(sum(`{total}`) over ({over}order by `{pid}` {upto}), 0)"))
    r, o = running.alias("r"), offsets.alias("o")
    on = F.col(f"r.{pid}") == F.col(f"o.{pid}")
    for c in keys:
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    return r.join(o, on).select(*[F.col(f"r.{c}") for c in df.columns], (F.col(f"r.{out}") + F.col(f"o.{before}")).alias(out))
