"""Exact duplicates by progressive refinement: length, then prefix hash, then the hash of the full content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import Filter, drop_cells, join_hot, stored, text_mark, text_of

#: Characters of the prefix that the second step hashes.
PREFIX_CHARS = 64


def normalised(text):
    """Runs of white space as one space. Only runs that change are matched, so single spaces cost nothing."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _full_hashes(docs: DataFrame, id_col: str, text_col: str, digests: bool) -> tuple[DataFrame, int]:
    """doc_id, text_sha256, suspect for each row, stored, and the number of rows. Without digests only suspects have a hash."""
    text = normalised(text_of(docs, text_col))
    measured = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select("doc_id", "text", F.length("text").alias("len"), F.xxhash64(F.substring("text", 1, PREFIX_CHARS)).alias("prefix"))
    sha = F.sha2("text", 256).alias("text_sha256")
    slim = stored(measured.select("doc_id", "len", "prefix", *[sha] * digests), "lengths")
    pairs = slim.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = pairs.groupBy("len").agg(F.sum("n").alias("all")).filter("all > 1").select("len")
    suspects = stored(pairs.join(lengths, "len", "left_semi").filter("n > 1"), "suspects")
    total = slim.count()
    if digests:
        many = join_hot(slim, suspects, ["len", "prefix"], "n", total).select("doc_id", "text_sha256", F.lit(True).alias("suspect"))
        alone = slim.join(suspects, ["len", "prefix"], "left_anti").select("doc_id", "text_sha256", F.lit(False).alias("suspect"))
        return many.unionByName(alone), total
    some, alone = survivors(measured, slim, suspects)
    many = some.select("doc_id", sha, F.lit(True).alias("suspect"))
    return many.unionByName(alone.select("doc_id", F.lit(None).cast("string").alias("text_sha256"), F.lit(False).alias("suspect"))), total


def survivors(measured: DataFrame, slim: DataFrame, suspects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of measured (with texts) whose length and prefix hash are among the suspects, and those of slim whose aren't. Of
    more suspects than can be broadcast a filter is: it lets some rows more through, in both tables alike, whose full hash
    then tells them apart, and no text moves."""
    keys, count = ["len", "prefix"], suspects.count()
    if count <= common.BROADCAST_ROWS:
        few = F.broadcast(suspects.select(keys))
        return measured.join(few, keys, "left_semi"), slim.join(few, keys, "left_anti")
    seen = Filter(suspects, F.xxhash64(*keys), count)
    return seen.maybe(measured, F.xxhash64(*keys)), seen.never(slim, F.xxhash64(*keys))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = True) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; a null text counts as empty. The row with the smallest id of its
    group stays; null ids come last, and a group of null ids alone has keep_id null. Rows that repeat both id and text
    count in group_size, and one of them is kept. Other columns, whatever their names, aren't read. An empty table
    gives an empty result.

    Refinement over fewer rows each time: lengths that occur twice; among those, (length, prefix hash) that occur twice;
    only rows that survive both meet their group by the full hash, which others have for themselves alone. One scan of
    the texts gives lengths and prefix hashes, and with digests, which every row shows, the full hashes too; without,
    text_sha256 is null for texts that are unique by length or prefix, and a second scan hashes the survivors. Group
    sizes and keepers are pre-aggregated; joins carry ids and hashes, never texts, and rows of a hot group don't move.
    """
    full, total = _full_hashes(docs, id_col, text_col, digests)
    # copies of one (id, text) become one row with a count, and are dealt out again at the end
    ids = stored(full.groupBy("text_sha256", "doc_id", "suspect").agg(F.count(F.lit(1)).alias("copies")), "hashed-ids")
    shared = ids.filter("suspect")
    groups = stored(shared.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256", "copies"]
    alone = ids.filter("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size"), "text_sha256", "copies")
    met = join_hot(shared, groups, ["text_sha256"], "group_size", total).select(columns).unionByName(alone)
    dealt = met.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return dealt.select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that duplicate_groups() doesn't keep, all columns as they were.

    Of rows that repeat id and text but differ elsewhere, any one stays; of rows of one id whose texts differ in white space
    alone, one. The refinement is the same, and texts that are unique by length or prefix hash are never hashed whole. Of
    equal texts a row for each id and spelling meets the group's keeper, hot groups without a shuffle; then rows go by id and
    spelling (drop_cells), texts staying where they lie."""
    raw = text_of(docs, text_col)
    text = normalised(raw)
    measured = docs.select(F.col(id_col).alias("doc_id"), text_mark(docs, text_col).alias("mark"), text.alias("text"))
    measured = measured.select("doc_id", "mark", "text", F.length("text").alias("len"), F.xxhash64(F.substring("text", 1, PREFIX_CHARS)).alias("prefix"))
    pairs = measured.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n"))
    suspects = stored(pairs.filter("n > 1"), "suspects")
    some, _ = survivors(measured, measured, suspects)
    hashed = some.select("doc_id", "mark", F.sha2("text", 256).alias("text_sha256"))
    cells = stored(hashed.groupBy("text_sha256", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n")), "cells")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    groups = stored(cells.groupBy("text_sha256").agg(first, F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows")).filter("rows > 1").drop("rows"), "groups")
    met = join_hot(cells, groups, ["text_sha256"], "cells", cells.count())
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return drop_cells(docs, met.select("doc_id", "mark", "n", kept.alias("kept")), id_col, text_col)
