"""Running statistics that several feature layouts share, as window expressions that Spark sorts and spills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Gaps of an hour and more aren't gaps within one activity.
LONGEST_GAP_US = 3_600_000_000
#: Stored bytes of input for a range at most, if what a table is made from has a known size: a few hundred thousand rows, which
#: a task sorts in several orders at once.
RANGE_BYTES = 2 << 20


def valid_gap(us: Column, before: Column) -> Column:
    """Microseconds since the row before, null unless 0 < gap < one hour and the row before has a time."""
    gap = us - before
    return F.when((before > 0) & (gap > 0) & (gap < LONGEST_GAP_US), gap)


def last_gaps(df: DataFrame, keys: list[str], order: list[str], gaps: int, name: str) -> DataFrame:
    """Adds name_gap, name_mean and name_std: the row's valid gap in seconds, and mean and population deviation of the last
    `gaps` valid ones up to it. A running number of valid gaps makes a RANGE frame that holds exactly those."""
    over = Window.partitionBy(*keys).orderBy(*order)
    gap = valid_gap(F.col("us"), F.lag("us").over(over))
    held = df.withColumn("__gap", gap).withColumn("__nth", F.sum(F.when(F.col("__gap").isNotNull(), 1).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    frame = Window.partitionBy(*keys).orderBy("__nth").rangeBetween(-(gaps - 1), 0)
    return (
        held.withColumn(f"{name}_mean", F.coalesce(F.avg("__gap").over(frame), F.lit(0.0)) / 1e6)
        .withColumn(f"{name}_std", F.coalesce(F.stddev_pop("__gap").over(frame), F.lit(0.0)) / 1e6)
        .withColumn(f"{name}_gap", F.col("__gap") / 1e6)
        .drop("__gap", "__nth")
    )


def running_count(keys: list[str], order: list[str], most: int | None = None) -> Column:
    """Rows of the keys so far, this one included, at most `most`."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return n if most is None else F.least(n, F.lit(most))


def _first(names: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in names]


def _same(a: str, b: str, names: list[str]) -> Column:
    on = F.col(f"{a}.__pid") == F.col(f"{b}.__pid")
    for k in names:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def input_bytes(df: DataFrame) -> int:
    """Stored bytes of the files and local rows that df is made from, as the optimizer knows them; without those of unknown
    size, such as a stream's micro-batch. A sum over leaves, for estimates above a join are products."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 62)  # an unknown size counts as the greatest long


def by_range(df: DataFrame, columns: list[Column]) -> DataFrame:
    """df dealt by range of the columns. Input that fits one range of RANGE_BYTES is dealt as shuffles are, and their partitions
    may be merged at run time. More has a number that stands: of ranges of at most RANGE_BYTES, and no fewer than keep the
    cores busy. Merged at run time, ranges would grow with the table, for compressed bytes say little of rows."""
    wanted = -(-input_bytes(df) // RANGE_BYTES)
    if wanted <= 1:
        return df.repartitionByRange(*columns)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(max(wanted, min(usual, 2 * df.sparkSession.sparkContext.defaultParallelism)), *columns)


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with __pid, its range of (keys, order), stored: a range partitioner samples anew in each job."""
    return stored(by_range(df, _first(keys + order)).withColumn("__pid", F.spark_partition_id()), "ranges")


def _ranges(base: DataFrame) -> int:
    """How many ranges there are in what ranged() gave."""
    return (base.agg(F.max("__pid")).first()[0] or 0) + 1


def _apart(rows: DataFrame, ranges: int) -> DataFrame:
    """rows with each range in a task of its own. By the hash of __pid some tasks would get several ranges, in large tables
    half a dozen, and a third of the tasks none."""
    return rows.repartitionById(ranges, F.col("__pid"))


def sums_before(df: DataFrame, keys: list[str], order: list[str], values: list[str], name: str = "before") -> DataFrame:
    """Adds {name}_{value} for each value: its sum over the rows of the same keys that stand before, where a key may hold most
    of all rows.

    Rows are dealt by range over (keys, order); a range sums its own. Only the first key of a range can have been in an
    earlier one, so the offsets are a row for each range at most, and are broadcast. A window over the key alone would put a
    hot key in one task. The order must be total within keys."""
    r = ranged(df, keys, order)
    own = Window.partitionBy("__pid", *keys).orderBy(*_first(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = _apart(r, _ranges(r)).withColumns({f"{name}_{v}": F.coalesce(F.sum(v).over(own), F.lit(0)) for v in values})
    span = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = r.groupBy("__pid", *keys).agg(*[F.sum(v).alias(f"__{v}") for v in values])
    offsets = offsets.select("__pid", *keys, *[F.sum(f"__{v}").over(span).alias(f"__{v}") for v in values])
    offsets = offsets.filter(F.coalesce(*[F.col(f"__{v}") for v in values]).isNotNull())  # null where nothing stands before
    met = local.alias("a").join(F.broadcast(offsets).alias("b"), _same("a", "b", keys), "left")
    return met.select(*[F.col(f"a.{c}") for c in df.columns], *[(F.col(f"a.{name}_{v}") + F.coalesce(F.col(f"b.__{v}"), F.lit(0))).alias(f"{name}_{v}") for v in values])


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Adds out: the row's number (from 1) within its keys, where a key may hold most of all rows (see sums_before)."""
    held = sums_before(df.withColumn("__one", F.lit(1)), keys, order, ["__one"], "__before")
    return held.withColumn(out, F.col("__before___one") + 1).drop("__one", "__before___one")


def _going_on(rows: DataFrame, key: str) -> DataFrame:
    """__pid, key where a range goes on with a key of an earlier one. That is the first key of a range, so there are no more
    such rows than ranges, and they can be broadcast."""
    pairs = rows.select("__pid", key).distinct()
    return pairs.withColumn("__nth", F.row_number().over(Window.partitionBy(key).orderBy("__pid"))).filter("__nth > 1").drop("__nth")


def hot_counts(rows: DataFrame, counters: dict[str, list[str]], order: list[str], most: int) -> DataFrame:
    """Adds for each counter the number of rows of its keys so far, this one included, at most `most`. rows: what ranged()
    gives over the first of each counter's keys. Counters of the same keys are counted once. The result lies in tasks by __pid.

    Ranges count their own rows. What earlier ranges counted of keys that a range has too comes into it as rows of that
    weight, ahead of its own, so that full rows are dealt once and never joined."""
    names = {}
    for name, keys in counters.items():
        names.setdefault(frozenset(keys), (name, list(dict.fromkeys(keys))))
    once, lead = dict(names.values()), next(iter(counters.values()))[0]
    columns = list(dict.fromkeys(k for keys in once.values() for k in keys))
    kinds = dict(rows.dtypes)
    hot = _going_on(rows, lead).select(F.col(lead).alias("__lead")).distinct()
    some = rows.join(F.broadcast(hot), F.col(lead).eqNullSafe(F.col("__lead")), "left_semi")
    each = [F.struct(F.lit(i).alias("__i"), *[(F.col(k) if k in keys else F.lit(None).cast(kinds[k])).alias(k) for k in columns]) for i, keys in enumerate(once.values())]
    counted = some.select("__pid", F.explode(F.array(*each)).alias("e")).select("__pid", "e.*").groupBy("__pid", "__i", *columns).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__i", *columns).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))
    carried = counted.withColumn("__more", F.least(F.coalesce(before, F.lit(0)), F.lit(most))).filter("__more > 0")
    carried = carried.select("__pid", *columns, F.lit(False).alias("__own"), *[F.when(F.col("__i") == i, F.col("__more")).otherwise(0).alias(f"__w{i}") for i in range(len(once))])
    own = rows.withColumns({"__own": F.lit(True), **{f"__w{i}": F.lit(1).cast("long") for i in range(len(once))}})
    held = _apart(own.unionByName(carried, allowMissingColumns=True), _ranges(rows))  # carried rows have no order: they come first
    upto = {name: F.sum(f"__w{i}").over(Window.partitionBy("__pid", *keys).orderBy(*_first(order)).rowsBetween(Window.unboundedPreceding, 0)) for i, (name, keys) in enumerate(once.items())}
    held = held.withColumns({name: F.least(n, F.lit(most)) for name, n in upto.items()}).filter("__own").drop("__own", *[f"__w{i}" for i in range(len(once))])
    return held.withColumns({name: F.col(names[frozenset(keys)][0]) for name, keys in counters.items() if name not in once})


def _gaps_carried(rows: DataFrame, key: str, order: list[str], gaps: int) -> DataFrame:
    """__pid, key, us, tails where a range goes on with a key: the time of the key's last row in an earlier range, and mean and
    population variance of the last 1, 2, ... (at most gaps - 1) valid gaps that earlier ranges hold, null where none do or
    the range itself has no valid gap. Stored: a row for each range at most.

    Only rows of keys that several ranges share are looked at, without their other columns. Each range gives the end of its
    gaps. Ranges without any are left out, so the gaps - 1 ranges before one have all the gaps that its first rows need."""
    slim = rows.select("__pid", key, *dict.fromkeys(["us", *order]))
    hot = _going_on(rows, key).select(F.col(key).alias("__key")).distinct()
    some = slim.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    own, spans = Window.partitionBy("__pid", key), Window.partitionBy(key).orderBy("__pid")
    last = some.groupBy("__pid", key).agg(F.max_by("us", F.struct(*order)).alias("__us")).withColumn("__carried", F.lag("__us").over(spans)).filter("__carried is not null").drop("__us")
    gap = _gap_of(own.orderBy(*order))
    valid = _met(_apart(some, _ranges(rows)), last, key).withColumn("__gap", gap).filter("__gap is not null")
    ends = valid.withColumn("__back", F.row_number().over(own.orderBy(*[F.desc(o) for o in order]))).filter(F.col("__back") < gaps)
    ends = ends.groupBy("__pid", key).agg(F.transform(F.sort_array(F.collect_list(F.struct("__back", "__gap"))), lambda e: e["__gap"].cast("double")).alias("__ends"))
    # newest first: the ends of the range just before, then of the one before that
    before = F.flatten(F.reverse(F.collect_list("__ends").over(spans.rowsBetween(-(gaps - 1), -1))))
    newest = ends.withColumn("__newest", F.slice(before, 1, gaps - 1)).filter("size(__newest) > 0").drop("__ends")
    part = lambda k: F.slice("__newest", 1, k)
    mean = lambda k: F.aggregate(part(k), F.lit(0.0), lambda x, g: x + g) / k
    with_mean = F.transform(F.sequence(F.lit(1), F.size("__newest")), lambda k: F.struct(k.alias("n"), mean(k).alias("mean")))
    tails = F.transform(with_mean, lambda t: F.struct(t["mean"].alias("mean"), (F.aggregate(part(t["n"]), F.lit(0.0), lambda x, g: x + (g - t["mean"]) * (g - t["mean"])) / t["n"]).alias("var")))
    newest = newest.select("__pid", key, tails.alias("__tails"))
    met = last.alias("a").join(newest.alias("b"), _same("a", "b", [key]), "left")
    return stored(met.select("a.*", "b.__tails"), "gaps-carried")


def _met(rows: DataFrame, carried: DataFrame, key: str) -> DataFrame:
    """rows with what is carried into their range for their key."""
    return rows.alias("a").join(F.broadcast(carried.alias("b")), _same("a", "b", [key]), "left").select("a.*", *[F.col(f"b.{c}") for c in carried.columns if c not in ("__pid", key)])


def _gap_of(own) -> Column:
    """The valid gap before the row, where __carried is the time before a range's first row of the key."""
    return valid_gap(F.col("us"), F.when(F.row_number().over(own) == 1, F.col("__carried")).otherwise(F.lag("us").over(own)))


def hot_gaps(rows: DataFrame, key: str, order: list[str], gaps: int, name: str, dealt: DataFrame | None = None) -> DataFrame:
    """What last_gaps() adds, but mean and deviation only in rows whose gap is valid; a key may hold most of all rows. rows:
    what ranged() gives over the key. dealt: those rows with more columns, if they lie in tasks by __pid already, as
    hot_counts() leaves them; they aren't shuffled again.

    Ranges work on their own rows. Into a range that goes on with a key come the time before its first row and mean and
    variance of the gaps that earlier ranges end with (_gaps_carried), a row for each range at most, which is broadcast. The
    range's first valid gaps, whose frames reach back, add those to their own by count."""
    carried = _gaps_carried(rows, key, order, gaps)
    these = _apart(rows, _ranges(rows)) if dealt is None else dealt
    own = Window.partitionBy("__pid", key).orderBy(*order)
    met = _met(these, carried, key).withColumn("__gap", _gap_of(own))
    met = met.withColumn("__nth", F.sum(F.when(F.col("__gap").isNotNull(), 1).otherwise(0)).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    frame = Window.partitionBy("__pid", key).orderBy("__nth").rangeBetween(-(gaps - 1), 0)
    met = met.withColumns({"__own_mean": F.avg("__gap").over(frame), "__own_std": F.stddev_pop("__gap").over(frame)})
    n = F.col("__nth")
    k = F.least(gaps - n, F.size("__tails"))
    tail = F.get("__tails", (k - 1).cast("int"))
    apart = F.col("__own_mean") - tail["mean"]
    both = (F.col("__own_std") * F.col("__own_std") * n + tail["var"] * k + apart * apart * n * k / (n + k)) / (n + k)
    reaches = (n < gaps) & F.col("__tails").isNotNull()
    valid = F.col("__gap").isNotNull()
    mean = F.when(valid & reaches, (F.col("__own_mean") * n + tail["mean"] * k) / (n + k)).when(valid, F.col("__own_mean"))
    std = F.when(valid & reaches, F.sqrt(both)).when(valid, F.col("__own_std"))
    return met.select(*these.columns, (mean / 1e6).alias(f"{name}_mean"), (std / 1e6).alias(f"{name}_std"), (F.col("__gap") / 1e6).alias(f"{name}_gap"))


def exact_quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float]:
    """Values at shares of the ranks, linear between neighbours, null and NaN left out; no rows: an empty list. Values are
    counted first, their ranks come from sums over ranges, and two rows for each share come back."""
    x = F.col(column).cast("double")
    counted = df.select(x.alias("x")).filter("x is not null and not isnan(x)").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    ranks = stored(sums_before(counted, [], ["x"], ["n"]), "ranks")
    whole = ranks.agg(F.sum("n")).first()[0]
    if not whole:
        return []
    wanted = sorted({min(int((whole - 1) * s) + k, whole - 1) for s in shares for k in (0, 1)})
    at = F.filter(F.array(*[F.lit(w).cast("long") for w in wanted]), lambda w: (w >= F.col("before_n")) & (w < F.col("before_n") + F.col("n")))
    found = {r.w: r.x for r in ranks.select("x", F.explode(at).alias("w")).collect()}
    out = []
    for s in shares:
        place = (whole - 1) * s
        low, high = found[int(place)], found[min(int(place) + 1, whole - 1)]
        out.append(low + (high - low) * (place - int(place)))
    return out
