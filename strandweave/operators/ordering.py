"""Places in a global order, without ever bringing all rows to one task.

Rows are sorted in ranges, as Spark's own sort does, and written; the sizes of the ranges, one number each, give every
range the place of its first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import scratch_path

_IN_PART = (1 << 33) - 1


def _ranges(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with _part and _nth, and (_part, _before): how many rows the ranges before have. Both are read from
    what was written, so that they agree whatever is computed again."""
    path = scratch_path(rows.sparkSession, "ordered")
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    sorted_rows.withColumns({"_part": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND(F.lit(_IN_PART))}).drop("_at").write.parquet(path)
    placed = rows.sparkSession.read.parquet(path)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    return placed, sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))


def with_places(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with place (long, from 1) in ``order``, whose ties go either way."""
    placed, before = _ranges(rows, order)
    return placed.join(F.broadcast(before), "_part").withColumn("place", F.col("_before") + F.col("_nth") + 1).drop("_part", "_nth", "_before")


#: So many rows are sorted for a page; of more, the range that holds it is cut finer. Cuts of a pass, and keys sampled for them.
SORT_ROWS, CUTS, SAMPLE = 100_000, 64, 20_000


def page_of_rows(rows: DataFrame, order: list[Column], page: int, size: int = 50) -> DataFrame:
    """Rows of page ``page`` (clamped to those there are) in ascending ``order``, with place, page, pages and total.

    The table is neither sorted nor shuffled: keys are sampled for cuts, rows between them are counted where they lie, and
    only the range that holds the page is read again, in finer cuts until it is small enough to sort. Cuts decide how much is
    sorted, never which rows are the page. Rows of equal keys stand in any order; a page inside more than SORT_ROWS of them is
    found by ``with_places``.
    """
    total = rows.count()
    pages = max(1, -(-total // size))
    page = min(max(1, page), pages)
    skip = (page - 1) * size
    part, before, held = rows.withColumn("_key", F.struct(*(c.alias(f"k{n}") for n, c in enumerate(order)))), 0, total
    while held > SORT_ROWS:
        keys = part.select("_key").sample(min(1.0, 2 * SAMPLE / held), seed=7).limit(SAMPLE).distinct().orderBy("_key").collect()
        cuts = [keys[len(keys) * n // CUTS]["_key"] for n in range(CUTS)] if keys else []
        cuts = [c for n, c in enumerate(cuts) if not n or c != cuts[n - 1]]
        kinds = [f.dataType for f in part.schema["_key"].dataType]
        bounds = [F.struct(*(F.lit(v).cast(t).alias(f"k{n}") for n, (v, t) in enumerate(zip(c, kinds, strict=True)))) for c in cuts]
        nth = sum(((F.col("_key") >= b).cast("int") for b in bounds), F.lit(0))
        sizes = dict(part.groupBy(nth.alias("_nth")).count().collect())
        start, lo, hi = before, None, None
        for n in range(len(bounds) + 1):  # the cuts that the page's first and last row lie between
            end = start + sizes.get(n, 0)
            if lo is None and skip < end:
                lo, before = n, start
            if lo is not None and hi is None and (min(skip + size, total) <= end):
                hi = n
            start = end
        now = sum(sizes.get(n, 0) for n in range(lo, hi + 1))
        if now == held:
            break
        part = part.where((F.col("_key") >= bounds[lo - 1]) if lo else F.lit(True)).where((F.col("_key") < bounds[hi]) if hi < len(bounds) else F.lit(True))
        held = now
    if held <= SORT_ROWS:
        some = part.orderBy("_key").limit(skip - before + size).withColumn("place", F.row_number().over(Window.orderBy("_key")))  # SORT_ROWS at most
    else:
        some = with_places(part.drop("_key"), order)
    some = some.withColumn("place", (F.col("place") + before).cast("int")).where(F.col("place").between(skip + 1, skip + size))
    return some.drop("_key").withColumns({"page": F.lit(page), "pages": F.lit(pages), "total": F.lit(total)})


def member_lists(rows: DataFrame, keys: list[str], member: str, size: int = 1000) -> DataFrame:
    """(keys, bucket, systems, members): the distinct members of each key, sorted, in one row per bucket of ``size`` names.

    All distinct members are numbered by name, and a bucket is a range of numbers: no row holds more than ``size``, however
    many members a key has; ``systems`` is the number of all of them. The lists of a key by bucket are its list in order.
    """
    pairs = rows.select(*keys, member).where(F.col(member).isNotNull()).distinct()
    numbers = with_places(pairs.select(member).distinct(), [F.col(member)])
    bucket = F.floor((F.col("place") - 1) / size).cast("int")
    lists = pairs.join(numbers, member).groupBy(*keys, bucket.alias("bucket")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    every = F.sum(F.size("members")).over(Window.partitionBy(*keys))  # a row for each bucket
    return lists.select(*keys, "bucket", every.cast("bigint").alias("systems"), "members")


def with_neighbours(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` with previous and next: the keys beside each row in ``order``; the ends of all rows meet."""
    placed, _ = _ranges(rows, order)
    ends = placed.groupBy("_part").agg(F.min_by(key, "_nth").alias("lo"), F.max_by(key, "_nth").alias("hi"))
    by = Window.orderBy("_part")  # one row a range
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("_part", F.coalesce(F.lag("hi").over(by), F.last("hi").over(every)).alias("_b"), F.coalesce(F.lead("lo").over(by), F.first("lo").over(every)).alias("_a"))
    own = Window.partitionBy("_part").orderBy("_nth")
    beside = placed.withColumns({"previous": F.lag(key).over(own), "next": F.lead(key).over(own)}).join(F.broadcast(ends), "_part")
    return beside.withColumns({"previous": F.coalesce("previous", "_b"), "next": F.coalesce("next", "_a")}).drop("_part", "_nth", "_b", "_a")
