"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words. Every document gets a number of expected
copies, in proportion to its rate within its source and at most `most`, such that
the expected words meet the target. The whole part of that number is allocated
for certain; the rest is the document's inclusion probability p. Documents are
ranked by their random odds over their inclusion odds, (u / (1 - u)) / (p / (1 - p)),
and taken in this order until the words still missing are reached, which fixes the
sample's size: a source misses its target by at most half of one document, also where equal rows meet the cut.

The rank is cut without sorting a source: words are added up in 4096 bins of the
order, and only the rows of the one bin that holds the cut are sorted.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotweave.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def rate_class(size: Column) -> Column:
    """How often a document is wanted against others of its source: the bits of its size, so long ones a little more."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("int")


def draw() -> Column:
    """A reproducible number in (0, 1) for every id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words wanted of every source; what a source can't take is shared out again by weight.

    Sources go by code point, null last; the weights repeat.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not over:
            return full | {s: rest * weight[s] / total for s in free}
        for s in over:
            full[s] = most * sizes[s]
            rest -= full[s]


def class_copies(by_class: dict[int, int], target: float, most: float = MOST) -> dict[int, float]:
    """Expected copies of the documents of every class: in proportion to the class, at most `most`, together the target."""
    full: set[int] = set()
    while True:
        rest = target - sum(most * by_class[k] for k in full)
        mass = sum(k * n for k, n in by_class.items() if k not in full)
        c = rest / mass if mass else 0.0
        over = {k for k in by_class if k not in full and c * k > most}
        if not over:
            return {k: most if k in full else c * k for k in by_class}
        full |= over


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """docs(id, source, text, ...) with size, source_size, target and copies added.

    A null text has no words and gets no copies, as has a text of white space. A null id draws the same
    number for all its rows; of rows equal in id and text as many are taken as still fit, which ones makes
    no difference. An empty table stays empty.
    """
    spark = docs.sparkSession
    size = words()
    measured = docs.select("id", "source", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    measured = stored(measured.withColumn("class", rate_class(F.col("size"))), "sizes")

    # One row per source and class (at most 63 classes): the mixture's configuration.
    by_source: dict[str | None, dict[int, int]] = defaultdict(dict)
    for r in measured.groupBy("source", "class").agg(F.sum("size").alias("size")).collect():
        by_source[r["source"]][r["class"]] = r["size"]
    sizes = {s: sum(c.values()) for s, c in by_source.items()}
    targets = source_targets(sizes, weights, share, most)
    rates, missing = [], []
    for s, by_class in by_source.items():
        certain = 0.0
        for k, copies in class_copies({k: n for k, n in by_class.items() if k}, targets[s], most).items():
            whole = min(int(most), int(copies + 1e-9))
            certain += whole * by_class[k]
            rates.append((s, k, whole, min(max(copies - whole, 0.0), 1.0)))
        missing.append((s, sizes[s], targets[s], targets[s] - certain))

    # Local relations: Spark knows their size, so while they are small it joins them without a shuffle of texts.
    string, short, whole, real = pa.string(), pa.int32(), pa.int64(), pa.float64()
    rate = _local(spark, rates, rate_source=string, rate_class=short, certain=short, p=real)
    want = _local(spark, missing, want_source=string, source_size=whole, target=real, rest=real)

    def ranked(df: DataFrame) -> DataFrame:
        same = F.col("source").eqNullSafe(F.col("rate_source")) & (F.col("class") == F.col("rate_class"))
        df = df.join(rate, same, "left").drop("rate_source", "rate_class")
        u, p = draw(), F.col("p")
        order = u * (1 - p) / (u * (1 - p) + (1 - u) * p)
        df = df.withColumn("order", F.when((p > 0) & (p < 1), order))
        return df.withColumn("bin", F.floor(F.col("order") * BINS).cast("int"))

    rows = ranked(measured)
    bins = rows.where("order is not null").groupBy("source", "bin").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("end", F.sum("size").over(upto)).withColumn("start", F.col("end") - F.col("size"))
    wanted = lambda df: df.join(want, F.col("source").eqNullSafe(F.col("want_source"))).drop("want_source")
    border = wanted(bins).where("start <= rest and end > rest").select("source", "bin", "start", "rest")
    # One bin of each source is sorted; rows equal in id and text, of which there may be many, are one row of it.
    edge = border.select(F.col("source").alias("s"), F.col("bin").alias("b"), "start", "rest")
    inside = rows.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    inside = inside.groupBy("source", "start", "rest", "order", "id", "crc", "size").agg(F.count(F.lit(1)).alias("times"))
    place = F.struct("order", "id", "crc")
    run = Window.partitionBy("source").orderBy("order", "id", "crc").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("start") + F.sum(F.col("size") * F.col("times")).over(run) - F.col("size") * F.col("times")
    # The k-th of equal rows is taken while more than half of it is missing.
    fit = F.floor((F.col("rest") - before) / F.col("size") + 0.5)
    taken = inside.withColumn("fit", F.least(F.greatest(fit, F.lit(0)), F.col("times"))).where("fit > 0")
    last = taken.groupBy("source").agg(F.max(F.struct(place.alias("place"), "fit", "times")).alias("last"))
    cuts = border.select("source", "bin").join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    split = F.coalesce(F.col("last.fit") < F.col("last.times"), F.lit(False)).alias("split")
    cuts = cuts.select(F.col("source").alias("cut_source"), F.col("bin").alias("cut_bin"), F.col("last.place").alias("last"), F.col("last.fit").alias("fit"), split)
    cuts = stored(cuts, "cuts")

    full = docs.withColumn("size", size).withColumn("class", rate_class(F.col("size")))
    full = full.withColumn("crc", F.crc32(F.coalesce("text", F.lit(""))))
    full = wanted(ranked(full)).join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    upto = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & (place <= F.col("last")))
    drawn = (
        F.when(F.col("p") >= 1, 1)
        .when(F.col("order").isNull(), 0)
        .when(F.col("cut_bin").isNull(), (F.col("rest") > 0).cast("int"))  # no cut: all or none fit
        .otherwise(F.coalesce(upto, F.lit(False)).cast("int"))
    )
    keep = [*docs.columns, "size", "source_size", "target"]

    def told(df: DataFrame, drawn) -> DataFrame:
        copies = F.when(F.col("size") > 0, F.col("certain") + drawn).otherwise(0)
        return df.select(*keep, copies.cast("int").alias("copies"))

    if cuts.where("split").limit(1).count() == 0:
        return told(full, drawn)
    parted = F.coalesce(F.col("split") & (F.col("bin") == F.col("cut_bin")) & (place == F.col("last")), F.lit(False))
    equal = _numbered(full.where(parted))
    return told(full.where(~parted), drawn).unionAll(told(equal, (F.col("__number") <= F.col("fit")).cast("int")))


def _local(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


def _numbered(equal: DataFrame) -> DataFrame:
    """The rows with their number within their source, from 1.

    They are stored with their task's number, so they stay where they are; rows are numbered within
    a task, and tasks by the rows of those before.
    """
    rows = stored(equal.withColumns({"__task": F.spark_partition_id(), "__nth": F.monotonically_increasing_id()}), "equal")
    held = rows.groupBy(F.col("source").alias("s"), F.col("__task").alias("t")).agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("s").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("s", "t", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("source", "__task").orderBy("__nth"))
    numbered = rows.withColumn("__number", within)
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("__task") == F.col("t"))
    return numbered.join(starts, same).withColumn("__number", F.col("__number") + F.col("first"))
