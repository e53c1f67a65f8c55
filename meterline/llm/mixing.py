"""Mixing sources to target weights by weighted sampling without replacement.

*Targets.* Sources in code-point order, null last, weigh 5, 2, 1, repeating. Together they get
``SHARE`` times all words; no source gets more than ``LIMIT`` times its own, and what that cuts is
shared again by weight. That is a water level: sources in order of limit per weight are full
while the level is above them, so running sums over the sources give it at once.

*Sampling.* Complete epochs come first: each document is taken floor(target / source size) times.
The rest of the target is filled by Efraimidis and Spirakis' keys: each document draws
``-ln(u) / weight``, with u from a hash of its id and text and ``weight`` its quality, and documents
are taken in ascending order of key while the middle of a document lies inside the rest.

*Scale.* No source is ordered as a whole. Sizes are summed by source and slice of the keys
(``SLICES`` per source); a running sum over slices finds the one that holds the cut. Low qualities
crowd the last slice, so while a source's slice has more than ``ORDERED`` places, it is cut again
by its own range of keys; only what is left is ordered. What is taken is then a comparison with the
source's cut.

Only Spark SQL functions are used. Defined cases: a null or empty text has size 0 and takes
nothing; null sources are one source; null ids and repeated rows draw keys like any other; equal
rows (source, id and text) draw equal keys, and where the cut falls among them, as many of them are
taken as lie inside the rest, whichever; a source without words has the target 0; empty tables
give empty results; other columns are kept by ``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty, unused_name, words
from meterline.workspace import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SLICES = 4096
# Places of a source that one task orders at most; ranges of keys above it are sliced again.
ORDERED = 4096
LEAST_QUALITY = 0.05


def size_of(text: str = "text") -> Column:
    """Words of the text."""
    return F.size(words(text_or_empty(text))).cast("long")


def quality_of(size: Column, text: str = "text") -> Column:
    """Sampling weight: falls with the share of mark-up symbols and exclamation marks per word."""
    marks = F.regexp_count(text_or_empty(text), F.lit(r"[#*$%&|<>!]"))
    return F.greatest(F.lit(LEAST_QUALITY), 1.0 - marks / F.greatest(size, F.lit(1)))


def draw(quality: Column, text: str = "text") -> Column:
    """Exponential key of a row; the same at every run."""
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty(text).cast("binary")))
    uniform = (F.conv(F.substring(F.md5(identity.cast("binary")), 1, 13), 16, 10).cast("long") + 1) / F.lit(float(1 << 52))
    return -F.log(uniform) / quality


def place(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, size, key and tie (a hash of the text) of every row."""
    sized = docs.select("doc_id", "source", F.col(text).alias("_text"), size_of(text).alias("size"))
    return sized.select(
        "doc_id", "source", "size", draw(quality_of(F.col("size"), "_text"), "_text").alias("key"),
        F.xxhash64(text_or_empty("_text")).alias("tie"),
    )


def targets(totals: DataFrame) -> DataFrame:
    """source, source_size -> and the target of each source.

    The windows run over one row per source, not over documents.
    """
    numbered = totals.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    cycle = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    weighted = numbered.withColumn("weight", cycle).withColumn("full", LIMIT * F.col("source_size"))
    filling = W.orderBy(F.col("full") / F.col("weight"), "rank")
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (
        (SHARE * F.sum("source_size").over(whole) - (F.sum("full").over(filling) - F.col("full")))
        / (F.sum("weight").over(whole) - (F.sum("weight").over(filling) - F.col("weight")))
    )
    levelled = weighted.withColumn("level", level)
    # The first source in filling order that its own level does not fill sets the level of all.
    fits = F.when(F.col("level") <= F.col("full") / F.col("weight"), F.struct(F.col("full") / F.col("weight"), "rank", "level"))
    chosen = levelled.withColumn("water", F.min(fits).over(whole)["level"])
    return chosen.select("source", "source_size", F.least(F.col("full").cast("double"), F.col("water") * F.col("weight")).alias("target"))


def plan(placed: DataFrame) -> DataFrame:
    """One row per source: source_size, target, epochs, and the cut of the fractional epoch.

    ``cut_slice`` is the slice of the keys that holds the cut and ``cut`` the last place all of whose
    rows are taken inside it (null: none of that slice). Of the rows at the place ``split`` only
    ``split_taken`` are taken (null: the cut falls between places).
    """
    sliced = placed.withColumn("slice", _slice(F.col("key")))
    sums = materialize(sliced.groupBy("source", "slice").agg(F.sum("size").alias("size")), "mix-slices")
    totals = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = (targets(totals).withColumn("epochs", epochs)
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    aims = materialize(aims, "mix-targets")
    running = F.sum("size").over(W.partitionBy("source").orderBy("slice")) - F.col("size")
    at = (sums.withColumn("before", running).alias("s").join(aims.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source")))
          .filter(F.col("before") + F.col("size") > F.col("rest"))
          .groupBy("s.source").agg(F.min(F.struct("slice", "before")).alias("first")))
    cut_at = materialize(at.select(F.col("source").alias("_source"), "first.slice", "first.before"), "mix-cut-slices")
    inside = (sliced.join(cut_at, F.col("source").eqNullSafe(F.col("_source")) & (sliced["slice"] == cut_at["slice"]))
              .groupBy("source", "before", "key", "doc_id", "tie").agg(F.max("size").alias("size"), F.count("*").alias("n"))
              .select("source", "before", "size", "n", F.struct("key", "doc_id", "tie").alias("place")))
    inside = _narrowed(inside.withColumn("passed", F.lit(None).cast(inside.schema["place"].dataType)), aims)
    order = W.partitionBy("source").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    ordered = inside.withColumn("ahead", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    # Of n rows of one size, those whose middle is inside the rest; in whole numbers, so that it is exact.
    left = F.floor(2 * F.col("rest")) - 2 * F.col("ahead") - F.col("size")
    fitting = F.when(left < 0, 0).when(F.col("size") == 0, F.col("n")).otherwise(F.least("n", F.expr("left div (2 * size)") + 1))
    taken = (ordered.alias("o").join(aims.alias("a"), F.col("o.source").eqNullSafe(F.col("a.source")))
             .withColumn("left", left).withColumn("fitting", fitting).groupBy("o.source").agg(
                 F.greatest(F.max("passed"), F.max(F.when(F.col("fitting") == F.col("n"), F.col("place")))).alias("cut"),
                 F.max(F.when((F.col("fitting") > 0) & (F.col("fitting") < F.col("n")), F.struct("place", "fitting"))).alias("split"))
             .withColumnRenamed("source", "_cut_source"))
    joined = (aims.join(cut_at, F.col("source").eqNullSafe(F.col("_source")), "left")
              .join(taken, F.col("source").eqNullSafe(F.col("_cut_source")), "left"))
    return materialize(joined.select(
        "source", "source_size", "target", "epochs", F.col("slice").alias("cut_slice"), "cut",
        F.col("split.place").alias("split"), F.col("split.fitting").alias("split_taken")), "mix-plan")


def _narrowed(inside: DataFrame, aims: DataFrame) -> DataFrame:
    """The places around each source's cut: at most ``ORDERED`` of them, unless their keys are equal.

    ``before`` is the size of what comes before them and ``passed`` the last place of it. Each round cuts
    a source's range of keys into slices of one width, of which the one with the cut stays.
    """
    inside = materialize(inside, "mix-inside")
    while True:
        ranges = inside.groupBy("source").agg(F.count("*").alias("places"), F.min("place.key").alias("low"), F.max("place.key").alias("high"))
        ranges = materialize(ranges.withColumnRenamed("source", "_source"), "mix-ranges")
        if ranges.filter((F.col("places") > ORDERED) & (F.col("low") < F.col("high"))).isEmpty():
            return inside
        parts = max(SLICES, 2)
        share = F.when(F.col("low") < F.col("high"), (F.col("place.key") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
        cells = (inside.join(ranges, F.col("source").eqNullSafe(F.col("_source")))
                 .withColumn("cell", F.least(F.lit(parts - 1), F.floor(parts * share)).cast("int")).drop("_source", "places", "low", "high"))
        sums = materialize(cells.groupBy("source", "cell").agg(
            F.sum(F.col("size") * F.col("n")).alias("size"), F.max("before").alias("before"),
            F.max("passed").alias("passed"), F.max("place").alias("last")), "mix-cells")
        # At most ``parts`` rows per source.
        earlier = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        found = (sums.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
                 .withColumn("passed", F.coalesce(F.max("last").over(earlier), "passed")).alias("s")
                 .join(aims.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source")))
                 .filter(F.col("before") + F.col("s.size") > F.col("rest"))
                 .groupBy("s.source").agg(F.min_by(F.struct("cell", "before", "passed"), "cell").alias("first")))
        found = materialize(found.select(F.col("source").alias("_source"), F.col("first.cell").alias("_cell"), "first.before", "first.passed"), "mix-cut-cells")
        inside = materialize(
            cells.drop("before", "passed").join(found, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
            .select("source", "before", "size", "n", "place", "passed"), "mix-inside")


def _slice(key: Column) -> Column:
    """Ascending with the key; about even for weights near 1."""
    return F.least(F.lit(SLICES - 1), F.floor(SLICES * (1 - F.exp(-key)))).cast("int")


def copies(key: Column, doc_id: Column, tie: Column) -> Column:
    """How often a row is taken, beside the columns of its source's plan; rows at ``split`` as if left out of the cut."""
    here = _slice(key)
    # Without a cut slice all slices end inside the rest.
    extra = F.when(F.col("cut_slice").isNull() | (here < F.col("cut_slice")), 1).when(
        (here == F.col("cut_slice")) & F.coalesce(_place(key, doc_id, tie) <= F.col("cut"), F.lit(False)), 1).otherwise(0)
    return F.when(F.col("source_size") > 0, F.col("epochs") + extra).otherwise(0).cast("long")


def _place(key: Column, doc_id: Column, tie: Column) -> Column:
    return F.struct(key.alias("key"), doc_id.alias("doc_id"), tie.alias("tie"))


def with_copies(joined: DataFrame, mixed: DataFrame) -> DataFrame:
    """``copies`` beside the rows of ``joined``: source, key, doc_id, tie and the columns of the plan ``mixed``.

    Rows at a split place are stored and numbered: by the task that stored them, and among those of one
    task by their order, so that no task numbers more rows than one has read.
    """
    columns = F.col("key"), F.col("doc_id"), F.col("tie")
    counted = joined.withColumn("copies", copies(*columns))
    if mixed.filter("split IS NOT NULL").isEmpty():
        return counted
    at_split = _place(*columns).eqNullSafe(F.col("split"))
    stored = materialize(counted.filter(at_split).withColumn("_at", F.monotonically_increasing_id()), "mix-split")
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    parts = stored.groupBy("source", "_part").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(W.partitionBy("source").orderBy("_part")) - F.col("_n")
    parts = materialize(parts.select(F.col("source").alias("_of"), F.col("_part").alias("_in"), earlier.alias("_earlier")), "mix-split-parts")
    number = F.col("_earlier") + F.row_number().over(W.partitionBy("source", "_part").orderBy("_at"))
    numbered = (stored.join(parts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
                .withColumn("_number", number)
                .withColumn("copies", F.col("copies") + F.when(F.col("_number") <= F.col("split_taken"), 1).otherwise(0)))
    return counted.filter(~at_split).unionByName(numbered.select(counted.columns))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    placed = materialize(place(docs), "mix-places")
    mixed = plan(placed).withColumnRenamed("source", "_source")
    joined = placed.join(mixed, F.col("source").eqNullSafe(F.col("_source")))
    return with_copies(joined, mixed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def apply_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix: every row as often as it is taken, all columns kept."""
    placed = materialize(place(docs), "mix-places")
    mixed = plan(placed).drop("target").withColumnRenamed("source", "_source")
    row = unused_name(docs, "_mix_row")
    whole = docs.select(F.struct("*").alias(row), "doc_id", "source", "text")
    sized = whole.withColumn("size", size_of("text"))
    keyed = sized.withColumn("key", draw(quality_of(F.col("size"), "text"), "text")).withColumn("tie", F.xxhash64(text_or_empty("text")))
    joined = keyed.select(row, "doc_id", "source", "key", "tie").join(mixed, F.col("source").eqNullSafe(F.col("_source")))
    repeated = with_copies(joined, mixed).withColumn("copies", F.col("copies").cast("int")).filter("copies > 0")
    return repeated.select(row, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(f"{row}.*")
