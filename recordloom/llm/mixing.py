"""Mixing sources to target weights: Pfair windows and earliest deadline first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, let, ranked

#: Rows of one block, and slots of one period.
BLOCK_ROWS = 8
PERIOD = 10_000
STRETCH = 100
#: With a cap no source gets more than this share of the mix (or an even share, if that is more).
CAP = 0.2
#: Blocks of one plan row, and the most plan rows that are broadcast (32 million rows of input).
CHUNK, BROADCAST_CHUNKS = 1_000, 4_000
#: Up to so many lanes, the first ranks of their rows are broadcast.
FEW_LANES = 1_000
#: Less than any share of a block that matters, for comparisons of doubles.
LITTLE = 1e-9


def release(block: Column, units: Column, period: Column | None = None) -> Column:
    """The first slot a block may take: block / weight, rounded down."""
    return F.floor(block * (F.lit(PERIOD) if period is None else period) / units).cast("long")


def deadline(block: Column, units: Column, period: Column | None = None) -> Column:
    """The slot before which a block must have run: (block + 1) / weight, rounded up."""
    return F.ceil((block + 1) * (F.lit(PERIOD) if period is None else period) / units).cast("long")


def earliest_deadline_first(units: Column, period: Column | None = None) -> Column:
    """The lane of every slot of one period, for an array of lane weights that sum to the period.

    In each slot the released block with the earliest deadline runs (ties: first lane).  Windows of unit
    blocks with whole-number bounds make this optimal on one server: every block meets its window, so each
    lane is always less than one block from its share.
    """
    length = F.lit(PERIOD) if period is None else period

    def plan(units: Column) -> Column:
        none = F.array().cast("array<int>")
        start = F.struct(F.transform(units, lambda u: F.lit(0).cast("long")).alias("done"), none.alias("lanes"))

        def step(state: Column, slot: Column) -> Column:
            due = F.array_min(F.transform(state["done"], lambda d, i: F.when(
                (F.get(units, i) > 0) & (release(d, F.get(units, i), length) <= slot),
                F.struct(deadline(d, F.get(units, i), length).alias("by"), i.alias("lane")))))
            return let(due, lambda x: F.struct(
                F.transform(state["done"], lambda d, i: d + (i == x["lane"]).cast("long")).alias("done"),
                F.concat(state["lanes"], F.array(x["lane"])).alias("lanes")))

        # A long array is copied once in STRETCH slots, not in each.
        def stretch(state: Column, at: Column) -> Column:
            slots = F.sequence(at, F.least(at + (STRETCH - 1), (length - 1).cast("int")))
            ran = F.aggregate(slots, F.struct(state["done"].alias("done"), none.alias("lanes")), step)
            return let(ran, lambda x: F.struct(x["done"].alias("done"), F.concat(state["lanes"], x["lanes"]).alias("lanes")))

        return F.aggregate(F.sequence(F.lit(0), (length - 1).cast("int"), F.lit(STRETCH)), start, stretch, lambda x: x["lanes"])

    return let(units, plan)


def lanes_of(docs: DataFrame, source: str, weights: dict[str | None, float] | None, cap: float | None, block_rows: int) -> DataFrame:
    """One row per source that has rows and a weight: source, lane, blocks, weight, units.

    A weight is in blocks.  Without given weights it is the source's own number of blocks, so that all sources run
    out together; with ``cap`` no more than that share of the mix: with M the size of the mix, a source gives
    min(blocks, cap * M), and the largest M for which that adds up is the least of (blocks outside the c largest sources) /
    (1 - c * cap) over c.  ``units`` is the share of the weights in 10,000ths, as a fraction.
    """
    held = docs.groupBy(F.col(source).alias("source")).agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
    # One row a source, not a document: the windows without a key see that list only.
    every = Window.partitionBy()
    down = Window.orderBy(F.desc("blocks"), F.asc_nulls_first("source"))
    if weights is not None:
        asked = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items() if w > 0], "asked string, weight double")
        held = held.join(asked, F.col("source").eqNullSafe(F.col("asked"))).drop("asked")
    elif cap is None:
        held = held.withColumn("weight", F.col("blocks").cast("double"))
    else:
        seen = (held.withColumn("rank", F.row_number().over(down)).withColumn("all", F.sum("blocks").over(every))
                .withColumn("sources", F.count("*").over(every))
                .withColumn("larger", F.coalesce(F.sum("blocks").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
        top = F.greatest(F.lit(cap), F.lit(1.0) / F.col("sources"))
        rest = F.lit(1.0) - (F.col("rank") - 1) * top
        mix = F.min(F.when(rest > LITTLE, (F.col("all") - F.col("larger")) / rest)).over(every)
        held = seen.withColumn("mix", mix).select("source", "blocks", F.least(F.col("blocks").cast("double"), top * F.col("mix")).alias("weight"))
    return held.select("source", F.row_number().over(down).alias("lane"), "blocks", "weight",
                       (F.col("weight") * PERIOD / F.sum("weight").over(every)).alias("units"))


def periods_of(lanes: DataFrame) -> DataFrame:
    """Every period of the schedule: number, start, length, and arrays (by lane) of the blocks done before it and in it.

    By slot T each lane ideally has run min(blocks, weight * v) blocks, with v such that these add up to T; a spent lane
    leaves and the others go on by their weights.  A period ends after 10,000 slots and where a lane is spent, so shares do not
    change inside.  At its end every lane has the whole part of its ideal or one more: the blocks that are left over go to the lanes
    whose next block is due first.  No block is taken back later, since those due within the next period are no more than its slots.
    """
    spent = Window.orderBy(F.col("blocks") / F.col("weight"), "lane")
    # v is the largest of (T - blocks of lanes spent sooner) / (weights of the others): a sum of such lines bends down.
    lines = lanes.select("lane", "blocks", "weight", F.coalesce(
        F.sum("blocks").over(spent.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("sooner"), F.sum("weight").over(
        spent.rowsBetween(0, Window.unboundedFollowing)).alias("rest"))
    # One row that holds a few numbers a source.
    listed = lines.agg(F.sort_array(F.collect_list(F.struct("lane", "blocks", "weight", "sooner", "rest"))).alias("lanes"),
                       F.sum("blocks").alias("total")).where("total > 0")
    full = F.transform(F.sequence(F.lit(1), F.ceil(F.col("total") / PERIOD).cast("int")), lambda k: F.least(k * PERIOD, F.col("total")).cast("long"))
    spent_at = F.transform("lanes", lambda x: F.least(F.ceil(x["sooner"] + x["blocks"] / x["weight"] * x["rest"] - 1e-6).cast("long"), F.col("total")))
    listed = listed.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(full, spent_at))))
    lane = lambda i: F.get(F.col("lanes"), i)
    none = F.array().cast("array<struct<start:bigint,length:bigint,before:array<bigint>,units:array<bigint>>>")
    zero = F.transform("lanes", lambda x: F.lit(0).cast("long"))

    def step(state: Column, upto: Column) -> Column:
        done, start = state["done"], state["at"]

        def ends(ideal: Column) -> Column:
            base = F.transform(ideal, lambda x, i: F.greatest(F.get(done, i), F.floor(x).cast("long")))
            # With nothing left over no block is the last: get() of place -1 is null.
            return let(base, lambda b: let(next_due(ideal, b), lambda due: let(
                F.get(F.array_sort(F.filter(due, lambda x: x.isNotNull())), (left(b) - 1).cast("int")),
                lambda last: F.transform(b, lambda x, i: x + F.coalesce(F.get(due, i) <= last, F.lit(False)).cast("long")))))

        def left(base: Column) -> Column:
            return upto - F.aggregate(base, F.lit(0).cast("long"), lambda a, x: a + x)

        def next_due(ideal: Column, base: Column) -> Column:
            return F.transform(base, lambda b, i: F.when(b < lane(i)["blocks"], F.struct(
                (b >= F.get(ideal, i)).alias("early"), ((b + 1) / lane(i)["weight"]).alias("by"), i.alias("at"))))

        v = F.array_max(F.transform("lanes", lambda x: (upto - x["sooner"]) / x["rest"]))
        ideal = let(v, lambda t: F.transform("lanes", lambda x: F.least(x["weight"] * t, x["blocks"].cast("double")) * (1 - 1e-12) - LITTLE))
        return let(let(ideal, ends), lambda after: F.struct(upto.alias("at"), after.alias("done"), F.concat(state["out"], F.array(F.struct(
            start.alias("start"), (upto - start).alias("length"), done.alias("before"),
            F.transform(after, lambda a, i: a - F.get(done, i)).alias("units")))).alias("out")))

    begin = F.struct(F.lit(0).cast("long").alias("at"), zero.alias("done"), none.alias("out"))
    walked = F.aggregate(F.filter("cuts", lambda t: t > 0), begin, step, lambda s: s["out"])
    return listed.select(walked.alias("out")).select(F.posexplode("out").alias("period", "p")).select("period", "p.*")


def plan_of(periods: DataFrame) -> DataFrame:
    """Slots and windows of blocks: lane, chunk, and an array (slot, first, last) of the chunk's blocks.  Each period is one row, planned by itself."""
    # Lanes without a block in the period take no part.
    parts = int(periods.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = periods.repartition(parts, "period").withColumn("used", F.filter(F.transform("units", lambda u, i: F.struct(i.alias("i"), u.alias("u"))), lambda x: x["u"] > 0))
    planned = own.select("start", "length", "before", "used", earliest_deadline_first(
        F.transform("used", lambda x: x["u"]), F.col("length")).alias("plan"))
    at = (planned.select("start", "length", "before", "used", F.posexplode("plan").alias("slot", "index"))
          .select("start", "length", "slot", F.get("used", F.col("index")).alias("x"), "before")
          .select("start", "length", "slot", F.col("x.i").alias("i"), F.col("x.u").alias("u"), F.get("before", F.col("x.i")).alias("done")))
    nth = at.withColumn("nth", F.row_number().over(Window.partitionBy("start", "i").orderBy("slot")).cast("long") - 1)
    block = F.col("done") + F.col("nth")
    return (nth.select((F.col("i") + 1).cast("int").alias("p_lane"), F.floor(block / CHUNK).cast("long").alias("p_chunk"), F.struct(
        block.alias("block"), (F.col("start") + F.col("slot")).alias("slot"),
        (F.col("start") + release(F.col("nth"), F.col("u"), F.col("length"))).alias("first"),
        (F.col("start") + deadline(F.col("nth"), F.col("u"), F.col("length"))).alias("last")).alias("b"))
        .groupBy("p_lane", "p_chunk").agg(F.sort_array(F.collect_list("b")).alias("blocks")))


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS, cap: float | None = CAP,
             source: str = "source", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with its place in the mix: all columns of ``docs`` in ``row``, and lane, block, slot, first, last, place, in_mix.

    Every source is a lane.  A lane's rows, in hash order of ``order``, form blocks; block j may run from slot ``first``
    and must have run before ``last``.  The schedule is cut into periods; each has a whole number of blocks of every lane, less than
    one from its exact share at either end, and is planned by earliest deadline first, so a lane is less than one block
    from its share in a schedule of one period, and less than two anywhere.  With ``cap=None`` the weights are the numbers of blocks: all rows are in the
    mix.  So they are with given weights: a spent lane leaves, the others go on.  With a cap, rows beyond the size at which it can be held
    keep their slot but in_mix is false.  ``place`` orders the rows.
    Null sources are a source; rows without a weighted source have no slot; repeated rows are kept; an empty table gives none.
    """
    lanes = landed(lanes_of(docs, source, weights, cap, block_rows), "mix-lanes")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(source).alias("at"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    # Lanes hold one row a source; Spark broadcasts them by their size or shuffles them.
    ends = lanes.select("source", "lane", "units", F.sum(F.least(F.col("weight"), F.col("blocks"))).over(Window.partitionBy()).alias("end"))
    placed = rows.join(ends, F.col("at").eqNullSafe(F.col("source")), "left")
    numbered = ranked(placed, ["lane"], [f"o{i}" for i in range(len(order))], "rank", lanes.count() <= FEW_LANES).withColumn(
        "block", F.floor(F.col("rank") / block_rows).cast("long")).withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("long"))
    plan = landed(plan_of(periods_of(lanes)), "mix-plan")
    # Numbers of one block in eight rows: broadcast up to the bound, joined by shuffle beyond.
    near = F.broadcast(plan) if plan.count() <= BROADCAST_CHUNKS else plan
    found = numbered.join(near, (F.col("lane") == F.col("p_lane")) & (F.col("chunk") == F.col("p_chunk")), "left").withColumn(
        "b", F.get("blocks", (F.col("block") % CHUNK).cast("int")))
    mixed = F.lit(True) if weights is not None or cap is None else F.col("b.slot") < F.col("end")
    return found.select(
        "row", "lane", "units", F.when(F.col("lane").isNotNull(), F.col("block")).alias("block"), F.col("b.slot").alias("slot"),
        F.col("b.first").alias("first"), F.col("b.last").alias("last"),
        (F.col("b.slot") * block_rows + F.col("rank") % block_rows).cast("long").alias("place"),
        F.coalesce(F.col("b.slot").isNotNull() & mixed, F.lit(False)).alias("in_mix"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS, cap: float | None = CAP,
        source: str = "source", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The rows of the mix in its order, with the columns of ``docs``: partitions are ranges of the schedule."""
    planned = schedule(docs, weights, block_rows, cap, source, order).where("in_mix")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return planned.repartitionByRange(parts, "place").sortWithinPartitions("place").select("row.*")


def stored_order(docs: DataFrame) -> DataFrame:
    """A mix that was written as Parquet and read again, with ``_file`` and ``_nth``: Spark numbers its part files by partition, and
    partitions are ranges of the schedule, so (_file, _nth) is the order of the mix whatever splits a reader makes."""
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long")
    return docs.select("*", F.struct(number.alias("number"), name.alias("name")).alias("_file"), F.col("_metadata.row_index").alias("_nth"))
