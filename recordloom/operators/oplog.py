"""Analytics over operational logs: latencies, sessions, traces, transaction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import landed

# Reported percentiles, slow limit, idle time, ring size, retry limit.
PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}
SLOW_MS = 1000
IDLE_SECONDS = 7200
RING_SIZE = 500
MAX_RECENT = 200
MAX_RETRIES = 3

# One task sorts at most so many distinct values of one key.
SORT_BOUND = 100_000


def error_key(operation: Column, failed: Column) -> Column:
    """Failed calls are counted under their own ``<operation>_ERROR`` key."""
    return F.when(failed, F.concat(operation, F.lit("_ERROR"))).otherwise(operation)


def _bucket(df: DataFrame, cuts: str, value: str, steps: int) -> DataFrame:
    """Number of cut points below the value, by bisection over ``2**steps - 1`` sorted cuts."""
    out = df.withColumn("_b", F.lit(0))
    for step in reversed(range(steps)):
        half = 1 << step
        beyond = F.get(cuts, F.col("_b") + (half - 1)) < F.col(value)
        out = out.withColumn("_b", F.col("_b") + F.when(beyond, half).otherwise(0))
    return out


def _narrow(hist: DataFrame, keys: list[str], targets: DataFrame, steps: int) -> DataFrame:
    """Keep, for each target rank, only the value bucket that contains it.

    Cut points split each key's distinct values into about equal buckets; bucket totals say
    where a rank falls.  Bucketing depends on values alone, so a rerun task agrees.  Cut points and hits are one short row a key
    and are written first, so that the planner knows their size.
    """
    buckets = 1 << steps
    shares = [i / buckets for i in range(1, buckets)]
    cuts = landed(hist.groupBy(*keys).agg(F.percentile_approx("value", shares, buckets * 10).alias("_cuts")), "cuts")
    marked = _bucket(hist.join(cuts, keys), "_cuts", "value", steps).drop("_cuts")
    running = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = marked.groupBy(*keys, "_b").agg(F.sum("n").alias("_n")).withColumn("_upto", F.sum("_n").over(running))
    hit = landed(
        sums.join(targets, keys)
        .filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))
        .select(*keys, "_b", "label", (F.col("rank") - F.col("_upto") + F.col("_n")).alias("rank")),
        "ranks")
    return marked.join(hit, [*keys, "_b"]).drop("_b")


def _picked(near: DataFrame, by: list[str]) -> tuple[DataFrame, Column]:
    """Rows with their running count, and the test that a rank falls on a row."""
    running = Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = near.withColumn("_upto", F.sum("n").over(running))
    return counted, (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n"))


def values_at_ranks(hist: DataFrame, keys: list[str], targets: DataFrame, steps: int = 7, bound: int = SORT_BOUND) -> DataFrame:
    """Exact values at 0-based ranks: ``hist (keys…, value, n)``, ``targets (keys…, label, rank)``.

    Keys of up to ``bound`` distinct values are sorted as they are.  For the others a rank is narrowed to one of ``2**steps``
    buckets of its key, again and again, until what is left for each rank is within the bound; the data say how often.
    """
    sizes = landed(hist.groupBy(*keys).agg(F.count(F.lit(1)).alias("_values")), "sizes")
    few = sizes.filter(F.col("_values") <= bound).select(*keys)
    counted, at_rank = _picked(hist.join(few, keys, "left_semi"), keys)
    out = counted.join(targets, keys).filter(at_rank).select(*keys, "label", "value")
    most = sizes.agg(F.max("_values")).first()[0] or 0
    if most <= bound:
        return out
    many = sizes.filter(F.col("_values") > bound).select(*keys)
    near = landed(_narrow(hist.join(many, keys, "left_semi"), keys, targets, steps), "near")
    while True:
        left = near.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("_values")).agg(F.max("_values")).first()[0]
        if left <= bound or left >= most:  # distinct values always part, so the second ends no search early
            break
        most = left
        again = near.groupBy(*keys, "label").agg(F.max("rank").alias("rank")).withColumn("_of", F.col("label"))
        inner = near.drop("rank").withColumnRenamed("label", "_of")
        near = landed(_narrow(inner, [*keys, "_of"], again, steps).drop("_of"), "near")
    counted, at_rank = _picked(near, [*keys, "label"])
    return out.unionByName(counted.filter(at_rank).select(*keys, "label", "value"))


def latency_stats(log: DataFrame, operation: str, duration: str, steps: int = 7, bound: int = SORT_BOUND) -> DataFrame:
    """Per operation: count, total, average, least, greatest and the exact values at sorted
    positions ``floor(share * count)``.

    Repeated durations collapse to (value, count) before the shuffle, spread by operation and
    value, so one dominant operation loads no single task.  That histogram is written once,
    since it is read several times; of an operation with many values no step sorts more than ``bound`` in a task.
    """
    hist = landed(
        log.filter(F.col(duration).isNotNull())
        .groupBy(F.col(operation).alias("operation"), F.col(duration).alias("value"))
        .agg(F.count(F.lit(1)).alias("n")),
        "histogram",
    )
    totals = landed(
        hist.groupBy("operation").agg(
            F.sum("n").alias("count"),
            F.sum(F.col("value") * F.col("n")).alias("total_ms"),
            F.min("value").alias("min_ms"),
            F.max("value").alias("max_ms"),
        ),
        "totals",
    )
    ranks = F.array(*[
        F.struct(F.lit(name).alias("label"), F.floor(F.col("count") * share).alias("rank"))
        for name, share in PERCENTILES.items()
    ])
    targets = totals.select("operation", F.inline(ranks))
    found = values_at_ranks(hist, ["operation"], targets, steps, bound)
    wide = found.groupBy("operation").agg(
        *[F.max(F.when(F.col("label") == name, F.col("value"))).alias(name) for name in PERCENTILES]
    )
    return totals.join(wide, "operation").select(
        "operation", "count", "total_ms", (F.col("total_ms") / F.col("count")).alias("avg_ms"), "min_ms", "max_ms",
        *PERCENTILES,
    )


def slow_operations(log: DataFrame, duration: str, limit_ms: float = SLOW_MS) -> DataFrame:
    return log.filter(F.col(duration) > limit_ms)


def error_split(log: DataFrame, operation: str, failed: Column) -> DataFrame:
    """The log with failed calls renamed, ready for ``latency_stats``."""
    return log.withColumn(operation, error_key(F.col(operation), failed))


def active_sessions(log: DataFrame, user: str, ts: str, now: Column, attributes: Sequence[str] = (),
                    expiry: Column | None = None, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Per user first and last sight, the latest attributes, seconds to expiry (never below
    zero); users idle too long are left out; latest first."""
    attrs = [F.max_by(a, ts).alias(a) for a in attributes]
    if expiry is not None:
        attrs.append(F.max_by(expiry, F.col(ts)).alias("_expiry"))
    seen = log.groupBy(user).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), *attrs)
    live = seen.filter(F.unix_timestamp(now) - F.unix_timestamp("last_seen") <= idle_seconds)
    out = [user, "first_seen", "last_seen", *attributes]
    if expiry is not None:
        left = F.greatest(F.col("_expiry") - F.unix_timestamp(now), F.lit(0).cast("bigint"))
        out.append(left.alias("expires_in_sec"))
    return live.select(*out).orderBy(F.col("last_seen").desc(), user)


def recent_entries(log: DataFrame, limit: int, order_by: Sequence[str], ring: int = RING_SIZE) -> DataFrame:
    """The newest entries (1 to 200), with the number kept in the ring."""
    kept = max(1, min(limit, MAX_RECENT))
    total = log.agg(F.least(F.count(F.lit(1)), F.lit(ring).cast("bigint"))).scalar()
    return log.orderBy(*[F.col(c).desc() for c in order_by]).limit(kept).withColumn("total", total)


def recent_per_key(log: DataFrame, key: str, limit: int, order_by: Sequence[str]) -> DataFrame:
    """The newest entries of every key; tasks cut each key to ``limit`` before the shuffle."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_by])
    return log.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= limit)


def incomplete_transactions(txlog: DataFrame) -> DataFrame:
    return txlog.filter(F.col("status").isin("in_progress", "pending"))


def exploded_ops(txlog: DataFrame) -> DataFrame:
    """One row per operation: ``(tx_id, op_index, op…)``."""
    return txlog.select("tx_id", F.posexplode("ops").alias("op_index", "op")).select("tx_id", "op_index", "op.*")


def pending_ops_to_apply(txlog: DataFrame, present: DataFrame) -> DataFrame:
    """Operations of incomplete transactions that still have to run: not done, and their key
    is not in ``present (collection, unique_check)`` yet."""
    todo = exploded_ops(incomplete_transactions(txlog)).filter(F.col("status") != "done")
    return todo.join(present.select("collection", "unique_check"), ["collection", "unique_check"], "left_anti")


def next_status(outcome: Column, retries: Column, max_retries: int = MAX_RETRIES) -> Column:
    """Status after an attempt: applied or duplicate means done; an error is retried until
    the retry limit."""
    return (
        F.when(outcome.isin("applied", "present", "duplicate"), "done")
        .when((outcome == "error") & (retries + 1 >= max_retries), "failed")
        .when(outcome == "error", "retrying")
    )


def advance_op_state(txlog: DataFrame, outcomes: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """The log after attempts ``(tx_id, op_index, outcome)``.

    Of several outcomes of one operation a success counts.  They gather to one map per
    transaction, no larger than its operation list, and the ops change in place.
    """
    good = F.col("outcome").isin("applied", "present", "duplicate")
    per_op = outcomes.groupBy("tx_id", "op_index").agg(
        F.when(F.bool_or(good), "applied").otherwise("error").alias("outcome")
    )
    by_tx = per_op.groupBy("tx_id").agg(
        F.map_from_entries(F.collect_list(F.struct("op_index", "outcome"))).alias("_outcomes")
    )

    def advanced(op: Column, i: Column) -> Column:
        outcome = F.try_element_at("_outcomes", i)
        status = F.when(op["status"] == "done", "done").otherwise(
            F.coalesce(next_status(outcome, op["retries"], max_retries), op["status"])
        )
        tried = (outcome == "error") & (op["status"] != "done")
        retries = op["retries"] + F.coalesce(tried, F.lit(False)).cast("int")
        return op.withField("status", status).withField("retries", retries)

    return txlog.join(by_tx, "tx_id", "left").withColumn("ops", F.transform("ops", advanced)).drop("_outcomes")


def transaction_rollup(txlog: DataFrame) -> DataFrame:
    """A transaction is committed once all its operations are done."""
    done = F.forall("ops", lambda o: o["status"] == "done")
    return txlog.withColumn("status", F.when(done, "committed").otherwise(F.col("status")))


def op_checksum(op: Column, names: Sequence[str]) -> Column:
    """SHA-256 of the operation as JSON with sorted keys; absent members are left out."""
    return F.sha2(F.to_json(F.struct(*[op[n].alias(n) for n in sorted(names)])), 256)


def annotate_ops(txlog: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fill the defaults of new operations: idempotency key, checksum, retries, status."""

    def annotated(op: Column, i: Column) -> Column:
        key = F.substring(F.sha2(F.concat_ws("|", F.col("tx_id"), i.cast("string")), 256), 1, 32)
        return F.struct(
            *[op[n].alias(n) for n in names],
            key.alias("idempotency_key"),
            op_checksum(op, names).alias("checksum"),
            F.lit(0).alias("retries"),
            F.lit("pending").alias("status"),
        )

    return txlog.withColumn("ops", F.transform("ops", annotated))


def reconcile_stores(structured: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Per key the rows in each store and whether it is in both.

    Both sides are counted in one aggregation over their union instead of an outer join.
    """
    marked = structured.select(F.col(key).alias("key"), F.lit(1).alias("s"), F.lit(0).alias("d")).unionByName(
        documents.select(F.col(key).alias("key"), F.lit(0).alias("s"), F.lit(1).alias("d"))
    )
    status = (
        F.when((F.col("structured_rows") > 0) & (F.col("document_rows") > 0), "both")
        .when(F.col("structured_rows") > 0, "structured_only")
        .otherwise("documents_only")
    )
    return marked.groupBy("key").agg(
        F.sum("s").alias("structured_rows"), F.sum("d").alias("document_rows")
    ).withColumn("status", status)
