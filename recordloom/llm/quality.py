"""Quality rules whose thresholds come from the data: quantile sketches per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, let, once

SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: Metrics are integers in these units; the sketch keeps the leading 6 bits of a value.
UNIT = 10_000
SKETCH_BITS = 6
#: A group with fewer documents takes the sketch of its language, merged over sources.
LEAST_GROUP = 200
#: How far beyond the middle of its group a document may lie, in distances from the median to the 90th (10th) percentile.
UPPER = {"symbols": 2, "dup_lines": 1.5, "repeats": 1.5, "word_chars": 3}
LOWER = {"word_chars": 4}
METRICS = tuple(UPPER)


def words_of(text: Column) -> Column:
    """The words between white space (space, tab to carriage return); none for null or blank."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.char_length(inner) > 0, F.split(inner, SPACE + "+")).otherwise(F.array().cast("array<string>"))


def repeat_words(words: Column) -> Column:
    """Words inside any window of five that occurs twice or more, the first occurrence included."""
    n = F.size(words)

    def covered(found: Column) -> Column:
        # found: start positions of repeated windows, ascending; each covers five words or up to the next start.
        steps = F.transform(found, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(found, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(pairs: Column) -> Column:
        # pairs: (hash, position), sorted; a window repeats if a neighbour has its hash.
        same = F.filter(pairs, lambda p, i: F.coalesce(F.get(pairs, i - 1)["h"] == p["h"], F.lit(False))
                        | F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False)))
        return let(F.array_sort(F.transform(same, lambda p: p["i"])), covered)

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, repeated))

    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(let(windows, count))


def measure(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts per row of ``docs``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = once(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                            body.alias("text")), words=words_of(F.col("text")),
                lines=F.filter(F.split("text", "\n"), lambda x: F.char_length(F.btrim(x, F.lit(SPACES))) > 0))
    return rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def _share(num: Column, den: Column) -> Column:
    return F.floor(num * UNIT / den).cast("long")


def metric(name: str) -> Column:
    """A metric as an integer: a share in 10,000ths, or 10,000ths of a character per word."""
    num, den = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
                "repeats": ("n_repeat_words", "n_words"), "word_chars": ("word_chars", "n_words")}[name]
    return _share(F.col(num), F.greatest(F.col(den), F.lit(1)))


#: What one more finding would add: one symbol, one line, one window of words.
ONE_MORE = {"symbols": 1, "dup_lines": 1, "repeats": WINDOW}


def rate(name: str) -> Column:
    """The metric with one more finding in the text, which the sketches hold.  Most texts have none, and their plain shares say nothing
    of what is usual; with one more they show how much a single finding weighs in the texts of a group, so
    that fences follow the group even where it is clean."""
    num, den = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
                "repeats": ("n_repeat_words", "n_words"), "word_chars": ("word_chars", "n_words")}[name]
    more = ONE_MORE.get(name)
    return metric(name) if more is None else _share(F.col(num) + more, F.col(den) + more)


def cell(value: Column) -> Column:
    """The lower bound of a value's sketch cell: its leading bits, a relative error below 1/32."""
    return F.floor(value / width(value)).cast("long") * width(value)


def width(value: Column) -> Column:
    """The width of a value's cell."""
    return F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """One mergeable sketch per (lang, source, metric): counts per cell.  Partial counts are
    summed before the shuffle, and adding counts merges sketches in any order with the same result."""
    named = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), cell(rate(m)).alias("cell")) for m in METRICS]))
    return (rows.where(F.col("n_words") > 0).select("lang", "source", named.alias("m"))
            .groupBy("lang", "source", "m.metric", "m.cell").agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Median, 10th and 90th percentile of each sketch: the first cell whose running count reaches the rank."""
    by = Window.partitionBy(*keys, "metric")
    cells = (sketch.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))
             .withColumn("upto", F.sum("n").over(by.orderBy("cell"))).withColumn("docs", F.sum("n").over(by)))
    at = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("docs") * percent, F.col("cell")))
    return cells.groupBy(*keys, "metric").agg(
        F.max("docs").alias("docs"), at(10).alias("low"), at(50).alias("mid"), at(90).alias("high"))


def fences(sketch: DataFrame) -> DataFrame:
    """Thresholds per (lang, source): metric -> (lower, upper) in one row.

    The upper fence of a metric lies ``spreads`` times the distance from the median to the 90th
    percentile above the median, the lower one likewise below, and at least one cell of the sketch: quantiles alone decide.  Values are
    compared by their cells.
    """
    own, lang = quantiles(sketch, ["lang", "source"]), quantiles(sketch, ["lang"])
    small = F.col("own.docs") < LEAST_GROUP
    pick = lambda c: F.when(small, F.col(f"all.{c}")).otherwise(F.col(f"own.{c}")).alias(c)
    both = own.alias("own").join(lang.alias("all"), F.col("own.lang").eqNullSafe(F.col("all.lang"))
                                 & (F.col("own.metric") == F.col("all.metric"))).select(
        F.col("own.lang").alias("f_lang"), F.col("own.source").alias("f_source"), F.col("own.metric").alias("metric"),
        pick("low"), pick("mid"), pick("high"))
    columns = []
    for m, spreads in UPPER.items():
        fence = F.col("mid") + F.greatest(spreads * (F.col("high") - F.col("mid")), width(F.col("mid")))
        columns.append(F.max(F.when(F.col("metric") == m, fence.cast("double"))).alias(f"upper_{m}"))
    for m, spreads in LOWER.items():
        fence = F.col("mid") - F.greatest(spreads * (F.col("mid") - F.col("low")), width(F.col("mid")))
        columns.append(F.max(F.when(F.col("metric") == m, fence.cast("double"))).alias(f"lower_{m}"))
    return both.groupBy("f_lang", "f_source").agg(*columns)


def quality(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts, base_failed and kept for every row of ``docs``.

    base_failed holds the fixed rule (fewer than 10 words, or over 20 % of them in repeated windows);
    the verdict joins every row with the fences of its language and source.  Null and blank texts
    have no words and fail; null languages and sources are groups of their own; repeated rows are judged
    alike; other columns are ignored; an empty table gives no rows.
    """
    rows = landed(measure(docs, text, doc_id, lang, source), "quality-rows")
    # One row per (lang, source); Spark broadcasts it by its measured size or shuffles it.
    joined = rows.join(fences(sketches(rows)), F.col("lang").eqNullSafe(F.col("f_lang"))
                       & F.col("source").eqNullSafe(F.col("f_source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    good = F.lit(True)
    for m in UPPER:
        good = good & (cell(metric(m)) <= F.col(f"upper_{m}"))
    for m in LOWER:
        good = good & (cell(metric(m)) >= F.col(f"lower_{m}"))
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        *[f"upper_{m}" for m in UPPER], *[f"lower_{m}" for m in LOWER],
        failed.alias("base_failed"), (~failed & F.coalesce(good, F.lit(True))).alias("kept"))
