"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed, once, utf8_lower

WINDOW = 10
#: Tokens of the join are shingles of five words, or of all words of a shorter item.
SHINGLE = 5
#: A word ends at any ASCII character but digits and letters.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many distinct item shingles (8 bytes each) are broadcast; beyond, the join shuffles.
BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(utf8_lower(text), F.lit("")), BREAK), "")


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; none if there are fewer words."""
    n = F.size(words)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))),
                                         lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(F.array().cast("array<long>"))


def windows_of(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """One row per distinct window: window (its words), size, and the items it belongs to."""
    rows = once(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), words=words_of(F.col("text")))
    n = F.size("words")
    size = F.least(n, F.lit(WINDOW))
    starts = F.sequence(F.lit(1), n - size + 1)
    return (rows.where(n > 0)
            .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window"))
            .groupBy("window").agg(F.collect_set("item_id").alias("items"))
            .select("window", "items", F.size("window").alias("size"), F.least(F.size("window"), F.lit(SHINGLE)).alias("token_size")))


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Every row of ``docs`` (whole, in ``row``) with n_words, n_hit, n_items, items_sha256 and hits.

    A window is 10 consecutive words of an item, or all words of a shorter one; ``hits`` are the (start, size) of
    its occurrences, 0-based in words.  The prefix: for whole containment one token of a window must be in the document,
    and the join takes its rarest, by counts over all documents.  A candidate keeps the position it implies for the
    window; that must lie inside the document (length and position bounds), and there all words are compared.

    Null texts have no words; empty items no windows; an item without id marks words but is not counted; rows that share
    a doc_id are each judged by their own text; other columns ride along; empty tables give no hits.
    """
    spark = docs.sparkSession
    windows = landed(windows_of(items, item_id, item_text).withColumn("id", F.xxhash64("window")), "benchmark-windows")
    # Item shingles with their offset in the window; the offset of the first occurrence is enough.
    sizes = sorted(r[0] for r in windows.select("token_size").distinct().collect())  # at most five values
    tokens = None
    for size in sizes:
        one = windows.where(F.col("token_size") == size).select("id", F.posexplode(shingles(F.col("window"), size)).alias("offset", "token"))
        tokens = one if tokens is None else tokens.unionByName(one)
    body = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    if tokens is None:
        hits = spark.createDataFrame([], f"hit_key {dict(body.dtypes)['key']}, found array<struct<id:long,start:int>>")
    else:
        known = tokens.select(F.col("token").alias("known")).distinct()
        count = known.count()
        small = F.broadcast(known) if count <= BROADCAST_SHINGLES else known
        # Each document's shingles leave the row as 8-byte hashes; texts are not shuffled.
        spread = once(body, words=words_of(F.col("text")))
        places = None
        for size in sizes:
            one = spread.select("key", F.posexplode(shingles(F.col("words"), size)).alias("at", "token"))
            places = one if places is None else places.unionByName(one)
        seen = landed(places.join(small, F.col("token") == F.col("known"), "left_semi"), "benchmark-seen")
        rarity = seen.groupBy(F.col("token").alias("r_token")).agg(F.count("*").alias("n"))
        rank = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "offset"))
        prefix = tokens.join(rarity, F.col("token") == F.col("r_token"), "left").withColumn("rank", rank).where(
            (F.col("rank") == 1) & F.col("n").isNotNull()).select(F.col("token").alias("p_token"), "id", "offset")
        if count <= BROADCAST_SHINGLES:  # one row a window: no more than shingles were counted, or a few times as many
            prefix = F.broadcast(prefix)
        hits = (seen.join(prefix, (F.col("token") == F.col("p_token")) & (F.col("at") >= F.col("offset")))
                .groupBy(F.col("key").alias("hit_key"))
                .agg(F.collect_set(F.struct("id", (F.col("at") - F.col("offset")).alias("start"))).alias("found")))
    return verified(docs, text, doc_id, windows, hits)


def verified(docs: DataFrame, text: str, doc_id: str, windows: DataFrame, hits: DataFrame) -> DataFrame:
    """Join candidates with their documents and windows, and compare words."""
    places = hits.select("hit_key", F.explode("found").alias("f")).select("hit_key", "f.id", "f.start")
    # The words of a candidate's window travel to its document.
    wanted = places.join(windows.select(F.col("id").alias("w_id"), "window", "items"), F.col("id") == F.col("w_id")).groupBy("hit_key").agg(
        F.collect_list(F.struct("start", "window", "items")).alias("wanted"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("key"), F.col(text).alias("text"))
    rows = once(whole.join(wanted, F.col("key").eqNullSafe(F.col("hit_key")), "left"), words=words_of(F.col("text")))
    exact = F.filter(F.col("wanted"), lambda h: (h["start"] + F.size(h["window"]) <= F.size("words"))
                     & (F.slice("words", h["start"] + 1, F.size(h["window"])) == h["window"]))
    none = F.array().cast(rows.schema["wanted"].dataType)
    rows = once(rows.select("row", F.size("words").cast("long").alias("n_words"), "wanted", "words"), hits=F.coalesce(exact, none))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + F.size(h["window"]) - 1))))
    items = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))
    names = F.sort_array(F.transform(items, lambda i: i.cast("string")))
    return rows.select(
        "row", "n_words", F.size(covered).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        F.transform("hits", lambda h: F.struct(h["start"].alias("start"), F.size(h["window"]).alias("size"))).alias("hits"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, with all their columns."""
    return contamination(docs, items, text, doc_id).where("n_hit = 0").select("row.*")
