"""Ranked lexical search: the Best Position Algorithm over impact lists."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import landed, ship

ship(__name__)

K = 10
#: Items are ranked in blocks of about so many distinct terms or so many items; a block's terms are known to every task.
BLOCK_TERMS, BLOCK_ITEMS = 100_000, 2_000
#: Lists are formed over shards of so many documents or postings, so a task's memory does not follow its input.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 20
#: Positions read from each list in the first round; each later round reads twice as many.
FIRST_READ = 32

# Bytes: capitals become small letters, separators blanks; digits, letters and all bytes of other characters stay.
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(c if c in _LETTERS else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, with repeats."""
    return text.translate(_FOLD).split()


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The bytes of each text, b'' for null."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


# --- impact lists

class Lists:
    """Impact lists of one shard: for each term its documents by falling impact, and, for direct access, by number.

    Documents are numbered by ascending id, so equal impacts (and scores) are in the order of ids.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int):
        """Postings in the order of documents."""
        self.docs = docs
        by_doc = np.argsort(term, kind="stable")
        term, doc, impact = term[by_doc], doc[by_doc], impact[by_doc]
        by_impact = np.lexsort((doc, -impact, term))
        place = np.empty(len(term), dtype=np.int64)
        place[by_impact] = np.arange(len(term))
        known, first = np.unique(term, return_index=True)
        self.range = dict(zip(known.tolist(), pairwise([*first.tolist(), len(term)]), strict=True))
        # By falling impact ...
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        # ... and by document, with the position in the former.
        self.direct_doc, self.direct_impact, self.position = doc, impact, place

    def best(self, terms: list[int], k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the k highest scores, equal ones by number, and the number of positions read.

        Every list is read in its order, some positions a round; a new document's score is completed by direct accesses to all
        lists, and those mark the position at which they find it.  A list's best position is the end of its beginning that is seen
        without a gap; no document yet unseen can have more there than the entry behind it.  Their sum bounds all unseen documents.
        Reading stops when it is strictly below the kth score, or below ``least``: a score that others of the k places have already.
        """
        ranges = [self.range[t] for t in terms if t in self.range]
        seen = [np.zeros(b - a, dtype=bool) for a, b in ranges]
        behind = [0] * len(ranges)
        known = np.zeros(self.docs, dtype=bool)
        top_doc, top_score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth, step, read = 0, FIRST_READ, 0
        while True:
            bound = sum(int(self.impact[a + p]) for (a, b), p in zip(ranges, behind, strict=True) if a + p < b)
            kth = max(least, int(top_score[-1]) if len(top_score) == k else 0)
            if not bound or bound < kth:
                return top_doc, top_score, read
            found = np.concatenate([self.doc[a + depth:min(a + depth + step, b)] for a, b in ranges])
            read += len(found)
            for mark in seen:
                mark[depth:depth + step] = True
            new = np.unique(found)
            new = new[~known[new]]
            known[new] = True
            score = np.zeros(len(new), dtype=np.int64)
            for (a, b), mark in zip(ranges, seen, strict=True):
                own = self.direct_doc[a:b]
                at = np.minimum(np.searchsorted(own, new), b - a - 1)
                hit = own[at] == new
                at = at[hit] + a
                score[hit] += self.direct_impact[at]
                mark[self.position[at] - a] = True
            depth, step = depth + step, step * 2
            for i, mark in enumerate(seen):
                rest = mark[behind[i]:]
                behind[i] += len(rest) if rest.all() else int(rest.argmin())
            top_doc, top_score = np.concatenate([top_doc, new]), np.concatenate([top_score, score])
            if len(top_score) > k:  # all that reach the kth score, then by number
                reach = top_score >= np.partition(top_score, len(top_score) - k)[len(top_score) - k]
                top_doc, top_score = top_doc[reach], top_score[reach]
            order = np.lexsort((top_doc, -top_score))[:k]
            top_doc, top_score = top_doc[order], top_score[order]


# --- tasks

POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
POSTINGS_TYPE = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = pa.schema([("nth", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def count_terms(numbers: dict[bytes, int]):
    def run(batches):
        for batch in batches:
            ns, terms, counts = [], [], []
            for text in utf8(batch.column("text")):
                words = terms_of(text)
                found = Counter(words)
                own = found.keys() & numbers.keys()
                ns.append(len(words))
                terms.append([numbers[t] for t in own])
                counts.append([found[t] for t in own])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ns, pa.int64()), pa.array(terms, POSTINGS.field("terms").type),
                                              pa.array(counts, POSTINGS.field("counts").type)], schema=POSTINGS)

    return run


def impacts(weight: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * count) // (1000 * count + 8 * length))


def rank(items: list[list[int]], weights: np.ndarray, docs: int, words: int, k: int):
    def run(batches):
        best: list[tuple[list, list]] = [([], []) for _ in items]  # of this task so far: ids (None last) and scores

        def search(parts: list[tuple]):
            ids = [i for part in parts for i in part[0]]
            order = np.array(sorted(range(len(ids)), key=lambda j: (ids[j] is None, ids[j] or 0)), dtype=np.int64)
            number = np.empty(len(ids), dtype=np.int64)
            number[order] = np.arange(len(ids))
            sizes = np.concatenate([part[2] for part in parts])
            length = np.array([10 + 90 * n * docs // max(words, 1) for part in parts for n in part[1]], dtype=np.int64)
            term = np.concatenate([part[3] for part in parts]).astype(np.int64)
            count = np.concatenate([part[4] for part in parts]).astype(np.int64)
            row = np.repeat(np.arange(len(ids)), sizes)
            value = impacts(weights[term], count, length[row])
            sort = np.argsort(number[row], kind="stable")
            sort = sort[value[sort] > 0]
            lists = Lists(term[sort], number[row][sort], value[sort], len(ids))
            for item, terms in enumerate(items):
                own_ids, own_scores = best[item]
                least = own_scores[-1] if len(own_scores) == k else 0
                found, scores, _ = lists.best(terms, k, least)
                if len(found):
                    merged = sorted(zip([*own_ids, *(ids[order[d]] for d in found)], [*own_scores, *scores.tolist()], strict=True),
                                    key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
                    best[item] = [x[0] for x in merged], [x[1] for x in merged]

        parts: list[tuple] = []
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                piece = batch.slice(a, 1024)
                terms, counts = piece.column("terms"), piece.column("counts")
                parts.append((piece.column("doc_id").to_pylist(), piece.column("n").to_pylist(), terms.value_lengths().to_numpy(),
                              terms.flatten().to_numpy(), counts.flatten().to_numpy()))
                if sum(len(p[0]) for p in parts) >= SHARD_DOCS or sum(len(p[3]) for p in parts) >= SHARD_POSTINGS:
                    search(parts)
                    parts = []
        if parts:
            search(parts)
        rows = [(i, d, s) for i, (ids, scores) in enumerate(best) for d, s in zip(ids, scores, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(FOUND)], schema=FOUND)

    return run


# --- the operator

def blocks_of(rows: Iterator[Row]) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(item id, distinct terms) in blocks; the driver holds one block and one row."""
    block: list[tuple[object, list[bytes]]] = []
    terms = 0
    for item, text in rows:
        own = sorted(set(terms_of((text or "").encode())))
        if block and (terms + len(own) > BLOCK_TERMS or len(block) == BLOCK_ITEMS):
            yield block
            block, terms = [], 0
        block.append((item, own))
        terms += len(own)
    if block:
        yield block


def weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id", item_text: str = "text",
           item_id: str = "item_id") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's k documents of highest score above 0, equal scores by ascending doc_id.

    One pass over all texts counts the items' terms and writes a short row per document to the shared folder; document frequencies and lengths
    are sums over that table.  A second pass forms impact lists per shard of a partition and runs the Best Position Algorithm for
    every item in it; the kth score of a task's earlier shards lets it stop sooner.  Tasks return at most k rows an item, and
    a window over items keeps k of them.  Nothing but these rows and the counts per term is shuffled.

    Items come to the driver in blocks of at most BLOCK_TERMS terms or one item, and each further block reads the documents again.
    Null texts have no terms; items without terms have no rows; each row of ``docs`` is a document, each row of ``items`` an item, repeated
    ids or not; a null doc_id comes last among equal scores; other columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = dict(items.dtypes)[item_id]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in blocks_of(items.select(item_id, item_text).toLocalIterator()):
        numbers = {t: i for i, t in enumerate(dict.fromkeys(t for _, own in block for t in own))}
        postings = landed(rows.mapInArrow(count_terms(numbers), POSTINGS_TYPE), "postings")
        total = postings.where("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect()  # a row a term of the block
        weights = np.zeros(len(numbers), dtype=np.int64)
        for r in holding:
            weights[r["term"]] = weight(total["docs"], r["n"])
        asked = [[numbers[t] for t in own] for _, own in block]
        found = postings.where(F.size("terms") > 0).mapInArrow(
            rank(asked, weights, total["docs"], total["words"], k), "nth int, doc_id long, score long")
        order = Window.partitionBy("nth").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"of int, item_id {kind}")
        out = out.unionByName(first.join(names, F.col("nth") == F.col("of")).select("item_id", "rank", "doc_id", "score"))
    return out
