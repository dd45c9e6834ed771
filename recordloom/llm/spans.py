"""Substring deduplication over sliding spans of sentences."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

#: A span is so many consecutive sentences at least, and goes on until it holds so many words.
RUN, RUN_WORDS = 3, 12
#: A longer sentence counts as several: it is cut after every word whose hash is 0 modulo CUT_EVERY, so that pieces
#: inside a passage agree whatever precedes it, and after so many words at the latest.
SENTENCE_WORDS = 12
CUT_EVERY = 8

#: Runs that a batch knows to be repeats are dealt by so many further keys.
SALTS = 64

#: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han are written without spaces: there, each character counts as a word.
UNSPACED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
STOPS = ".!?\u3002\uff01\uff1f"
WORD = re.compile(r"\S+")
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD_OR_CHARACTER = re.compile(f"[{UNSPACED}][^\\s\\w]*|[^\\s{UNSPACED}]+")


def split_words(line: str) -> list[str]:
    """The words of a line in lower case."""
    if line.isascii():
        return line.lower().split()
    return [w.lower() for w in (WORD_OR_CHARACTER.findall(line) if ANY_UNSPACED.search(line) else line.split())]


def pieces(words: list[str]) -> list[tuple[int, int]]:
    """The sentences of a line, as ranges of its words; a long sentence is several.  A sentence ends after '.', '!' or '?' before
    white space, at a line feed, and in a script without spaces after a full stop of its own."""
    out, first = [], 0
    for end, word in enumerate(words, 1):
        if word[-1] in STOPS or end == len(words):
            if end - first <= SENTENCE_WORDS:
                out.append((first, end))
            else:
                at = first
                for i in range(first + 1, end + 1):
                    if i - at == SENTENCE_WORDS or i == end or crc32(words[i - 1].encode("utf-8", "replace")) % CUT_EVERY == 0:
                        out.append((at, i))
                        at = i
            first = end
    return out


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normal form, words) of every sentence; the normal form is its words in lower case with single spaces."""
    out, line_start = [], 0
    for line in text.split("\n"):
        unspaced = not line.isascii() and ANY_UNSPACED.search(line)
        places = [m.span() for m in (WORD_OR_CHARACTER if unspaced else WORD).finditer(line)]
        words = split_words(line)
        out += [(line_start + places[i][0], line_start + places[j - 1][1], " ".join(words[i:j]), j - i) for i, j in pieces(words)]
        line_start += len(line) + 1
    return out


def forms(text: str) -> tuple[list[str], list[int]]:
    """Normal forms and numbers of words of all sentences, as ``sentences`` has them."""
    texts, counts = [], []
    for line in text.split("\n"):
        words = split_words(line)
        for i, j in pieces(words):
            texts.append(" ".join(words[i:j]))
            counts.append(j - i)
    return texts, counts


def run_ends(counts: list[int]) -> list[int]:
    """For each sentence from the first, the end (exclusive) of the shortest run from there that has three sentences and enough
    words; sentences behind the last such run have none.  A text of fewer sentences with enough words is one run."""
    if len(counts) < RUN:
        return [len(counts)] if sum(counts) >= RUN_WORDS else []
    ends, j, words = [], 0, 0
    for i in range(len(counts)):
        while j < len(counts) and (j - i < RUN or words < RUN_WORDS):
            words += counts[j]
            j += 1
        if j - i < RUN or words < RUN_WORDS:
            break
        ends.append(j)
        words -= counts[i]
    return ends


def runs(texts: list[str], counts: list[int]) -> list[bytes]:
    """The 128-bit hash of the shortest run of three sentences or more with enough words, from every sentence that has one."""
    digest, join = xxhash.xxh3_128_digest, "\n".join
    return [digest(join(texts[i:end]).encode("utf-8", "replace")) for i, end in enumerate(run_ends(counts))]


RUNS = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("later", pa.bool_())])


def hash_runs(batches):
    """Runs of all texts.  Of equal runs in one batch all but those in the first place are ``later``: whatever other tasks
    hold, they are not the first of the table.  So a passage that many texts share counts once a batch from here on."""
    for batch in batches:
        hashes: list[bytes] = []
        counts = []
        for text in batch.column("text"):
            own = runs(*forms(text.as_py() or ""))
            hashes += own
            counts.append(len(own))
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        doc = np.repeat(batch.column("doc_id").fill_null(0).to_numpy(), counts)
        none = np.repeat(~known, counts)
        row = np.repeat(batch.column("row").to_numpy(), counts)
        at = np.concatenate([np.arange(n, dtype=np.int32) for n in counts]) if counts else np.zeros(0, dtype=np.int32)
        high, low = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([
            pa.array(high), pa.array(low), pa.array(doc, mask=none), pa.array(row), pa.array(at),
            pa.array(later_places(high, low, none, doc, row, at))], schema=RUNS)


def later_places(high: np.ndarray, low: np.ndarray, *place: np.ndarray) -> np.ndarray:
    """Which of the runs have an equal one in an earlier place."""
    later = np.zeros(len(high), dtype=bool)
    order = np.argsort(high, kind="stable")
    same = high[order][1:] == high[order][:-1]
    among = order[np.flatnonzero(np.append(same, False) | np.append(False, same))]  # most runs are alone and need no full sort
    if len(among):
        among = among[np.lexsort((*[p[among] for p in reversed(place)], low[among], high[among]))]
        start = np.append(True, (high[among][1:] != high[among][:-1]) | (low[among][1:] != low[among][:-1]))
        first = among[np.maximum.accumulate(np.where(start, np.arange(len(among)), 0))]
        later[among] = np.logical_or.reduce([p[among] != p[first] for p in place])
    return later


CUT = pa.schema([("doc_id", pa.int64()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.string()), ("text", pa.string())])


def cut(batches):
    """Remove the sentences covered by the given runs; the white space before a sentence goes with it."""
    for batch in batches:
        out = []
        for doc_id, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                       batch.column("found").to_pylist(), strict=True):
            parts = sentences(text or "")
            ends = run_ends([p[3] for p in parts]) if found else []
            gone = sorted({k for i in found or () for k in range(i, ends[i])})
            spans: list[list[int]] = []
            for i in gone:
                start = parts[i - 1][1] if i else 0
                if spans and spans[-1][1] == start:
                    spans[-1][1] = parts[i][1]
                else:
                    spans.append([start, parts[i][1]])
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            rest = None if text is None else "".join(kept) + text[at:]
            out.append((doc_id, len(parts), len(gone), ",".join(f"{a}:{b}" for a, b in spans), rest))
        cols = list(zip(*out, strict=True)) if out else [[] for _ in CUT]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, CUT, strict=True)], schema=CUT)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row with the text that is left: doc_id, n_sentences, n_removed, removed, text.

    The shortest run of three sentences or more with 12 words is hashed from each sentence; of equal runs in the whole table the first stays (least doc_id, null ids last,
    then the hash of the row's text, then the place) and sentences covered by any other are removed.  ``removed`` are the
    spans cut, as start:end in code points, with the white space before them.  Rows that are equal in id and text
    count as one occurrence and are cut alike.  A text of fewer than three sentences is one run if it has 12 words; null texts stay null;
    other columns are ignored; an empty table gives no rows.

    Runs are made once and shuffled once, by their hash; a rank among equal ones tells the first from the others.  What a batch knows to be
    no first place travels by a salted key, so a passage of any number of texts brings its task one row a batch.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.xxhash64("text"))
    spans = rows.mapInArrow(hash_runs, "high long, low long, doc_id long, row long, at int, later boolean")
    salted = spans.withColumn("salt", F.when(F.col("later"), F.pmod(F.hash("row", "at"), F.lit(SALTS)) + 1).otherwise(0).cast("short"))
    places = Window.partitionBy("high", "low", "salt").orderBy(F.asc_nulls_last("doc_id"), "row", "at")
    again = salted.withColumn("nth", F.rank().over(places)).where(F.col("later") | (F.col("nth") > 1))
    found = again.groupBy(F.col("doc_id").alias("f_doc"), F.col("row").alias("f_row")).agg(F.collect_set("at").alias("found"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_doc")) & F.col("row").eqNullSafe(F.col("f_row")), "left")
    return joined.select("doc_id", "text", "found").mapInArrow(
        cut, "doc_id long, n_sentences long, n_removed long, removed string, text string")
