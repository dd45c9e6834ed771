"""Token ids in files: one zstandard frame per document, one shared dictionary, and an index."""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import ship, work_folder, worker_memory

ship(__name__)

END_ID = 1
END_BYTES = np.uint32(END_ID).tobytes()
DICTIONARY_BYTES = 64 * 1024
#: The dictionary is trained on at most so many documents (those with the least hash of their id) of at most so many ids each.
DICTIONARY_DOCS, DICTIONARY_IDS = 2000, 4096
LEVEL = 3
#: A page is a row of the file: frames of consecutive documents up to about so many bytes, and their index.
PAGE_BYTES = 1 << 20
#: A worker remembers the encodings of at most twice so many chunks and words.
CHUNKS, WORDS = 400_000, 20_000
MARKS = ".,;:!?"

PAGE = pa.schema([
    ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("dictionary_sha256", pa.string()), ("payload", pa.binary()), ("n_tokens", pa.int64()),
    ("index", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                                  ("offset", pa.int64()), ("length", pa.int64())])))])
PAGE_TYPE = ("first_doc long, last_doc long, dictionary_sha256 string, payload binary, n_tokens long, "
             "index array<struct<doc_id:long,start:long,n_tokens:long,offset:long,length:long>>")
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def to_bytes(ids: np.ndarray) -> bytes:
    """Ids as their number of bytes (2 or 4) and planes of bytes: all lowest bytes first, and so on."""
    size = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return bytes([size]) + ids.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype("<u4")


class Memo(dict):
    """A dictionary that fills itself by ``make`` and forgets what was not used for a while: when it is full,
    it becomes the old half, from which entries in use are taken over."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Whole texts to ids.

    If the tokenizer's definition is the known one (lower case, white space dropped, words by one pattern, byte-level BPE), it
    never joins across a space or a line feed, so the chunks between them are encoded one by one and remembered, and words of
    visible Latin-1 characters go to the library's BPE model directly.  The ids are those of the whole text.  By any other
    definition whole texts go through the whole tokenizer.
    """

    #: What the short way stands for, as it is written in a tokenizer's definition.
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    STEPS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        steps = ([x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])],
                 [x["type"] for x in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])])
        self.short = (steps == self.STEPS and parts["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": self.WORDS}
                      and parts["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"})
        self.special = [x["content"] for x in parts["added_tokens"]]
        self.visible = regex.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]*")
        self.words = regex.compile(self.WORDS)
        self.model = self.tokenizer.model
        self.alphabet = str.maketrans({chr(i): "".join(map(byte_letter, chr(i).encode())) for i in range(256)})
        self.pieces = Memo(self.piece, WORDS)
        self.chunks = Memo(self.chunk, CHUNKS)
        self.chunks[""] = b""

    def piece(self, word: str) -> bytes:
        """The ids of one word in lower case."""
        letters = word if word.isascii() else word.translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def chunk(self, text: str) -> bytes:
        if not text:
            return b""
        # A word with marks behind it is the common case; letters and marks never share a piece.
        word = text.rstrip(MARKS)
        if word.isalpha() and (word.isascii() or self.visible.fullmatch(word)):
            lower = word.lower()
            if lower == text:
                return self.piece(text)
            return self.chunks[lower] + self.pieces[text[len(word):]] if len(word) < len(text) else self.chunks[lower]
        if self.visible.fullmatch(text) and not any(x in text for x in self.special):
            return b"".join(map(self.pieces.__getitem__, self.words.findall(text.lower())))
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if not self.short:
            return np.frombuffer(self.whole(text) + END_BYTES, dtype="<u4")
        chunks = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join([*map(self.chunks.__getitem__, chunks), END_BYTES]), dtype="<u4")


def byte_letter(byte: int) -> str:
    """The letter that stands for a byte in byte-level BPE: visible Latin-1 characters for themselves, the
    other bytes, in order, for the characters from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return chr(byte) if byte in seen else chr(0x100 + [b for b in range(256) if b not in seen].index(byte))


def encoder(definition: str) -> Encoder:
    """This worker's encoder; loading one costs as much as encoding some hundred documents."""
    kept = worker_memory()
    if kept.get("encoder_of") != definition:
        kept["encoder"], kept["encoder_of"] = Encoder(definition), definition
    return kept["encoder"]


def train_dictionary(docs: DataFrame, definition: str) -> bytes:
    """A dictionary from a bounded sample of serialized id arrays; empty if there is too little to learn from."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(DICTIONARY_DOCS).distinct()
    sample = docs.join(F.broadcast(chosen), docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")

    def arrays(batches):
        encode = encoder(definition)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [to_bytes(encode(t or "")[-DICTIONARY_IDS:]) for t in batch.column("text").to_pylist()], pa.binary())], names=["ids"])

    samples = [bytes(r.ids) for r in sample.select("text").mapInArrow(arrays, "ids binary").limit(DICTIONARY_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def write_tokens(docs: DataFrame, tokenizer_file: str, folder: str, text: str = "text", doc_id: str = "doc_id") -> str:
    """Write every row's ids below ``folder`` in ascending doc_id order (nulls first, ties by text) and return its name.

    ``dictionary`` holds the shared dictionary and its SHA-256; ``pages`` holds rows of frames with the hash
    of the dictionary they need and an index of (doc_id, start, n_tokens, offset, length), so one document
    is read without its neighbours.  Spark's writers commit the files, so a lost executor leaves no half or
    double page, and any store that Spark reads will do.  Texts are dealt by ranges of doc_id: one shuffle.
    A null text is empty: its only id is the end id.
    """
    spark = docs.sparkSession
    definition = Path(tokenizer_file).read_text(encoding="utf-8")  # on the driver; executors need no file
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(rows, definition)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, dictionary)], "sha256 string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def pages(batches):
        encode = encoder(definition)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data:
            data.precompute_compress(level=LEVEL)  # else every document would digest the dictionary again
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)
        index, frames, at, start = [], [], 0, 0

        def page():
            return pa.RecordBatch.from_arrays([
                pa.array([index[0]["doc_id"]], pa.int64()), pa.array([index[-1]["doc_id"]], pa.int64()), pa.array([name]), pa.array([b"".join(frames)], pa.binary()),
                pa.array([sum(x["n_tokens"] for x in index)], pa.int64()), pa.array([index], PAGE.field("index").type)], schema=PAGE)

        for batch in batches:
            for key, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encode(value.as_py() or "")
                frame = squeeze.compress(to_bytes(ids))
                index.append({"doc_id": key.as_py(), "start": start, "n_tokens": len(ids), "offset": at, "length": len(frame)})
                frames.append(frame)
                at, start = at + len(frame), start + len(ids)
                if at >= PAGE_BYTES:
                    yield page()
                    index, frames, at, start = [], [], 0, 0
        if index:
            yield page()

    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = rows.repartitionByRange(int(parts), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    numbered = ordered.mapInArrow(pages, PAGE_TYPE)
    # The page number keeps order among pages that begin with the same (or a null) doc_id.
    numbered.withColumn("page", F.monotonically_increasing_id()).write.parquet(f"{folder}/pages")
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary,
    little-endian unsigned 32-bit).  Frames are checked against the dictionary's hash."""
    stored = spark.read.parquet(f"{folder}/dictionary").first()
    sha, dictionary = stored["sha256"], bytes(stored["data"])
    pages = spark.read.parquet(f"{folder}/pages")
    # One short row a page, some hundred documents each; the running sum is over pages of one part of 2**33 rows, then over parts.
    sizes = pages.select("page", "n_tokens", F.shiftright("page", 33).alias("part"))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select(
        "page", (F.col("first") + F.col("inner")).alias("page_start"))

    def unpack(batches):
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        open_ = zstandard.ZstdDecompressor(dict_data=data)
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("dictionary_sha256")[row].as_py() != sha:
                    raise ValueError("a page was written with another dictionary")
                payload = memoryview(batch.column("payload")[row].as_buffer())
                index = batch.column("index")[row].as_py()
                base = batch.column("page_start")[row].as_py()
                ids = [from_bytes(open_.decompress(payload[x["offset"]:x["offset"] + x["length"]])).tobytes() for x in index]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x["doc_id"] for x in index], pa.int64()), pa.array([base + x["start"] for x in index], pa.int64()),
                    pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(ids, pa.binary())], schema=READ)

    return pages.join(firsts, "page").select("dictionary_sha256", "payload", "index", "page_start").mapInArrow(
        unpack, "doc_id long, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """Ids of one document through the index: only the row groups whose range may hold it are read."""
    stored = spark.read.parquet(f"{folder}/dictionary").first()
    # A page that begins among rows without id has no first one; null ids come first, so its last one bounds it.
    bounds = (F.col("first_doc").isNull() | (F.col("first_doc") <= doc_id)) & (F.col("last_doc") >= doc_id)
    hit = spark.read.parquet(f"{folder}/pages").where(bounds).select(
        "payload", F.explode("index").alias("x")).where(F.col("x.doc_id") == doc_id).select(
        F.substring(F.col("payload"), (F.col("x.offset") + 1).cast("int"), F.col("x.length").cast("int")).alias("frame")).first()
    if hit is None:
        return None
    data = zstandard.ZstdCompressionDict(bytes(stored["data"])) if stored["data"] else None
    return from_bytes(zstandard.ZstdDecompressor(dict_data=data).decompress(bytes(hit["frame"]))).tolist()


def token_folder(spark: SparkSession) -> str:
    return work_folder(spark, "tokens")


def crc32_of_ids(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC of the ids, as read back."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
