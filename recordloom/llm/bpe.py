"""Byte-level BPE by a tokenization automaton: encoding by table-driven transitions, decoding by the labels of arcs."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .common import ship, worker_memory
from .token_files import Memo

ship(__name__)

#: Fixed value: how the byte-level pre-tokenizer splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that Unicode versions agree on; a text with others is split by the tokenizer's own splitter, which may know other letters.
AGREED = r"[\x00-\u0557\u0590-\u07ff\u0900-\u0bff\u0d00-\u1aaf\u1e00-\u1fff\u2000-\u2064\u20a0-\u20bf\u2100-\u218b\u2190-\u23ff" \
    r"\u2500-\u2bff\u3000-\u312e\u3130-\u31ff\u3400-\u4db5\u4e00-\u9fef\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001f64f]*"
#: A worker remembers the ids of at most twice so many words, and chunks, of at most so many characters.
WORDS, CHUNKS, WORD_CHARACTERS, CHUNK_CHARACTERS = 50_000, 300_000, 48, 64
MARKS = ".,;:!?"
#: Before a blank between two visible characters.
GAP = re.compile(r"(?<=\S)(?= \S)")
#: ... and at most about so many entries of each table; a forgotten entry is found again.
ENTRIES = 600_000
LABEL_BITS = 22
LABEL_MASK = (1 << LABEL_BITS) - 1
#: No state: the automaton has no such arc.
DEAD = -1
ROOT = 0


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 characters for themselves, the
    other bytes, in order, for the characters from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(0x100 + rest.index(b)) for b in range(256)]


class Automaton:
    """A deterministic automaton over labels (pieces of bytes) that accepts exactly the correct tokenizations.

    It begins with one state, the root, and an arc from it to itself for every single byte.  A merge (u, v) adds a gadget:
    where an arc u ends in a state q that has an arc v, a copy of q without that arc becomes the end of u, and
    wherever u leaves, an arc with the new label uv now leads where v led from q.  So a path u, v is replaced by uv and
    nothing else changes.  All arcs of a label end in one state, hence a merge adds at most one state.

    States are kept as what the gadgets did: ``parent`` (the state copied), ``removed`` (the label left out) and ``since`` (the number of
    the merge).  Whether a state has an arc follows from these: a label made at the state's merge or later is there if its left part
    is, one made before as in the state copied, if it is not the one left out.
    """

    def __init__(self, pieces: list[bytes], merges: list[tuple[int, int, int]]):
        """``pieces``: the bytes of each label.  ``merges``: (left, right, result) in order of priority."""
        self.pieces = pieces
        count = len(pieces)
        self.left, self.made, self.end = [DEAD] * count, [DEAD] * count, [ROOT] * count
        self.parent, self.removed, self.since = [ROOT], [DEAD], [DEAD]
        self.usable = [len(p) == 1 for p in pieces]  # labels that an arc has
        ready = list(self.usable)
        # The states of one label's arcs follow each other: ``owner`` is the label, ``base`` where it began, ``cut`` the merge that removed a label there.
        self.owner, self.base, self.cut = [DEAD], [ROOT] * count, {}
        for number, (u, v, w) in enumerate(merges):
            if ready[w] or not (ready[u] and ready[v]):
                raise ValueError("each piece must be made by one merge, from pieces made before")
            ready[w] = True
            if not (self.usable[u] and self.usable[v]):
                continue
            q = self.end[u]
            if not self.has(q, v):  # u, v never stand together: the merge never applies
                continue
            self.left[w], self.made[w], self.usable[w] = u, number, True
            self.end[w] = self.base[w] = self.end[v]
            self.parent.append(q)
            self.removed.append(v)
            self.since.append(number)
            self.owner.append(u)
            self.cut[u * count + v] = number
            self.end[u] = len(self.parent) - 1

    def has(self, state: int, label: int) -> bool:
        """Whether an arc with ``label`` leaves ``state``: the copies it comes from are gone through, those of one owner at once."""
        left, made, cut, count = self.left, self.made, self.cut, len(self.pieces)
        while state != ROOT:
            owner, upto = self.owner[state], self.since[state]
            begun = made[owner]
            while True:
                while made[label] > DEAD and made[label] >= upto:
                    label = left[label]
                if cut.get(owner * count + label, upto + 1) <= upto:
                    return False
                if made[label] <= begun:
                    break
                upto = made[label]
            state = self.base[owner]
        return True


class Encoder:
    """Encoding and decoding by a vocabulary file of a byte-level BPE tokenizer."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model, before = parts["model"], parts["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
               if model.get(k)]
        added = parts["added_tokens"]
        if (model["type"] != "BPE" or odd or parts["normalizer"] or before.get("type") != "ByteLevel" or not before.get("use_regex", True)
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)):
            raise ValueError("a byte-level BPE definition without normalizer and further options is needed")
        self.prefix = bool(before.get("add_prefix_space"))
        letters = {c: b for b, c in enumerate(byte_letters())}
        ids = model["vocab"]
        spell = lambda token: bytes(letters[c] for c in token)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        names = {}  # token to label; labels in the order of ids
        for token in sorted(ids, key=ids.get):
            if all(c in letters for c in token):
                names[token] = len(names)
        self.ids = [ids[t] for t in names]
        self.automaton = Automaton([spell(t) for t in names], [(names[a], names[b], names[a + b]) for a, b in pairs])
        # Labels of arcs by id, to be emitted in decoding; an added token stands for its own text.
        self.text_of = {ids[t]: spell(t) for t in names} | {t["id"]: t["content"].encode() for t in added}
        self.added = {t["content"]: t["id"] for t in added}
        self.apart = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if added else None
        self.split, self.agreed = regex.compile(SPLIT), regex.compile(AGREED)
        self.own_split = ByteLevel(add_prefix_space=False, use_regex=True)
        # The bytes of labels as a table of transitions: from a node by a byte to a node; the label that ends in a node.
        self.step: dict[int, int] = {}
        self.ends: list[int] = [DEAD]
        for label, piece in enumerate(self.automaton.pieces):
            if self.automaton.usable[label]:
                node = 0
                for byte in piece:
                    node = self.step.setdefault(node << 8 | byte, len(self.ends))
                    if node == len(self.ends):
                        self.ends.append(DEAD)
                self.ends[node] = label
        self.nodes = len(self.ends)
        self.goes_on = bytearray(self.nodes)
        for key in self.step:
            self.goes_on[key >> 8] = 1
        self.sizes = [len(p) for p in self.automaton.pieces]
        self.arcs: dict[int, int] = {}
        self.forget()
        self.id_bytes = [array("I", [i]).tobytes() for i in self.ids]
        self.words = Memo(self.word, WORDS)
        self.chunks = Memo(self.chunk, CHUNKS)
        self.chunks[""] = b""
        most = max(self.text_of, default=0)
        self.emitted = [self.text_of.get(i, b"") for i in range(most + 1)]

    def arc(self, state: int, label: int) -> int:
        """The state that ``label`` leads to from ``state``, or DEAD; a row of the table is filled when it is first asked for."""
        key = state * len(self.ids) + label
        end = self.arcs.get(key)
        if end is None:
            if len(self.arcs) >= ENTRIES:
                self.arcs.clear()
            end = self.arcs[key] = self.automaton.end[label] if self.automaton.has(state, label) else DEAD
        return end

    def advance(self, place: int, byte: int) -> int:
        """Fill one entry of the byte table.

        A place in a word is the set of (state, node) of all labels begun so far: the state before the label and how far its bytes
        have come.  Every beginning of a word has exactly one path in the automaton, so at most one of the labels that end with
        this byte has an arc; its end state is where the next label begins.
        """
        begun, label = [], DEAD
        for pair in self.places[place]:
            state, node = divmod(pair, self.nodes)
            node = self.step.get(node << 8 | byte, DEAD)
            if node == DEAD:
                continue
            if label == DEAD and self.ends[node] != DEAD and self.arc(state, self.ends[node]) != DEAD:
                label = self.ends[node]
            if self.goes_on[node]:
                begun.append(state * self.nodes + node)
        if label == DEAD:
            raise ValueError("the vocabulary lacks a byte")
        begun.append(self.automaton.end[label] * self.nodes)
        key = tuple(begun)
        to = self.numbers.get(key)
        if to is None:
            to = self.numbers[key] = len(self.places)
            self.places.append(key)
        entry = self.table[place << 8 | byte] = to << LABEL_BITS | label
        return entry

    def word(self, text: str) -> bytes:
        """The ids of a pre-split word, as little-endian 32-bit numbers: one look at the byte table for each byte, then back
        along the labels that ended last."""
        if len(self.table) >= ENTRIES:
            self.forget()
        look, place, came = self.table.get, 0, []
        data = text.encode()
        for byte in data:
            entry = look(place << 8 | byte)
            if entry is None:
                entry = self.advance(place, byte)
            place = entry >> LABEL_BITS
            came.append(entry & LABEL_MASK)
        out, at, size, ids = [], len(data) - 1, self.sizes, self.id_bytes
        while at >= 0:
            label = came[at]
            out.append(ids[label])
            at -= size[label]
        out.reverse()
        return b"".join(out)

    def forget(self) -> None:
        """Begin the byte table anew; the place of its first row is the beginning of a word."""
        self.places: list[tuple] = [(ROOT * self.nodes,)]
        self.numbers: dict[tuple, int] = {self.places[0]: 0}
        self.table: dict[int, int] = {}

    def chunk(self, text: str) -> bytes:
        """The ids of a text without added tokens, word by word; long words are not remembered."""
        agreed = text.isascii() or self.agreed.fullmatch(text)
        if agreed:
            # Letters behind a blank, and marks behind them, are the common case: the letters are one word, the marks another.
            letters = text.rstrip(MARKS)
            if letters[1:].isalpha() and (letters[0] == " " or letters[0].isalpha()):
                if len(letters) == len(text):
                    return self.word(text)
                return self.chunks[letters] + self.words[text[len(letters):]]
            words = self.split.findall(text)
        else:
            words = [text[a:b] for _, (a, b) in self.own_split.pre_tokenize_str(text)]
        return b"".join([self.words[w] if len(w) <= WORD_CHARACTERS else self.word(w) for w in words])

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens.

        A blank or a line feed between two visible characters begins a pre-split word, so the chunks between them are coded one by one,
        a blank with the chunk behind it and a line feed as a chunk of its own, and frequent chunks are remembered.
        Wherever white space stands together, or at an end, the stretch around it is one chunk.
        """
        if self.prefix and not text.startswith(" "):
            text = " " + text
        seen, between = text.split(), text.count(" ") + text.count("\n")
        if len(seen) == between + 1 and sum(map(len, seen)) + between == len(text) and "\0" not in text:
            chunks = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        else:
            chunks = GAP.split(text)
        known = self.chunks
        return b"".join([known[c] if len(c) <= CHUNK_CHARACTERS else self.chunk(c) for c in chunks])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit; added tokens in it have their own ids."""
        if not text:
            return b""
        if self.apart is None or not any(t in text for t in self.added):
            return self.plain(text)
        out, at = [], 0
        for m in self.apart.finditer(text):
            if at < m.start():
                out.append(self.plain(text[at:m.start()]))
            out.append(array("I", [self.added[m.group()]]).tobytes())
            at = m.end()
        return b"".join([*out, self.plain(text[at:])] if at < len(text) else out)

    def decode(self, ids: bytes) -> str:
        """The text of ids, bytes that are no UTF-8 as U+FFFD: the labels of the path, one after another.  Unknown ids have none."""
        numbers = np.frombuffer(ids, dtype="<u4")
        if len(numbers) and int(numbers.max()) >= len(self.emitted):
            numbers = numbers[numbers < len(self.emitted)]
        return b"".join(map(self.emitted.__getitem__, numbers.tolist())).decode("utf-8", "replace")


def encoder(definition: str) -> Encoder:
    """This worker's encoder; the automaton is compiled once a worker."""
    kept = worker_memory()
    if kept.get("bpe_of") != definition:
        kept["bpe"], kept["bpe_of"] = Encoder(definition), definition
    return kept["bpe"]


CODED = pa.schema([("ids", pa.binary()), ("decoded", pa.string())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encoded(docs: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (binary, little-endian unsigned 32-bit) and decoded (the text of those ids) behind its columns.

    A narrow map over whole texts: nothing is shuffled, and a task holds one batch of Arrow and bounded memories of words and
    transitions.  Null and empty texts have no ids and the decoded text ''; repeated rows are coded alike; columns of ``docs`` named
    ids or decoded are replaced; an empty table gives no rows.
    """
    definition = Path(tokenizer_file).read_text(encoding="utf-8")  # on the driver; executors need no file
    Encoder(definition)  # what the automaton cannot stand for stops here

    kept = [c for c in docs.columns if c not in ("ids", "decoded")]

    def run(batches):
        code = encoder(definition)
        for batch in batches:
            ids = [code.encode(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(ids, pa.binary()), pa.array([code.decode(x) for x in ids], pa.string())],
                names=[*kept, "ids", "decoded"])

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept]
    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(run, ", ".join([*types, "ids binary", "decoded string"]))


def digests(docs: DataFrame, tokenizer_file: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids and decoded texts stay in their task."""
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    Encoder(definition)
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches):
        code = encoder(definition)
        for batch in batches:
            out = []
            for value in batch.column("text"):
                ids = code.encode(value.as_py() or "")
                out.append((len(ids) // 4, sha(ids), sha(code.decode(ids).encode())))
            n, a, b = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], schema=DIGEST)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
