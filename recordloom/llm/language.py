"""Language labels for spans of words: script ranges, word scores, and Viterbi over languages."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_fold, ship

ship(__name__)

#: At most so many labelled documents teach the model (whole texts, those with the least hash of their id).
TRAIN_DOCS = 6000
#: Letter n-grams of 1 to 4 letters are counted in so many hashed cells for each language.
CELLS = 1 << 17  # the hash keeps 64 - 47 bits
SMOOTH = 0.5
#: What a change of language costs, in nats.  One odd word does not pay for it, several do.
SWITCH = 8.0
#: No single word counts for more than this between two languages.
WORD_BOUND = 6.0
#: The memory of word scores in a task is emptied at so many words.
MEMO = 150_000
#: A padded block of Viterbi holds at most so many words.
BLOCK_WORDS = 400_000

WORD = re.compile(r"[^\W\d_]+")
#: Script ranges by first and last code point.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
)


def script(word: str) -> str:
    c = ord(word[0])
    return next((name for name, first, last in SCRIPTS if first <= c <= last), "other")


SCRIPT_NAMES = ["other", *dict.fromkeys(s[0] for s in SCRIPTS)]


def gram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, cell) of every letter n-gram, for many words at once.  Words are laid end to end with their
    ends marked, n-grams of 2 to 5 bytes are hashed by multiplication, and those across two words are left out."""
    raw = [f"<{w}>".encode() for w in words]
    sizes = np.array([len(x) for x in raw])
    text = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), sizes)
    owners, cells = [], []
    h = text
    for n in range(2, 6):
        if len(text) < n:
            break
        h = h[:-1] * np.uint64(0x100000001B3) + text[n - 1:]
        inside = owner[:len(h)] == owner[n - 1:]
        owners.append(owner[:len(h)][inside])
        cells.append(((h[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(cells)


def count_grams(batches):
    """Per batch: counts of (lang, cell), and of (lang, script) as negative cells."""
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).extend(w.lower() for w in WORD.findall(text or ""))
        langs, cells, counts = [], [], []
        for lang, words in by_lang.items():
            if not words:
                continue
            n = np.bincount(gram_cells(words)[1], minlength=CELLS)
            kinds = np.bincount([SCRIPT_NAMES.index(script(w)) for w in words], minlength=len(SCRIPT_NAMES))
            for first, step, found in ((0, 1, n), (-1, -1, kinds)):
                at = np.flatnonzero(found)
                langs += [lang] * len(at)
                cells.append(first + step * at)
                counts.append(found[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate([*cells, np.empty(0, dtype=np.int64)])),
             pa.array(np.concatenate([*counts, np.empty(0, dtype=np.int64)]))], names=["lang", "cell", "n"])


class Model:
    """Log likelihoods of hashed n-grams per language, and the languages each script allows."""

    def __init__(self, langs: list[str], table: np.ndarray, allowed: dict[str, np.ndarray]):
        self.langs, self.table, self.allowed = langs, table, allowed

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words relative to their best language; zeros for a word in a script that no language uses."""
        if not words:
            return np.zeros((0, len(self.langs)), dtype=np.float32)
        low = [w.lower() for w in words]
        owner, cell = gram_cells(low)
        scores = np.stack([np.bincount(owner, weights=self.table[cell, k], minlength=len(low)) for k in range(len(self.langs))], axis=1)
        ok = np.array([self.allowed[script(w)] for w in low])
        scores = np.where(ok, scores, -np.inf)
        known = ok.any(axis=1, keepdims=True)
        best = np.where(known, scores.max(axis=1, keepdims=True), 0)
        return np.where(known, np.maximum(scores - best, -WORD_BOUND), 0).astype(np.float32)


def train(docs: DataFrame, limit: int = TRAIN_DOCS, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Fit on at most ``limit`` labelled documents outside the held-out fold; counting runs on the
    executors, and the driver receives at most languages x (cells + scripts) counts."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~check_fold(F.col("doc_id")))
    # The limit is applied to ids, so that whole texts are not sorted.
    chosen = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).distinct()
    sample = rows.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")
    counts = sample.mapInArrow(count_grams, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    langs = sorted(found["lang"].unique())
    names = SCRIPT_NAMES
    table = np.full((CELLS, len(langs)), SMOOTH, dtype=np.float64)
    scripts = np.zeros((len(names), len(langs)))
    if langs:
        col = found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
        cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
        g = cell >= 0
        table[cell[g], col[g]] += n[g]
        scripts[-1 - cell[~g], col[~g]] += n[~g]
    table = np.log(table / table.sum(axis=0)).astype(np.float32)
    # A script is allowed for a language that writes a hundredth of its words in it.
    allowed = {s: scripts[i] >= 0.01 * np.maximum(scripts.sum(axis=0), 1) for i, s in enumerate(names)}
    return Model(langs, table, allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels for a padded block (documents x words x languages), all documents at once."""
    docs, steps, langs = scores.shape
    stay = np.empty((steps, docs, langs), dtype=bool)
    best = np.empty((steps, docs), dtype=np.int16)
    v = np.zeros((docs, langs), dtype=np.float32)
    for t in range(steps):
        top = v.argmax(axis=1)
        best[t] = top
        jump = v[np.arange(docs), top] - SWITCH
        stay[t] = v >= jump[:, None]
        v = np.maximum(v, jump[:, None])
        live = lengths > t
        v[live] += scores[live, t]
    labels = np.empty((docs, steps), dtype=np.int16)
    at = v.argmax(axis=1)
    rows = np.arange(docs)
    for t in range(steps - 1, -1, -1):
        labels[:, t] = at
        at = np.where(stay[t, rows, at], at, best[t])
    return labels


def blocks(work: list) -> list[list]:
    """Documents of like length together, each block bounded in padded size."""
    out: list[list] = []
    for item in sorted(work, key=lambda x: len(x[1])):
        if out and (len(out[-1]) + 1) * len(item[1]) <= BLOCK_WORDS:
            out[-1].append(item)
        else:
            out.append([item])
    return out


def spans_of(labels: np.ndarray, text: str, last_word: str, langs: list[str]) -> str:
    """Runs of equal labels as lang:start:end in code points, comma-joined."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    if not len(cuts):  # no letter follows the last word, so its last occurrence is it
        return f"{langs[labels[0]]}:{WORD.search(text).start()}:{text.rfind(last_word) + len(last_word)}"
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(labels)]]) - 1
    wanted = {*first.tolist(), *last.tolist()}
    places = {i: m.span() for i, m in enumerate(WORD.finditer(text)) if i in wanted}
    return ",".join(f"{langs[labels[a]]}:{places[a][0]}:{places[b][1]}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


def decide(model: Model, known: np.ndarray, work: list):
    """(row, language, score, spans) for documents given as (row, word numbers, word lengths, text, last word)."""
    langs = model.langs
    for block in blocks(work):
        lengths = np.array([len(x[1]) for x in block])
        scores = np.zeros((len(block), lengths.max(), len(langs)), dtype=np.float32)
        for k, x in enumerate(block):
            scores[k, :lengths[k]] = known[x[1]]
        labels = viterbi(scores, lengths)
        for k, (row, words, sizes, text, last_word) in enumerate(block):
            own = labels[k, :len(words)]
            letters = np.bincount(own, weights=sizes, minlength=len(langs))
            best = int(letters.argmax())
            # How sure: the share of letters in spans of that language, times its posterior in those spans.
            total = scores[k, :len(words)][own == best].sum(axis=0, dtype=np.float64)
            posterior = 1.0 / np.exp(np.minimum(total - total[best], 700.0)).sum()
            yield row, langs[best], float(letters[best] / letters.sum() * posterior), spans_of(own, text, last_word, langs)


class Numbers(dict):
    """Word -> number, given out in order; ``fresh`` lists the words that have no scores yet.  Number 0 is no word's."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) + 1
        self.fresh.append(word)
        return number


def label(model: Model):
    """A ``mapInArrow`` function: the language of each document and of its spans.

    Words are numbered as they come; new ones are scored together, and so many words make one turn of Viterbi.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.string())])

    def run(batches):
        memo, known = Numbers(), np.zeros((1, len(model.langs)), dtype=np.float32)
        for batch in batches:
            ids, out, work, held = batch.column("doc_id").to_pylist(), [], [], 0

            def turn(work):
                nonlocal memo, known
                known = np.concatenate([known, model.words(memo.fresh)])
                memo.fresh = []
                out.extend(decide(model, known, work))
                if len(memo) > MEMO:
                    memo, known = Numbers(), known[:1]

            for i, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                words = WORD.findall(text)
                if not words or not model.langs:
                    out.append((i, "und", 0.0, ""))
                    continue
                work.append((i, np.fromiter(map(memo.__getitem__, words), dtype=np.int32, count=len(words)),
                             np.fromiter(map(len, words), dtype=np.int32, count=len(words)), text, words[-1]))
                held += len(words)
                if held >= BLOCK_WORDS:
                    turn(work)
                    work, held = [], 0
            if work:
                turn(work)
            out.sort(key=lambda x: x[0])
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in cols[0]], pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols[1:], list(schema)[1:], strict=True)]],
                schema=schema)
        pa.default_memory_pool().release_unused()

    return run


def identify(docs: DataFrame, model: Model | None = None, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """Language of every row and of its spans: doc_id, held_out, lang_pred, score, spans.

    A word's script first narrows the languages; letter n-grams score it among those; Viterbi with a
    cost per change of language joins words to spans, and the language with most letters is the
    document's.  ``und`` with score 0 for null texts, texts without a letter, and when there is nothing
    to learn from.  Words in a script that no learned language uses tell nothing; if all are such, the first
    learned language is named with the score of a guess.  Repeated rows give equal results; other columns are ignored.
    """
    fitted = train(docs, text=text, lang=lang, doc_id=doc_id) if model is None else model
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(label(fitted), "doc_id long, lang_pred string, score double, spans string")
    return out.select("doc_id", check_fold(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
