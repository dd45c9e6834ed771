"""The tokenization automaton against the tokenizers library and against plain merging."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordloom.llm import bpe, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def code():
    with open(FILE, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def ids(data):
    return np.frombuffer(data, dtype="<u4").tolist()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_whole_table(spark, sf, texts, library):
    got = {r.doc_id: r for r in queries.QUERIES["op12_bpe_automaton"](spark, sf).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        row = got[doc_id]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == sha(np.array(want, dtype="<u4").tobytes())
        assert row.decoded_sha256 == sha(library.decode(want, skip_special_tokens=False).encode()) == sha((text or "").encode())


def test_odd_rows(odd, empty, library):
    rows = bpe.encoded(odd, FILE).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert ids(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "") and r.words == "x"
    assert sorted(r.n_tokens for r in bpe.digests(odd, FILE).collect()) == sorted(len(r.ids) // 4 for r in rows)
    assert bpe.encoded(empty, FILE).count() == bpe.digests(empty, FILE).count() == 0


ALPHABET = "ab cde \n\t'sthe0123#-.,!\0\x85 　​\x1c\x1fé한글漢字ख़ि😀Ᲊ࢏՘İß"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=6), st.sampled_from([" the", "  ", "\n\n", " \n", "<|endoftext|>", "ing", "'ll", "aaaa"])), max_size=12).map("".join))
def test_any_text(code, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(code.encode(text)) == want
    assert code.decode(code.encode(text)) == library.decode(want, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["a" * 30_000, "-" * 30_000, " " * 30_000, "ab" * 9_000, "=-" * 9_000, "é" * 9_000])
def test_long_words(code, library, text):
    assert ids(code.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_agreed_characters_are_split_alike(code, library):
    """Each character that the short way takes has the class that the tokenizer's splitter gives it."""
    split = library.pre_tokenizer.pre_tokenize_str
    wrong = []
    for cp in itertools.chain(range(0x3400), range(0x4DA0, 0x4E40), range(0x9FD0, 0xA000), range(0xAC00, 0xD800, 7), range(0xFF00, 0xFFF0), range(0x1F2F0, 0x1F660)):
        c = chr(cp)
        if code.agreed.fullmatch(c):
            probe = f"a{c}a1{c}1#{c}#"
            if [probe[a:b] for _, (a, b) in split(probe)] != code.split.findall(probe):
                wrong.append(hex(cp))
    assert wrong == []


def merged(word, merges):
    """Plain merging: the first rule that applies, everywhere from the left, until none does."""
    rank = {(a, b): i for i, (a, b, _) in enumerate(merges)}
    result = {(a, b): c for a, b, c in merges}
    while True:
        pairs = [(rank[p], i) for i, p in enumerate(itertools.pairwise(word)) if p in rank]
        if not pairs:
            return word
        _, i = min(pairs)
        word = [*word[:i], result[word[i], word[i + 1]], *word[i + 2:]]


def test_automaton_accepts_exactly_the_correct_tokenizations():
    """Random merges over three bytes: of all label sequences of a string, the automaton has one path, that of merging."""
    rng = random.Random(3)
    for _ in range(60):
        pieces, merges, seen = [b"a", b"b", b"c"], [], {b"a", b"b", b"c"}
        for _ in range(rng.randrange(1, 14)):
            u, v = rng.randrange(len(pieces)), rng.randrange(len(pieces))
            if pieces[u] + pieces[v] not in seen and len(pieces[u]) + len(pieces[v]) < 7:
                merges.append((u, v, len(pieces)))
                pieces.append(pieces[u] + pieces[v])
                seen.add(pieces[-1])
        machine = bpe.Automaton(pieces, merges)
        assert len(machine.parent) <= len(merges) + 1

        def paths(rest, state, machine=machine, pieces=pieces):
            if not rest:
                return [[]]
            return [[x, *more] for x, p in enumerate(pieces) if rest.startswith(p) and machine.usable[x] and machine.has(state, x)
                    for more in paths(rest[len(p):], machine.end[x])]

        for _ in range(25):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 11)))
            assert paths(word, bpe.ROOT) == [merged([b"abc".index(c) for c in word], merges)]


def test_full_tables_are_begun_anew(code, library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "ENTRIES", 500)
    for _, text in texts[:60]:
        assert ids(code.encode(text or "")) == library.encode(text or "", add_special_tokens=False).ids


def test_other_definitions_stop():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError, match="byte-level"):
        bpe.Encoder(f.read())
    with pytest.raises(ValueError, match="one merge"):
        bpe.Automaton([b"a", b"b", b"ab", b"aba"], [(2, 0, 3), (0, 1, 2)])
