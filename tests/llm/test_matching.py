"""Operators that compare texts, against brute force over whole tables and odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import decontaminate, ngram_join, queries, spans
from recordloom.llm.ngram_join import Shingler, agree, further_prefixes, least_overlap, prefix_size, shared_blocks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if w else ():
            windows[tuple(w[k:k + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = item_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= {i for i in x if i is not None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()))
    return Counter(out)


def of(df):
    return Counter(tuple(r) for r in df.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256").collect())


def test_contamination_of_whole_tables(spark, sf, con, texts):
    got = queries.QUERIES["op1_decontamination"](spark, sf)
    want = contamination(texts, con.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert Counter(tuple(r)[:5] for r in got.collect()) == want
    assert sum(n for row, n in want.items() if row[2]) > 0


def test_contamination_of_odd_rows(spark, odd, empty):
    items = [(1, "ONE two three four five six seven eight nine ten eleven"), (2, "Привет мир"), (2, "short"), (None, "another text"),
             (3, None), (4, "!!"), (5, "w0x0"), (6, "one two three four five six seven eight nine TEN")]
    table = spark.createDataFrame(items, "item_id long, text string")
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    assert of(decontaminate.contamination(odd, table)) == contamination(pairs, items)
    assert of(decontaminate.contamination(odd, table.where("false"))) == contamination(pairs, [])
    assert decontaminate.contamination(empty, table).count() == 0
    kept = decontaminate.drop_contaminated(odd, table)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None}


def test_contamination_beyond_the_broadcast_bound(spark, sf, monkeypatch):
    query = queries.QUERIES["op1_decontamination"]
    whole = Counter(map(tuple, query(spark, sf).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 1)
    assert Counter(map(tuple, query(spark, sf).collect())) == whole


def test_contamination_runs_no_python(spark, sf):
    plan = queries.QUERIES["op1_decontamination"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


def similar(rows, size, percent):
    """Links by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_links_of_whole_table(spark, sf, texts):
    got = Counter(map(tuple, queries.QUERIES["op8_ngram_jaccard"](spark, sf).collect()))
    assert got == similar(texts, 4, 85)


def test_links_of_odd_rows(odd, empty):
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    for size, percent in ((4, 85), (5, 80), (1, 50)):
        assert Counter(map(tuple, ngram_join.similar(odd, size, percent).collect())) == similar(pairs, size, percent)
    assert ngram_join.similar(empty).count() == 0
    kept = ngram_join.keep_first(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 2, 3, 4, 5, None, 7, 8, 9]) or ids == Counter([1, 2, 3, 4, 5, None, 7, 8]), ids


@pytest.mark.parametrize("rounds", [1, 6])
def test_links_in_chains_and_near_misses(spark, monkeypatch, rounds):
    """A family whose members link along a chain, one just below the threshold, and a common passage."""
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "WORTH_A_ROUND", 0)
    monkeypatch.setattr(ngram_join, "LOCAL_LEAST", 2)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:3 * i // 2], *[f"x{i}" for _ in range(0)], *[f"c{k}" for k in range(3 * i // 2)], *base[3 * i // 2:]])) for i in range(20)]
    rows += [(100 + i, " ".join([*base[:50], *[f"t{i}_{k}" for k in range(7)]])) for i in range(15)]
    rows += [(200 + i, " ".join([f"u{i}_{k}" for k in range(40)] + base[:30])) for i in range(15)]
    rows += [(300 + i, rows[5][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (60, 85):
        assert Counter(map(tuple, ngram_join.similar(df, 4, percent).collect())) == similar(rows, 4, percent)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1), st.integers(50, 95))
def test_prefixes_lose_no_link(a, b, percent):
    import numpy as np

    both = len(a & b)
    if 100 * both >= percent * len(a | b):
        assert both >= max(least_overlap(len(a), percent), least_overlap(len(b), percent))
        x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
        p, q = (np.frombuffer(further_prefixes(v, percent), dtype="<u4") for v in (x, y))
        assert agree(p, len(x), q, len(y), percent)
        assert set(sorted(a)[:prefix_size(len(a), percent)]) & set(sorted(b)[:prefix_size(len(b), percent)])
        first = min(a & b)
        for s in (a, b):  # the position bound
            assert (100 + percent) * (len(s) - sorted(s).index(first)) >= percent * (len(a) + len(b))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=40), st.integers(1, 7))
def test_blocks_over_batch_borders(rows, width):
    import pyarrow as pa

    rows = sorted(rows)
    batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in p], pa.int64()), pa.array([n for _, n in p], pa.int64()),
                                           pa.array([1] * len(p), pa.int32()), pa.array([0] * len(p), pa.int32())], schema=ngram_join.POSTING)
               for p in (rows[i:i + width] for i in range(0, len(rows), width))]
    got = [(t, n) for b in shared_blocks(iter(batches)) for t, n in zip(b["token"].to_pylist(), b["node"].to_pylist())]
    nodes = defaultdict(set)
    for t, n in rows:
        nodes[t].add(n)
    assert got == [(t, n) for t in sorted(nodes) if len(nodes[t]) > 1 for n in sorted(nodes[t])]


def test_shingles_lower_ascii_only():
    s = Shingler(2)
    assert list(s("A b\x0bc")) == list(s("a B C")) and len(s("É b")) == 1 and list(s("É b")) != list(s("é b"))
    assert len(s("a a a a")) == 1 and len(s(" \n")) == 0


def plain_sentences(text):
    """Normal forms and sizes by the rule as it is stated, without the operator's code."""
    out = []
    for line in text.split("\n"):
        sentence = []
        units = re.findall(f"[{spans.UNSPACED}][^\\s\\w]*|[^\\s{spans.UNSPACED}]+", line)
        for k, unit in enumerate(units):
            sentence.append(unit.lower())
            if unit[-1] in ".!?\u3002\uff01\uff1f" or k == len(units) - 1:
                piece = []
                for i, word in enumerate(sentence):
                    piece.append(word)
                    cut = len(sentence) > 12 and (len(piece) == 12 or zlib.crc32(word.encode()) % 8 == 0)
                    if cut or i == len(sentence) - 1:
                        out.append((" ".join(piece), len(piece)))
                        piece = []
                sentence = []
    return out


def repeats(rows):
    """Removed sentences by looking at every run in the order of ids; rows equal in id and text are one occurrence.
    From each sentence the shortest run of three or more with twelve words; a shorter text with twelve words is one run."""
    first, gone = set(), defaultdict(set)
    parts = {(d, t): plain_sentences(t or "") for d, t in rows}
    for key in sorted(parts, key=lambda k: (k[0] is None, k[0] or 0)):
        p = parts[key]
        for i in range(len(p)):
            least = 3 if len(p) >= 3 else len(p)
            end = next((j for j in range(i + least, len(p) + 1) if sum(n for _, n in p[i:j]) >= 12), None)
            if end is None:
                continue
            run = tuple(t for t, _ in p[i:end])
            if run in first:
                gone[key].update(range(i, end))
            first.add(run)
    return {k: (len(parts[k]), len(gone[k])) for k in parts}


def test_spans_of_whole_table(spark, sf, texts):
    got = queries.QUERIES["op10_sentence_spans"](spark, sf).collect()
    want = repeats(texts)
    whole = dict(texts)
    assert {r.doc_id: (r.n_sentences, r.n_removed) for r in got} == {d: v for (d, _), v in want.items()}
    assert sum(r.n_removed for r in got) > 0
    for r in got:  # what is left is the text without the removed spans
        cuts = [tuple(map(int, s.split(":"))) for s in r.removed.split(",") if s]
        left, at = "", 0
        for a, b in cuts:
            left, at = left + whole[r.doc_id][at:a], b
        assert r.text == left + whole[r.doc_id][at:]


def test_spans_of_odd_rows(odd, empty):
    got = spans.remove_repeats(odd).collect()
    assert len(got) == odd.count() and spans.remove_repeats(empty).count() == 0
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.n_removed for r in by[5] if r.text and r.n_sentences == 3] == [0, 0]  # equal rows are one occurrence
    assert by[6][0].text == " More words." and by[6][0].removed == "0:83"
    assert sorted((r.text is None, r.n_removed) for r in by[None]) == [(False, 3), (True, 0)]
    assert by[9][0].n_removed == 3 and by[1][0].text is None and by[2][0].text == "" and by[3][0].text == "  \n\t "


def test_long_sentences_are_cut_alike():
    words = " ".join(f"w{i}" for i in range(60))
    a, b = (spans.runs(*spans.forms(x + words + " end.")) for x in ("Before this. ", "Another start here.\n"))
    assert set(a) & set(b)


def test_both_ways_to_sentences_agree(texts):
    odd = ["a\x0bb\x1cc. d\x85e! ΑΣ. ΣΑΣ' Σ\n İI ẞ. x", "漢字。かな mixed words. ไทย\n\n . ! ", "", " \n ", "One. Two"]
    for text in [t or "" for _, t in texts] + odd:
        forms, counts = spans.forms(text)
        assert [(f, n) for _, _, f, n in spans.sentences(text)] == list(zip(forms, counts, strict=True)) == plain_sentences(text)


def test_short_texts_and_hot_passages(spark, monkeypatch):
    """Texts of one or two sentences; a passage in every text over many batches, equal rows among them."""
    two = "one two three four five six seven eight. nine ten eleven twelve thirteen."
    passage = " ".join(f"All of these know sentence {i} by heart now." for i in range(6))
    rows = [(k, two) for k in range(3)] + [(10, "Too short."), (11, "Too short.")]
    rows += [(100 + k, f"Own start {k} is here. {passage} And an own end {k}.") for k in range(200)] + [(150, f"Own start 50 is here. {passage} And an own end 50.")]
    monkeypatch.setattr(spans, "SALTS", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter((r.doc_id, r.n_sentences, r.n_removed) for r in spans.remove_repeats(df).collect())
    want = repeats(rows)
    assert got == Counter((d, *want[d, t]) for d, t in rows)
    assert [n for (d, _, n) in got if d == 0] == [0] and [n for (d, _, n) in got if d == 2] == [len(spans.sentences(two))]


def test_repeats_of_short_sentences_are_found(spark):
    """Shouted words, and lines of a script without spaces: no three of them have twelve words together."""
    shout = " ".join(f"W{i}!!" for i in range(150))
    han = "\n".join("".join(chr(0x4E00 + (7 * i + k) % 900) for k in range(6)) for i in range(30))
    line = "".join(chr(0x4E00 + (11 * i) % 900) + ("\u3002" if i % 9 == 8 else "") for i in range(90))  # one line, its own full stops
    rows = [(k, t) for k, t in enumerate([shout, shout, han, han, line, line])]
    got = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].n_removed for k in (0, 2, 4)] == [0, 0, 0]
    assert [got[k].text for k in (1, 3, 5)] == ["", "", ""]


@pytest.mark.parametrize("stops", [False, True])
def test_passages_inside_a_sentence_are_found(spark, stops):
    """A passage behind unpunctuated words, three to nine in number, without a stop or with one late stop."""
    words = [f"p{i}" for i in range(66)]
    passage = " ".join(w + "." if stops and i == 40 else w for i, w in enumerate(words))
    rows = [(k, " ".join([*[f"own{k}x{i}" for i in range(k)], passage, *[f"end{k}x{i}" for i in range(9)]])) for k in range(3, 10)]
    got = spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = {r.doc_id: len(set(words) & set(r.text.replace(".", "").split())) for r in got}
    assert left.pop(3) == len(words) and max(left.values()) <= 2 * spans.SENTENCE_WORDS


def test_each_group_keeps_a_row(spark):
    """Different texts without an id, and with one id; the least id of a group may be that of an unrelated text."""
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(30))
    rows = [(None, text(k % 4)) for k in range(8)] + [(5, text(10)), (5, text(11)), (7, text(11)), (9, text(1)), (5, " "), (5, text(10))]
    kept = ngram_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string"), unique_ids=False)
    assert Counter(map(tuple, kept.collect())) == Counter(
        [(None, text(0)), (9, text(1)), (None, text(2)), (None, text(3)), (5, text(10)), (5, text(11)), (5, " ")])
    assert sum(r.doc_id is None for r in ngram_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == 3
