"""N-gram Jaccard self-join: candidates must agree under several global token orders."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed, ship

ship(__name__)

#: Tokens counted together in a task; a token met at least LOCAL_LEAST times among them is a candidate for the frequent ones.
CHUNK_TOKENS = 1 << 20
LOCAL_LEAST = 2
#: The most frequent tokens go last in the first order.  Any order gives the same links, so the number only bounds a broadcast.
FREQUENT = 200_000
#: While the pairs left between components outnumber the postings by this factor, and the round before at least halved
#: them, another round of pivots comes first.
WORTH_A_ROUND = 16
PIVOT_ROUNDS = 6
PIVOTS = 3
#: Up to so many document ids (8 bytes each) are broadcast to fetch texts; beyond, texts are shuffled.
BROADCAST_IDS = 1_000_000


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes; words are hashed once and remembered."""

    MEMO = 100_000

    def __init__(self, size: int):
        self.size, self.memo = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower lowers A-Z only, bytes.split cuts at space and \x09 to \x0d.
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        memo = self.memo
        if len(memo) > self.MEMO:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.size, len(words))
        n = len(words) - k + 1
        mixed = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            mixed ^= h[j:j + n]
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def least_overlap(n: int, percent: int) -> int:
    """How many shingles a set of n shares at least with any partner: J >= percent / 100."""
    return -(-percent * n // 100)


def prefix_size(n: int, percent: int) -> int:
    return n - least_overlap(n, percent) + 1


def digest(tokens: np.ndarray) -> int:
    """The node of a set: equal sets are one node.  64 bits tell 10**9 sets apart with a risk of 3 % for a single mix-up."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def further_prefixes(tokens: np.ndarray, percent: int) -> bytes:
    """Prefixes under the second and third order (rising and falling hash), each token cut to 32 bits."""
    p = prefix_size(len(tokens), percent)
    return np.concatenate([tokens[:p], tokens[:-p - 1:-1]]).astype("<u4").tobytes()


def agree(a: np.ndarray, n: int, b: np.ndarray, m: int, percent: int) -> bool:
    """Can sets of n and m tokens link, judged by their further prefixes?

    With at least ``o`` tokens in common, prefixes of n - o + l and m - o + l tokens share l or more under any order.
    Cut tokens can only seem to share more, so no link is lost.
    """
    o = -(-percent * (n + m) // (100 + percent))
    p, q = prefix_size(n, percent), prefix_size(m, percent)
    least = min(p - (n - o), q - (m - o))
    if least < 1:
        return True
    i, j = n - o + least, m - o + least
    return all(int(np.isin(x[:i], y[:j]).sum()) >= least for x, y in ((a[:p], b[:q]), (a[p:], b[q:])))


SEEN = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("prefixes", pa.binary()),
                  ("token", pa.int64()), ("count", pa.int64())])
SEEN_TYPE = "doc_id long, hash long, n long, node long, prefixes binary, token long, count long"


def survey(size: int, percent: int):
    """One row per document (set size, digest, further prefixes), and rows of tokens frequent in a chunk of documents."""

    def run(batches):
        shingler = Shingler(size)
        chunk: list[np.ndarray] = []
        held = 0

        met: set[int] = set()

        def frequent():
            tokens, counts = np.unique(np.concatenate(chunk), return_counts=True)
            many = counts >= LOCAL_LEAST
            k = int(many.sum())
            return pa.RecordBatch.from_arrays([
                *[pa.nulls(k, pa.int64())] * 4, pa.nulls(k, pa.binary()),
                pa.array(tokens[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], schema=SEEN)

        for batch in batches:
            ns, nodes, prefixes = [], [], []
            for text in batch.column("text"):
                tokens = shingler(text.as_py())
                ns.append(len(tokens))
                node = digest(tokens) if len(tokens) else None
                nodes.append(node)
                prefixes.append(further_prefixes(tokens, percent) if len(tokens) else None)
                if node is None or node in met:  # copies make no token frequent
                    continue
                met.add(node)
                chunk.append(tokens)
                held += len(tokens)
                if held >= CHUNK_TOKENS:
                    yield frequent()
                    chunk, held = [], 0
                    met.clear()
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("hash"), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(prefixes, pa.binary()),
                pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=SEEN)
        if held:
            yield frequent()
        pa.default_memory_pool().release_unused()

    return run


POSTING = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])
POSTING_TYPE = "token long, node long, n int, pos int"


def first_prefix(size: int, percent: int, frequent: np.ndarray):
    """Prefix tokens of each document, with their positions, under the first order: rare tokens by hash, then the
    frequent ones by count.

    ``frequent`` is sorted by hash, with ranks beside.  Documents that a task has met before are passed over,
    so a group of copies leaves a task as one document.
    """
    known, ranks = frequent

    def run(batches):
        shingler = Shingler(size)
        met: set[int] = set()
        for batch in batches:
            tokens_out, nodes_out, n_out, pos_out = [], [], [], []
            for text in batch.column("text"):
                tokens = shingler(text.as_py())
                n = len(tokens)
                if not n:
                    continue
                node = digest(tokens)
                if node in met:
                    continue
                if len(met) > 200_000:  # only spares work
                    met.clear()
                met.add(node)
                p = prefix_size(n, percent)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    often = np.where(known[at] == tokens, ranks[at], 0)
                    rare = tokens[often == 0]
                    if len(rare) >= p:
                        chosen = rare[:p]
                    else:
                        late = often > 0
                        chosen = np.concatenate([rare, tokens[late][np.argsort(often[late], kind="stable")]])[:p]
                else:
                    chosen = tokens[:p]
                tokens_out.append(chosen)
                nodes_out.append(np.full(len(chosen), node, dtype=np.int64))
                n_out.append(np.full(len(chosen), n, dtype=np.int32))
                pos_out.append(np.arange(len(chosen), dtype=np.int32))
            if tokens_out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens_out).view(np.int64)), pa.array(np.concatenate(nodes_out)),
                    pa.array(np.concatenate(n_out)), pa.array(np.concatenate(pos_out))], schema=POSTING)

    return run


def shared_blocks(batches):
    """From postings sorted by token and node: those of tokens with two different nodes or more, without repeats.

    Only the last row is carried from batch to batch, so a block of any size passes through.
    """
    last = None  # the last row, and whether it has left already
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in POSTING.names]
        gone = False
        if last is not None:
            rows = [np.concatenate([[x], y]) for x, y in zip(last[0], rows, strict=True)]
            gone = last[1]
        token, node = rows[:2]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        rows = [x[new] for x in rows]
        token = rows[0]
        to_last = np.concatenate([[False], token[1:] == token[:-1]])
        shared = to_last.copy()
        shared[:-1] |= to_last[1:]
        last = ([x[-1] for x in rows], bool(shared[-1]) or (len(token) == 1 and gone))
        if gone:
            shared[0] = False
        if shared.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[shared].astype(f.type.to_pandas_dtype())) for x, f in zip(rows, POSTING, strict=True)], schema=POSTING)


def screen(percent: int):
    """Pairs with their sizes and further prefixes -> the pairs that may link under every order."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("prefixes_a"), batch.column("prefixes_b")
            n, m = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            good = [agree(np.frombuffer(left[i].as_buffer(), dtype="<u4"), n[i],
                          np.frombuffer(right[i].as_buffer(), dtype="<u4"), m[i], percent) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def verify(percent: int):
    """Pairs with their sets -> the pairs that link."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("set_a"), batch.column("set_b")
            good = []
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), dtype="<u8")
                b = np.frombuffer(right[i].as_buffer(), dtype="<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def set_rows(size: int):
    """(node, text) -> (node, its sorted shingles); a text that shares its id with the wanted one is passed over."""

    def run(batches):
        shingler = Shingler(size)
        met: set[int] = set()
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                tokens = shingler(text.as_py()) if node not in met else None
                if tokens is not None and digest(tokens) == node:
                    met.add(node)
                    nodes.append(node)
                    sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): node, root, with the least node of each component as root.

    Alternating large and small stars: every node is joined to the least of its neighbours, first for its larger
    neighbours, then for its smaller ones, until nothing changes.  Each half is one aggregation and one join; a hub's
    neighbours are never in one list.  Each turn is written to the shared folder, which also cuts the lineage.
    """
    now = landed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m_v")).select("m_u", F.least("m_u", "m_v").alias("m"))
        large = both.join(least, F.col("u") == F.col("m_u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("m_u")).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").where("u != v").distinct()
        after = landed(small, "edges")
        # Stars all: no root is anyone's member.
        if after.join(after.select(F.col("u").alias("r")).distinct(), F.col("v") == F.col("r"), "left_semi").isEmpty() and (
                after.select("u").distinct().count() == after.count()):
            roots = after.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        now = after


def similar(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id.

    Sets are distinct ``size``-word shingles (A-Z lowered; a shorter text is one shingle); two rows link when
    100 * intersection >= ``percent`` * union.  component_id is the least doc_id reachable by links.

    Equal sets are one node.  Nodes that may link share a prefix token under every global order: the first order (rare
    before frequent) is a distributed join on tokens, two more orders (rising and falling hash) are tested on each
    candidate pair before its sets are intersected.  Blocks of nodes with a common token are not expanded into
    pairs: nodes are compared with a few pivots first, the links found make components, and only pairs that are left
    between components are compared, so the result equals that of comparing all pairs.

    Null and blank texts have no shingles and their own id; a null doc_id counts as no id (its component has the least
    id of the others, or null); rows with one doc_id are separate texts; other columns are ignored; an empty table gives no rows.
    """
    named, alone = linked(docs, size, percent, text, doc_id)
    # The least id of a hot class comes from partial minima; its rows are joined, never gathered.
    least = named.groupBy(F.col("root").alias("l_root")).agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, F.col("root") == F.col("l_root")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(alone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def linked(docs: DataFrame, size: int, percent: int, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """doc_id, hash of the text, set size and root of every row with words, and the rows without words."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    seen = landed(rows.mapInArrow(survey(size, percent), SEEN_TYPE), "ngram-survey")
    sets = seen.where("token is null").select("doc_id", "hash", "n", "node", "prefixes")
    top = (seen.where("token is not null").groupBy("token").agg(F.sum("count").alias("n"))
           .orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas())
    by_count = top["token"].to_numpy(dtype=np.int64).view(np.uint64)[::-1]  # the most frequent last
    by_hash = np.argsort(by_count)
    postings = rows.mapInArrow(first_prefix(size, percent, (by_count[by_hash], (by_hash + 1).astype(np.int32))), POSTING_TYPE)
    blocks = landed(postings.repartition("token").sortWithinPartitions("token", "node").mapInArrow(
        shared_blocks, POSTING_TYPE), "ngram-blocks")
    roots = linked_nodes(rows, sets, blocks, size, percent)
    named = sets.where("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return named, sets.where("n = 0")


def with_roots(blocks: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return blocks.withColumn("root", F.col("node"))
    return blocks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def may_link(percent: int):
    """The length and position bounds on sets of n and m tokens whose first common token stands at ``pos`` and
    ``other_pos``: what comes from there on must suffice for the overlap that the threshold asks of both."""
    least = percent * (F.col("n") + F.col("m"))
    return ((100 + percent) * (F.col("n") - F.col("pos")) >= least) & ((100 + percent) * (F.col("m") - F.col("other_pos")) >= least)


def ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def pivot_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member of a block with a few others: linear in the block.  Chosen are the members with the fewest rare tokens
    before the block's (the middle of a family of near copies), ties by a hash of this turn."""
    chosen = members.groupBy(F.col("token").alias("p_token")).agg(F.array(*[
        F.min(F.struct(F.col("pos").alias("other_pos"), F.xxhash64("node", F.lit(turn * PIVOTS + k)).alias("h"), F.col("node").alias("other"),
                       F.col("n").alias("m"), F.col("root").alias("other_root"))) for k in range(PIVOTS if turn else 1)]).alias("pivots"))
    pivots = chosen.select("p_token", F.explode(F.array_distinct("pivots")).alias("p")).select(
        "p_token", "p.other", "p.m", "p.other_pos", "p.other_root")
    return ordered_pairs(members.join(pivots, (F.col("token") == F.col("p_token")) & (F.col("root") != F.col("other_root"))
                                      & may_link(percent)))


def split_blocks(members: DataFrame) -> DataFrame:
    """Blocks with more than one component: token, their largest component, how many members there are and how many outside it."""
    return members.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy(F.col("token").alias("s_token")).agg(
        F.max(F.struct("k", "root")).alias("most"), F.sum("k").alias("size"), F.count("*").alias("roots")).where("roots > 1").select(
        "s_token", F.col("most.root").alias("main"), "size", (F.col("size") - F.col("most.k")).alias("outside"))


def pairs_between(members: DataFrame, split: DataFrame, percent: int) -> DataFrame:
    """All pairs of a block that lie in different components.  Members outside the block's largest component are
    compared with all others; inside it, nothing is."""
    here = members.join(split.select("s_token", "main"), F.col("token") == F.col("s_token")).drop("s_token")
    others = here.select(F.col("token").alias("o_token"), F.col("node").alias("other"), F.col("n").alias("m"),
                         F.col("pos").alias("other_pos"), F.col("root").alias("other_root"), (F.col("root") == F.col("main")).alias("other_main"))
    return ordered_pairs(here.where("root != main").join(others, (F.col("token") == F.col("o_token")) & (
        F.col("root") != F.col("other_root")) & (F.col("other_main") | (F.col("node") < F.col("other"))) & may_link(percent)))


def checked(pairs: DataFrame, rows: DataFrame, profiles: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that link.  First all orders must agree, on prefixes alone; only for the pairs left, texts are
    read again and whole sets compared."""
    a, b = (profiles.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("prefixes").alias(f"prefixes_{x}")) for x in "ab")
    left = landed(pairs.join(a, "a").join(b, "b").mapInArrow(screen(percent), "a long, b long"), "ngram-screened")
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = landed(nodes.join(profiles.select("node", "w_id"), "node"), "ngram-wanted")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = rows.join(few, F.col("doc_id").eqNullSafe(F.col("w_id"))).select("node", "text")
    tokens = landed(texts.mapInArrow(set_rows(size), "node long, tokens binary"), "ngram-sets")
    set_a, set_b = (tokens.select(F.col("node").alias(x), F.col("tokens").alias(f"set_{x}")) for x in "ab")
    return landed(left.join(set_a, "a").join(set_b, "b").mapInArrow(verify(percent), "a long, b long"), "ngram-links")


def linked_nodes(rows: DataFrame, sets: DataFrame, blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Components over nodes: (node, root) for every node with a link."""
    # One row per node; any row of a node has its prefixes, the least id is where its text is read.
    profiles = landed(sets.where("n > 0").join(blocks.select("node").distinct(), "node", "left_semi").groupBy("node", "n", "prefixes")
                      .agg(F.min("doc_id").alias("w_id")), "ngram-profiles")
    postings, tried, edges, roots, before = blocks.count(), None, None, None, None
    for turn in range(PIVOT_ROUNDS + 1):
        members = with_roots(blocks, roots)
        split = landed(split_blocks(members), "ngram-split")
        work = split.agg(F.sum(F.col("outside") * F.col("size"))).first()[0] or 0
        if not work:
            break
        final = turn == PIVOT_ROUNDS or (turn > 0 and (work <= WORTH_A_ROUND * postings or 2 * work > before))
        before = work
        here = members.join(split.select(F.col("s_token").alias("token")), "token", "left_semi")
        pairs = pairs_between(members, split, percent) if final else pivot_pairs(here, turn, percent)
        pairs = landed(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
        found = checked(pairs, rows, profiles, size, percent)
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            roots = landed(components(edges), "ngram-roots")
        if final:
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
    return rows.sparkSession.createDataFrame([], "node long, root long") if roots is None else roots


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", unique_ids: bool = True) -> DataFrame:
    """One row of each group of similar texts, with all columns of ``docs``; rows without words all stay.

    It is the one with the least doc_id (null ids last), then the least hash of its text, and of equal rows one.  With ``unique_ids`` an id is
    that of one text: of several groups whose first rows share an id (null is none) only the one with the least hash is kept.
    """
    named, _ = linked(docs, size, percent, text, doc_id)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("f_key"), F.col("hash").alias("f_hash"))
    firsts = named.groupBy("root").agg(F.min(first).alias("f")).select("f.f_key", "f.f_hash")
    if unique_ids:
        shared = firsts.groupBy("f_key").agg(F.min("f_hash").alias("f_hash")).where("f_key is not null")
        firsts = shared.unionByName(firsts.where("f_key is null"))
    key = F.col(doc_id).cast("long")
    words = F.col(text).isNotNull() & (F.char_length(F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))) > 0)
    whole = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), F.xxhash64(text).alias("hash"), words.alias("words"))
    kept = whole.where("words").join(firsts, F.col("key").eqNullSafe(F.col("f_key")) & (F.col("hash") == F.col("f_hash")), "left_semi")
    # Equal rows collapse in partial aggregates before the shuffle.
    return kept.dropDuplicates(["key", "hash"]).select("row.*").unionByName(whole.where(~F.col("words")).select("row.*"))
