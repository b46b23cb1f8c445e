"""Near-duplicates by shingle sets: a similarity join over chosen paths.

Documents with equal sets are one set. Each of ``TREES`` independent trees branches the sets: a node selects one minwise
function, a second one with probability 1 / similarity - 1, and sends each set to the child of its minwise token. Two sets of
the least similarity thus share one child on average, while unlike sets part. The nodes at DEPTH are the leaves. A pair meets in
a leaf of a tree with probability similarity^DEPTH at least; ``TREES`` is the number of trees that brings pairs at the threshold
to RECALL. Pairs more alike do better. Every set has a bounded number of leaves, dealt out once.

The tokens come from a signature of TREES * DEPTH minwise values, DEPTH of its own for each tree. In a leaf the signatures' low
bytes tell which sets are alike: nine of sixteen equal ones, which a pair at the threshold misses with a probability under
10^-8. Sets that are alike, directly or through others, are a cluster. Only sets of clusters are looked up in full, and each is
sent to its own cluster once, however many trees it met others in. Links are confirmed on full sets, block against block of up
to SMALL sets or WEIGHT shingles, without exception.

Clusters of more than BLOCKS blocks, and leaves too large to compare signatures in, are compared leaf by leaf, and only between
sets that are not in one class already: the trees are taken in batches (BATCHES), and after each batch the classes so far are
the labels of the next. A node whose sets have one label needs no comparison, so a large group of near copies is settled by a
few links a member:

* A node of more than SMALL sets, or more than WEIGHT shingles, is dealt into blocks of that size; its pivot, one set, joins
  every block. Each block is compared exhaustively, so its links are at most its members.
* If labels still differ, the node is branched on, with minwise functions drawn from the node over the full sets, up to
  LEVELS times. What is crowded even then is compared block against block, without exception.

Sets are sorted 64-bit hashes of shingles, compared in full; 2^-64 times the product of two sizes bounds the chance of one
wrong element. Equal sets are found by 128 bits.

Defined cases: null and empty texts and texts without words have an empty set and are linked with nothing (their component is
their own id); texts of fewer words have one shingle; copies and repeated rows share a component; without any id in a component
it is null; a document without an id is kept only in such a component; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.arrow import LOWER, by_batch, utf8
from tillbook.llm.components import stars
from tillbook.operators.core import keep_one
from tillbook.session import stage

SHINGLE, PERCENT = 5, 85
DEPTH, RECALL = 4, 1 - 1e-6
SMALL, WEIGHT, LEVELS = 256, 2_000_000, 12
#: Blocks of a cluster that is compared as a whole, and of a leaf whose signatures are.
BLOCKS = 16
#: Trees of each batch; the last takes the rest.
BATCHES = (1, 3)
#: The low bits of a leaf's number are its tree.
TREE_BITS = 5
#: Bits of the table of wanted texts: so many for each, 16 MB at most.
BITS_EACH, MIN_BITS, MAX_BITS = 16, 1 << 15, 1 << 27
#: Texts, and bytes of them, worked on at a time.
ROWS, BYTES = 500, 1_000_000
#: Shingles hashed at a time by all functions of a signature.
CHUNK = 2048


def recall(similarity: float, trees: int, depth: int) -> float:
    """Least probability that two sets share a node at this depth of one of the trees."""
    return 1 - (1 - similarity**depth) ** trees


def trees_for(target: float, depth: int, percent: int = PERCENT) -> int:
    """Trees that give pairs at the threshold this recall."""
    return math.ceil(math.log(1 - target) / math.log(1 - (percent / 100) ** depth))


TREES = trees_for(RECALL, DEPTH)
COORDINATES = TREES * DEPTH
#: Equal low bytes of two signatures, of COORDINATES, from which their sets are compared; seven deviations below the mean at the threshold.
LIKE = COORDINATES * 9 // 16


# --- Sets and hashes -------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of n minwise functions."""
    return _numbers(n, 11) | np.uint64(1), _numbers(n, 12)


#: Of byte values: white space, and their numbers in word hashes.
SPACE = np.array([c in b" \t\n\x0b\x0c\r" for c in range(256)])
BYTE = _numbers(256, 9)
FACTOR = 0x9E3779B97F4A7C15 | 1


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts in turn, and where each text's words begin and the last one's end.

    A word's hash is a polynomial in its bytes' numbers, modulo 2^64, so it is one sum over the word.
    """
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    joined = b"\n".join([*texts, b""]).translate(LOWER)
    found, words = [], []
    for at, end in _blocks(joined):
        raw = np.frombuffer(joined, np.uint8, end - at, at)
        space = SPACE[raw]
        edges = np.r_[0, np.flatnonzero(space[1:] != space[:-1]) + 1]
        place = np.arange(len(raw)) - np.repeat(edges, np.diff(edges, append=len(raw)))
        powers = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), FACTOR, np.uint64)])
        sums = np.add.reduceat(BYTE[raw] * powers[place], edges)
        odd = slice(int(space[0]), None, 2)  # words and white space take turns
        found.append(sums[odd])
        words.append(edges[odd] + at)
    where = np.concatenate(words)
    return mix(np.concatenate(found)), np.searchsorted(where, starts)


def _blocks(joined: bytes) -> Iterator[tuple[int, int]]:
    """Limits of blocks of about BYTES bytes that begin and end between words."""
    at = 0
    while at < len(joined):
        end = min(at + BYTES, len(joined))
        while end < len(joined) and not SPACE[joined[end]]:
            end += 1
        yield at, end
        at = end


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    h, limits = word_hashes(texts)
    full = _shingles(h, size) if len(h) >= size else np.empty(0, np.uint64)
    for start, end in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        if end - start >= size:
            yield np.unique(full[start : end - size + 1])
        else:
            yield _shingles(h[start:end], end - start) if end > start else np.empty(0, np.uint64)


def _shingles(h: np.ndarray, size: int) -> np.ndarray:
    factors = _numbers(size, 5) | np.uint64(1)
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total += h[k : len(h) - size + 1 + k] * factors[k]
    return mix(total)


def by_pieces(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches in pieces of up to ROWS rows and about BYTES bytes of text, with their texts."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = utf8(batch.column(text).slice(at, ROWS))
            n = max(1, int(np.searchsorted(np.cumsum([len(t) for t in piece]), BYTES)))
            yield batch.slice(at, min(n, len(piece))), piece[:n]
            at += n


def signature(items: np.ndarray, multipliers: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The upper half of each function's smallest value."""
    least = np.full(len(masks), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), CHUNK):
        part = (items[None, at : at + CHUNK] ^ masks[:, None]) * multipliers[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("key")


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """docs (doc_id, key, text) -> (doc_id, key, n, rep, sig): the set's size, its 128-bit name and its signature."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(COORDINATES)
        for batch, texts in by_pieces(batches, 2):
            made = [(len(x), xxhash.xxh3_128_digest(x.tobytes()), signature(x, *functions).tobytes()) for x in shingle_sets(texts, size)]
            n, rep, sig = zip(*made, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(rep, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "key", "n", "rep", "sig"]
            )

    return docs.mapInArrow(rows, f"doc_id {kind}, key binary, n long, rep binary, sig binary")


# --- Branching -------------------------------------------------------------------

#: Free coordinates of a tree for each mask of used ones.
FREE = [[c for c in range(DEPTH) if not used >> c & 1] for used in range(1 << DEPTH)]


def _second(r: np.ndarray, percent: int) -> np.ndarray:
    return (r >> np.uint64(40)).astype(np.float64) < (100 / percent - 1) * (1 << 24)


def children(tree: np.ndarray, used: np.ndarray, node: np.ndarray, values: np.ndarray, percent: int) -> tuple:
    """(row, used, node) of the children of rows whose signatures are values."""
    out = []
    r = mix(node + np.uint64(1))
    free = np.array([f + [0] * (DEPTH - len(f)) for f in FREE])
    n_free = DEPTH - np.array([u.bit_count() for u in range(1 << DEPTH)])[used]
    first = (r >> np.uint64(8)).astype(np.int64) % n_free
    step = 1 + (r >> np.uint64(24)).astype(np.int64) % np.maximum(1, n_free - 1)
    for at, rows in ((first, np.arange(len(node))), ((first + step) % n_free, np.flatnonzero(_second(r, percent) & (n_free > 1)))):
        c = free[used[rows], at[rows]]
        token = values[rows, tree[rows] * DEPTH + c].astype(np.uint64)
        out.append((rows, used[rows] | (1 << c), mix(mix(node[rows] ^ (c + 1).astype(np.uint64)) + token)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _values(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def leaves(reps: DataFrame, percent: int) -> DataFrame:
    """reps (id, sig) -> (node, id): the nodes of every tree at DEPTH."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values, n = _values(part.column(1), COORDINATES, np.uint32), part.num_rows
                tree, at = np.tile(np.arange(TREES), n), np.repeat(np.arange(n), TREES)
                used, node = np.zeros(n * TREES, np.int64), mix(tree.astype(np.uint64) + np.uint64(1))
                for _ in range(DEPTH):
                    own, used, node = children(tree, used, node, values[at], percent)
                    tree, at = tree[own], at[own]
                numbers = (node >> np.uint64(TREE_BITS) << np.uint64(TREE_BITS)) | tree.astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), part.column(0).take(pa.array(at))], names=["node", "id"])

    return reps.select("id", "sig").mapInArrow(rows, "node long, id long")


def next_nodes_of_sets(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """rows (node, rep) one level down, by minwise functions over the full sets; a set has a bounded number of nodes."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, nodes = [], []
        for k, (own, items) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            own, items = np.array(own, np.int64).view(np.uint64), np.frombuffer(items, np.uint64)
            twice = own[_second(mix(own + np.uint64(1)), percent)]
            drawn = mix(np.concatenate([own + np.uint64(2), twice + np.uint64(3)]))
            token = np.array([((items ^ mask) * factor).min() for mask, factor in zip(drawn, mix(drawn) | np.uint64(1), strict=True)], np.uint64)
            at += [k] * len(drawn)
            nodes.append(mix(drawn + token))
        node = np.concatenate(nodes) if nodes else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), batch.column(0).take(pa.array(at, pa.int64())), batch.column(3).take(pa.array(at, pa.int64()))], names=["node", "rep", "n"])

    own = rows.groupBy("rep").agg(F.collect_set("node").alias("nodes"))
    return own.join(sets, "rep").select("rep", "nodes", "items", "n").mapInArrow(by_batch(fn), "node long, rep binary, n long")


# --- Comparing -------------------------------------------------------------------


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups (equal in the first ``keys`` columns), with the groups' limits."""
    rest: list[pa.RecordBatch] = []

    def limits(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in range(keys):
            x = table.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(np.r_[True, new[1:]])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*rest, batch])
        starts = limits(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1]).to_batches()
    if rest:
        table = pa.Table.from_batches(rest)
        yield table, np.r_[limits(table), table.num_rows]


def low_bytes(reps: DataFrame) -> DataFrame:
    """(id, low): the low byte of each coordinate."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        low = _values(batch.column(1), COORDINATES, np.uint32).astype(np.uint8)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in low], pa.binary())], names=["id", "low"])

    return reps.select("id", "sig").mapInArrow(by_batch(fn), "id long, low binary")


def alike(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """rows (node, id) of leaves -> links (a, b) that join the ids of each leaf whose signatures are alike."""

    def fn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, limits in whole_groups(batches, 1):
            low, ids = _values(table.column("low"), COORDINATES, np.uint8), table.column("id").to_numpy()
            begin, end = np.repeat(limits[:-1], np.diff(limits)), np.repeat(limits[1:], np.diff(limits))  # of each row's group
            label, at, links = np.arange(len(low)), np.arange(len(low)), []
            for lag in range(1, int(np.diff(limits).max())):
                at = at[at + lag < end[at]]
                ask = at[label[at] != label[at + lag]]
                for k in range(0, len(ask), 50_000):
                    i = ask[k : k + 50_000]
                    for j in i[(low[i] == low[i + lag]).sum(axis=1) >= LIKE].tolist():
                        if label[j] != label[j + lag]:
                            own = label[begin[j] : end[j]]
                            own[own == label[j + lag]] = label[j]
                            links.append((j, j + lag))
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    near = rows.select("node", "id").join(low_bytes(reps), "id").select("node", "id", "low")
    return near.repartition("node").sortWithinPartitions("node").mapInArrow(fn, "a long, b long")


def linked(n: np.ndarray, items: list[np.ndarray], label: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links between members of a group whose labels differ so far, each joining two labels."""
    joined, sizes = np.concatenate(items), np.array([len(x) for x in items])
    starts = np.cumsum(sizes) - sizes
    _, codes = np.unique(joined, return_inverse=True)
    here = np.zeros(int(codes.max()) + 1, bool)
    label = label.copy()
    for i in range(len(items) - 1):
        if (label[i + 1 :] == label[i]).all():
            continue
        mine = codes[starts[i] : starts[i] + sizes[i]]
        here[mine] = True
        both = np.add.reduceat(here[codes[starts[i + 1] :]].astype(np.int64), starts[i + 1 :] - starts[i + 1])
        here[mine] = False
        for j in i + 1 + np.flatnonzero(100 * both >= percent * (n[i] + n[i + 1 :] - both)):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                yield i, int(j)


def compare_groups(rows: DataFrame, percent: int) -> DataFrame:
    """rows (node, block, rep, label, n, items) -> links (a, b), found by comparing each block exhaustively."""

    def fn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, limits in whole_groups(batches, 2):
            a, b = [], []
            for start, end in zip(limits[:-1], limits[1:], strict=True):
                if end - start < 2:
                    continue
                group = table.slice(start, end - start)
                rep, items = group.column("rep").to_pylist(), [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
                _, label = np.unique(np.array(group.column("label").to_pylist(), "S16"), return_inverse=True)
                for i, j in linked(group.column("n").to_numpy(), items, label, percent):
                    a.append(rep[i])
                    b.append(rep[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    near = rows.select("node", "block", "rep", "label", "n", "items").repartition("node", "block").sortWithinPartitions("node", "block")
    return near.mapInArrow(fn, "a binary, b binary")


def node_stats(rows: DataFrame, small: int) -> DataFrame:
    """Of nodes with more than one label: the blocks they need and the pivot."""
    pivot = F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "label", "n"))
    stats = rows.groupBy("node").agg(F.count("*").alias("m"), F.sum("n").alias("weight"), F.min("label").alias("low"), F.max("label").alias("high"), pivot.alias("pivot"))
    return stats.where("low <> high").select("node", blocks_of("m", "weight", small).alias("parts"), "pivot")


def blocks_of(sets: str, shingles: str, small: int) -> Column:
    return F.ceil(F.greatest(F.col(sets) / small, F.col(shingles) / WEIGHT)).cast("int")


def compare(rows: DataFrame, sets: DataFrame, labels: DataFrame | None, percent: int, small: int, all_pairs: bool = False) -> DataFrame:
    """Links (a, b) inside the nodes of rows (node, rep, n): of each block and with the pivot, or of all pairs of blocks."""
    rows = labelled(rows, labels)
    stats = stage(node_stats(rows, small))
    block = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = rows.join(stats.select("node", "parts"), "node").withColumn("block", block)
    if all_pairs:
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.withColumn("other", other).withColumn("block", F.least("block", "other") * F.col("parts") + F.greatest("block", "other"))
    dealt = dealt.select("node", "block", "rep", "label", "n")
    if not all_pairs:
        crowded = stats.where("parts > 1").select("node", "pivot.*", "parts")
        more = crowded.withColumn("own", block).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("block <> own")
        dealt = dealt.unionByName(more.select("node", "block", "rep", "label", "n"))
    return compare_groups(dealt.join(sets.select("rep", "items"), "rep"), percent)


def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("rep"))
    return rows.join(labels.withColumnsRenamed({"a": "rep", "b": "label"}), "rep", "left").withColumn("label", F.coalesce("label", "rep"))


# --- The join --------------------------------------------------------------------


def candidates(reps: DataFrame, percent: int, small: int) -> tuple[DataFrame, DataFrame | None]:
    """Sets worth comparing: (node, rep, n) in clusters; (tree, node, rep, n) in the leaves that are too large or hold a part of too large a cluster, if any."""
    reps = reps.withColumn("id", F.xxhash64("rep"))  # sets with one id, if any, come together
    rows = leaves(reps, percent).withColumn("m", F.count("*").over(Window.partitionBy("node"))).where("m > 1")
    rows = stage(rows)
    few = F.col("m") <= BLOCKS * small
    stars_of = stars(alike(rows.where(few), reps))
    members = stage(stars_of.select(F.col("a").alias("id"), F.col("b").alias("node")).unionByName(stars_of.select(F.col("b").alias("id"), F.col("b").alias("node")).distinct()))
    members = stage(members.join(reps.select("id", "rep", "n"), "id"))
    large = members.groupBy("node").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).where(blocks_of("sets", "shingles", small) > BLOCKS)
    large = stage(large.select("node"))
    clusters = members.join(large, "node", "left_anti").select("node", "rep", "n")
    crowded = rows.where(~few).join(reps.select("id", "rep", "n"), "id")
    crowded = crowded.unionByName(rows.where(few).join(members.join(large, "node", "left_semi").select("id", "rep", "n"), "id"))
    crowded = stage(crowded.select(F.col("node").bitwiseAND((1 << TREE_BITS) - 1).alias("tree"), "node", "rep", "n"))
    return clusters, None if crowded.isEmpty() else crowded


def _slots(keys: pa.Array, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys.to_pylist()), np.uint64) % np.uint64(bits)


def among(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs (key, text) whose key is one of keys (key), and few others, told by a bit table; keys begin with random bytes."""
    bits = min(max(1 << (BITS_EACH * keys.count()).bit_length(), MIN_BITS), MAX_BITS)

    def slots(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_slots(batch.column(0), bits).astype(np.int64))], names=["slot"])

    word = F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("word")
    made = keys.select("key").mapInArrow(by_batch(slots), "slot long").groupBy(F.expr("slot div 64").alias("at")).agg(word).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[made["at"].to_numpy()] = made["word"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot = _slots(batch.column(0), bits)
        return batch.filter(pa.array((shared.value[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)))

    return docs.select("key", "text").mapInArrow(by_batch(fn), "key binary, text string")


def full_sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, n, items) of the wanted sets, made again from one text of each."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_pieces(batches, 2):
            items = pa.array([x.tobytes() for x in shingle_sets(texts, size)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items], names=["rep", "n", "items"])

    keys = stage(reps.join(wanted, "rep", "left_semi").select("rep", "n", "key"))
    texts = keep_one(among(docs, keys), ["key"], ["key"])
    return stage(keys.join(texts, "key").select("rep", "n", "text").mapInArrow(rows, "rep binary, n long, items binary"))


def classes(docs: DataFrame, reps: DataFrame, size: int = SHINGLE, percent: int = PERCENT, small: int = SMALL, levels: int = LEVELS) -> DataFrame | None:
    """(a, b): each set that is not the first of its class, and the first; None without links."""
    found, more = candidates(reps, percent, small)
    sets = full_sets(docs, reps, (found if more is None else found.select("rep").unionByName(more.select("rep"))).select("rep").distinct(), size)
    links: list[DataFrame] = []
    labels = None

    def take(rows: DataFrame, **how) -> None:
        nonlocal labels
        links.append(stage(compare(rows, sets, labels, percent, small, **how).distinct()))
        every = links[0]
        for more in links[1:]:
            every = every.unionByName(more)
        labels = stars(every)

    take(found, all_pairs=True)
    if more is None:
        return labels
    at = 0
    for n in (*BATCHES, TREES):
        take(more.where((F.col("tree") >= at) & (F.col("tree") < at + n)).select("node", "rep", "n"))
        at += n
    rows = more.select("node", "rep", "n")
    for _ in range(levels):
        rows = still_crowded(rows, labels, small)
        if rows is None:
            return labels
        rows = stage(next_nodes_of_sets(rows, sets, percent))
        take(rows)
    rows = still_crowded(rows, labels, small)
    if rows is not None:
        take(rows, all_pairs=True)
    return labels


def still_crowded(rows: DataFrame, labels: DataFrame, small: int) -> DataFrame | None:
    """The rows of nodes that were compared in blocks and have different labels yet."""
    stats = node_stats(labelled(rows, labels), small).where("parts > 1")
    left = stage(rows.join(stats.select("node"), "node", "left_semi"))
    return None if left.isEmpty() else left


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, small: int = SMALL, levels: int = LEVELS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_key(text), F.col(text).alias("text"))
    marked = stage(signatures(slim, size))
    reps = stage(keep_one(marked.where("n > 0").select("rep", "key", "n", "sig"), ["rep"], ["key"]))
    labels = classes(slim.select("key", "text"), reps, size, percent, small, levels)
    full = labelled(marked.select("doc_id", "n", "rep"), labels)
    least = full.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least")).withColumnRenamed("label", "of")
    out = full.join(least, (F.col("label") == F.col("of")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
