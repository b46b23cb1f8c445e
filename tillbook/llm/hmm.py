"""LM scoring by a hidden Markov model over words.

Words are counted over all training documents, and every training word has its own emission in every state. The VOCABULARY
most frequent words are symbols of their own; every other word has, in each state, a share of its ending's class, by its
expected counts in that state. The end of a document is a symbol too. Each of the ROUNDS rounds of Baum-Welch runs over
the whole training set: each task adds up the expected transitions and emissions of its documents, the sums over tasks
give the next model. A text's score is the log10 of its exact probability, by the scaled forward recursion over the whole
text.

The DICTIONARY most frequent words (of at most LONGEST bytes, so of a proven size) travel to the tasks with their counts
and expected counts. All other words are dealt once to buckets by their hash, where they get numbers and their training
counts. In every round each block of documents sends its expected counts to the buckets, packed by bucket, and each bucket
returns the sums over all blocks to the blocks that have the word; so no word travels by itself, nor is joined again.

Defined cases: a null text is empty and has only its end; a null id counts as the empty text, so its document is held out;
without training documents all counts are zero; repeated rows are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.suffixes import release
from tillbook.session import stage

STATES, VOCABULARY, ENDINGS = 8, 8192, 64
SYMBOLS = VOCABULARY + ENDINGS
DICTIONARY, LONGEST = 1 << 18, 64
ROUNDS = 4
#: Tokens of a block of documents, which share one list of other words; a longer document is a block of its own.
BLOCK = 4_000_000
#: Training only: longer documents count as several sequences, and so many tokens are in memory at a time.
SEQUENCE, TOKENS = 100_000, 500_000
FLUSH_WORDS, ROWS = 300_000, 2500
SMOOTH = 0.1
#: Expected counts leave a block as whole numbers of this part, near the precision of the recursion; so their sums have no order.
PART = 2.0**-20
END = b""
#: Occurrences of other words for which there is a bucket, so at most as many pairs of a block and a word in it, about; words of the dictionary in a slice of it.
BUCKET, SLICE = 1_000_000, 1024
#: What blocks and buckets send each other: a bucket's words of a block by number, their training counts and expected counts. Slices
#: of the dictionary are numbered down from -2; -1 has the classes of other words, the start and the moves.
SENT = "block bigint, held_out boolean, bucket int, ids binary, c binary, sums binary"
#: Columns of a word's expected counts.
SUMS = [f"e{k}" for k in range(STATES)]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one text after the other, and how many each has; a null text has none."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, n = parts.flatten(), parts.value_lengths().to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    before, ends = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False)))), np.cumsum(n)
    return words.filter(full).cast(pa.binary()), before[ends] - before[ends - n]


def few_rows(batches):
    """The batches in parts of ROWS rows, so that few words are in memory at a time."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def packed(numbers: np.ndarray) -> bytes:
    """Compressed: the first bytes of all numbers, then the second ones and so on, as the later ones vary little."""
    planes = np.ascontiguousarray(numbers).reshape(-1).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(cell: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(cell[8:], int.from_bytes(cell[:8], "little"), "zstd") if cell else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def _count(batches):
    held: list[pa.Table] = []

    def summed():
        counts = pa.concat_tables(held).group_by("word").aggregate([("c", "sum")])
        held.clear()
        yield from counts.select(["word", "c_sum"]).rename_columns(["word", "c"]).to_batches()

    for batch in few_rows(batches):
        words, _ = split_words(batch.column(0))
        counts = words.value_counts()
        held.append(pa.table({"word": counts.field("values"), "c": counts.field("counts")}))
        held.append(pa.table({"word": pa.array([END], pa.binary()), "c": pa.array([len(batch)], pa.int64())}))
        if sum(map(len, held)) > FLUSH_WORDS:
            yield from summed()
    if held:
        yield from summed()


class Lexicon:
    """The frequent words with their counts and symbols, the end being word and symbol 0."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, classes: dict[int, tuple[int, int]]):
        """words by falling count, without the end, whose count comes first in counts. classes: ending -> (sum, words) of all but the end."""
        self.total, self.distinct = total, distinct
        self.packed, self.counts = b" ".join(words), np.array(counts, np.int64)
        known = [list(classes.get(g, (0, 0))) for g in range(ENDINGS)]
        ends = np.array([ending(w) for w in words], np.int64)
        for g, c in zip(ends[: VOCABULARY - 1].tolist(), counts[1:VOCABULARY], strict=True):
            known[g][0] -= c
            known[g][1] -= 1
        self.class_counts = np.array([s for s, _ in known], np.float64)
        self.class_size = np.array([s + SMOOTH * (n + 1) for s, n in known])
        #: Ending classes of the words from VOCABULARY on.
        self.rare = ends[VOCABULARY - 1 :]

    @property
    def base_size(self) -> float:
        return self.total + SMOOTH * (self.distinct + 1)

    @property
    def buckets(self) -> int:
        """For the words that are not in the dictionary."""
        return 1 + int(self.total - self.counts.sum()) // BUCKET

    def index(self) -> dict[bytes, int]:
        words = self.packed.split(b" ") if self.packed else []
        return {w: i for i, w in enumerate(words, 1)}

    def symbol_counts(self) -> np.ndarray:
        """Training counts of the symbols."""
        own = np.zeros(VOCABULARY)
        own[: len(self.counts[:VOCABULARY])] = self.counts[:VOCABULARY]
        return np.concatenate([own, np.maximum(0, self.class_size - SMOOTH)])

    def shares(self, g: np.ndarray, c: np.ndarray, sums: np.ndarray, class_sums: np.ndarray) -> np.ndarray:
        """(states x words): the share each word has of its class g, from its count c and its expected counts, sums.

        In a state the shares of a class and one unseen word add up to one; without expected counts they follow c.
        """
        scaled = (self.class_counts[g] * sums + c) / (class_sums[:, g] + 1)
        return (scaled + SMOOTH) / self.class_size[g]


def lexicon(train: DataFrame, text: str = "text") -> tuple[Lexicon, DataFrame]:
    """From the training documents; also the table (word, c) of all words."""
    counts = stage(train.select(F.col(text).alias("text")).mapInArrow(_count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c")))
    total, distinct, docs = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.max(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0))).first()
    by_end = (F.crc32(F.substring("word", -2, 2)) % ENDINGS).alias("g")
    classes = {r.g: (r.c, r.n) for r in counts.where(F.octet_length("word") > 0).groupBy(by_end).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    top = counts.where(F.octet_length("word").between(1, LONGEST)).orderBy(F.desc("c"), "word").limit(DICTIONARY).toArrow()
    return Lexicon(top["word"].to_pylist(), [docs, *top["c"].to_pylist()], total, distinct, classes), counts


def encode(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """rows (doc_id, held_out, text) -> blocks of documents: their words as 32-bit numbers, the block's other words numbered after the dictionary's.

    These are in the order of their buckets; cuts: where each bucket begins and the last one ends; times: how often each comes up.
    """
    names = ["block", "held_out", "doc_ids", "lengths", "words", "others", "cuts", "times"]
    buckets = lex.buckets
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        known = pa.array(list(lex.index()), pa.binary())
        first, made = len(lex.counts), TaskContext.get().partitionId() << 32
        ids, words, others = ({False: [], True: []} for _ in range(3))
        held = {False: 0, True: 0}

        def block(flag: bool) -> pa.RecordBatch:
            nonlocal made
            made += 1
            numbers = np.concatenate(words[flag])
            found = pa.concat_arrays([pa.array([], pa.binary()), *others[flag]]).dictionary_encode()
            dealt = np.fromiter(map(zlib.crc32, found.dictionary.to_pylist()), np.int64, len(found.dictionary)) % buckets
            order = np.argsort(dealt, kind="stable")
            place = np.argsort(order)[found.indices.to_numpy()]
            numbers[numbers < 0] = first + place
            times = np.bincount(place, minlength=len(order)).astype("<i4")
            cuts = np.searchsorted(dealt[order], np.arange(buckets + 1))
            cells = made, flag, pa.array(ids[flag], id_type), pa.array([len(w) for w in words[flag]], pa.int64()), packed(numbers), found.dictionary.take(pa.array(order)), pa.array(cuts), packed(times)
            kinds = pa.int64(), pa.bool_(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()
            ids[flag], words[flag], others[flag], held[flag] = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([c], type=k) for c, k in zip(cells, kinds, strict=True)], names=names)

        for batch in few_rows(batches):
            id_type = batch.column(0).type
            found, lengths = split_words(batch.column(2))
            at = pc.index_in(found, value_set=known)
            # Other words are -1 until their block is made.
            numbers, far = (at.fill_null(-2).to_numpy() + 1).astype("<i4"), found.filter(at.is_null())
            before, end = np.concatenate(([0], np.cumsum(numbers < 0))).tolist(), 0
            for doc_id, flag, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), lengths.tolist(), strict=True):
                if ids[flag] and held[flag] + n >= BLOCK:
                    yield block(flag)
                start, end = end, end + n
                ids[flag].append(doc_id)
                words[flag].append(np.append(numbers[start:end], np.int32(0)))
                others[flag].append(far.slice(before[start], before[end] - before[start]))
                held[flag] += n + 1
        for flag in (False, True):
            if ids[flag]:
                yield block(flag)

    return rows.mapInArrow(run, f"block bigint, held_out boolean, doc_ids array<{kind}>, lengths array<bigint>, words binary, others array<binary>, cuts array<bigint>, times binary")


class Hmm:
    """start (states), move (states x states), emit (states x symbols); expected counts of the dictionary's words from VOCABULARY on, and of the classes (states x each)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, rare: np.ndarray | float = 0.0, class_sums: np.ndarray | None = None):
        self.start, self.move, self.emit, self.rare = start, move, emit, rare
        self.class_sums = np.zeros((len(start), ENDINGS)) if class_sums is None else class_sums

    def over(self, lex: Lexicon, g: np.ndarray, c: np.ndarray, sums: np.ndarray, kind: type = np.float64) -> Hmm:
        """The model with an emission for each word: the dictionary's, then the others given by class, count and expected counts."""
        emit = np.empty((len(lex.counts) + len(g), len(self.start)), kind)
        first = len(lex.counts[:VOCABULARY])
        emit[:first] = self.emit[:, :first].T
        for g, c, sums in ((lex.rare, lex.counts[VOCABULARY:], self.rare), (g, c, sums)):
            for at in range(0, len(g), VOCABULARY):
                some = slice(at, at + VOCABULARY)
                own = self.emit[:, VOCABULARY + g[some]] * lex.shares(g[some], c[some], sums if np.ndim(sums) == 0 else sums[:, some], self.class_sums)
                emit[first + at : first + at + own.shape[1]] = own.T
            first += len(g)
        return Hmm(self.start, self.move, emit.T)

    @classmethod
    def first(cls, unigram: np.ndarray, seed: int = 11) -> Hmm:
        """Near the unigram shares, each state leaning its own way, and slow to change state."""
        rng = np.random.default_rng(seed)
        emit = (unigram + 0.01) * np.exp(rng.standard_normal((STATES, len(unigram))))
        move = np.full((STATES, STATES), 0.3 / (STATES - 1))
        np.fill_diagonal(move, 0.7)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def from_counts(cls, sums: np.ndarray, unigram: np.ndarray) -> Hmm:
        """The next model from expected counts; every state keeps a small part of the unigram shares, so nothing is impossible."""
        start, move, emit = split_counts(sums, len(unigram))
        start, move = start + 1, move + 1
        emit = emit + (unigram + SMOOTH) / (unigram + SMOOTH).sum() * (1 + 0.001 * emit.sum(axis=1, keepdims=True))
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def split_counts(sums: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return sums[:STATES], sums[STATES : STATES + STATES**2].reshape(STATES, STATES), sums[STATES + STATES**2 :].reshape(STATES, symbols)


def _in_step(sequences: list[np.ndarray]):
    """The sequences joined, longest first, with their starts and, for each step, how many are that long."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    return order, np.concatenate([sequences[i] for i in order]), np.concatenate(([0], np.cumsum(lengths)[:-1])), alive


def log10_likelihoods(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each sequence (none empty): the forward recursion, rescaled at every step."""
    order, flat, starts, alive = _in_step(sequences)
    emit = np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(sequences))
    state = np.broadcast_to(model.start, (len(sequences), STATES))
    for t, n in enumerate(alive.tolist()):
        state = (state[:n] @ model.move if t else state) * emit[flat[starts[:n] + t]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(model: Hmm, sequences: list[np.ndarray], sums: np.ndarray | None = None) -> np.ndarray:
    """Baum-Welch sums of the sequences: starts, transitions, emissions, in one vector; added to sums, if given."""
    _, flat, starts, alive = _in_step(sequences)
    symbols, states = model.emit.shape[1], len(model.start)
    emit, move = np.ascontiguousarray(model.emit.T / model.emit.max(axis=0)[:, None], np.float32), model.move.astype(np.float32)
    where, count = np.concatenate(([0], np.cumsum(alive))).tolist(), alive.tolist()
    seen = np.empty(where[-1], np.int64)
    for t, n in enumerate(count):
        seen[where[t] : where[t + 1]] = flat[starts[:n] + t]
    likely, forward = emit[seen], np.empty((where[-1], states), np.float32)
    del emit
    # A product with it puts the sum of a row in each of its columns.
    ones = np.ones((states, states), np.float32)
    state = np.broadcast_to(model.start.astype(np.float32), (len(sequences), states))
    for t, n in enumerate(count):
        span = slice(where[t], where[t + 1])
        state = (state[:n] @ move if t else state) * likely[span]
        state = np.divide(state, state @ ones, out=forward[span])
    moves = np.zeros((states, states))
    back, backward = np.ascontiguousarray(move.T), np.ones((count[0], states), np.float32)
    for t in range(len(count) - 1, -1, -1):
        n, now = count[t], forward[where[t] : where[t + 1]]
        if t:
            ahead = backward[:n] * likely[where[t] : where[t + 1]]
            earlier, before = ahead @ back, forward[where[t - 1] : where[t - 1] + n]
            moves += (before / ((before * earlier) @ ones)).T @ ahead
            now *= backward[:n]
            np.divide(earlier, earlier @ ones, out=backward[:n])
        else:
            now *= backward
    del likely
    forward /= forward @ ones
    if sums is None:
        sums = np.zeros(states + states**2 + states * symbols)
    sums[:states] += forward[: count[0]].sum(axis=0, dtype=np.float64)
    sums[states : states + states**2] += (moves * model.move).reshape(-1)
    for k, own in enumerate(sums[states + states**2 :].reshape(states, symbols)):
        own += np.bincount(seen, forward[:, k], symbols)
    return sums


def _pieces(sequences: list[np.ndarray], longest: int, tokens: int):
    """The sequences in groups of so many tokens, the longest first; longer ones cut."""
    rows = sorted((r[at : at + longest] for r in sequences for at in range(0, len(r), longest)), key=len, reverse=True)
    group, held = [], 0
    for r in rows:
        group.append(r)
        held += len(r)
        if held >= tokens:
            yield group
            group, held = [], 0
    if group:
        yield group


def _joined(cells: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(unpacked(c, kind) for c in cells.to_pylist())])


def places(blocks: DataFrame) -> DataFrame:
    """(the columns of SENT), for each block and bucket: numbers and training counts of the block's other words there, no sums yet."""

    def deal(batches):
        for batch in batches:
            for block, held_out, others, cuts, times in zip(*batch.columns, strict=True):
                cuts, times = cuts.values.to_numpy(), unpacked(times.as_py(), "<i4") * (not held_out.as_py())
                some = np.flatnonzero(np.diff(cuts))
                parts = [others.values.slice(cuts[b], cuts[b + 1] - cuts[b]) for b in some]
                words = pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), pa.concat_arrays([pa.array([], pa.binary()), *parts]))
                own = pa.array([packed(times[cuts[b] : cuts[b + 1]]) for b in some], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py()] * len(some), x.type) for x in (block, held_out)] + [pa.array(some, pa.int32()), words, own], names=["block", "held_out", "bucket", "words", "times"])

    def count(rows: pa.Table) -> pa.Table:
        words = rows["words"].combine_chunks()
        ids = words.flatten().dictionary_encode().indices.to_numpy().astype("<i4")
        c = np.bincount(ids, _joined(rows["times"], "<i4")).astype("<i8")[ids]
        ends = np.cumsum(words.value_lengths().to_numpy())[:-1]
        cells = [pa.array([packed(a) for a in np.split(b, ends)], pa.binary()) for b in (ids, c)]
        return pa.table([rows["block"], rows["held_out"], rows["bucket"], *cells, pa.array([b""] * len(rows), pa.binary())], names=["block", "held_out", "bucket", "ids", "c", "sums"])

    dealt = blocks.select("block", "held_out", "others", "cuts", "times").mapInArrow(deal, "block bigint, held_out boolean, bucket int, words array<binary>, times binary")
    return stage(dealt.groupBy("bucket").applyInArrow(count, SENT))


def _with_words(blocks: DataFrame, told: DataFrame, fn, schema: str) -> DataFrame:
    """fn(a block, what was told of each bucket, its other words' classes, counts and expected counts) -> a table of the schema, for each block."""

    def run(block: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("bucket")
        g = np.array([ending(w) for w in block["others"][0].values.to_pylist()], np.int64)
        c, sums = _joined(rows["c"], "<i8"), _joined(rows["sums"], "<f4").reshape(-1, STATES).T
        return fn({n: block[n][0] for n in block.column_names}, rows, g, c, sums if sums.size else np.zeros((STATES, len(g))))

    return blocks.drop("times").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def _kind(bucket: int) -> str:
    """Numbers of the sums sent: of words that come up often in a block, 64 bits."""
    return "<f8" if -1 - VOCABULARY // SLICE <= bucket < 0 else "<f4"


def _add(rows: pa.Table) -> pa.Table:
    """A bucket's sums over all blocks, to each block that asked; those of a slice of the dictionary and of the rest in one row."""
    bucket = rows["bucket"][0].as_py()
    ids = [unpacked(i, "<i4") for i in rows["ids"].to_pylist()]
    total = np.zeros((1 + max(int(i.max()) for i in ids), STATES))
    for i, sums in zip(ids, rows["sums"].to_pylist(), strict=True):
        if sums:
            total[i] += unpacked(sums, _kind(bucket)).reshape(-1, STATES)
    if bucket < 0:
        return rows.slice(0, 1).select(["block", "held_out", "bucket", "ids", "c"]).append_column("sums", [[packed(total)]])
    return rows.drop_columns("sums").append_column("sums", [[packed(total[i].astype("<f4")) for i in ids]])


def _sequences(block: dict) -> list[np.ndarray]:
    words = unpacked(block["words"].as_py(), "<u4")
    return np.split(words, np.cumsum(block["lengths"].values.to_numpy())[:-1])


def one_round(blocks: DataFrame, told: DataFrame, asked: DataFrame | None, words: Broadcast, model: Hmm) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Expected counts over all blocks, summed in each, then over all: those of the model's symbols, those of the dictionary's words from VOCABULARY on, what the
    buckets tell of the others, to the blocks of asked also. words: the lexicon."""
    lex, shared = words.value, blocks.sparkSession.sparkContext.broadcast(model)
    known = len(lex.counts)

    def run(block: dict, rows: pa.Table, g: np.ndarray, c: np.ndarray, sums: np.ndarray) -> pa.Table:
        whole = shared.value.over(words.value, g, c, sums, np.float32)
        total = np.zeros(STATES + STATES**2 + STATES * (known + len(g)))
        for some in _pieces(_sequences(block), SEQUENCE, TOKENS):
            expected_counts(whole, some, total)
        del whole
        np.rint(np.divide(total, PART, out=total), out=total)
        start, move, emit = split_counts(np.multiply(total, PART, out=total), known + len(g))
        emit = emit.T
        classes = np.array([np.bincount(g, e, ENDINGS) for e in emit[known:].T])
        head = np.concatenate([classes, start[:, None], move.T], axis=1).T
        seen = np.flatnonzero(emit[:known].any(axis=1))
        parts = np.split(seen, np.searchsorted(seen, np.arange(SLICE, known, SLICE)))
        sent = [(-1, np.arange(len(head)), head)] + [(-2 - s, p % SLICE, emit[p]) for s, p in enumerate(parts) if len(p)]
        ids = [packed(i.astype("<i4")) for _, i, _ in sent] + rows["ids"].to_pylist()
        of = [b for b, _, _ in sent] + rows["bucket"].to_pylist()
        cuts = block["cuts"].as_py()
        values = [packed(v.astype(_kind(b))) for b, _, v in sent] + [packed(emit[known + cuts[b] : known + cuts[b + 1]].astype("<f4")) for b in of[len(sent) :]]
        cells = [block["block"].as_py()] * len(of), [False] * len(of), pa.array(of, pa.int32()), pa.array(ids, pa.binary()), pa.array([None] * len(sent) + rows["c"].to_pylist(), pa.binary()), pa.array(values, pa.binary())
        return pa.table(list(map(pa.array, cells)), names=["block", "held_out", "bucket", "ids", "c", "sums"])

    sent = _with_words(blocks, told, run, SENT)
    found = stage((sent.unionByName(asked) if asked is not None else sent).groupBy("bucket").applyInArrow(_add, SENT))
    shared.destroy()
    own, head = np.zeros((STATES, known)), np.zeros((STATES, ENDINGS + 1 + STATES))
    for bucket, cell in found.where("bucket < 0").select("bucket", "sums").toLocalIterator():
        sums, first = unpacked(cell, "<f8").reshape(-1, STATES).T, (-2 - bucket) * SLICE
        if bucket == -1:
            head[:] = sums
        else:
            own[:, first : first + sums.shape[1]] = sums
    classes, start, move = np.split(head, [ENDINGS, ENDINGS + 1], axis=1)
    emit = np.zeros((STATES, SYMBOLS))
    emit[:, : len(lex.counts[:VOCABULARY])], rare = own[:, :VOCABULARY], own[:, VOCABULARY:]
    emit[:, VOCABULARY:] = classes + [np.bincount(lex.rare, e, ENDINGS) for e in rare]
    return np.concatenate([start.reshape(-1), move.T.reshape(-1), emit.reshape(-1)]), rare, found.where("bucket >= 0")


def learn(blocks: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> tuple[Hmm, DataFrame]:
    """The model, from the blocks that are not held out; what the buckets tell all blocks of their other words."""
    unigram = lex.symbol_counts()
    model = Hmm.first(unigram / max(1.0, unigram.sum()))
    first = places(blocks)
    held = stage(first.where("held_out"))
    rounds, told = rounds if lex.total else 0, first
    words = blocks.sparkSession.sparkContext.broadcast(lex)
    for n in range(rounds):
        asked = held if n == rounds - 1 else None
        sums, rare, made = one_round(blocks.where("not held_out"), told.where("not held_out"), asked, words, model)
        release(told)
        model, told = Hmm.from_counts(sums, unigram), made
        model.rare, model.class_sums = rare, split_counts(sums, SYMBOLS)[2][:, VOCABULARY:]
    words.destroy()
    release(held)
    return model, told


def train(blocks: DataFrame, lex: Lexicon, counts: DataFrame, rounds: int = ROUNDS) -> tuple[Hmm, DataFrame]:
    """blocks: of the training documents. counts: (word, c). The model, and the table (word, c, the sums) of the words that are not in the dictionary."""
    model, told = learn(blocks, lex, rounds)

    def run(block: dict, rows: pa.Table, g: np.ndarray, c: np.ndarray, sums: np.ndarray) -> pa.Table:
        return pa.table([block["others"].values.cast(pa.binary()), *sums.astype(np.float64)], names=["word", *SUMS])

    words = _with_words(blocks, told, run, f"word binary, {', '.join(f'{e} double' for e in SUMS)}")
    return model, words.dropDuplicates(["word"]).join(counts, "word").select("word", "c", *SUMS)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each document."""
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10
    rows = docs.select(F.col(doc_id).alias("doc_id"), (fold == 0).alias("held_out"), F.col(text).alias("text"))
    lex, counts = lexicon(rows.where("not held_out"))
    release(counts)
    blocks = stage(encode(rows, lex))
    model, told = learn(blocks, lex)
    shared = docs.sparkSession.sparkContext.broadcast((lex, model))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(block: dict, rows: pa.Table, g: np.ndarray, c: np.ndarray, sums: np.ndarray) -> pa.Table:
        lex, model = shared.value
        sequences, counts = _sequences(block), np.concatenate([lex.counts, c])
        base, whole = np.log10((counts + SMOOTH) / lex.base_size), model.over(lex, g, c, sums)
        found = log10_likelihoods(whole, sequences)
        n = len(sequences)
        out = [block["doc_ids"].values, pa.array([block["held_out"].as_py()] * n), pa.array([len(q) for q in sequences]), pa.array([int((counts[q] > 0).sum()) for q in sequences])]
        return pa.table([*out, pa.array([lex.total] * n, pa.int64()), pa.array([float(base[q].sum()) for q in sequences]), pa.array(found)], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return _with_words(blocks, told, run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
