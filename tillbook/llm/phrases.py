"""Phrase collocations by best-first branch-and-bound growth.

A candidate is a phrase of two or three words that occurs ``min_count`` times or more in its language. Cut after its first k
words it scores floor(1000000 * a * a / (l * r)), a, l and r being the counts of phrase, first part and rest; its lowest cut
counts. The best ``limit`` phrases of each language are found without counting all phrases of three words:

* Words are counted, then pairs of words that are both frequent enough (a phrase is no more frequent than its parts).
* A pair (x, y) is a prefix of longer phrases. No such phrase is more frequent than the pair, so none scores above
  ``ahead`` = floor(1000000 * count / count of x); as the end of longer phrases the pair bounds them by ``back``, the same
  with y. Both bounds are admissible, and no pair scores above either.
* The frontier is taken best bound first: a round sets each language's ``floor``, the score of its k-th best pair, and counts
  the phrases whose bounds reach it, with every phrase that holds a pair reaching it (these decide whether the pair is
  dropped). Then all survivors with a score at or above the floor are known, ties included. A language with ``limit`` of
  them is settled; the others go on with a k four times as large, at last with all pairs.

Scores are exact: decimals of 38 digits hold the products for counts up to 10^15.

Counting runs over Arrow batches that combine counts before the shuffle. Which words and pairs are wanted reaches the tasks as
bit tables of at most ``MAX_BITS`` bits each, a proven size; a wrong hit in them counts a phrase for nothing, and exact joins
follow. The best of a language are taken in two steps, so no task ranks a whole language.

Defined cases: null and empty texts have no words; a null language is ``und``, an empty one a language of its own; repeated
rows count again; ties in score go by count, then by the phrase's UTF-8 bytes; very long texts are worked on in slices that
share their border words; languages without candidates give no rows, an empty table an empty result; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.arrow import utf8
from tillbook.session import stage

MIN_COUNT, LIMIT, CONTAINED = 10, 2000, 50
SCALE = 1_000_000
#: The first floor is the score of the pair at this many times the limit; each further round takes GROWTH times as many.
START, GROWTH = 2, 4
#: Bits of a word's number in a task. A slice has at most a quarter as many different words as bytes (those of one and two
#: bytes apart, under 60,000), so numbers never run out if the task's words are written out at FULL.
NUMBER_BITS = 21
#: Bytes of text worked on at a time, words and phrases held before they are written out, texts taken from a batch at a time.
SLICE, HELD_WORDS, HELD_CODES, ROWS = 1_000_000, 400_000, 1_000_000, 500
FULL = (1 << NUMBER_BITS) - SLICE // 4 - 60_000
MIN_BITS, MAX_BITS, BITS_EACH = 1 << 20, 1 << 27, 16
PAGE = 4096  # bytes of a bitmap in Spark's bitmap functions
SLOTS = 256

#: A-Z to lower case, what ends a piece to a line feed.
FOLD = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = re.compile(rb"[ \t\n]")


# --- Bit tables ----------------------------------------------------------------


def seed_of(lang: bytes) -> int:
    return xxhash.xxh64_intdigest(lang)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64 bits of a pair from its words' 64 bits; arrays of uint64 wrap around."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _places(hashes, len(table) * 8)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _phrase_hashes(lang: list, phrase: list[bytes]) -> np.ndarray:
    seeds = {x: seed_of(x) for x in set(lang)}
    words = [(p.split(b" "), seeds[x]) for x, p in zip(lang, phrase, strict=True)]
    first = np.fromiter((xxhash.xxh64_intdigest(w[0], s) for w, s in words), np.uint64, len(words))
    if all(len(w) == 1 for w, _ in words):
        return first
    return pair_hash(first, np.fromiter((xxhash.xxh64_intdigest(w[1], s) for w, s in words), np.uint64, len(words)))


def bit_tables(phrases: DataFrame, kinds: int) -> list[np.ndarray]:
    """phrases (lang, phrase, flags): one bit table for each of the lowest bits of flags; the driver gets these bits only."""
    n = phrases.count()
    bits = min(max(1 << (BITS_EACH * n).bit_length(), MIN_BITS), MAX_BITS)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((kinds, bits // 8), np.uint8)
        for batch in batches:
            at = _places(_phrase_hashes(utf8(batch.column(0)), utf8(batch.column(1))), bits)
            flags = batch.column(2).to_numpy(zero_copy_only=False)
            for k in range(kinds):
                mine = at[flags >> k & 1 == 1]
                np.bitwise_or.at(tables[k], mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        pages = tables.reshape(kinds, -1, PAGE)
        for k, page in zip(*np.nonzero(pages.any(axis=2)), strict=True):
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k], pa.int32()), "page": pa.array([page], pa.int32()), "bits": pa.array([pages[k, page].tobytes()])})

    made = phrases.select("lang", "phrase", F.col("flags").cast("int")).mapInArrow(rows, "kind int, page int, bits binary")
    out = np.zeros((kinds, bits // 8), np.uint8)
    for r in made.groupBy("kind", "page").agg(F.bitmap_or_agg("bits").alias("bits")).collect():
        out[r.kind, r.page * PAGE : (r.page + 1) * PAGE] = np.frombuffer(bytes(r.bits), np.uint8)
    return list(out)


# --- Counting in tasks ---------------------------------------------------------


class _Words(dict):
    """Numbers of the words of one language; unwanted words have -1."""

    def __init__(self, seed: int, wanted: np.ndarray | None):
        self.seed, self.words, self.hashes = seed, [], []
        self.wanted = wanted if wanted is None else wanted.tobytes()
        self.shift = 0 if wanted is None else 64 - (len(wanted) * 8).bit_length() + 1
        self[b"\n"] = -1

    def __missing__(self, word: bytes) -> int:
        number, h = -1, xxhash.xxh64_intdigest(word, self.seed)
        at = h >> self.shift
        if self.wanted is None or self.wanted[at >> 3] >> (at & 7) & 1:
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
        self[word] = number
        return number


def _slices(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = len(text) if at + SLICE >= len(text) else at + SLICE
        if end < len(text):
            cut = SPACE.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def tokens(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of a folded text; the number of each word in turn; the line feeds before each word and in all."""
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | (raw == 9) | (raw == 10)
    edges = np.r_[0, np.flatnonzero(space[1:] != space[:-1]) + 1, len(raw)].astype(np.int32)
    values = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(text)])
    at = np.arange(int(space[0]), len(values), 2)
    coded = values.take(pa.array(at)).dictionary_encode()
    feeds = np.flatnonzero(raw == 10)
    return coded.dictionary, coded.indices.to_numpy(), np.r_[np.searchsorted(feeds, edges[at]), len(feeds)]


class _Counter:
    """Counts of the phrases of ``size`` words of one language."""

    def __init__(self, lang: bytes, size: int, tables: list[np.ndarray]):
        self.lang, self.size, self.tables = lang, size, tables
        self.texts, self.bytes = [], 0
        self.clear()

    def clear(self) -> None:
        self.words = _Words(seed_of(self.lang), self.tables[0] if self.tables else None)
        self.codes, self.counts, self.new, self.held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def codes_of(self, ids: np.ndarray) -> np.ndarray:
        """The wanted phrases among the word numbers, as one number each."""
        if self.size == 1:
            return ids[ids >= 0]
        parts = [ids[k : len(ids) - self.size + 1 + k] for k in range(self.size)]
        sure = np.bitwise_or.reduce(parts) >= 0
        parts = [p[sure] for p in parts]
        if self.size == 3:
            h = np.array(self.words.hashes, np.uint64)
            left, right = pair_hash(h[parts[0]], h[parts[1]]), pair_hash(h[parts[1]], h[parts[2]])
            frequent, ahead, back, contends = self.tables[1:]
            frequent_l, frequent_r = holds(frequent, left), holds(frequent, right)
            take = frequent_l & frequent_r & ((holds(ahead, left) & holds(back, right)) | holds(contends, left) | holds(contends, right))
            parts = [p[take] for p in parts]
        code = parts[0]
        for p in parts[1:]:
            code = code << NUMBER_BITS | p
        return code

    def work(self) -> Iterator[pa.RecordBatch]:
        """Counts the texts gathered so far."""
        text, self.texts, self.bytes = b"\n".join(self.texts), [], 0
        carried: list[bytes] = []
        for part in _slices(text.translate(FOLD)):
            distinct, at, feeds = tokens(part)
            numbers = np.fromiter(map(self.words.__getitem__, carried + distinct.to_pylist()), np.int64, len(carried) + len(distinct))
            before = np.cumsum(np.diff(feeds, prepend=0) > 0)  # one place for each end of a piece
            ids = np.full(len(carried) + len(at) + before[-1], -1, np.int64)
            ids[: len(carried)] = numbers[: len(carried)]
            ids[len(carried) + np.arange(len(at)) + before[:-1]] = numbers[len(carried) + at]
            found = self.codes_of(ids) if len(ids) >= self.size else np.empty(0, np.int64)
            carried = [self.words.words[i] if i >= 0 else b"\n" for i in ids[-(self.size - 1) :].tolist()] if self.size > 1 else []
            self.new.append(found)
            self.held += len(found)
            crowded = len(self.words) > HELD_WORDS or len(self.words.words) > FULL
            if crowded or self.held > HELD_CODES:
                self.combine()
                if crowded or len(self.codes) > HELD_CODES // 2:
                    yield from self.out()

    def combine(self) -> None:
        codes = np.concatenate([self.codes, *self.new])
        weights = np.concatenate([self.counts, np.ones(len(codes) - len(self.codes), np.int64)])
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
        self.codes, self.counts = codes[starts], np.add.reduceat(weights[order], starts) if len(codes) else self.counts
        self.new, self.held = [], 0

    def out(self) -> Iterator[pa.RecordBatch]:
        self.combine()
        words = pa.array(self.words.words, pa.binary()).cast(pa.large_binary())
        mask = (1 << NUMBER_BITS) - 1
        for at in range(0, len(self.codes), 200_000):
            codes = self.codes[at : at + 200_000]
            parts = [words.take(pa.array(codes >> (NUMBER_BITS * k) & mask)) for k in reversed(range(self.size))]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if self.size > 1 else parts[0]
            lang = pa.array([self.lang.decode()] * len(codes), pa.string())
            yield pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(self.counts[at : at + 200_000])], names=["lang", "phrase", "n"])
        self.clear()


def count(docs: DataFrame, size: int, tables: list[np.ndarray] = ()) -> DataFrame:
    """docs (lang, text) -> (lang, phrase, n): how often each phrase of ``size`` wanted words occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(list(tables))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, _Counter] = {}
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True):
                c = counters.get(lang) or counters.setdefault(lang, _Counter(lang, size, shared.value))
                c.texts.append(text)
                c.bytes += len(text)
                if c.bytes >= SLICE:
                    yield from c.work()
            if sum(c.bytes + 100 * len(c.words) + 16 * len(c.codes) for c in counters.values()) > 400_000_000:
                for c in counters.values():
                    yield from c.work()
                    yield from c.out()
                counters.clear()
        for c in counters.values():
            yield from c.work()
            yield from c.out()

    found = docs.mapInArrow(rows, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


# --- Scores --------------------------------------------------------------------


def floor_ratio(numerator: list, denominator: list) -> Column:
    """floor of the products' quotient, exactly; the numerator is at most 10^38."""

    def product(factors: list) -> Column:
        out = F.lit(1).cast("decimal(38,0)")
        for f in factors:
            out = (out * (F.col(f) if isinstance(f, str) else F.lit(f)).cast("decimal(19,0)")).cast("decimal(38,0)")
        return out

    return F.call_function("div", product(numerator), product(denominator))


def _first(c: str = "phrase") -> Column:
    return F.substring_index(c, " ", 1)


def _last(c: str = "phrase") -> Column:
    return F.substring_index(c, " ", -1)


def with_count(phrases: DataFrame, part: Column, counts: DataFrame, name: str) -> DataFrame:
    """phrases and the count ``name`` of a part of them."""
    known = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(name))
    return phrases.withColumn("_of", part).join(known, (F.col("lang") == F.col("_lang")) & (F.col("_of") == F.col("_part"))).drop("_lang", "_part", "_of")


def floors(pairs: DataFrame, k: int) -> DataFrame:
    """(lang, floor): the score of the k-th best pair of each language, 0 if it has fewer. Scores are at most SCALE + 1 values."""
    sizes = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    reached = sizes.withColumn("upto", upto).groupBy("lang").agg(F.max(F.when(F.col("upto") >= k, F.col("score"))).alias("floor"))
    return reached.select("lang", F.coalesce("floor", F.lit(0)).alias("floor"))


def grown(docs: DataFrame, words: DataFrame, pairs: DataFrame, cut: DataFrame, wanted: np.ndarray, min_count: int, contained: int) -> DataFrame:
    """Survivors at or above their language's floor: (lang, phrase, a, l, r, score). pairs: with n, f1, f2, score, ahead, back; cut: (lang, floor)."""
    docs, pairs = docs.join(cut.select("lang"), "lang", "left_semi").select("lang", "text"), pairs.join(cut, "lang")
    reach = [F.lit(True), F.col("ahead") >= F.col("floor"), F.col("back") >= F.col("floor"), F.col("score") >= F.col("floor")]
    flags = sum((r.cast("int") * (1 << k) for k, r in enumerate(reach)), F.lit(0))
    tables = bit_tables(pairs.select("lang", "phrase", flags.alias("flags")), len(reach))
    triples = stage(count(docs, 3, [wanted, *tables]).where(F.col("n") >= min_count))
    head, tail = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    scored = triples
    for part, counts, name in ((_first(), words, "f1"), (_last(), words, "f3"), (head, pairs, "f12"), (tail, pairs, "f23")):
        scored = with_count(scored, part, counts, name)
    one, two = floor_ratio([SCALE, "n", "n"], ["f1", "f23"]), floor_ratio([SCALE, "n", "n"], ["f12", "f3"])
    scored = scored.withColumns({"one": one, "two": two})
    early = F.col("one") <= F.col("two")
    longer = scored.select(
        "lang", "phrase", F.col("n").alias("a"), F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("one", "two").alias("score"),
    )
    longer = longer.join(cut, "lang").where("score >= floor").drop("floor")
    held = triples.select("lang", F.explode(F.array(head, tail)).alias("phrase"), F.col("n").alias("most")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    able = pairs.where("score >= floor").join(held, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("most") < contained * F.col("n"), F.lit(True)))
    return able.select("lang", "phrase", F.col("n").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), "score").unionByName(longer)


def best(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each language with their rank; first of each of SLOTS parts of a language, then of these."""
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    some = found.withColumn("slot", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slot").orderBy(*order))).where(F.col("rank") <= limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return some.withColumn("rank", rank).where(F.col("rank") <= limit).drop("slot")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, limit: int = LIMIT, contained: int = CONTAINED, start: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language; n counts all its words."""
    slim = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = stage(count(slim, 1))
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every.where(F.col("n") >= min_count)
    wanted = bit_tables(words.select("lang", "phrase", F.lit(1).alias("flags")), 1)[0]
    pairs = count(slim, 2, [wanted]).where(F.col("n") >= min_count)
    pairs = with_count(with_count(pairs, _first(), words, "f1"), _last(), words, "f2")
    pairs = stage(pairs.withColumns({"score": floor_ratio([SCALE, "n", "n"], ["f1", "f2"]), "ahead": floor_ratio([SCALE, "n"], ["f1"]), "back": floor_ratio([SCALE, "n"], ["f2"])}))
    settled, k = [], start or START * limit
    while not pairs.isEmpty():
        cut = stage(floors(pairs, k))
        found = stage(grown(slim, words, pairs, cut, wanted, min_count, contained))
        state = stage(cut.join(found.groupBy("lang").agg(F.count("*").alias("held")), "lang", "left"))
        done = state.where((F.col("floor") == 0) | (F.col("held") >= limit)).select("lang")
        settled.append(found.join(done, "lang", "left_semi"))
        pairs = pairs.join(done, "lang", "left_anti")
        k *= GROWTH
    if not settled:
        settled = [totals.where("false").select("lang", F.lit("").alias("phrase"), *(F.lit(0).cast("long").alias(c) for c in ("a", "l", "r", "score")))]
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    ranked = best(out, limit).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
