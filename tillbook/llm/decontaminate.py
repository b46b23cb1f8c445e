"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts are normalised byte by byte (A-Z lowered, other ASCII that is no digit or letter to a blank), so an offset in the
normalised text is the same offset in the original. Blanks are then collapsed, and the automaton, whose patterns carry
a blank on either side, reads each text once; a match ends at a blank, whose rank is the number of the word before it.

Defined cases: a null or empty text has no words, no hits and is not contaminated; items without words have no window;
rows with the same item id are one item; a null item id is written as the empty string; repeated documents are judged
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.arrow import by_batch, map_rows, utf8

WINDOW = 13
#: Contaminated from one hit word in so many.
HIT_SHARE = 20
#: Proven bound of what each task receives: the test items, in bytes. Larger sets are passed in parts by the caller.
MAX_BENCHMARK_BYTES = 256 << 20
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def _joined(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode("latin-1")  # one character for each byte


def build_automaton(items: list[tuple[str, bytes]], window: int = WINDOW) -> ahocorasick.Automaton | None:
    """items: (id as text, UTF-8 text). Each pattern carries its number of words and the ids of its items."""
    owners: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1) if size else ():
            owners.setdefault(_joined(words[at : at + size]), (size, set()))[1].add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for pattern, owner in owners.items():
        automaton.add_word(pattern, owner)
    automaton.make_automaton()
    return automaton


def find_hits(words: list[bytes], automaton: ahocorasick.Automaton | None) -> tuple[np.ndarray, list[str]]:
    """Which words lie inside an occurrence of a window, and the sorted ids of the items concerned."""
    hit, found = np.zeros(len(words), dtype=bool), set()
    if automaton is None or not words:
        return hit, []
    text = _joined(words)
    blanks = None
    for end, (size, items) in automaton.iter(text):
        if blanks is None:
            blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 32)
        after = int(np.searchsorted(blanks, end))  # the blank of this rank follows the window's last word
        hit[after - size : after] = True
        found |= items
    return hit, sorted(found)


def hit_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as offsets into the original text, in code points, end exclusive."""
    if not hit.any():
        return []
    inside = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    point = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return [(int(point[starts[a]]), int(point[ends[b - 1]])) for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True)]


def is_contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and HIT_SHARE * n_hit >= n_words


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = MAX_BENCHMARK_BYTES) -> list[tuple[str, bytes]]:
    """The test items, whose size is checked before they leave the cluster."""
    total = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if total > limit:
        raise ValueError(f"benchmark holds {total} bytes, over the bound of {limit}; pass it in parts")
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).collect()
    return [(r[0], r[1].encode()) for r in rows]


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each document: word counts, items found, verdict, and the hit spans in the original text."""
    items = docs.sparkSession.sparkContext.broadcast(benchmark_items(benchmark))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {slim.schema[0].dataType.simpleString()}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<start: int, end: int>>"

    def run(batches):
        automaton = build_automaton(items.value, window)

        def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for raw in utf8(batch.column(1)):
                words = words_of(raw)
                hit, found = find_hits(words, automaton)
                n_hit = int(hit.sum())
                out.append((len(words), n_hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), is_contaminated(len(words), n_hit), [{"start": a, "end": b} for a, b in hit_spans(raw, hit)]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            columns = [pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

        yield from by_batch(judge)(batches)

    return slim.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    items = docs.sparkSession.sparkContext.broadcast(benchmark_items(benchmark))
    at = docs.columns.index(text)

    def run(batches):
        automaton = build_automaton(items.value, window)

        def clean(raw: bytes) -> bool:
            words = words_of(raw)
            return not is_contaminated(len(words), int(find_hits(words, automaton)[0].sum()))

        yield from by_batch(lambda b: b.filter(pa.array([clean(x) for x in utf8(b.column(at))], type=pa.bool_())))(batches)

    return map_rows(docs, run)
