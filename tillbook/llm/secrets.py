"""Secret scans: fixed patterns, then character Markov models of random strings and of ordinary text.

Two first-order models over the characters of identifiers (all other bytes are one boundary symbol) are trained from
labelled samples of the whole corpus: the values of the fixed patterns as random strings, the rest of the texts as
ordinary. Transition counts are added up across partitions; what reaches the driver is two tables of SYMBOLS ** 2 counts.
A run of identifier characters that holds letters and digits, is long enough and lies outside the spans of the patterns is
a secret if its log-likelihood under the random model exceeds the one under the ordinary model by MIN_RATIO for each
character.

Defined cases: a null text is empty; with no random sample in the corpus the models agree and no span is added; repeated
rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.arrow import LOWER, by_batch, code_points, utf8

#: Fixed patterns and least lengths (of group 2, or of the match).
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")

#: The models' alphabet; symbol 0 stands for every other byte.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOL_OF = bytes(ALPHABET.find(bytes([c])) + 1 for c in range(256))
SYMBOLS = len(ALPHABET) + 1
MIN_RUN = 16
RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGIT, LETTER = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z]")
MIN_RATIO = 0.3
IN_RUN = bytes(120 if SYMBOL_OF[c] else 32 for c in range(256))
IN_HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))


def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in bytes, in order."""
    out = []
    lower = text.translate(LOWER)
    if any(k in lower for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if b"x" * 32 in text.translate(IN_HEX):
        out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def transitions(text: bytes) -> np.ndarray:
    """Counts of neighbouring symbols, with a boundary before and after."""
    symbols = np.frombuffer((b" " + text + b" ").translate(SYMBOL_OF), dtype=np.uint8).astype(np.int64)
    return np.bincount(symbols[:-1] * SYMBOLS + symbols[1:], minlength=SYMBOLS * SYMBOLS)


def _train(batches):
    counts = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
    for batch in batches:
        for text in utf8(batch.column(0)):
            spans = base_spans(text)
            if spans:
                kept = bytearray(text)
                for _, _, end, value in spans:
                    counts[1] += transitions(text[value:end])
                    kept[value:end] = b" " * (end - value)
                text = bytes(kept)
            counts[0] += transitions(text)
    label, pair = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(pair), pa.array(counts[label, pair])], names=["label", "pair", "n"])


def log_models(counts: np.ndarray) -> np.ndarray:
    """(2, symbols, symbols): log probabilities of the next symbol, one added to each count."""
    grid = counts.reshape(2, SYMBOLS, SYMBOLS) + 1.0
    return np.log(grid / grid.sum(axis=2, keepdims=True))


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The difference of the models' log probabilities, random less ordinary, by pair of symbols."""
    counts = np.zeros((2, SYMBOLS * SYMBOLS))
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_train, "label bigint, pair bigint, n bigint")
    for r in rows.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        counts[r.label, r.pair] = r.n
    models = log_models(counts)
    return (models[1] - models[0]).reshape(-1) if counts[1].any() else np.full(SYMBOLS * SYMBOLS, -np.inf)


def ratio(run: bytes, model: np.ndarray) -> float:
    """Mean log-likelihood ratio of a run's inner transitions."""
    symbols = np.frombuffer(run.translate(SYMBOL_OF), dtype=np.uint8).astype(np.int64)
    return float(model[symbols[:-1] * SYMBOLS + symbols[1:]].mean())


def all_spans(text: bytes, model: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes: the base spans, and the runs that the models call random."""
    base = base_spans(text)
    spans = [s[:3] for s in base]
    if b"x" * MIN_RUN in text.translate(IN_RUN):
        for m in RUN.finditer(text):
            run = m.group()
            if DIGIT.search(run) and LETTER.search(run) and not any(a < m.end() and m.start() < b for a, _, b in spans) and ratio(run, model) > MIN_RATIO:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def digest_row(text: bytes, model: np.ndarray) -> tuple:
    spans = all_spans(text, model)
    named = [(k, f"{KINDS[k]}:{(start := code_points(text[:a]))}:{start + code_points(text[a:b])}") for a, k, b in spans]
    base = ",".join(s for k, s in named if k < 3)
    n = [sum(k == kind for k, _ in named) for kind in range(4)]
    return (*n[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, s in named), n[3])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov), one row for each document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, text))
    kinds = (pa.int64(),) * 3 + (pa.string(),) * 2 + (pa.int64(),)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [digest_row(t, model.value) for t in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {slim.schema[0].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_markov bigint"
    return slim.mapInArrow(by_batch(rows), schema)
