"""Fill-in-middle transformation by repeated-capture matching.

The regex library keeps every repetition of a group, so one ``fullmatch`` of ``(unit)*`` over a text gives the ends of all
its units: ``match.ends(1)`` supplies their number n and, looked up at two positions, both cut offsets. The quantifiers are
possessive, which matches the same units and leaves no backtracking state behind.

The cuts come from the hash of seed and id: the prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units, the middle
after the larger, the suffix is the rest. A share of ``rate`` percent is transformed, of these ``spm`` percent suffix first.

Defined cases: a null or empty text has no units and stays plain (output empty); a text that holds a sentinel stays plain,
so every output can be taken apart again (``restored``); a null id hashes as the empty string; repeated rows give equal
results; one very long unit is one unit; columns with the added names are replaced by the operator's own; an empty table gives
an empty result. A task holds one batch of texts and, for one text at a time, the ends of its units.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tillbook.llm.arrow import by_batch, map_rows

#: Lines, their end included; the last may have none. Possessive: nothing is given back.
LINES = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = 7, 100, 50
PLAIN, PSM, SPM_FORM = "plain", "psm", "spm"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Sentinels that could begin inside one another or inside themselves would make an output ambiguous."""
    if len(set(sentinels)) < 3 or not all(sentinels):
        raise ValueError("three different sentinels that are not empty")
    for a, b in [*permutations(sentinels, 2), *((s, s) for s in sentinels)]:
        inside = a != b and a in b
        if inside or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
            raise ValueError(f"sentinels {a!r} and {b!r} overlap")


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from seed and id."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(hexed[8 * k : 8 * k + 8], 16) for k in range(4))


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    unit: str = LINES,
    seed: int = SEED,
    rate: int = RATE,
    spm: int = SPM,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """All columns, and n, form, prefix_chars, middle_chars (null if plain) and output."""
    check_sentinels(sentinels)
    kept = docs.drop(*ADDED) if not {doc_id, text} & set(ADDED) else docs
    at_id, at_text = kept.columns.index(doc_id), kept.columns.index(text)
    units = f"({unit})*+"
    first, last, mid = sentinels

    def one(key, body: str) -> tuple:
        match = regex.fullmatch(units, body)
        if match is None:
            raise ValueError("the units do not cover every text")
        ends = match.ends(1) if body else []
        n = len(ends)
        h1, h2, h3, h4 = draws(key, seed)
        if not body or any(s in body for s in sentinels) or h3 % 100 >= rate:
            return n, PLAIN, None, None, body
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[k - 1] if k else 0 for k in (low, high))
        prefix, middle, suffix = body[:a], body[a:b], body[b:]
        if h4 % 100 < spm:
            return n, SPM_FORM, a, b - a, f"{last}{suffix}{first}{prefix}{mid}{middle}"
        return n, PSM, a, b - a, f"{first}{prefix}{last}{suffix}{mid}{middle}"

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [one(k.as_py(), t.as_py() or "") for k, t in zip(batch.column(at_id), batch.column(at_text), strict=True)]
        added = [pa.array(c, kind) for c, kind in zip(zip(*made, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *ADDED])

    types = (LongType(), StringType(), LongType(), LongType(), StringType())
    return map_rows(kept, by_batch(rows), [StructField(n, t) for n, t in zip(ADDED, types, strict=True)])


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output was made from: no part holds a sentinel, so each occurs once."""
    first, last, mid = sentinels

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, mid, -1)
    psm = F.concat(between(first, last), middle, between(last, mid))
    spm = F.concat(between(first, mid), middle, between(last, first))
    return F.when(form == PSM, psm).when(form == SPM_FORM, spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of documents."""
    out = transform(docs.select("doc_id", "text"))
    again = restored(F.col("output"), F.col("form"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256")
    )
