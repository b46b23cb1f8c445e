"""Quality rules: base counts, then the divergence of a document's histograms from language references.

References come from all documents of a language: a histogram over character classes, and one over the language's most
common words (the rest of the words is one more bin). A document is compared with every reference by Jensen-Shannon
distance (base 2, so 0 to 1) and goes by the nearest, which forgives a wrong or missing language tag. References of
languages with less than ``MIN_REFERENCE_SHARE`` of all words, of which there may be any number, stay a table and are
joined to the documents of their language.

Defined cases: a null text has no words and fails the base rules; a null language is a language of its own; documents
under the length guards are not judged by that histogram. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.arrow import CONTINUATION, LOWER, by_batch, map_rows, utf8
from tillbook.session import stage

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
REPEAT = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Histogram bins: white space, lower case, upper case, digits, sentence marks, symbols, other ASCII, others.
CLASSES = ("white", "lower", "upper", "digit", "mark", "symbol", "ascii", "other")
CLASS_OF = bytes(
    0 if c in WHITE else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 4 if c in b".,;:!?'\"()-" else 5 if c in b"#*$%&|<>=+@^~_{}[]\\/`" else 6 if c < 128 else 7
    for c in range(256)
)
COMMON_WORDS = 100
MIN_REFERENCE_SHARE = 0.001
#: Length guards and largest distances.
MIN_CHARS, MAX_CLASS_DISTANCE = 200, 0.25
MIN_COMMON_WORDS, MAX_WORD_DISTANCE = 50, 0.55
#: Words counted in a task before it passes them on.
FLUSH_WORDS = 300_000


def base_counts(text: bytes) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > REPEAT:
        windows = list(zip(*(islice(words, k, None) for k in range(REPEAT))))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            twice = np.fromiter((times[w] > 1 for w in windows), dtype=np.int64, count=len(windows))
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            edges[: len(windows)] += twice
            edges[REPEAT : REPEAT + len(windows)] -= twice
            repeated = int((np.cumsum(edges)[:-1] > 0).sum())
    return len(words), len(text.translate(None, WHITE + CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, words


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def class_histogram(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text.translate(CLASS_OF, CONTINUATION), dtype=np.uint8), minlength=len(CLASSES))


def js_distance(hist: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of one histogram to each row of refs (rows sum to 1)."""
    p = hist / hist.sum()
    m = (p + refs) / 2

    def kl(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.sqrt(np.maximum(0, (kl(np.broadcast_to(p, refs.shape)) + kl(refs)) / 2))


def _counts(batches):
    """(lang, kind, token, n) of a partition: words, character classes."""
    words: dict[str | None, Counter] = {}
    classes: dict[str | None, np.ndarray] = {}

    def rows():
        out = [(k, "w", w, n) for k, c in words.items() for w, n in c.items()]
        words.clear()
        return out

    def packed(out):
        lang, kind, token, n = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.string()), pa.array(token, pa.binary()), pa.array(n, pa.int64())], names=["lang", "kind", "token", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            words.setdefault(lang, Counter()).update(text.translate(LOWER).split())
            classes[lang] = classes.get(lang, 0) + class_histogram(text)
            if sum(map(len, words.values())) > FLUSH_WORDS:
                yield packed(rows())
    out = rows() + [(k, "c", name.encode(), int(n)) for k, h in classes.items() for name, n in zip(CLASSES, h, strict=True)]
    if out:
        yield packed(out)


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS) -> tuple[tuple, list, DataFrame | None]:
    """The references of the common languages (see ``pack_references``), these languages, and a table (l, own) of the other languages' reference rows.

    Counts cover all documents. Only the words of languages above a share of all words, so of at most
    1 / MIN_REFERENCE_SHARE languages, come to the driver. There is no table without other languages.
    """
    counts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).mapInArrow(_counts, "lang string, kind string, token binary, n bigint")
    counts = stage(counts.groupBy("lang", "kind", "token").agg(F.sum("n").alias("n")))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "token"))).where(F.col("rank") <= common)
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total")).withColumn("words", F.max(F.when(F.col("kind") == "w", F.col("total"))).over(Window.partitionBy("lang")))
    every = totals.where("kind = 'w'").agg(F.sum("total")).first()[0] or 0
    totals = totals.where("words > 0").withColumnsRenamed({"lang": "l", "kind": "k"})
    rows = top.join(totals, F.col("l").eqNullSafe(F.col("lang")) & (F.col("k") == F.col("kind"))).select("lang", "kind", "token", "n", "total", (F.col("words") >= MIN_REFERENCE_SHARE * every).alias("common"))
    rows = stage(rows)
    found = [(r.lang, r.kind, bytes(r.token), r.n, r.total) for r in rows.where("common").collect()]
    rare = rows.where("not common")
    own = rare.groupBy(F.col("lang").alias("l")).agg(F.collect_list(F.struct("kind", "token", "n", "total")).alias("own"))
    return pack_references(found), list({r[0] for r in found}), None if rare.isEmpty() else stage(own)


def with_own(df: DataFrame, key: str, langs: list, rare: DataFrame | None) -> DataFrame:
    """df and a last column: the reference rows of a document's language where that is none of langs."""
    nothing = F.lit(None).cast("array<struct<kind: string, token: binary, n: bigint, total: bigint>>")
    if rare is None:
        return df.withColumn("own", nothing)
    lang = F.col(key).cast("string")
    common = F.when(lang.isNull(), F.lit(None in langs)).otherwise(lang.isin([x for x in langs if x is not None]))
    return df.where(common).withColumn("own", nothing).union(df.where(~common).join(rare, lang.eqNullSafe(F.col("l")), "left").drop("l"))


def pack_references(rows) -> tuple[np.ndarray, dict[bytes, int], np.ndarray]:
    langs = sorted({r[0] for r in rows}, key=lambda x: (x is None, x or ""))
    vocabulary = {w: i for i, w in enumerate(sorted({r[2] for r in rows if r[1] == "w"}))}
    classes, words = np.zeros((len(langs), len(CLASSES))), np.zeros((len(langs), len(vocabulary) + 1))
    for lang, kind, token, n, total in rows:
        at = langs.index(lang)
        if kind == "c":
            classes[at, CLASSES.index(token.decode())] = n / max(total, 1)
        else:
            words[at, vocabulary[token]] = n / total
    words[:, -1] = 1 - words.sum(axis=1)
    return classes, vocabulary, np.maximum(words, 0)


def distances(text: bytes, words: list[bytes], refs) -> tuple[float | None, float | None]:
    """Distance to the nearest reference by character classes and by common words; None under a length guard."""
    classes, vocabulary, common = refs
    by_class = by_word = None
    if len(classes):
        hist = class_histogram(text)
        if hist.sum() >= MIN_CHARS:
            by_class = float(js_distance(hist, classes).min())
        if len(words) >= MIN_COMMON_WORDS:
            known = [vocabulary[w] for w in text.translate(LOWER).split() if w in vocabulary]
            hist = np.bincount(known, minlength=len(vocabulary) + 1)
            hist[-1] = len(words) - len(known)
            by_word = float(js_distance(hist, common).min())
    return by_class, by_word


def judge(text: bytes, refs, own=None) -> tuple:
    """The row of counts and verdicts for one text; own: the references of its language, if not in refs."""
    *counts, words = base_counts(text)
    failed = fails_base(counts[0], counts[4])
    found = [distances(text, words, r) for r in (refs, own) if r]
    by_class, by_word = (min((d for d in kind if d is not None), default=None) for kind in zip(*found, strict=True))
    far = (by_class or 0) > MAX_CLASS_DISTANCE or (by_word or 0) > MAX_WORD_DISTANCE
    return (*counts, failed, not failed and not far, by_class, by_word)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def _judged(texts: pa.Array, own: pa.Array, refs) -> list[tuple]:
    rows = [x and pack_references([("", r["kind"], r["token"], r["n"], r["total"]) for r in x]) for x in own.to_pylist()]
    return [judge(t, refs, x) for t, x in zip(utf8(texts), rows, strict=True)]


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each document: counts, base verdict, verdict, distances."""
    found, langs, rare = language_references(docs, text, lang)
    refs = docs.sparkSession.sparkContext.broadcast(found)
    kinds = (pa.int64(),) * 5 + (pa.bool_(),) * 2 + (pa.float64(),) * 2

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = _judged(batch.column(1), batch.column(2), refs.value)
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", *NAMES])

    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    schema = f"doc_id {slim.schema[0].dataType.simpleString()}, {', '.join(f'{n} bigint' for n in NAMES[:5])}, base_failed boolean, kept boolean, class_distance double, word_distance double"
    return with_own(slim, "lang", langs, rare).drop("lang").mapInArrow(by_batch(rows), schema)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns."""
    found, langs, rare = language_references(docs, text, lang)
    refs = docs.sparkSession.sparkContext.broadcast(found)
    at = docs.columns.index(text)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([r[6] for r in _judged(batch.column(at), batch.column(batch.num_columns - 1), refs.value)], type=pa.bool_()))

    names = [f"c{i}" for i in range(len(docs.columns))]
    wide = with_own(docs.toDF(*names), names[docs.columns.index(lang)], langs, rare)
    return map_rows(wide, by_batch(rows)).drop("own").toDF(*docs.columns)
