"""CSV files of unknown encodings and column orders as one table, read by splits.

A line feed is never part of a longer character in the encodings here, so a file has an encoding exactly if each of its lines
has it: the encoding of a file is settled by one aggregate over the lines of its splits, however large the file.

Files in UTF-8 whose quoted fields end on their line are read by Spark's CSV reader, all in one scan of columns by position;
the header of each file says which positions are wanted. The others go by lines: these are decoded in Arrow batches and joined
to records. For that each line is a function from "begins inside a quoted field" to "ends inside one"; the functions compose,
so a line's beginning follows from running values over the lines of its file (``core.running``, in slices for large files).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.core import running
from tillbook.session import stage

#: In the order in which they are tried; the last takes any bytes.
CSV_ENCODINGS = ("utf-8-sig", "cp949", "euc-kr", "latin-1")
UTF8 = ("utf-8", "utf-8-sig", "utf8")
GLOB = "*.{csv,txt}"
PARSE = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def walk(line: str, inside: bool) -> tuple[int, bool]:
    """Field ends within a line, and whether it ends inside a quoted field, given whether it begins inside one."""
    at = commas = 0
    while True:
        if inside:
            quote = line.find('"', at)
            if quote < 0:
                return commas, True
            at = quote + 1
            if line.startswith('"', at):  # a quote of the text
                at += 1
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        comma = line.find(",", at)
        if comma < 0:
            return commas, False
        at, commas = comma + 1, commas + 1


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, at, line): raw lines with the start of their split and their order in it."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", GLOB).text(list(paths))
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")
    )


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def _too_long(most: Column) -> Column:
    text = F.concat(F.lit("a row has "), most.cast("string"), F.lit(" fields, the header "), F.size("names").cast("string"))
    return F.when(most > F.size("names"), text)


def with_names(files: DataFrame) -> DataFrame:
    """files and the names in their header, in order."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        import csv

        names = [None if h is None else [n.strip() for n in next(csv.reader([h]), [])] for h in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.list_(pa.string()))], names=["file", "names"])

    return files.join(_map(files.select("file", "header"), read, "file string, names array<string>"), "file")


def survey(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str]) -> DataFrame:
    """(file, names, plain, error): each file with its header; plain if Spark's reader can take it as it is."""
    lines = _lines(spark, paths)
    commas = F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))
    has_text, quoted = F.trim("line") != "", F.col("line").contains('"')
    files = lines.groupBy("file").agg(
        F.every(F.is_valid_utf8("line")).alias("utf8"), F.bool_or(quoted).alias("quoted"), F.min(F.when(has_text, F.struct("block", "at", "line")))["line"].alias("header"),
        F.max(F.when(has_text & ~quoted, commas + 1)).alias("most"),
    )
    files = stage(files)
    if files.where("quoted").isEmpty():
        files = files.withColumns({"opens": F.lit(False), "most_quoted": F.lit(None).cast("long")})
    else:

        def walked(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [walk(b.decode("latin-1"), False) for b in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([n + 1 for n, _ in found], pa.int64()), pa.array([o for _, o in found])], names=["file", "n", "opens"])

        marked = _map(lines.where(quoted).select("file", F.col("line").cast("binary")), walked, "file string, n long, opens boolean")
        files = files.join(marked.groupBy("file").agg(F.bool_or("opens").alias("opens"), F.max("n").alias("most_quoted")), "file", "left")
    plain = F.lit(encodings[0].lower() in UTF8) & F.col("utf8") & ~F.coalesce("opens", F.lit(False))
    files = with_names(files.withColumn("plain", plain))
    return stage(files.select("file", "names", "plain", F.when(F.col("plain"), _too_long(F.greatest("most", "most_quoted"))).alias("error")))


def _paths(files: DataFrame) -> list[str]:
    """Paths as Spark's readers take them; as in any scan, the list of files is the driver's."""
    return [unquote(r[0]) for r in files.select("file").collect()]


def counted_fields(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = [1 + (walk(t, False)[0] if '"' in t else t.count(",")) for t in batch.column(3).to_pylist()]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n"])


def encoded(lines: DataFrame, encodings: Sequence[str]) -> DataFrame:
    """(file, encoding): the first encoding that takes all lines of a file, null if none does."""
    charsets = list(encodings)

    def fits(raw: bytes, charset: str) -> bool:
        try:
            raw.decode(charset)
        except UnicodeDecodeError:
            return False
        return True

    def takes(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(1).to_pylist()
        masks = [sum(1 << i for i, c in enumerate(charsets) if fits(b, c)) for b in raw]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(masks, pa.int32())], names=["file", "mask"])

    masks = _map(lines.select("file", F.col("line").cast("binary")), takes, "file string, mask int").groupBy("file").agg(F.bit_and("mask").alias("mask"))
    chosen = F.lit(None).cast("string")
    for i, charset in reversed(list(enumerate(charsets))):
        chosen = F.when(F.col("mask").bitwiseAND(1 << i) != 0, charset).otherwise(chosen)
    return masks.select("file", chosen.alias("encoding"))


def records(spark: SparkSession, paths: Sequence[str], encodings: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """((file, encoding, names, error) of files read by lines, (file, record)); blank lines between records are none."""
    lines = _lines(spark, paths)
    charset = stage(encoded(lines, encodings))

    def decoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [b.decode(c).removeprefix("﻿") for b, c in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        ends = [[walk(t, inside)[1] if '"' in t else inside for t in text] for inside in (False, True)]
        out, kept = (pa.array(e, pa.bool_()) for e in ends)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(text, pa.string()), batch.column(4), out, kept], names=["file", "block", "at", "line", "encoding", "opens", "stays"])

    known = lines.withColumn("line", F.col("line").cast("binary")).join(charset.where("encoding IS NOT NULL"), "file")
    # Written out, so that block and place are the same for all that follows, wherever the splits fall.
    text = stage(_map(known.select("file", "block", "at", "line", "encoding"), decoded, "file string, block long, at long, line string, encoding string, opens boolean, stays boolean"))
    # A line's function is constant (opens = stays), keeps its beginning (not opens, stays) or turns it round (opens, not stays).
    turns = (F.col("opens") & ~F.col("stays")).cast("int")
    order = ["block", "at"]
    counted = running(text.withColumn("turn", turns), ["file"], order, {"turned": ("sum", "turn"), "line_no": ("count", None)})
    fixed = F.when(F.col("opens") == F.col("stays"), F.col("opens").cast("int") + F.col("turned"))
    ended = running(counted.withColumn("fixed", fixed), ["file"], order, {"last_fixed": ("last", "fixed")})
    inside_after = F.pmod(F.coalesce("last_fixed", F.lit(0)) + F.col("turned"), F.lit(2)) == 1
    # The line ends a record if it ends outside; a record is the lines up to such an end.
    ends = ended.withColumn("end", (~inside_after).cast("int"))
    numbered = running(ends, ["file"], order, {"upto": ("sum", "end")}).withColumn("record_no", F.col("upto") - F.col("end"))
    whole = numbered.groupBy("file", "encoding", "record_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("parts"))
    whole = whole.select("file", "encoding", "record_no", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record")).where(F.trim("record") != "")
    whole = stage(_map(whole, counted_fields, "file string, encoding string, record_no long, record string, n long"))
    heads = whole.groupBy("file").agg(F.min("record_no").alias("first"), F.min_by("record", "record_no").alias("header"), F.max("n").alias("most"))
    files = with_names(charset.join(heads, "file", "left"))
    error = F.when(F.col("encoding").isNull(), "no encoding fits").otherwise(_too_long(F.col("most")))
    return stage(files.select("file", "encoding", "names", error.alias("error"))), whole.join(heads, "file").where("record_no > first").select("file", "record")


def _bound(rows: DataFrame, width: int, wanted: Sequence[str]) -> DataFrame:
    """rows (file, encoding, names, f0, f1, ...) -> (file, encoding, error, c0, c1, ...): the fields that have the wanted names."""
    fields = F.array(*[f"f{i}" for i in range(width)]) if width else F.array().cast("array<string>")
    at = [F.array_position("names", F.lit(c)).cast("int") for c in wanted]
    values = [F.when(p > 0, F.nullif(F.get(fields, p - 1), F.lit(""))).alias(f"c{i}") for i, p in enumerate(at)]
    return rows.select("file", "encoding", F.lit(None).cast("string").alias("error"), *values)


def _width(files: DataFrame) -> int:
    return files.agg(F.max(F.size("names"))).first()[0] or 0


def csv_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], encodings: Sequence[str] = CSV_ENCODINGS) -> DataFrame:
    """(_file, _encoding, _error, the columns): the rows of CSV files, columns bound by the names in each file's header.

    A wanted column that a file lacks is null, so are an empty field and one that a short row does not reach. A file that no
    encoding takes, or with a row of more fields than its header, gives one row with the error and no others.
    """
    wanted = list(columns)
    files = survey(spark, paths, encodings)
    kinds = ", ".join(["file string", "encoding string", "error string", *(f"c{i} string" for i in range(len(wanted)))])
    bound = spark.createDataFrame([], kinds)

    def failed(bad: DataFrame) -> DataFrame:
        return bad.where(F.col("error").isNotNull()).select("file", F.lit(None).cast("string").alias("encoding"), "error", *(F.lit(None).cast("string").alias(f"c{i}") for i in range(len(wanted))))

    good = files.where(F.col("plain") & F.col("error").isNull() & F.col("names").isNotNull())
    plain, others = _paths(good), _paths(files.where(~F.col("plain")))
    if plain:
        width = _width(good)
        rows = spark.read.options(**PARSE, header=True, enforceSchema=True).schema(", ".join(f"f{i} string" for i in range(width))).csv(plain)
        named = rows.withColumn("file", F.col("_metadata.file_path")).join(good.select("file", "names", F.lit(encodings[0]).alias("encoding")), "file")
        bound = bound.unionByName(_bound(named, width, wanted))
    bound = bound.unionByName(failed(files))
    if others:
        odd, found = records(spark, others, encodings)
        good = odd.where(F.col("error").isNull())
        width = max(1, _width(good))
        parsed = F.from_csv("record", ", ".join(f"f{i} string" for i in range(width)), PARSE)
        named = found.join(good, "file").select("file", "encoding", "names", parsed.alias("p")).select("file", "encoding", "names", "p.*")
        bound = bound.unionByName(_bound(named, width, wanted)).unionByName(failed(odd))
    return bound.toDF("_file", "_encoding", "_error", *wanted)


def scan_csv_union(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], encodings: Sequence[str] = CSV_ENCODINGS,
    source_col: str | None = None, on_error: str = "raise",
) -> DataFrame:
    """The rows of all CSV files; short rows are padded with nulls.

    A file that cannot be read (a row longer than the header, bytes in no encoding) fails the job; with ``on_error="skip"`` it
    is left out whole, and ``skipped_csv_files`` names it.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error is 'raise' or 'skip'")
    found = csv_files(spark, paths, columns, encodings)
    if on_error == "skip":
        found = found.where(F.col("_error").isNull())
    else:
        fail = F.raise_error(F.concat_ws(": ", "_file", "_error")).cast("string")
        found = found.withColumn("_file", F.when(F.col("_error").isNotNull(), fail).otherwise(F.col("_file"))).where(F.col("_file").isNotNull())
    return found.select(*[F.col(f"`{c}`") for c in columns], *([F.col("_file").alias(source_col)] if source_col else []))


def skipped_csv_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], encodings: Sequence[str] = CSV_ENCODINGS) -> DataFrame:
    """(file, error) of the files that ``scan_csv_union`` fails on or leaves out."""
    found = csv_files(spark, paths, columns, encodings).where(F.col("_error").isNotNull())
    return found.select(F.col("_file").alias("file"), F.col("_error").alias("error"))
