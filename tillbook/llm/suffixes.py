"""Suffix order of many strings by the distributed difference-cover algorithm (modulo three).

Strings are rows (sid, names): names are positive 64-bit numbers, and an end of string sorts below every name. A zero is a
gap: no suffix begins there, and none reads on past it, as the name before a gap occurs once. One level
sorts the triples at the positions 1 and 2 modulo 3 and numbers them; if numbers repeat, the strings of these numbers are
ordered first by the same algorithm. The remaining positions are then merged: beside positions 1 modulo 3 they go by
(name, place of the next suffix), beside positions 2 modulo 3 by (name, name, place of the one after), and a suffix's
place is the number of suffixes before it. Every sort is a range exchange whose partitions count for themselves; only a
few numbers a partition come to the driver. Equal keys are split by their string, so no key meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from tillbook.session import stage

MAX_LEVELS = 12


def release(*staged: DataFrame) -> None:
    """Remove staged tables whose readers are staged themselves."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def looked_up(values: dict[int, int], key: str):
    """A column: the value of each key, keys being small numbers."""
    known = [values.get(i, 0) for i in range(max(values, default=0) + 1)]
    return F.element_at(F.expr(f"array({', '.join(f'{v}L' for v in known)})"), F.col(key).cast("int") + 1)


def range_sorted(rows: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    return rows.repartitionByRange(*keys, *ties).sortWithinPartitions(*keys, *ties)


def numbered(rows: DataFrame, keys: list[str], ties: list[str]) -> tuple[DataFrame, int, int]:
    """(ties, number, place, twin): number counts the distinct keys up to a row from 1, place the rows before it. Also both totals.

    twin tells whether another row has the key; it may also be set for the first and last row of a partition.
    """
    own = [rows.schema[t] for t in ties]
    fields = [*own, *(StructField(n, LongType()) for n in ("number", "place")), StructField("twin", BooleanType()), StructField("part", IntegerType()), StructField("edge", BinaryType())]
    names = [f.name for f in fields]

    def run(batches):
        part, last, number, place, held = TaskContext.get().partitionId(), None, 0, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(b.schema.get_field_index(k)) for k in keys]
            new = np.ones(b.num_rows, bool)
            if b.num_rows > 1:
                new[1:] = np.logical_or.reduce([pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False) for c in columns])
            ends = [repr([c[i].as_py() for c in columns]).encode() for i in (0, b.num_rows - 1)]
            new[0] = ends[0] != last
            numbers = number + np.cumsum(new)
            edge = [None] * b.num_rows
            edge[0], edge[-1] = ends[0], ends[1]
            twin = ~new
            twin[:-1] |= ~new[1:]
            if place == 0:
                twin[0] = True
            if held is not None:  # the last row of the batch before, which has met its successor now
                yield pa.RecordBatch.from_arrays([*held[:-3], pa.array([bool(held[-3][0].as_py() or not new[0])]), *held[-2:]], names=names)
            made = [
                *(b.column(b.schema.get_field_index(t)) for t in ties), pa.array(numbers), pa.array(place + np.arange(b.num_rows)),
                pa.array(twin), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(edge, pa.binary()),
            ]
            if b.num_rows > 1:
                yield pa.RecordBatch.from_arrays([c[:-1] for c in made], names=names)
            held, last, number, place = [c[-1:] for c in made], ends[1], int(numbers[-1]), place + b.num_rows
        if held is not None:
            yield pa.RecordBatch.from_arrays([*held[:-3], pa.array([True]), *held[-2:]], names=names)

    found = stage(range_sorted(rows.select(*keys, *ties), keys, ties).mapInArrow(run, StructType(fields)))
    edges = found.where("edge is not null").groupBy("part").agg(F.min_by("edge", "place").alias("first"), F.max_by("edge", "place").alias("last"), F.max("number").alias("number"), F.max("place").alias("place"))
    number = place = 0
    numbers, places, before = {}, {}, None
    for r in edges.orderBy("part").collect():
        numbers[r.part], places[r.part] = number - (bytes(r["first"]) == before), place
        number, place, before = numbers[r.part] + r.number, place + r.place + 1, bytes(r["last"])
    out = found.select(*ties, (F.col("number") + looked_up(numbers, "part")).alias("number"), (F.col("place") + looked_up(places, "part")).alias("place"), "twin")
    return out, number, place


class Joined:
    """The strings of a batch one after the other, each with two ends behind it; gaps are ends as well."""

    def __init__(self, sids: pa.Array, names: pa.Array):
        packed = names.to_pylist()
        sizes = np.array([len(x) // 8 for x in packed], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]
        self.sid = np.repeat(sids.to_numpy(), sizes + 2)
        self.j = np.arange(len(self.sid)) - np.repeat(self.starts, sizes + 2)
        self.names = np.where(self.j < np.repeat(sizes, sizes + 2), 1, 0)
        self.names[self.names > 0] = np.frombuffer(b"".join(packed), np.int64)
        self.begins = np.flatnonzero(self.names > 0)
        self.names = np.where(self.names > 0, self.names, -self.sid - 1)


def _triples(batches):
    for b in batches:
        s = Joined(b.column(0), b.column(1))
        at = s.begins[s.j[s.begins] % 3 > 0]
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s.names[at], s.names[at + 1], s.names[at + 2], s.sid[at], s.j[at])], names=["a", "b", "c", "sid", "j"])


def gathered(rows: DataFrame, value: str) -> DataFrame:
    """(sid, j, value) -> (sid, found): the entries of each string, which is no longer than a text."""
    return rows.groupBy("sid").agg(F.collect_list(F.struct("j", F.col(value).alias("v"))).alias("found"))


def flat_entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a gathered column: the row of each entry, its position and its value."""
    flat, ends = column.flatten(), column.offsets.to_numpy()
    return np.repeat(np.arange(len(column)), np.diff(ends)), flat.field("j").to_numpy(), flat.field("v").to_numpy()


def entries(column: pa.Array):
    """Of each row of a gathered column: positions and values."""
    _, j, v = flat_entries(column)
    ends = column.offsets.to_numpy() - column.offsets[0].as_py()
    for a, z in zip(ends[:-1], ends[1:], strict=True):
        yield j[a:z], v[a:z]


def _numbers_as_strings(batches):
    for b in batches:
        sids, names = [], []
        for sid, (j, v) in zip(b.column(0).to_pylist(), entries(b.column(1)), strict=True):
            own = np.zeros(int(j.max()) + 1, np.int64)
            own[j] = v
            for rest in (1, 2):
                sids.append(2 * sid + rest - 1)
                names.append(own[rest::3].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(names, pa.binary())], names=["sid", "names"])


def _merge_keys(batches):
    """Each string's rows for the two merges. kind: 3 * side + position modulo 3, side 1 or 2 being that of the sampled positions."""
    for b in batches:
        s = Joined(b.column(0), b.column(1))
        row, j, v = flat_entries(b.column(2))
        places = np.where(s.names > 0, 0, s.names)
        np.add.at(places, s.starts[row] + j, v)
        rest = s.j % 3
        out = []
        for side in (1, 2):
            at = s.begins[(rest[s.begins] == 0) | (rest[s.begins] == side)]
            second = places[at + 1] if side == 1 else s.names[at + 1]
            third = np.zeros(len(at), np.int64) if side == 1 else places[at + 2]
            out.append((np.full(len(at), side, np.int32), s.names[at], second, third, (3 * side + rest[at]).astype(np.int32), s.sid[at], s.j[at], places[at]))
        if len(s.begins):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["side", "x", "y", "z", "kind", "sid", "j", "own"])


MERGE = "side int, x bigint, y bigint, z bigint, kind int, sid bigint, j bigint, own bigint"
MERGED = "kind int, sid bigint, j bigint, v bigint, c bigint, part int, zeros bigint, ones bigint"


def _merged(batches):
    """(kind, sid, j, v, c, part): v and c count, within the partition, the sampled rows and the others before a row, with what is known already."""
    part, zeros, ones = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        kind, sid, j, own = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("kind", "sid", "j", "own"))
        is0 = (kind % 3 == 0).astype(np.int64)
        c0, c1 = np.cumsum(is0) - is0 + zeros, np.cumsum(1 - is0) - (1 - is0) + ones
        zeros, ones = zeros + int(is0.sum()), ones + int((1 - is0).sum())
        last = np.zeros(b.num_rows, bool)
        last[-1] = True
        columns = (kind, sid, j, np.where(is0 == 1, c1, own), c0, np.full(b.num_rows, part, np.int32), np.where(last, zeros, -1), np.where(last, ones, -1))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "sid", "j", "v", "c", "part", "zeros", "ones"])


def places(strings: DataFrame, levels: int = MAX_LEVELS) -> DataFrame:
    """(sid, j, v): the v of a position's rows add up to the number of suffixes before its own.

    With ``levels`` spent, suffixes that agree over 3 ** (levels + 1) names are put in any order.
    """
    named, distinct, total = numbered(strings.mapInArrow(_triples, "a bigint, b bigint, c bigint, sid bigint, j bigint"), ["a", "b", "c"], ["sid", "j"])
    used = [named]
    if distinct == total or not levels:
        sample = named.select("sid", "j", F.col("place").alias("v"))
    else:
        shorter = stage(gathered(named, "number").mapInArrow(_numbers_as_strings, "sid bigint, names binary"))
        deeper = places(shorter, levels - 1)
        used += [shorter, deeper]
        sample = deeper.select(F.shiftright("sid", 1).alias("sid"), (3 * F.col("j") + 1 + F.col("sid") % 2).alias("j"), "v")
    known = strings.join(gathered(sample, "v"), "sid", "left").withColumn("found", F.coalesce("found", F.expr("cast(array() as array<struct<j: bigint, v: bigint>>)")))
    rows = known.select("sid", "names", "found").mapInArrow(_merge_keys, MERGE)
    merged = stage(range_sorted(rows, ["side", "x", "y", "z"], ["sid", "j"]).mapInArrow(_merged, MERGED))
    release(*used)
    zeros = ones = 0
    zero_at, one_at = {}, {}
    for r in merged.where("zeros >= 0").groupBy("part").agg(F.max("zeros").alias("zeros"), F.max("ones").alias("ones")).orderBy("part").collect():
        zero_at[r.part], one_at[r.part] = zeros, ones
        zeros, ones = zeros + r.zeros, ones + r.ones
    first = merged.where("kind < 6").agg(F.count_if(F.col("kind") == 3).alias("n0"), F.count_if(F.col("kind") != 3).alias("n1")).first()
    c0 = F.col("c") + looked_up(zero_at, "part") - F.when(F.col("kind") >= 6, first.n0).otherwise(0)
    c1 = F.col("v") + looked_up(one_at, "part") - F.when(F.col("kind") >= 6, first.n1).otherwise(0)
    value = F.when(F.col("kind") % 3 != 0, F.col("v") + c0).when(F.col("kind") == 6, c1).otherwise(c0 + c1)
    return merged.select("sid", "j", value.alias("v"))
