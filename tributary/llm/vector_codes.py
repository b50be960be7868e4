"""Compression of vectors to codes: one code book for each of equal consecutive parts of them.

Equal integer parts at one position are one row with a weight, counted within
each task before anything is shuffled, so that a part however common is looked
at once a round. Lloyd's rounds run over these rows: each task adds up what it
assigns, and the sums of all tasks make the next code books. The final codes and
errors are joined back to the vectors' parts: those of very common parts, of which
there can be few, are sent to all tasks, the others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, discard, materialise, returning_memory
from .vectors import MOST, as_long, finite, moved, nearest, real, sums_by

#: Components are held to this, so that integers of 64 bits hold them.
_LIMIT = 1 << 62
#: A part is very common if it is more than one of so many at its position.
HOT = 2000
#: Codes that are packed in one long.
_PACKED = 8

Books = list[list[list[int]]]


@dataclass(frozen=True)
class Codes:
    """``rows``: (id, label, code, error) of each vector that was kept; ``books``: the entries of each position's code book."""

    rows: DataFrame
    books: Books

    def digest(self) -> str:
        """SHA-256 of all entries' components, by position, entry and component."""
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()


def _first(kept: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids; of rows that share an id, the least vector."""
    found: dict = {}
    rest = kept.where("id is not null")
    while len(found) < entries:
        rows = rest.select("id", "v").orderBy("id", "v").limit(entries).collect()
        for r in rows:
            found.setdefault(r["id"], list(r["v"]))
        if len(rows) < entries:
            break
        rest = kept.where(F.col("id") > F.lit(rows[-1]["id"]))
    out = list(found.values())[:entries]
    if len(out) < entries:
        out += [list(r["v"]) for r in kept.where("id is null").select("v").orderBy("v").limit(1).collect()]
    return out


def _by_position(batch: pa.RecordBatch, books: Books):
    """(position, rows there, their parts, number of the nearest entry, distance) for each position in a batch of (pos, part, ...)."""
    pos = batch.column(0).to_numpy()
    parts = batch.column(1).flatten().to_numpy().reshape(len(pos), -1)
    for p in np.unique(pos):
        at = np.nonzero(pos == p)[0]
        yield int(p), at, parts[at], *nearest(parts[at], books[p])


def _trained(distinct: DataFrame, books: Books, rounds: int) -> Books:
    def partial(batches, books):
        total: dict = {}
        for batch in batches:
            weights = batch.column(2).to_numpy()
            for p, at, parts, numbers, _ in _by_position(batch, books):
                for k, (n, sums) in sums_by(numbers, parts, weights[at]).items():
                    m, before = total.get((p, k), (0, [0] * len(sums)))
                    total[p, k] = (m + n, [x + y for x, y in zip(before, sums)])
        rows = [(p, k, j, n, Decimal(s)) for (p, k), (n, sums) in total.items() for j, s in enumerate(sums)]
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["pos", "entry", "j", "n", "s"])

    for _ in range(rounds):
        sums = distinct.mapInArrow(returning_memory(lambda batches, books=books: partial(batches, books)), "pos int, entry int, j int, n long, s decimal(38,0)")
        # a row for each component of each entry of the code books
        rows = sums.groupBy("pos", "entry", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("pos", "entry", "j").collect()
        found: list[dict] = [{} for _ in books]
        for r in rows:
            found[r["pos"]].setdefault(r["entry"], (r["n"], []))[1].append(int(r["s"]))
        books = [moved(book, own) for book, own in zip(books, found)]
    return books


def _hex(column: Column, many: int) -> Column:
    return F.lower(F.lpad(F.hex(column), 2 * many, "0"))


def compress_vectors(table: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> Codes:
    """Codes of all vectors of which no component is null or not finite; other rows are dropped.

    A component x counts as the integer floor(256 x), held to 2^62 either way.
    A vector is cut into ``parts`` equal ones; where that can't be done, zeros are
    put behind it up to the next length that can. All vectors have the length of the first
    one by id; those of another length and empty ones have no codes and are dropped.
    A code book starts as the parts of the vectors of the ``entries`` (at most 256) smallest
    ids, ascending: of rows that share an id the least vector, of those without an id one,
    after the others. With fewer ids there are fewer entries; without a vector there are no
    rows and no code books. Each round assigns every part to the nearest entry, the first
    of equally near ones, and moves each entry that has parts to the floor of their mean.

    ``code`` has two hexadecimal digits for each part. ``error`` is the squared
    distance of a vector to what its code stands for; beyond a long it counts as the
    largest one. Repeated rows have a row each. Other columns are ignored.
    """
    spark = table.sparkSession
    vector = real(table, vector_column)
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * 256.0), F.lit(_LIMIT)), F.lit(-_LIMIT)))
    label = F.col(label_column) if label_column in table.columns else F.lit(None).cast("int")
    rows = table.where(finite(vector)).select(F.col(id_column).alias("id"), label.alias("label"), whole.alias("v"))
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    named = lambda df: df.withColumnsRenamed({"id": id_column, "label": label_column})
    lengths = rows.select("id", F.size("v").alias("n"), "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not lengths:
        empty = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(named(empty), [])
    width = -(-lengths[0]["n"] // parts)
    rows = rows.where(F.size("v") == lengths[0]["n"])
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), width * parts - lengths[0]["n"]))
    each = F.array(*[F.slice("padded", p * width + 1, width) for p in range(parts)])
    cut = rows.withColumn("padded", padded).select("rid", F.posexplode(each).alias("pos", "part"))

    first = [v + [0] * (width * parts - len(v)) for v in _first(rows, entries)]
    books = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)]
    distinct = materialise(cut.groupBy("pos", "part").agg(F.count("*").alias("n")), "parts")
    books = _trained(by_small_batches(distinct), books, rounds)

    def coded(batches):
        for batch in batches:
            code, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for _, at, _, numbers, distances in _by_position(batch, books):
                code[at], far[at] = numbers, distances
            yield pa.record_batch([*batch.columns[:3], pa.array(code), pa.array(far)], names=["pos", "part", "n", "code", "far"])

    codes = materialise(distinct.mapInArrow(returning_memory(coded), "pos int, part array<long>, n long, code int, far long"), "codes")
    discard(distinct)
    common = F.col("n") * HOT > F.lit(rows.count())  # fewer than HOT at a position
    hot = F.broadcast(codes.where(common).select("pos", "part", "code", "far"))
    cold = codes.where(~common).select("pos", "part", "code", "far")
    near = cut.join(hot, ["pos", "part"]).select("rid", "pos", "code", "far")
    other = cut.join(hot, ["pos", "part"], "left_anti").join(cold, ["pos", "part"]).select("rid", "pos", "code", "far")

    groups = [range(a, min(parts, a + _PACKED)) for a in range(0, parts, _PACKED)]
    packed = [
        F.bit_or(F.when(F.col("pos").between(g[0], g[-1]), F.call_function("shiftleft", F.col("code").cast("long"), 8 * (F.lit(g[-1]) - F.col("pos")))).otherwise(F.lit(0).cast("long"))).alias(f"g{i}")
        for i, g in enumerate(groups)
    ]
    found = near.unionByName(other).groupBy("rid").agg(*packed, F.sum(F.col("far").cast("decimal(19,0)")).alias("error"))
    code = F.concat(*[_hex(F.col(f"g{i}"), len(g)) for i, g in enumerate(groups)])
    out = rows.select("rid", "id", "label").join(found, "rid").select("id", "label", code.alias("code"), as_long(F.col("error")).alias("error"))
    return Codes(named(out), books)
