"""Packing of token sequences: dominance reduction, then best fit.

The instance is the histogram of piece lengths, at most ``capacity`` counts, so
it and its packing are of bounded size whatever the number of documents. The
driver packs the histogram; Spark tokenizes, counts, ranks the pieces within
each length, and hands each piece the slot of its rank.

Reduction (after Martello and Toth), in bulk over equal lengths: the largest
length is fixed together with what dominates every alternative for it:

* nothing, if not even the shortest piece fits beside it;
* the longest piece that fits, if that fills the sequence exactly, or if no two
  pieces fit beside it together, or if it is no shorter than the two longest
  that fit beside it and no three do.

Fixing these keeps some optimal packing reachable. What the rules leave is
packed by best fit, longest first, again in bulk.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MEMO_CHARS, by_small_batches, materialise, returning_memory, without_nulls
from .token_count import _ODD_SPACE, LAST_LATIN, Merger, _tokenizer, is_as_known

#: Units whose ids a worker keeps; beyond it the memo starts afresh.
MEMO_ENTRIES = 400_000

#: No pre-token of the byte-level pattern runs from a visible character into white space.
_UNITS = re.compile(r"\s*\S+|\s+").findall
#: The tokenizer's own pre-token pattern.
_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII_PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")


_BEYOND_LATIN = re.compile(f"[^\0-{LAST_LATIN}]")


#: What this module knows to do by itself; files that say otherwise are left to the library.
KNOWN = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "end_of_word_suffix": None}


class UnitEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes, by a memo over pre-tokens and units.

    Texts of characters up to LAST_LATIN without marks of special tokens are cut to
    pre-tokens; the others to units. A unit is a run of white space with the visible run after it. Units are
    encoded apart, which gives the ids of the whole text because the
    tokenizer's pre-tokens never cross from one unit to the next.
    """

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        import regex

        self.tokenizer, self.limit, self.memo, self.known = _tokenizer(path), memo_entries, {}, is_as_known(path, KNOWN)
        self.merger = Merger(self.tokenizer, memo_entries)
        self.find = regex.compile(_PRE_TOKEN).findall
        known = [chr(c) for c in range(ord(LAST_LATIN) + 1)]
        letters, numbers = ("".join(re.escape(c) for c in known if regex.match(kind, c)) for kind in (r"\p{L}", r"\p{N}"))
        # words first: they are the most, and no contraction begins with a letter or a space
        self.latin_find = re.compile(rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+").findall

    def whole(self, text: str) -> bytes:
        """By the tokenizer alone."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, units: set[str]) -> None:
        memo, ids, find, ascii_find = self.memo, self.merger.ids, self.find, _ASCII_PRE_TOKEN.findall
        for unit in units:
            if "<|" in unit or max(unit) > LAST_LATIN:
                memo[unit] = self.whole(unit)
            else:
                pre = ascii_find(unit) if unit.isascii() else find(unit)
                memo[unit] = ids(pre[0]) if len(pre) == 1 else b"".join([ids(p) for p in pre])

    def _cut(self, texts: list[str]) -> tuple[list[list[str] | None], set[str], set[str]]:
        """The parts of each text (None: it isn't cut), and which pre-tokens and units there are."""
        cut: list[list[str] | None] = []
        pre_tokens: set[str] = set()
        units: set[str] = set()
        for t in texts:
            if not self.known or _ODD_SPACE.search(t):
                cut.append(None)
            elif "<|" in t or not t.isascii() and _BEYOND_LATIN.search(t):
                cut.append(_UNITS(t))
                units.update(cut[-1])
            else:
                cut.append(self.latin_find(t))
                pre_tokens.update(cut[-1])
        return cut, pre_tokens, units

    def encode(self, texts: list[str]) -> list[bytes]:
        cut, pre_tokens, units = self._cut(texts)
        unseen = pre_tokens | units
        new = unseen.difference(self.memo)
        if len(self.memo) + len(new) > self.limit:
            self.memo.clear()
            new = unseen
        memo, merged = self.memo, self.merger.merged
        for pre in new - units:
            memo[pre] = merged(pre)
        self._learn(new & units)
        get = self.memo.__getitem__
        found = [self.whole(t) if c is None else b"".join(map(get, c)) for t, c in zip(texts, cut)]
        for unit in unseen:
            if len(unit) > MEMO_CHARS:
                del self.memo[unit]
        return found


@lru_cache(maxsize=2)
def _encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of every document: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its text's ids and then ``end_id``. Only documents over
    ``capacity`` ids are cut, from their end, so that the first piece alone may
    be shorter. Null texts count as empty: one piece of one id.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        encoder = _encoder(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                    ids += end
                    n, start, piece = len(ids) // 4, 0, 0
                    length = n if n <= capacity else n % capacity or capacity
                    while start < n:
                        rows.append((key, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                        start, length, piece = start + length, capacity, piece + 1
                if rows:
                    columns = list(zip(*rows))
                    types = [part.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=[id_column, "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_column), without_nulls(F.col(text_column)).alias("text"))
    return by_small_batches(rows).mapInArrow(returning_memory(cut), f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long")


#: Sequences of one layout: how many, and the (length, number) runs of each.
Layout = tuple[int, list[tuple[int, int]]]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Layout], dict[int, int]]:
    """Sequences that some optimal packing has, and the counts that they leave."""
    left, sizes, fixed = dict(counts), sorted(s for s, n in counts.items() if n), []

    def take(size: int, n: int) -> None:
        left[size] -= n
        if not left[size]:
            sizes.remove(size)

    def longest(room: int, besides: dict[int, int]) -> int:
        """The longest length up to ``room`` of which a piece is left besides those."""
        at = bisect_left(sizes, room + 1) - 1
        while at >= 0 and left[sizes[at]] <= besides.get(sizes[at], 0):
            at -= 1
        return sizes[at] if at >= 0 else 0

    for size in sorted(sizes, reverse=True):
        while left[size]:
            room, own = capacity - size, {size: 1}
            mate = longest(room, own)
            if not mate:
                n = left[size]
                fixed.append((n, [(size, 1)]))
                take(size, n)
                continue
            few = []  # the three shortest besides this one
            for s in sizes:
                few += [s] * min(3, left[s] - (s == size))
                if len(few) >= 3:
                    break
            pair_fits = len(few) > 1 and few[0] + few[1] <= room
            triple_fits = len(few) > 2 and sum(few[:3]) <= room
            if not (mate == room or not pair_fits):
                if triple_fits:
                    break
                best = max((a + b for a in sizes if (b := longest(room - a, {size: 1} | {a: 1 + (a == size)}))), default=0)
                if mate < best:
                    break
            n = left[size] // 2 if mate == size else min(left[size], left[mate])
            # The longest mate stays the same until its pieces, or those of this length, are used up.
            fixed.append((n, [(size, 2)] if mate == size else [(size, 1), (mate, 1)]))
            for s in (size, mate):
                take(s, n)
    return fixed, {s: n for s, n in left.items() if n}


def best_fit(counts: dict[int, int], capacity: int) -> list[Layout]:
    """Best fit, longest first, in bulk: equal sequences are kept as one layout with a number."""
    closed: list[Layout] = []
    open_: dict[int, list[Layout]] = defaultdict(list)  # by room left
    rooms: list[int] = []

    def put(room: int, layout: Layout) -> None:
        if room == 0:
            closed.append(layout)
            return
        if not open_[room]:
            insort(rooms, room)
        open_[room].append(layout)

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                full, rest = divmod(n, each)
                if full:
                    put(capacity - each * size, (full, [(size, each)]))
                if rest:
                    put(capacity - rest * size, (1, [(size, rest)]))
                break
            room = rooms[at]
            many, runs = open_[room].pop()
            if not open_[room]:
                del rooms[at]
            each = room // size
            full = min(many, n // each)
            if full:
                put(room - each * size, (full, [*runs, (size, each)]))
                n -= full * each
            if full < many:
                if 0 < n < each:
                    put(room - n * size, (1, [*runs, (size, n)]))
                    full, n = full + 1, 0
                if full < many:
                    put(room, (many - full, runs))
    for layouts in open_.values():
        closed += layouts
    return closed


def pack_histogram(counts: dict[int, int], capacity: int) -> list[Layout]:
    """All pieces of ``counts`` (length: number) in as few sequences as the two steps find."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _slots(layouts: list[Layout]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces in a sequence, first sequence, offset), by first rank."""
    found, ranks, sequence = defaultdict(list), defaultdict(int), 0
    for many, runs in layouts:
        offset = 0
        for size, each in runs:
            found[size].append((ranks[size], each, sequence, offset))
            ranks[size] += many * each
            offset += size * each
        sequence += many
    return {size: np.array(rows, dtype=np.int64) for size, rows in found.items()}


def assign(pieces: DataFrame, capacity: int, id_column: str = "doc_id") -> DataFrame:
    """``pieces`` (a table that reads alike each time) with ``sequence_id`` and ``offset``.

    A piece's rank within its length comes from two levels: the rank within
    (length, share), where a hash deals the pieces to shares, and the number of
    pieces in earlier shares. So no task gets all pieces of one length.
    """
    spark = pieces.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_share", F.pmod(F.xxhash64(F.col(id_column), F.col("piece")), F.lit(shares)))
    sizes = dealt.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    slots = spark.sparkContext.broadcast(_slots(pack_histogram(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_share").orderBy(id_column, "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(starts.hint("shuffle_merge"), ["length", "_share"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    names, kinds = pieces.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                own, table = length == size, slots.value[int(size)]
                t = rank[own]
                first, each, base, start = table[np.searchsorted(table[:, 0], t, side="right") - 1].T
                sequence[own] = base + (t - first) // each
                offset[own] = start + (t - first) % each * size
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(returning_memory(place), f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each piece of each document with its place: ``sequence_id`` and ``offset``.

    Null texts are empty ones (a piece of the end id alone). Rows that repeat an
    id are packed each. An empty table packs to an empty result. Other columns
    are ignored. The tokenized pieces are written to the shared folder once;
    what is sent to all tasks is the packed histogram, bounded by ``capacity``.
    """
    pieces = materialise(token_pieces(docs, tokenizer_file, capacity, end_id, id_column, text_column), "pieces")
    return assign(pieces, capacity, id_column)
