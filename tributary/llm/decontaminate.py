"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says
little. As in an LSH ensemble, items are partitioned by their number of
shingles; for a partition with at most u of them, a document is seen as windows
of 5 u / 4 shingles that begin every u / 4, so any passage the length of an item
lies within one. Window and item are candidates where one of MINIMA min-wise
values agrees. At a containment of 0.8 their Jaccard similarity is 0.29 at
least, and all but 2 in 100,000 pairs become candidates; of whole copies, all but
one in ten million. Candidates are verified by the exact containment of the
item's shingles, as word tuples, in the whole document.

Only windows with some shingle of some item are given a signature: the others
have similarity 0 with every item and could agree with none.

The items are a stated query set. They are sent to all documents in blocks of
bounded size, so documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import by_small_batches, returning_memory, without_nulls

#: Min-wise values of a signature.
MINIMA = 32
#: Bytes of items' texts that are sent to the tasks at once.
BLOCK_BYTES = 4 << 20
#: Bytes of documents that a task hashes at once.
_BATCH_BYTES = 1 << 20

_P = 0x100000001B3
_P_INVERSE = pow(_P, -1, 1 << 64)
#: Words: runs of ASCII letters, digits and underscores and of all other characters beyond ASCII.
_WORD = re.compile(rb"[0-9A-Za-z_\x80-\xff]+")
_IN_WORD = np.array([bool(_WORD.fullmatch(bytes([b]))) for b in range(256)])


def _lowered(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        done = 1
        while done < n:
            step = np.uint64(pow(base, done, 1 << 64))
            more = min(done, n - done)
            out[done : done + more] = out[:more] * step
            done += more
    return out


class _Powers:
    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_P, n), _powers(_P_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word, all at once: differences of one running polynomial."""
    data = np.frombuffer(joined, np.uint8)
    inside = np.concatenate(([False], _IN_WORD[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.of(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=running[1:])
    found = (running[ends] - running[starts]) * down[starts] if len(starts) else np.zeros(0, np.uint64)
    found = (found ^ (found >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return found ^ (found >> np.uint64(29)), starts


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(30))


_ODD = np.random.default_rng(5).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MINIMA min-wise values of a set of shingles."""
    mixed = hashes[None, :] * _ODD[:, None]
    return (mixed ^ (mixed >> np.uint64(32))).min(axis=1)


class ItemIndex:
    """One block of items: their shingles, and signatures by size partition."""

    def __init__(self, items: list[tuple[object, str]], words: int = 5):
        self.words = words
        self.keys, self.tuples, self.hashes = [], [], []
        by_width: dict[int, list[int]] = defaultdict(list)
        for key, text in items:
            raw = _lowered(text or "")
            tokens = _WORD.findall(raw)
            if not tokens:
                continue
            width = min(words, len(tokens))
            by_width[width].append(len(self.keys))
            self.keys.append(key)
            self.tuples.append(frozenset(zip(*(tokens[k:] for k in range(width)))))
            self.hashes.append(np.unique(shingles(word_hashes(raw)[0], width)))
        self.widths = {}
        for width, own in by_width.items():
            known = np.unique(np.concatenate([self.hashes[i] for i in own]))
            marked = np.zeros(1 << 20, bool)
            marked[known >> np.uint64(44)] = True
            partitions: dict[int, list[int]] = defaultdict(list)
            for i in own:
                upper = 4
                while upper < len(self.hashes[i]):
                    upper *= 2
                partitions[upper].append(i)
            tables = []
            for upper, members in sorted(partitions.items()):
                values = np.array([signature(self.hashes[i]) for i in members])
                order = np.argsort(values, axis=0)
                shared = np.unique(np.concatenate([self.hashes[i] for i in members]))
                tables.append((upper, np.array(members), order, np.take_along_axis(values, order, axis=0), shared))
            self.widths[width] = (known, marked, tables)

    def candidates(self, hashes: np.ndarray, doc: np.ndarray, doc_start: np.ndarray, width: int):
        """(document, item) pairs with a window whose signature agrees with the item's in some value.

        ``hashes``: shingles of all documents in turn; ``doc``: the document of
        each; ``doc_start``: where each document's shingles begin.
        """
        known, marked, tables = self.widths[width]
        maybe = np.flatnonzero(marked[hashes >> np.uint64(44)])
        at = np.searchsorted(known, hashes[maybe])
        at[at == len(known)] = 0
        hits = maybe[known[at] == hashes[maybe]]
        found = set()
        if not len(hits):
            return found
        doc_end = np.append(doc_start[1:], len(hashes))
        for upper, members, order, values, shared in tables:
            at = np.searchsorted(shared, hashes[hits])
            at[at == len(shared)] = 0
            own = hits[shared[at] == hashes[hits]]
            step = max(1, upper // 4)
            reach = -(-upper // step)
            first = (own - doc_start[doc[own]]) // step
            windows = np.unique(np.concatenate([np.column_stack([doc[own], np.maximum(first - k, 0)]) for k in range(reach + 1)]), axis=0)
            for d, cell in windows.tolist():
                begin = int(doc_start[d]) + cell * step
                content = hashes[begin : min(int(doc_end[d]), begin + (reach + 1) * step)]
                if not len(content):
                    continue
                sign = signature(content)
                for k in range(MINIMA):
                    a = np.searchsorted(values[:, k], sign[k], "left")
                    while a < len(members) and values[a, k] == sign[k]:
                        found.add((d, int(members[order[a, k]])))
                        a += 1
        return found

    def matches(self, texts: list[str], containment: float):
        """(text's index, item's index, shared, shingles) of every contained item."""
        raws = [_lowered(t) for t in texts]
        at = 0
        while at < len(raws):
            end, size = at, 0
            while end < len(raws) and (end == at or size + len(raws[end]) <= _BATCH_BYTES):
                size += len(raws[end]) + 1
                end += 1
            yield from self._matches(raws, at, end, containment)
            at = end

    def _matches(self, raws, at, end, containment):
        joined = b" ".join(raws[at:end])
        words, starts = word_hashes(joined)
        offsets = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws[at:end]])[:-1]))
        word_doc = np.searchsorted(offsets, starts, "right") - 1
        for width in self.widths:
            all_hashes = shingles(words, width)
            if not len(all_hashes):
                continue
            inside = word_doc[: len(all_hashes)] == word_doc[width - 1 :]
            hashes, doc = all_hashes[inside], word_doc[: len(all_hashes)][inside]
            doc_start = np.searchsorted(doc, np.arange(end - at))
            by_doc = defaultdict(list)
            for d, i in self.candidates(hashes, doc, doc_start, width):
                by_doc[d].append(i)
            for d, items in by_doc.items():
                stop = doc_start[d + 1] if d + 1 < len(doc_start) else len(hashes)
                own = np.unique(hashes[doc_start[d] : stop])
                held = None
                for i in items:
                    wanted = self.hashes[i]
                    if np.isin(wanted, own, assume_unique=True).sum() < containment * len(wanted):
                        continue
                    if held is None:
                        tokens = _WORD.findall(raws[at + d])
                        held = set(zip(*(tokens[k:] for k in range(width))))
                    shared = len(self.tuples[i] & held)
                    if shared >= containment * len(self.tuples[i]):
                        yield at + d, i, shared, len(self.tuples[i])


def _blocks(items: DataFrame, id_column: str, text_column: str):
    """The items in lists of about BLOCK_BYTES."""
    rows = items.select(F.col(id_column).alias("k"), without_nulls(F.col(text_column)).alias("t")).distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    many = max(1, -(-size // BLOCK_BYTES))
    for block in range(many):
        yield [(r["k"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(many)) == block).collect()]


def find_contained(docs: DataFrame, items: DataFrame, words: int = 5, containment: float = 0.8, id_column: str = "doc_id", item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, shingles, containment): items that documents contain.

    Containment is the share of the item's distinct shingles of ``words`` words
    that the document has, ``containment`` or more. Items of fewer words make
    one shingle, of all their words; null items and those without a word are in
    no document, and null documents contain nothing. Case, white space and
    ASCII punctuation don't matter. Of rows that repeat an item one counts;
    each row that repeats a document gives its pairs. Ids are of any type. An
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    doc_kind, item_kind = docs.schema[id_column].dataType, items.schema[item_column].dataType
    schema = f"`{id_column}` {doc_kind.simpleString()}, `{item_column}` {item_kind.simpleString()}, shared long, shingles long"
    rows = docs.select(F.col(id_column), without_nulls(F.col(text_column)).alias("text"))
    keys_kind = to_arrow_type(item_kind)
    found = None
    for block in _blocks(items, item_column, text_column):
        sent, built = spark.sparkContext.broadcast(block), []

        def search(batches, sent=sent, built=built):
            if not built:
                built.append(ItemIndex(sent.value, words))
            for batch in batches:
                hits = list(built[0].matches(batch.column(1).to_pylist(), containment))
                at, item, shared, size = zip(*hits) if hits else ((), (), (), ())
                keys = pa.array([built[0].keys[i] for i in item], keys_kind)
                yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), keys, pa.array(shared, pa.int64()), pa.array(size, pa.int64())], names=[id_column, item_column, "shared", "shingles"])

        part = by_small_batches(rows).mapInArrow(returning_memory(search), schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("shared") / F.col("shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, words: int = 5, containment: float = 0.8, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no item, as ``find_contained`` has it.

    Rows with null or empty texts contain nothing and stay; of rows that repeat,
    all stay or all go. Without items all rows stay. Column names may clash with those
    of ``items``.
    """
    spark, names = docs.sparkSession, docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    for block in _blocks(items, item_column, text_column):
        sent, built = spark.sparkContext.broadcast(block), []

        def clean(batches, sent=sent, built=built):
            if not built:
                built.append(ItemIndex(sent.value, words))
            for batch in batches:
                texts = [t or "" for t in batch.column(names.index(text_column)).to_pylist()]
                bad = {m[0] for m in built[0].matches(texts, containment)}
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))

        rows = by_small_batches(rows).mapInArrow(returning_memory(clean), kinds)
    return rows.toDF(*names)
