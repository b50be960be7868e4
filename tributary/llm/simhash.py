"""SimHash fingerprints, exact near neighbours by tiles, and their components.

Distinct fingerprints (or texts) are dealt to buckets by keys that any linked
pair shares: for a radius of k bits, two of k + 2 blocks of the fingerprint's
bits (two fingerprints at k bits or fewer agree in two blocks at least); for
shingle similarity, the same of the fingerprints of the sets, and min-wise keys of the shingles for
sets whose fingerprints are further apart. Within a bucket, fingerprints
stand in tiles by population count, and tiles are compared exactly by exclusive-or
and bit counts in numpy. Tile pairs whose population counts differ beyond the
radius are skipped, for they can hold no link. For shingle similarity, sets stand
in tiles by size, and tile pairs whose sizes differ beyond the similarity are
skipped; what is compared are parities of the sets, whose differing bits are
never more than the sets' differing shingles.

A bucket larger than a tile, in members or in bytes, is dealt out, tile pair by
tile pair, to tasks of its own. Each task hands on a spanning forest of the links
it finds, never all pairs, so a group of thousands of near copies gives as many
edges as members.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, discard, materialise, returning_memory, without_nulls

#: Members of a tile.
TILE = 2048
#: Bytes of a tile's sets; a task holds two tiles.
TILE_BYTES = 16 << 20
#: Cells of one exclusive-or block.
_CELLS = 1 << 22
SEED = 42


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle of ``words`` ASCII-lower-cased words, repeats included.

    Words are runs other than space and the controls 09-0D. Fewer words than
    that make one shingle; none makes none.
    """
    tokens = text.encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined, hashed = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([hashed(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    n = len(tokens) - words + 1
    starts, view = (ends - sizes)[:n].tolist(), memoryview(joined)
    return np.array([hashed(view[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; of none, 0."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8", copy=False)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each whole text as a signed long; a narrow stage."""
    kind = docs.schema[id_column].dataType.simpleString()

    def hashed(batches):
        for batch in batches:
            fps = [_signed(simhash(shingle_hashes(t, words))) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    return by_small_batches(docs).select(F.col(id_column), without_nulls(F.col(text_column)).alias("text")).mapInArrow(returning_memory(hashed), f"id {kind}, fp long")


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int):
    """Blocks of index pairs (i, j) with ``left[i]`` and ``right[j]`` within ``radius`` bits.

    Both sides are in order of population count; of each block of ``left`` only
    the run of ``right`` whose counts are within the radius is compared.
    """
    left_ones, right_ones = np.bitwise_count(left), np.bitwise_count(right)
    step = max(1, _CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at : at + step]
        low, high = int(left_ones[at]) - radius, int(left_ones[min(at + step, len(left)) - 1]) + radius
        a, b = np.searchsorted(right_ones, low, "left"), np.searchsorted(right_ones, high, "right")
        if a < b:
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ right[None, a:b]) <= radius)
            yield i + at, j + a


def forest_edges(n: int, blocks, verified=None):
    """Edges (x, y) of a spanning forest of the links in ``blocks`` of index pairs.

    ``verified(x, ys)`` masks the links that count; it is asked only about
    members that are not connected yet.
    """
    labels = np.arange(n)
    for i, j in blocks:
        bounds = [0, *(np.flatnonzero(np.diff(i)) + 1).tolist(), len(i)]
        for at, end in zip(bounds, bounds[1:]):
            if at == end:
                continue
            x = int(i[at])
            ys = j[at:end]
            ys = ys[labels[ys] != labels[x]]
            if verified is not None and len(ys):
                ys = ys[verified(x, ys)]
            if len(ys):
                reached, first = np.unique(labels[ys], return_index=True)
                labels[np.isin(labels, reached)] = labels[x]
                for y in ys[first].tolist():
                    yield x, y


def _bucketed(keyed: DataFrame, radius: int, tile: int, payload: list[str]) -> DataFrame:
    """(pair, side, payload): the members of every tile pair to be compared.

    ``keyed`` has (band, key, rank, bytes, payload), a row for each distinct
    member of a bucket; the first of ``payload`` tells members apart. Buckets of
    one member are dropped. Buckets up to ``tile`` members and TILE_BYTES are one
    tile; larger ones are cut by rank and by a hash of the member to tiles of
    about that size, and only pairs of tiles within ``radius`` ranks are made.
    """
    counted = keyed.groupBy("band", "key", "rank").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    totals = counted.groupBy("band", "key").agg(F.sum("n").alias("total"), F.sum("bytes").alias("bytes")).where("total > 1")
    is_large = (F.col("total") > tile) | (F.col("bytes") > TILE_BYTES)
    small = keyed.join(totals.where(~is_large).select("band", "key"), ["band", "key"])
    single = small.select(F.struct("band", "key", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("pair"), F.lit(0).alias("side"), *payload)
    large = totals.where(is_large).select("band", "key")
    cuts = F.least("n", F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("bytes") / TILE_BYTES))).cast("int")
    ranks = counted.join(large, ["band", "key"]).select("band", "key", "rank", cuts.alias("cuts"))
    tiles = ranks.select("band", "key", "rank", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    tiles = tiles.select("band", "key", "rank", (F.col("rank").cast("long") * (1 << 32) + F.col("cut")).alias("tile"))
    # an equal join on the ranks in reach, so that no pair is made to be skipped
    a = tiles.select("band", "key", F.col("tile").alias("a"), F.explode(F.sequence(F.col("rank"), F.col("rank") + radius)).alias("rank"))
    pairs = a.join(tiles.withColumnRenamed("tile", "b"), ["band", "key", "rank"]).where("a <= b").select("band", "key", "a", "b")
    own = keyed.select("band", "key", "rank", *payload).join(ranks, ["band", "key", "rank"])
    own = own.withColumn("tile", F.col("rank").cast("long") * (1 << 32) + F.pmod(F.xxhash64(payload[0], F.lit(7)), F.col("cuts")))
    dealt = single
    for side, name in enumerate("ab"):
        of = pairs if side == 0 else pairs.where("a < b")
        part = own.join(of.withColumn("tile", F.col(name)), ["band", "key", "tile"])
        dealt = dealt.unionByName(part.select(F.struct("band", "key", "a", "b").alias("pair"), F.lit(side).alias("side"), *payload))
    return dealt


def _groups(batches, columns: int):
    """(pair, columns) of each run of equal pairs in batches sorted by pair."""
    held: list[list] = []
    last = None
    for batch in batches:
        marks = list(zip(*(f.to_pylist() for f in batch.column(0).flatten())))
        at = 0
        while at < len(marks):
            end = at + 1
            while end < len(marks) and marks[end] == marks[at]:
                end += 1
            if marks[at] != last and held:
                yield last, [pa.concat_arrays(c) for c in zip(*held)]
                held = []
            last = marks[at]
            held.append([batch.column(k).slice(at, end - at) for k in range(1, columns)])
            at = end
    if held:
        yield last, [pa.concat_arrays(c) for c in zip(*held)]


def _compared(side: np.ndarray, fps: np.ndarray, radius: int):
    """The order in which a tile pair's members are compared, and the close pairs in that order."""
    bits = fps.astype(np.int64).view(np.uint64)
    order = np.lexsort((bits, np.bitwise_count(bits), side))
    bits, split = bits[order], int((side == 0).sum())
    if split == len(bits):
        return order, close_pairs(bits, bits, radius)
    return order, ((i, j + split) for i, j in close_pairs(bits[:split], bits[split:], radius))


def radius_links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(src, dst): forest edges that connect all fingerprints within ``radius`` bits.

    ``distinct`` has one row for each fingerprint, column ``fp``.
    """
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = lambda i: F.expr(f"shiftrightunsigned(fp, {cuts[i]}) & {(1 << (cuts[i + 1] - cuts[i])) - 1}L")
    keys = [F.struct(F.lit(k).alias("band"), F.xxhash64(part(i), part(j)).alias("key")) for k, (i, j) in enumerate(combinations(range(blocks), 2))]
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.band", "k.key", F.bit_count("fp").cast("int").alias("rank"), F.lit(8).cast("long").alias("bytes"), "fp")
    dealt = _bucketed(keyed, radius, tile, ["fp"])

    def linked(batches):
        for _, (side, fps) in _groups(batches, 3):
            order, blocks = _compared(side.to_numpy(), fps.to_numpy(), radius)
            raw = fps.to_numpy()[order]
            edges = list(forest_edges(len(raw), blocks))
            if edges:
                src, dst = np.array(edges).T
                yield pa.record_batch([pa.array(raw[src]), pa.array(raw[dst])], names=["src", "dst"])

    sorted_ = dealt.repartition("pair").sortWithinPartitions("pair")
    return sorted_.mapInArrow(returning_memory(linked), "src long, dst long").distinct()


def _state(pairs: DataFrame):
    """Number and hash sums of distinct rows: equal for equal tables, and for others with a chance of 2^-64."""
    hashed = F.xxhash64("u", "v")
    return pairs.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first()


def component_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node that has an edge.

    ``edges`` (src, dst) stand in a table that reads alike each time. Small and
    large stars (Kiveris and others, 2014): each round hangs every node's
    neighbours under the smallest of them, until nothing changes; the number of
    rounds grows with the logarithm of the largest component. Rows that share a
    node are only ever reduced by minimum, so no neighbourhood is collected.
    """
    pairs = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u != v").distinct()
    pairs = materialise(pairs, "links")
    state = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above a node go under the least of its surroundings
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its lower neighbours go under the least of them
        large = large.where("u != v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(floor.select("u", F.col("m").alias("v")))
        after = materialise(small.where("u != v").distinct(), "links")
        discard(pairs)
        pairs, before, state = after, state, _state(after)
        if state == before:
            break
    stars = pairs.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    labels = materialise(stars.unionByName(roots.join(stars, "node", "left_anti")), "labels")
    discard(pairs)
    return labels


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest id reachable, itself included. Null and empty texts have
    fingerprint 0, linked like any other. Copies and repeated rows collapse to
    one fingerprint before anything is compared. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = materialise(fingerprints(docs, words, id_column, text_column), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    edges = materialise(radius_links(distinct.select("fp"), radius), "edges")
    labels = component_labels(distinct.select("fp"), edges)
    discard(edges)
    member = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = member.groupBy("label").agg(F.min("first").alias("component_id"))
    named = member.join(least, "label").select("fp", "component_id")
    out = rows.join(named, "fp")
    return out.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Bits of a set's parities, a power of two.
PARITY_BITS = 2048
#: Min-wise keys: bands of so many minima each. Of pairs at 0.8, all but 5 in a million share one.
BANDS, MINIMA = 12, 2
#: Differing bits up to which sets are found by their fingerprints, and the keys that such fingerprints share.
NEAR_BITS = 2
NEAR_KEYS = math.comb(NEAR_BITS + 2, 2)
#: Most nodes whose keys are sent to all tasks to pick out their sets; more are picked out by a shuffle.
BROADCAST_NODES = 4_000_000


def _band_keys(hashes: np.ndarray) -> list[int]:
    """BANDS keys of MINIMA min-wise values each."""
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.array([(hashes * o).min() for o in odd], np.uint64).reshape(BANDS, MINIMA)
    keys = least[:, 0].copy()
    for k in range(1, MINIMA):
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + least[:, k]
    return keys.view(np.int64).tolist()


def _block_keys(fp: int) -> list[int]:
    """NEAR_KEYS keys: each two of NEAR_BITS + 2 blocks of a fingerprint's bits. Fingerprints at NEAR_BITS or fewer share one."""
    blocks = NEAR_BITS + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [fp >> a & (1 << (b - a)) - 1 for a, b in zip(cuts, cuts[1:])]
    return [part[i] | part[j] << 32 for i, j in combinations(range(blocks), 2)]


def described(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """(id, h, node, fp, bands, shingles): ``h`` is a hash of the text, ``node`` of its set of shingles, ``fp`` that set's SimHash.

    ``bands``: the keys of the fingerprint, then the min-wise ones. ``shingles``: the
    set as sorted 32-bit hashes. Texts without words have an empty set.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def one(text: str):
        hashes = shingle_hashes(text, words)
        distinct = np.unique(hashes)
        node = _signed(xxhash.xxh64_intdigest(distinct.tobytes(), SEED))
        fp = simhash(distinct)
        bands = _block_keys(fp) + (_band_keys(distinct) if len(distinct) else [0] * BANDS)
        return node, _signed(fp), bands, np.unique((distinct >> np.uint64(32)).astype("<u4")).tobytes()

    def all_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                columns = list(zip(*map(one, part.column(2).to_pylist())))
                types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.record_batch([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(columns, types))], names=["id", "h", "node", "fp", "bands", "shingles"])

    text = without_nulls(F.col(text_column))
    rows = docs.select(F.col(id_column), F.xxhash64(text).alias("h"), text.alias("text"))
    return by_small_batches(rows).mapInArrow(returning_memory(all_of), f"id {kind}, h long, node long, fp long, bands array<long>, shingles binary")


def size_ranks(size, similarity: float) -> tuple[F.Column, int]:
    """A rank of sizes, finer than the similarity, and how many ranks two sets of that similarity differ by at most."""
    if similarity >= 1:
        return size.cast("int"), 0
    steps = 8  # the larger of two such sets is at most 1 / similarity times the smaller
    rank = F.floor(F.log(F.greatest(size, F.lit(1))) * (steps / -math.log(similarity))).cast("int")
    return rank, steps + 1  # one more, for rounding


def sized_pairs(sizes: np.ndarray, split: int, similarity: float):
    """Blocks of index pairs whose sizes allow the similarity: of the first ``split`` with the rest, or of all if there is no rest.

    Both parts are in order of size, so each member's partners are one run.
    """
    start = split if split < len(sizes) else 0
    low = start + np.searchsorted(sizes[start:], sizes[:split] * (similarity * (1 - 1e-9)), "left")
    high = start + np.searchsorted(sizes[start:], sizes[:split] * ((1 + 1e-9) / similarity), "right")
    for x in range(split):
        ys = np.arange(low[x] if start else x + 1, high[x])
        yield np.full(len(ys), x), ys


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set a row of bits: whether an odd number of its members fall there.

    A member that only one of two sets has changes one bit, so the rows of two
    sets differ in no more bits than the sets differ in members.
    """
    odd = lambda s: (np.bincount(s & np.uint32(PARITY_BITS - 1), minlength=PARITY_BITS) & 1).astype(np.uint8)
    return np.stack([np.packbits(odd(s)) for s in sets]).view(np.uint64)


def similarity_links(distinct: DataFrame, rows: DataFrame, similarity: float, tile: int = TILE) -> DataFrame:
    """(src, dst): forest edges that connect all nodes whose shingle sets have that Jaccard similarity.

    Sets whose fingerprints differ in NEAR_BITS or fewer are found by the tiled
    comparison of fingerprints, as in ``radius_links``; of the others, those that
    share a min-wise key are compared. The exact similarity decides on both.

    ``distinct`` has (node, size, bands), a row for each node; ``rows`` has
    (node, fp, bands, shingles). The links are a written table.
    """
    rank, radius = size_ranks(F.col("size"), similarity)
    light = distinct.select("node", rank.alias("rank"), (F.col("size") * 4).alias("bytes"), F.posexplode("bands").alias("band", "key"))
    dealt = materialise(_bucketed(light, radius, tile, ["node"]), "dealt")
    # only the sets of nodes that share a bucket are shuffled
    wanted = dealt.select("node").distinct()
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    own = ["fp", "bands", "shingles"]
    sets = rows.select("node", *own).join(wanted, "node", "left_semi").groupBy("node").agg(*[F.first(c).alias(c) for c in own])
    full = dealt.join(sets, "node").select("pair", "side", "node", *own)

    def linked(batches):
        for (band, *_), (side, nodes, fps, bands, shingles) in _groups(batches, 6):
            side, near = side.to_numpy(), band < NEAR_KEYS
            if near:
                order, blocks = _compared(side, fps.to_numpy(), NEAR_BITS)
            else:
                order = np.lexsort((nodes.to_numpy(), pc.binary_length(shingles).to_numpy(), side))
            nodes, bits = nodes.to_numpy()[order], fps.to_numpy()[order].view(np.uint64)
            before = bands.flatten().to_numpy().reshape(len(nodes), -1)[order][:, 0 if near else NEAR_KEYS : band]
            sets = [np.frombuffer(shingles[int(k)].as_py(), "<u4") for k in order]
            sizes = np.array([len(s) for s in sets])
            odd = parities(sets) if len(sets) > 16 else None

            def alike(x: int, ys: np.ndarray) -> np.ndarray:
                mask = ~(before[ys] == before[x]).any(axis=1)  # an earlier band compares these
                small, large = np.minimum(sizes[ys], sizes[x]), np.maximum(sizes[ys], sizes[x])
                mask &= small >= similarity * large
                if not near:  # the fingerprints' bands compare these
                    mask &= np.bitwise_count(bits[ys] ^ bits[x]) > NEAR_BITS
                if odd is not None:  # sets of that similarity differ in so many members at most
                    mask &= np.bitwise_count(odd[ys] ^ odd[x]).sum(axis=1) <= (1 - similarity) / (1 + similarity) * (sizes[ys] + sizes[x]) + 1e-6
                own = np.flatnonzero(mask)
                if len(own) and sizes[x]:
                    flat = np.concatenate([sets[y] for y in ys[own]])
                    at = np.searchsorted(sets[x], flat)
                    at[at == sizes[x]] = 0
                    hits = (sets[x][at] == flat).astype(np.int64)
                    n = sizes[ys[own]]
                    shared = np.add.reduceat(hits, np.concatenate(([0], np.cumsum(n)[:-1])))
                    mask[own] = shared >= similarity * (n + sizes[x] - shared)
                return mask

            if not near:
                blocks = sized_pairs(sizes, int((side == 0).sum()), similarity)
            edges = list(forest_edges(len(nodes), blocks, alike))
            if edges:
                src, dst = np.array(edges).T
                yield pa.record_batch([pa.array(nodes[src]), pa.array(nodes[dst])], names=["src", "dst"])

    found = full.repartition("pair").sortWithinPartitions("pair").mapInArrow(returning_memory(linked), "src long, dst long").distinct()
    edges = materialise(found, "edges")
    discard(dealt)
    return edges


def _grouped(docs: DataFrame, words: int, similarity: float, id_column: str, text_column: str) -> DataFrame:
    """(id, h, label): ``label`` names the connected group of each row's text."""
    rows = materialise(described(docs, words, id_column, text_column), "described")
    # rows of one node have the same set, and so the same size and bands
    size = (F.length("shingles") / 4).cast("long")
    distinct = materialise(rows.groupBy("node").agg(F.min(size).alias("size"), F.min("bands").alias("bands")), "nodes")
    edges = similarity_links(distinct, rows, similarity)
    labels = component_labels(distinct.select("node"), edges)
    named = distinct.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    groups = materialise(rows.select("id", "h", "node").join(named, "node").select("id", "h", "label"), "groups")
    discard(rows, distinct, edges, labels)
    return groups


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, group_id): connected groups of texts with that similarity of their shingle sets.

    ``group_id`` is the group's smallest id. Candidates are sets whose SimHash
    fingerprints differ in NEAR_BITS or fewer, and beyond these, sets that share a
    min-wise key; all are compared, tile by tile, and verified by the Jaccard
    similarity of their whole sets. Null, empty and white texts
    have the empty set and form one group. Repeated rows collapse first; an
    empty table gives an empty result.
    """
    rows = _grouped(docs, words, similarity, id_column, text_column)
    least = rows.groupBy("label").agg(F.min("id").alias("group_id"))
    return rows.join(least, "label").select(F.col("id").alias(id_column), "group_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of ``similar_groups``: the one with the smallest id.

    Of rows that repeat that id the one with the smallest hash of its text
    stays, and of rows that repeat both any one. A null id comes first.
    """
    rows = _grouped(docs, words, similarity, id_column, text_column)
    heads = rows.groupBy("label").agg(F.min(F.struct("id", "h")).alias("head")).select(F.xxhash64("head.id").alias("_kid"), F.col("head.h").alias("_h"))
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    tagged = docs.toDF(*own).withColumn("_kid", F.xxhash64(own[names.index(id_column)])).withColumn("_h", F.xxhash64(without_nulls(F.col(own[names.index(text_column)]))))
    kept = tagged.join(heads.hint("shuffle_hash"), ["_kid", "_h"], "left_semi").dropDuplicates(["_kid", "_h"])
    return kept.select(*[F.col(c).alias(n) for c, n in zip(own, names)])
