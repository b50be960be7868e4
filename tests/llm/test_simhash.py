import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tributary.llm import simhash as sh


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    out = defaultdict(list)
    for i in range(n):
        out[root(i)].append(i)
    return [min(out[root(i)]) for i in range(n)]


def plain_fingerprint(text, words=3):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgÉß", k=4))
    texts = [None, "", " \n", "One", "one", "a B", "x y z"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([40, 120]))]
        for _ in range(6):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    rows = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in sh.near_duplicates(rows).collect()}
    fps = [plain_fingerprint(t or "") for t in texts]
    wanted = components(len(texts), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == wanted
    assert len(set(wanted)) < len(texts) - 10


@pytest.mark.parametrize("tile", [2, 7, 2048])
def test_tiles_of_any_size_give_the_same_components(spark, tile):
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**62), 2**62, 6)
    fps = sorted({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 60, (15, 2))})
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = {(min(r.src, r.dst), max(r.src, r.dst)) for r in sh.radius_links(distinct, 2, tile).collect()}
    close = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 2]
    at = {f: i for i, f in enumerate(fps)}
    assert components(len(fps), [(at[a], at[b]) for a, b in links]) == components(len(fps), close)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = sh.component_labels(spark.range(201).toDF("node"), edges)
    assert {(r.node, r.label) for r in got.collect()} == {(i, 0) for i in range(201)}


def near_texts(rng, groups, size, words):
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
    return out


def test_similar_groups_against_all_pairs(spark):
    rng = random.Random(9)
    texts = near_texts(rng, 10, 8, 150) + near_texts(rng, 3, 3, 3) + [None, "", " ", "same text here", "same text here"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shingles = []
    for t in texts:
        w = (t or "").lower().split()
        shingles.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    wanted = components(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if alike(shingles[i], shingles[j])])
    got = {r.doc_id: r.group_id for r in sh.similar_groups(rows).collect()}
    assert [got[i] for i in range(len(texts))] == wanted
    kept = sh.drop_near_duplicates(rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted)) and kept.columns == rows.columns


def test_dropping_keeps_one_of_repeats_and_odd_ids(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", None), (1, "a b c d e f", None), (1, "x y z u v w", "k"), (None, "q r s t u p", "k"), (2, "a b c d e f", "k")], "doc_id long, text string, label string")
    got = sh.drop_near_duplicates(rows).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "a b c d e f"), ("1", "x y z u v w"), ("None", "q r s t u p")]
    assert sh.drop_near_duplicates(rows.limit(0)).count() == 0 and sh.near_duplicates(rows.limit(0)).count() == 0


def test_repeated_lines_and_tiny_sets_are_no_reason_to_miss_a_near_copy(spark):
    rng = random.Random(3)
    words = lambda n: ["".join(rng.choices("abcdefghijklm", k=7)) for _ in range(n)]
    texts = []
    for _ in range(20):  # 300 shingles, and 10 more of a line that is repeated
        base = words(304)
        texts += [" ".join(base), " ".join(base + words(6) * 20)]
    while len(texts) < 44:  # 4 shingles against 5, of unlike fingerprints
        base = words(9)
        a, b = " ".join(base[:8]), " ".join(base)
        if (sh.simhash(sh.shingle_hashes(a, 5)) ^ sh.simhash(sh.shingle_hashes(b, 5))).bit_count() > 22:
            texts += [a, b]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in sh.similar_groups(rows).collect()}
    assert [got[i] for i in range(len(texts))] == [i - i % 2 for i in range(len(texts))]


@pytest.mark.parametrize("tile, size", [(2, 1 << 24), (5, 1 << 24), (2048, 700)])
def test_small_tiles_give_the_same_groups(spark, monkeypatch, tile, size):
    """Tiles by members and by bytes; texts that grow by shares share keys with longer and shorter ones."""
    texts = near_texts(random.Random(7), 2, 24, 80)
    long = near_texts(random.Random(8), 1, 1, 300)[0].split()
    texts += [" ".join(long[: 60 + 12 * k]) for k in range(20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {r.doc_id: r.group_id for r in sh.similar_groups(rows).collect()}
    links = sh.similarity_links
    monkeypatch.setattr(sh, "similarity_links", lambda distinct, rows, similarity: links(distinct, rows, similarity, tile))
    monkeypatch.setattr(sh, "TILE_BYTES", size)
    assert {r.doc_id: r.group_id for r in sh.similar_groups(rows).collect()} == wanted


def test_parities_differ_in_no_more_bits_than_the_sets_in_members():
    rng = np.random.default_rng(2)
    for n in (3, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint32))
        b = np.unique(np.concatenate([a[n // 10 :], rng.integers(0, 1 << 32, n // 5, dtype=np.uint32)]))
        x, y = sh.parities([a, b])
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_size_ranks_and_runs_lose_no_pair_of_that_similarity(spark):
    for similarity in (0.5, 0.8, 0.95):
        sizes = np.unique(np.concatenate([np.arange(1, 80), (4 * 1.25 ** np.arange(60)).astype(int)]))
        rank, radius = sh.size_ranks(F.col("id"), similarity)
        at = np.array([r[0] for r in spark.createDataFrame([(int(n),) for n in sizes], "id long").select(rank).collect()])
        fit = np.minimum.outer(sizes, sizes) >= similarity * np.maximum.outer(sizes, sizes)
        assert (np.abs(np.subtract.outer(at, at))[fit] <= radius).all()
        one = {(x, int(y)) for i, j in sh.sized_pairs(sizes, len(sizes), similarity) for x, y in zip(i, j)}
        assert {(x, y) for x, y in np.argwhere(fit).tolist() if x < y} <= one
        both = np.concatenate([sizes[::2], sizes[1::2]])
        half = len(sizes[::2])
        two = {(x, int(y)) for i, j in sh.sized_pairs(both, half, similarity) for x, y in zip(i, j)}
        assert {(x, y + half) for x, y in np.argwhere(fit[::2, 1::2]).tolist()} <= two and all(x < half <= y for x, y in two)
    assert sh.size_ranks(F.col("id"), 1.0)[1] == 0


def test_a_key_that_many_sizes_share_makes_no_square_of_tile_pairs(spark):
    keyed = spark.range(2000).selectExpr("0 as band", "1L as key", "int(id % 200) as rank", "400L as bytes", "id as node")
    dealt = sh._bucketed(keyed, 3, 10, ["node"])
    assert dealt.select("pair").distinct().count() == 200 * 4 - (3 + 2 + 1)
    assert dealt.where("side = 0").select("node").distinct().count() == 2000


def test_similar_texts_are_found_by_their_fingerprints(spark):
    """Sets at two bits or fewer need no min-wise key in common, and are still held against the similarity."""
    from pyspark.sql import functions as F

    from tributary.llm import simhash
    from tributary.llm.common import materialise

    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words), " ".join([*words[:3999], "other"]), " ".join(f"v{i}" for i in range(4000))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = simhash.described(docs, 5, "doc_id", "text")
    keys = F.expr(f"concat(slice(bands, 1, size(bands) - {simhash.BANDS}), transform(sequence(1, {simhash.BANDS}), i -> node + i))")
    rows = materialise(rows.withColumn("bands", keys), "rows")
    node = {r["id"]: r["node"] for r in rows.collect()}
    distinct = rows.select("node", (F.length("shingles") / 4).cast("long").alias("size"), "bands")
    for similarity, wanted in ((0.8, [{node[0], node[1]}]), (1.0, [])):
        assert [set(r) for r in simhash.similarity_links(distinct, rows, similarity).collect()] == wanted
