"""Against the same sampling in plain Python."""

import hashlib
import math
from collections import Counter

import pytest
import xxhash

from tributary.llm.fingerprint import SAMPLES, SEED, fingerprint_edits


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_of(*parts):
    """Spark's xxhash64: each part is hashed with the hash before it as its seed."""
    seed = 42
    for part in parts:
        raw = part.encode() if isinstance(part, str) else part[0].to_bytes(part[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed & ((1 << 64) - 1))
    return seed


def uniform(h, part):
    return (((h >> 21 * part) & ((1 << 21) - 1)) + 0.5) * 2.0**-21


def signature(text):
    out = []
    words = Counter(__import__("re").split(r"[ \t\n\x0b\x0c\r]+", text.strip(" \t\n\x0b\x0c\r").lower()))
    for k in range(SAMPLES):
        best = None
        for word, n in words.items():
            term = signed(hash_of(word, (SEED, 4)))
            h, g = hash_of((term, 8), (k, 4)), hash_of((k, 4), (term, 8))
            minus_r, b = math.log(uniform(h, 0) * uniform(h, 1)), uniform(h, 2)
            lw = math.log(1.0 + math.log(n))
            t = 0.0 if lw == 0 else math.floor(b - lw / minus_r)
            a = math.log(-math.log(uniform(g, 0) * uniform(g, 1))) + minus_r * (t - b + 1.0)
            best = (a, word) if best is None or a < best[0] else best
        out.append(best)
    return [(w, round(a, 9)) for a, w in out]


TEXTS = {1: "The cat sat on the mat. The cat!", 2: "a dog ran off with the bone\nand a cat", 3: "", 4: None, 5: "  one ", 6: "éé 🎈 two two two", 7: "The cat sat on the mat. The cat!", 8: "x"}


@pytest.fixture(scope="module")
def got(spark):
    rows = spark.createDataFrame([(i, t, "a", 1) for i, t in TEXTS.items()], "doc_id long, text string, kid string, h int")
    return {r.doc_id: r for r in fingerprint_edits(rows).collect()}


def edited(i):
    ids = sorted(TEXTS, reverse=True)
    own, after = TEXTS[i] or "", TEXTS[ids[(ids.index(i) + 1) % len(ids)]] or ""
    third = len(own) // 3
    return own[: len(own) - third] + after[:third]


def test_edits(got):
    assert len(got) == len(TEXTS)
    for i, r in got.items():
        assert r.n_chars == len(TEXTS[i] or "")
        assert r.edited_sha256 == hashlib.sha256(edited(i).encode()).hexdigest()


def test_samples_agree_where_the_plain_form_does(got):
    ids = sorted(TEXTS, reverse=True)
    share = lambda a, b: sum(x == y for x, y in zip(signature(a), signature(b))) / SAMPLES
    for i, r in got.items():
        after = TEXTS[ids[(ids.index(i) + 1) % len(ids)]] or ""
        assert r.near_edited == pytest.approx(share(TEXTS[i] or "", edited(i)))
        assert r.near_next == pytest.approx(share(TEXTS[i] or "", after))


def test_equal_texts_have_equal_fingerprints(got):
    assert got[1].fingerprint == got[7].fingerprint and got[3].fingerprint == got[4].fingerprint
    assert len(got[1].fingerprint) == 4 * SAMPLES and got[3].near_edited == 1.0
    assert len({got[i].fingerprint for i in TEXTS}) == 6


def test_repeats_nulls_and_empty(spark):
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "d e f"), (None, "g h i")], "doc_id long, text string")
    out = fingerprint_edits(rows).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in out) == [(False, 5)] * 3 + [(True, 5)]
    assert len({tuple(r) for r in out}) == 3
    assert fingerprint_edits(rows.limit(0)).count() == 0
    single = fingerprint_edits(spark.createDataFrame([(9, "abc def")], "doc_id long, text string")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()


def test_every_row_has_a_row(spark, monkeypatch):
    from tributary.llm import fingerprint

    monkeypatch.setattr(fingerprint, "COPIES", 7)
    rows = [(n % 3, f"text {n % 2} of it") for n in range(60)] + [(8, "once")]
    got = Counter((r.doc_id, r.n_chars, r.fingerprint) for r in fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sorted(got.values()) == [1] + [10] * 6


def test_collisions_estimate_generalised_jaccard(spark):
    left, right = "a a a a b c d e f g h i", "a b b c d e f x y z w v"
    weigh = lambda t: {w: 1 + math.log(n) for w, n in Counter(t.split()).items()}
    x, y = weigh(left), weigh(right)
    true = sum(min(x.get(k, 0), y.get(k, 0)) for k in x.keys() | y.keys()) / sum(max(x.get(k, 0), y.get(k, 0)) for k in x.keys() | y.keys())
    many = fingerprint_edits(spark.createDataFrame([(2, left), (1, right)], "doc_id long, text string"), samples=1024).where("doc_id = 2").first()
    assert abs(many.near_next - true) < 0.06
