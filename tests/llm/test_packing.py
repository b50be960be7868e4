import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm.packing import pack_documents, pack_histogram, reduce_by_dominance

FILE = public_tokenizers.path("byte_bpe_50k.json")


def fewest(pieces, capacity):
    """By exhaustion: the fewest sequences for a few pieces."""
    best = len(pieces)

    def place(left, rooms):
        nonlocal best
        if len(rooms) >= best and left or len(rooms) > best:
            return
        if not left:
            best = min(best, len(rooms))
            return
        piece, *rest = left
        for k in {r: i for i, r in enumerate(rooms) if r >= piece}.values():
            place(rest, [*rooms[:k], rooms[k] - piece, *rooms[k + 1 :]])
        place(rest, [*rooms, capacity - piece])

    place(sorted(pieces, reverse=True), [])
    return best


def counts_of(pieces):
    out = defaultdict(int)
    for p in pieces:
        out[p] += 1
    return dict(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_fixed_sequences_keep_an_optimum(pieces):
    fixed, rest = reduce_by_dominance(counts_of(pieces), 20)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + fewest(left, 20) == fewest(pieces, 20)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_layouts_hold_all_pieces(pieces):
    held = defaultdict(int)
    total = 0
    for many, runs in pack_histogram(counts_of(pieces), 50):
        assert sum(s * n for s, n in runs) <= 50
        total += many
        for s, n in runs:
            held[s] += many * n
    assert dict(held) == counts_of(pieces)
    assert total <= 11 / 9 * max(1, -(-sum(pieces) // 50)) + 0.67 * max(pieces, default=0) + sum(p > 25 for p in pieces)


def test_documents(spark):
    rng = np.random.default_rng(2)
    texts = [None, "", "hi", "hi"] + [" ".join(rng.choice(["the", "of", "zörg", "x1", "日本"], n)) for n in (5, 40, 300, 2100, 5000, 77, 900, 1200)]
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(2, "hi", 0)], "doc_id long, text string, offset int")
    got = pack_documents(rows, FILE).collect()
    tokenizer = Tokenizer.from_file(FILE)
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(pieces[i], key=lambda r: r.start)
        if i == 2:
            assert len(own) == 2 and [tuple(r)[:5] for r in own] == [tuple(own[0])[:5]] * 2
            continue
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.length == 2048 or len(own) == 1 or r.piece == 0
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 2048
    assert len(places) == -(-sum(n for own in places.values() for _, n in own) // 2048)
    assert pack_documents(rows.limit(0), FILE).count() == 0


def test_plain_texts_are_cut_to_pre_tokens(monkeypatch):
    """Units that differ in marks and white space alone share their words: what is merged and kept is a pre-token."""
    import public_tokenizers

    from tributary.llm import packing

    encoder = packing.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["it's 'twas ''s' don't I'LL we're'd  x", "  a  b\n\n c\t d ", "é'sœ 'ŝ12½²x ª º", "<|x|> a", "日本 it's", "a\x1cb", "", " ", " a \u0085b", "'", " 's x's", "ɏɐ ǅ"]
    assert encoder.encode(odd) == [encoder.whole(t) for t in odd]
    encoder = packing.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"strange{mark} {mark}strange words{mark}" for mark in "!?.,;:+*#~"]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]
    assert sorted(p for p in encoder.memo if "words" in p) == [" words"] and sum("strange" in p for p in encoder.memo) == 1
