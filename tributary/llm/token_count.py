"""Token counts by the whole-token shortcut.

A vocabulary entry that the tokenizer encodes, on its own, as exactly that one
token needs no merging wherever it turns up as a pre-token. The set of such
entries is proved once, on the driver, against the tokenizer itself; its size
is bounded by the vocabulary, so it is broadcast. In the tasks each
white-space-delimited chunk is cut into pre-tokens; those in the proved set
count one, and only the others are merged.

Chunks can be counted apart because the tokenizer drops white space and no
pre-token crosses it. Counts of chunks are kept in a bounded memo.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import MEMO_CHARS, by_small_batches, returning_memory, without_nulls
from pyspark.sql import functions as F

#: Chunks whose counts a worker keeps; beyond it the memo starts afresh.
MEMO_ENTRIES = 400_000

#: Beyond this character pre-tokens are left to the tokenizer: letter tables differ by Unicode version.
LAST_LATIN = "\u024f"
#: Python's str.split() takes these as white space and the tokenizer doesn't.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: The tokenizer's own pre-token pattern, for lower-cased text without white space.
_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_ASCII_PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: character to byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: What this module knows to do by itself; files that say otherwise are left to the library.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "end_of_word_suffix": "</w>",
}


def is_as_known(path: str, known: dict) -> bool:
    """Whether a tokenizer's file has these settings, a plain BPE model, and special tokens that all begin with ``<|``."""
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    model = own["model"]
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    special = all(t["content"].startswith("<|") and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in own["added_tokens"])
    same = own["normalizer"] == known["normalizer"] and own["pre_tokenizer"] == known["pre_tokenizer"] and model.get("end_of_word_suffix") == known["end_of_word_suffix"]
    return plain and special and same and not own.get("truncation") and not own.get("padding")


def prove_whole_tokens(path: str, end_mark: str = "</w>") -> frozenset[str]:
    """The strings that the tokenizer encodes, alone, as their one vocabulary entry."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    to_byte, candidates = _byte_alphabet(), {}
    for entry, token in vocabulary.items():
        if not entry.endswith(end_mark):
            continue
        try:
            text = bytes(to_byte[c] for c in entry.removesuffix(end_mark)).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if text:
            candidates[text] = token
    texts = list(candidates)
    found = _tokenizer(path).encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, found) if e.ids == [candidates[t]])


class Merger:
    """Token ids of single pre-tokens by the tokenizer's own merges, with a bounded memo."""

    def __init__(self, tokenizer, entries: int = MEMO_ENTRIES):
        self.merge, self.entries, self.memo = tokenizer.model.tokenize, entries, {}
        self.spelled = {b: c for c, b in _byte_alphabet().items()}

    def merged(self, pre: str) -> bytes:
        """Little-endian 32-bit ids, without the memo."""
        text = pre.encode("utf-8").decode("latin-1").translate(self.spelled)
        return array("I", [t.id for t in self.merge(text)]).tobytes()

    def ids(self, pre: str) -> bytes:
        """Little-endian 32-bit ids."""
        found = self.memo.get(pre)
        if found is None:
            found = self.merged(pre)
            if len(pre) <= MEMO_CHARS:
                if len(self.memo) >= self.entries:
                    self.memo.clear()
                self.memo[pre] = found
        return found


class ChunkCounter:
    """Counts tokens of chunks: proved pre-tokens directly, the rest by merging."""

    def __init__(self, path: str, whole: frozenset[str], memo_entries: int = MEMO_ENTRIES):
        import regex

        self.tokenizer, self.whole, self.limit, self.known = _tokenizer(path), whole, memo_entries, is_as_known(path, KNOWN)
        self.pre_token = regex.compile(_PRE_TOKEN)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.merger = Merger(self.tokenizer, memo_entries)
        self.memo: dict[str, int] = {}

    def _learn(self, chunks: set[str]) -> None:
        whole, normal, ids = self.whole, self.tokenizer.normalizer.normalize_str, self.merger.ids
        memo, ascii_find, find = self.memo, _ASCII_PRE_TOKEN.findall, self.pre_token.findall
        for chunk in chunks:
            if chunk.isascii():
                if "<|" in chunk and any(s in chunk for s in self.special):
                    memo[chunk] = len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
                    continue
                pre = ascii_find(chunk.lower())
            elif "<|" in chunk or max(chunk) > LAST_LATIN:
                memo[chunk] = len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
                continue
            else:
                pre = find(normal(chunk))
            n = 0
            for p in pre:
                n += 1 if p in whole else len(ids(p)) >> 2
            memo[chunk] = n

    def count(self, texts: list[str]) -> list[int]:
        if not self.known:
            return [len(self.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
        chunked = [None if _ODD_SPACE.search(t) else t.split() for t in texts]
        unseen: set[str] = set()
        for chunks in chunked:
            unseen.update(chunks or ())
        if len(self.memo) + len(unseen.difference(self.memo)) > self.limit:
            self.memo.clear()
        self._learn(unseen.difference(self.memo))
        get = self.memo.__getitem__
        counts = [len(self.tokenizer.encode(t, add_special_tokens=False).ids) if c is None else sum(map(get, c)) for t, c in zip(texts, chunked)]
        for chunk in unseen:
            if len(chunk) > MEMO_CHARS:
                del self.memo[chunk]
        return counts


_COUNTERS: dict[tuple[str, int], ChunkCounter] = {}


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Null and empty texts have no bytes and no tokens. Repeated rows are counted
    each; other columns are ignored, whatever their names. An empty table gives
    an empty result. Texts of any length are counted whole; a special token's
    string inside a text counts as the tokenizer's default has it: one token.
    A tokenizer file with another pattern or normalizer than KNOWN is left to the library.
    No shuffle: one narrow stage from the scan.
    """
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(prove_whole_tokens(tokenizer_file))
    kind = docs.schema[id_column].dataType.simpleString()

    def counted(batches):
        key = (tokenizer_file, len(whole.value))
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, ChunkCounter(tokenizer_file, whole.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                n = counter.count(texts)
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([len(t) if t.isascii() else len(t.encode("utf-8")) for t in texts], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([k > limit for k in n], pa.bool_()),
                    ],
                    names=[id_column, "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id_column), without_nulls(F.col(text_column)).alias("text"))
    return by_small_batches(rows).mapInArrow(returning_memory(counted), f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
