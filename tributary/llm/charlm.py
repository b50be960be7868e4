"""Character n-gram models with interpolated modified Kneser-Ney smoothing.

Counts are gathered and smoothed in Spark over all training rows, for several
classes (languages, streams) at once; the tables of each order are joined by
context and by suffix, sharded by those keys. Texts are scored in one of two
ways, with the same results:

* ``score_by_joins``: the distinct n-grams of the texts are joined to the count
  tables; the scores of the most frequent ones are sent to all tasks as arrays
  and looked up there, each text's other ones are joined to theirs, and summed
  by text;
* ``Model``: sorted hash arrays of all n-grams with full 64-bit keys, for models
  up to a stated size, which are sent to all tasks.

A text is one stream of characters: ``order - 1`` begin marks, its characters,
an end mark. Contexts reach over the ends of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, discard, if_small, materialise, returning_memory

#: Begin and end marks of a text; within it they count as white space.
BEGIN, END = "\x02", "\x03"
_MARKS = str.maketrans({BEGIN: " ", END: " "})
#: Most rows (class, n-gram) of a model that is sent to all tasks as arrays, of 16 bytes a row or so.
ARRAY_ROWS = 3_000_000
#: Most scored n-grams of one class that are sent to all tasks, the most frequent ones, of 16 bytes each; of several classes fewer. The others' occurrences are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Characters of a window, and cells of a block of scores.
WINDOW_CHARS, CELLS = 1 << 19, 1 << 21
#: Distinct n-grams whose counts a task holds before it hands them on.
COUNTED_GRAMS = 300_000
_P = np.uint64(0x9E3779B97F4A7C15)


def unmarked(text: str | None) -> str:
    """The text without begin and end marks; null counts as empty."""
    text = text or ""
    return text.translate(_MARKS) if BEGIN in text or END in text else text


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(32))


def _sums(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 0 .. order, a 64-bit sum over the n characters that end at each position."""
    found = [np.zeros(len(codes), np.uint64)]
    power = np.uint64(1)
    for n in range(1, order + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[n - 1 :] = codes[: len(codes) - n + 1]
        found.append(found[-1] + (shifted + np.uint64(n)) * power)
        power = np.uint64(int(power) * int(_P) % (1 << 64))
    return found


def _top(codes: np.ndarray, order: int) -> np.ndarray:
    """The last of ``_sums``, without the others."""
    found, power = np.zeros(len(codes), np.uint64), np.uint64(1)
    for n in range(1, order + 1):
        found[n - 1 :] += codes[: len(codes) - n + 1] * power
        found += np.uint64(n * int(power) % (1 << 64))
        power = np.uint64(int(power) * int(_P) % (1 << 64))
    return found


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_keys(grams: pd.Series) -> pd.Series:
    """The 64-bit key of each n-gram (a string of its characters), as a signed long."""
    out = np.zeros(len(grams), np.uint64)
    lengths = grams.str.len().to_numpy()
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        if n:
            sums = _sums(_codes("".join(grams.iloc[own])), int(n))[int(n)]
            out[own] = _mixed(sums[n - 1 :: n])
    return pd.Series(out.view(np.int64))


@dataclass
class Window:
    """Some characters of some texts: ``text`` is the number of the text of each scored position in ``place``."""

    stream: str
    codes: np.ndarray
    place: np.ndarray
    text: np.ndarray


def windows(texts: list[str], order: int, chars: int = WINDOW_CHARS) -> Iterator[Window]:
    """All positions of the texts that are scored, in windows of bounded size; longer texts take several."""
    lead, held, owners, size = BEGIN * (order - 1), [], [], 0

    def made() -> Window:
        stream = "".join(held)
        sizes = np.array([len(h) for h in held])
        scored = np.ones(len(stream), bool)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        for k in range(order - 1):
            scored[starts + k] = False
        place = np.flatnonzero(scored)
        return Window(stream, _codes(stream), place, np.repeat(np.array(owners), sizes)[place])

    for i, text in enumerate(texts):
        full = f"{lead}{text}{END}"
        for at in range(0, len(full) - order + 1, chars):
            part = full[at : at + chars + order - 1]
            if held and size + len(part) > chars:
                yield made()
                held, owners, size = [], [], 0
            held.append(part)
            owners.append(i)
            size += len(part)
    if held:
        yield made()


def counts_by_text(text: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, number) of the distinct n-grams of each text, in order of text.

    Sorted by text and the upper bits of the key; should two keys of a text agree
    in these, one of them may come in several parts, which does no harm to sums.
    """
    order = np.argsort((text.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20)))
    text, keys = text[order], keys[order]
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])))) if len(text) else np.zeros(0, np.int64)
    return text[first], keys[first], np.diff(np.append(first, len(text)))


def gram_counts(rows: DataFrame, spelled: Callable[[str], str], order: int) -> DataFrame:
    """(class, gram, n): how often each gram of ``order`` characters ends at some character, over all rows of (class, text)."""

    def handed_on(held: dict) -> Iterator[pa.RecordBatch]:
        for k, c in held.items():
            yield pa.record_batch([pa.array([k] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["class", "gram", "n"])
        held.clear()

    def counted(batches):
        held: dict[str | None, Counter] = {}
        for batch in batches:
            classes, texts = (c.to_pylist() for c in batch.columns)
            for k in dict.fromkeys(classes):
                own = held.setdefault(k, Counter())
                for w in windows([spelled(unmarked(t)) for c, t in zip(classes, texts) if c == k], order, 2 * WINDOW_CHARS):
                    _, at, n = np.unique(_top(w.codes, order)[w.place], return_index=True, return_counts=True)
                    for end, many in zip((w.place[at] + 1).tolist(), n.tolist()):
                        own[w.stream[end - order : end]] += many
            if sum(map(len, held.values())) > COUNTED_GRAMS:
                yield from handed_on(held)
        yield from handed_on(held)

    found = by_small_batches(rows).mapInArrow(returning_memory(counted), "class string, gram string, n long")
    return found.groupBy("class", "gram").agg(F.sum("n").alias("n"))


def _order_below(counts: DataFrame) -> DataFrame:
    """Counts one order lower: kinds of left neighbours; after a begin mark, which has none, plain sums."""
    lower = counts.groupBy("class", F.substring("gram", 2, 1 << 20).alias("gram")).agg(F.count("*").alias("kinds"), F.sum("raw").alias("raw"))
    return lower.select("class", "gram", F.when(F.col("gram").startswith(BEGIN), F.col("raw")).otherwise(F.col("kinds")).alias("n"), "raw")


@dataclass
class Smoothed:
    """Tables of a smoothed model, each written to the shared folder.

    ``grams[n]``: (class, gram, logp), the interpolated probability of the last
    of n characters after the others. ``rests[n]``: (class, gram, total, log_rest), the
    weight that a context of n characters leaves to the order below. ``floor``:
    (class, logp) of a character never seen, before that weight.
    """

    order: int
    grams: dict[int, DataFrame]
    rests: dict[int, DataFrame]
    floor: DataFrame | None = None

    def discard(self) -> None:
        discard(*self.grams.values(), *self.rests.values(), self.floor)

    def rows(self) -> int:
        return sum(t.count() for t in (*self.grams.values(), *self.rests.values()))


def smoothed(counts: DataFrame, order: int) -> Smoothed:
    """The model of ``counts`` (class, gram, n), grams of ``order`` characters."""
    tables = [counts.withColumn("raw", F.col("n"))]
    for _ in range(order - 1):
        tables.insert(0, materialise(_order_below(tables[0]), "grams"))
    n, found, lower = F.col("n"), Smoothed(order, {}, {}), None
    for k, table in enumerate(tables, 1):
        of = [F.sum((n == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        d = table.groupBy("class").agg(*of)  # one row for each class
        y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        bounded = lambda i, have, more: F.when(F.col(have) > 0, F.least(F.greatest(i - (i + 1) * y * F.col(more) / F.col(have), F.lit(0.1)), F.lit(i * 0.95))).otherwise(0.5 * i)
        d = d.select("class", bounded(1, "n1", "n2").alias("d1"), bounded(2, "n2", "n3").alias("d2"), bounded(3, "n3", "n4").alias("d3"))
        less = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        seen = table.join(F.broadcast(d), "class").withColumn("context", F.expr("left(gram, length(gram) - 1)")).withColumn("less", less)
        contexts = seen.groupBy("class", "context").agg(F.sum("n").alias("total"), F.sum("less").alias("rest"))
        contexts = contexts.select("class", F.col("context").alias("gram"), "total", F.log(F.col("rest") / F.col("total")).alias("log_rest"))
        found.rests[k - 1] = materialise(contexts, "contexts")
        joined = seen.join(found.rests[k - 1].withColumnRenamed("gram", "context"), ["class", "context"])
        if lower is None:
            found.floor = materialise(table.groupBy("class").agg((-F.log(F.count("*") + 1)).alias("logp")), "floor")
            joined = joined.join(F.broadcast(found.floor), "class").withColumn("p_below", F.exp("logp"))
        else:
            joined = joined.withColumn("suffix", F.substring("gram", 2, 1 << 20)).join(lower.select("class", F.col("gram").alias("suffix"), F.exp("logp").alias("p_below")), ["class", "suffix"])
        p = (n - F.col("less")) / F.col("total") + F.exp("log_rest") * F.col("p_below")
        lower = found.grams[k] = materialise(joined.select("class", "gram", F.log(p).alias("logp")), "smoothed")
    discard(*tables[:-1])
    return found


def scored_grams(grams: DataFrame, model: Smoothed, classes: list[str]) -> DataFrame:
    """(class, gram, logp) of each gram of ``grams`` (distinct, of full order) under each class; with its ``n``, if ``grams`` has it.

    From the shortest to the longest suffix: a gram that was seen has its
    interpolated probability, another what its context leaves times the
    probability of its suffix. The tables are joined by class and gram. Each
    order's rows are written before the next ones are joined to them: in one plan,
    all orders hold each other's joins, and the driver has dozens of exchanges
    under way at once.
    """
    suffix = F.substring("gram", 2, 1 << 20)
    wanted = {model.order: grams}
    for k in range(model.order - 1, 0, -1):
        wanted[k] = materialise(wanted[k + 1].select(suffix.alias("gram")).distinct(), "wanted")
    each = F.explode(F.array(*map(F.lit, classes)))
    below, found = model.floor.withColumnRenamed("logp", "below"), None
    for k in range(1, model.order + 1):
        counts = [c for c in wanted[k].columns if c == "n"]
        own = wanted[k].select(each.alias("class"), "gram", *counts)
        own = own.withColumn("context", F.expr("left(gram, length(gram) - 1)")).withColumn("suffix", suffix)
        own = own.join(F.broadcast(below), "class") if k == 1 else own.join(below, ["class", "suffix"])
        own = own.join(model.grams[k], ["class", "gram"], "left")
        own = own.join(model.rests[k - 1].select("class", F.col("gram").alias("context"), "log_rest"), ["class", "context"], "left")
        own = own.select("class", "gram", F.coalesce("logp", F.coalesce("log_rest", F.lit(0.0)) + F.col("below")).alias("logp"), *counts)
        last, found = found, materialise(own, "grams")
        discard(wanted[k], *([last] if last is not None else []))
        below = found.select("class", F.col("gram").alias("suffix"), F.col("logp").alias("below"))
    return found


def least_count(keyed: DataFrame, rows: int) -> int | None:
    """The least ``_n`` that at most so many rows of ``keyed`` reach, to within a tenth; None if more have the largest one."""
    steps = keyed.groupBy(F.floor(8 * F.log2("_n")).alias("step")).agg(F.min("_n").alias("least"), F.count("*").alias("many"))
    least = None
    for step in sorted(steps.collect(), reverse=True):  # one row for each step
        rows -= step["many"]
        if rows < 0:
            break
        least = step["least"]
    return least


def score_by_joins(rows: DataFrame, scores: DataFrame, spelled: Callable[[str], str], order: int, classes: list[str]) -> DataFrame:
    """The distinct rows of ``rows`` with ``copies``, ``length`` and, for each class, ``total_i``: the summed log probability.

    ``rows`` has (text, and columns that don't identify it alone); ``scores``
    (class, gram, logp, and n: how often it occurs) covers all their n-grams. ``length`` is the number of
    characters and end marks that are scored; a text that is spelled empty has 0. The
    scores of the most frequent n-grams, BROADCAST_ROWS at most, go to all tasks,
    which look them up and sum them by text. What is left of a text, its rare
    n-grams, is joined to their scores by a shuffle and summed by text: that
    moves as many rows as the rare n-grams occur, not each n-gram of each text.
    """
    keep = [c for c in rows.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    pairs = pa.struct([("key", pa.int64()), ("n", pa.int32())])
    columns = [f"_p{i}" for i in range(len(classes))]

    picks = [F.max(F.when(F.col("class") == c, F.col("logp"))).alias(p) for p, c in zip(columns, classes)]
    often = F.max("n") if "n" in scores.columns else F.lit(1)
    keyed = scores.withColumn("_key", F.pandas_udf(gram_keys, "long")("gram")).groupBy("_key").agg(often.alias("_n"), *picks)
    keyed = materialise(keyed, "scores")
    least = least_count(keyed, 2 * BROADCAST_ROWS // (1 + len(classes)))
    head = keyed.where(F.col("_n") >= least if least is not None else F.lit(False)).select("_key", *columns).toArrow()
    keys = head.column("_key").to_numpy().view(np.uint64)
    by_key = np.argsort(keys)
    sent = rows.sparkSession.sparkContext.broadcast((keys[by_key], [head.column(p).to_numpy()[by_key] for p in columns]))
    del head, keys, by_key

    def summed(batches):
        known, values = sent.value
        for batch in batches:
            texts = [spelled(unmarked(t)) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
            totals = np.zeros((len(classes), len(texts)))
            held = np.flatnonzero(sizes)
            for w in windows([texts[i] for i in held], order):
                text = held[w.text]
                distinct, place = np.unique(_mixed(_top(w.codes, order)[w.place]), return_inverse=True)
                at = np.searchsorted(known, distinct)
                at[at == len(known)] = 0
                found = known[at] == distinct if len(known) else np.zeros(len(distinct), bool)
                for total, value in zip(totals, values):
                    if len(known):
                        total += np.bincount(text, np.where(found, value[at], 0.0)[place], len(texts))
                if not found.all():
                    rare = np.flatnonzero(~found[place])
                    owner, key, n = counts_by_text(text[rare], distinct[place[rare]])
                    own, first = np.unique(owner, return_index=True)
                    entries = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int32))], fields=list(pairs))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), entries)
                    yield record(batch, own, sizes, 0, np.zeros((len(classes), len(own))), lists)
            yield record(batch, np.arange(len(texts)), sizes, 1, totals, pa.nulls(len(texts), pa.list_(pairs)))

    def record(batch, own, sizes, copies, totals, lists):
        kept = [batch.column(batch.schema.get_field_index(c)).take(pa.array(own)) for c in keep]
        return pa.record_batch([*kept, pa.array(sizes[own]), pa.array(np.full(len(own), copies, np.int64)), *map(pa.array, totals), lists], names=[*keep, "_length", "_copies", *columns, "_rare"])

    kinds = f"{kinds}, _length long, _copies long, {', '.join(f'{p} double' for p in columns)}, _rare array<struct<key: long, n: int>>"
    parts = materialise(by_small_batches(rows).mapInArrow(returning_memory(summed), kinds), "parts")
    sent.destroy()
    row = F.xxhash64(*keep, "_length")
    found = parts.groupBy(*keep, "_length").agg(F.sum("_copies").alias("copies"), *[F.sum(p).alias(p) for p in columns])
    left = keyed if least is None else keyed.where(F.col("_n") < least)
    if not left.isEmpty():
        rare = parts.where("_rare is not null").select(row.alias("_row"), F.explode("_rare").alias("_g")).select("_row", F.col("_g.key").alias("_key"), F.col("_g.n").alias("_times"))
        more = rare.join(left, "_key").groupBy("_row").agg(*[F.sum(F.col("_times") * F.col(p)).alias(f"{p}_rare") for p in columns])
        found = found.withColumn("_row", row).join(more, "_row", "left").withColumns({p: F.col(p) + F.coalesce(f"{p}_rare", F.lit(0.0)) for p in columns})
    return found.select(*keep, "copies", F.col("_length").alias("length"), *[(F.col(p) / F.col("copies")).alias(f"total_{i}") for i, p in enumerate(columns)])


class Model:
    """Sorted hash arrays of a smoothed model, for all its classes."""

    def __init__(self, classes: list[str], order: int, floor: np.ndarray, grams: dict[int, tuple], rests: dict[int, tuple]):
        self.classes, self.order, self.floor = classes, order, floor
        self.grams, self.rests = grams, rests

    @staticmethod
    def _entries(table: tuple, wanted: np.ndarray):
        """(place in ``wanted``, class, value) of all entries whose key is wanted."""
        keys, bounds, classes, values = table
        if not len(keys):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.float32),)
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        hit = np.flatnonzero(keys[at] == wanted)
        first, many = bounds[at[hit]], bounds[at[hit] + 1] - bounds[at[hit]]
        place = np.repeat(hit, many)
        entry = np.repeat(first - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(len(place))
        return place, classes[entry], values[entry]

    def scores(self, keys: dict[int, np.ndarray], contexts: dict[int, np.ndarray]) -> np.ndarray:
        """Log probabilities of n-grams given as the keys of their suffixes and contexts: n-grams x classes."""
        total = np.tile(self.floor, (len(keys[1]), 1))
        for n in range(1, self.order + 1):
            place, k, value = self._entries(self.rests[n - 1], contexts[n - 1])
            total[place, k] += value
            place, k, value = self._entries(self.grams[n], keys[n])
            total[place, k] = value
        return total

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(summed log probability, texts x classes; characters and end marks scored) of spelled texts."""
        out = np.zeros((len(texts), len(self.classes)))
        for w in windows(texts, self.order):
            sums = _sums(w.codes, self.order)
            top = _mixed(sums[self.order][w.place])
            distinct, at = np.unique(top, return_index=True)
            text, keys, n = counts_by_text(w.text, top)
            place = w.place[at]
            found = self.scores({k: _mixed(sums[k][place]) for k in range(1, self.order + 1)}, {k: _mixed(sums[k][place - 1]) if k else np.zeros(len(place), np.uint64) for k in range(self.order)})
            row = np.searchsorted(distinct, keys)
            step = max(1, CELLS // len(self.classes))
            for i in range(0, len(row), step):
                part = slice(i, i + step)
                own, first = np.unique(text[part], return_index=True)
                out[own] += np.add.reduceat(found[row[part]] * n[part, None], first, axis=0, dtype=np.float64)
        return out, np.array([len(t) + 1 for t in texts])


def as_arrays(model: Smoothed, classes: list[str]) -> Model:
    """The model's tables, of ARRAY_ROWS rows at most, as arrays on the driver."""
    code = F.element_at(F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))]), F.col("class"))
    key = F.pandas_udf(gram_keys, "long")

    def table(rows: DataFrame, value: str) -> tuple:
        frame = rows.select(key("gram").alias("key"), code.cast("int").alias("code"), F.col(value).cast("float").alias("value")).toPandas()
        keys = frame["key"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((frame["code"].to_numpy(), keys))
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.append(first, len(keys)), frame["code"].to_numpy(np.int32)[order], frame["value"].to_numpy(np.float32)[order]

    floor = {r["class"]: r["logp"] for r in model.floor.collect()}
    return Model(classes, model.order, np.array([floor[c] for c in classes], np.float32), {n: table(t, "logp") for n, t in model.grams.items()}, {n: table(t, "log_rest") for n, t in model.rests.items()})
