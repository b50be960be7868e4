"""Language identification by character models.

One interpolated Kneser-Ney character model for each language, all in the same
sorted hash arrays. A text gets the language with the lowest cross-entropy a
character. Texts that their best model describes worse than nearly all of its
training texts are marked as rejected; the bound is calibrated on these.

The arrays hold every n-gram with its full key. A model of more rows than
``charlm.ARRAY_ROWS`` isn't sent to the tasks: texts are then scored by joins,
with the same results.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import charlm
from .common import by_small_batches, discard, fold_of, materialise, returning_memory, without_nulls

UNDETERMINED = "und"
#: Characters of an n-gram.
ORDER = 4
#: Texts whose scores a worker holds at once.
HELD_TEXTS = 500

#: Characters that patterns take for word characters although they are no letters: number signs.
_NUMBERS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
_WORDS = re.compile(r"[^\W\d_]+").findall


def letters(text: str) -> str:
    """Its runs of letters (Unicode category L), lower-cased, with a space between."""
    if not text.isascii() and (odd := _NUMBERS.intersection(text)):
        text = text.translate({ord(c): " " for c in odd})
    return " ".join(_WORDS(text.lower()))


def train(rows: DataFrame, order: int = ORDER) -> tuple[charlm.Smoothed, list[str]]:
    """The smoothed models of all languages, from all rows of (text, lang) that have both; and the languages."""
    rows = rows.where("text is not null and lang is not null")
    counts = charlm.gram_counts(rows.select(F.col("lang").alias("class"), "text"), letters, order)
    # a text without letters is an end mark alone: no language
    counts = materialise(counts.where(F.col("gram") != charlm.BEGIN * (order - 1) + charlm.END), "counts")
    classes = sorted(r[0] for r in counts.select("class").distinct().collect())
    model = charlm.smoothed(counts, order)
    return model, classes


def _named(totals: np.ndarray, lengths: np.ndarray, classes: list[str], sharpness: float):
    """(best language, share, cross-entropy) of each text of a positive length."""
    best = totals.argmax(axis=1) if len(totals) else np.zeros(0, np.int64)
    top = totals[np.arange(len(totals)), best]
    share = 1 / np.exp((totals - top[:, None]) / lengths[:, None] * lengths[:, None] ** sharpness).sum(axis=1)
    return [classes[k] for k in best], share, -top / lengths


def score(rows: DataFrame, model: charlm.Model | None, sharpness: float = 0.5) -> DataFrame:
    """``rows`` without ``text``, with ``lang_pred``, ``score`` and ``cross_entropy`` (nats a character).

    ``score`` is the best language's share under a softmax of the text's total
    log likelihoods, their length tempered to its power ``sharpness``, for
    neighbouring characters aren't independent evidence.
    """
    sent = rows.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in rows.schema if f.name != "text"]

    def described(batches):
        fitted = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, HELD_TEXTS):
                part = batch.slice(at, HELD_TEXTS)
                texts = [letters(charlm.unmarked(t)) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                own = [i for i, t in enumerate(texts) if t] if fitted is not None else []
                best, share, entropy = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
                if own:
                    found, share[own], entropy[own] = _named(*fitted.totals([texts[i] for i in own]), fitted.classes, sharpness)
                    for i, name in zip(own, found):
                        best[i] = name
                kept = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.record_batch([*kept, pa.array(best), pa.array(share), pa.array(entropy, from_pandas=True)], names=[*names, "lang_pred", "score", "cross_entropy"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return by_small_batches(rows).mapInArrow(returning_memory(described), f"{kinds}, lang_pred string, score double, cross_entropy double")


def score_by_joins(rows: DataFrame, model: charlm.Smoothed, classes: list[str], sharpness: float = 0.5) -> DataFrame:
    """What ``score`` gives, for a model too large to be sent to all tasks."""
    names = [c for c in rows.columns if c != "text"]
    spelled = rows.withColumn("text", without_nulls(F.col("text"))).withColumn("_text", F.xxhash64("text"))
    grams = materialise(charlm.gram_counts(spelled.select(F.lit("").alias("class"), "text"), letters, model.order), "grams")
    scores = charlm.scored_grams(grams.select("gram", "n"), model, classes)
    found = charlm.score_by_joins(spelled, scores, letters, model.order, classes)
    discard(grams, scores)
    totals = F.array(*[F.col(f"total_{i}") for i in range(len(classes))])
    found = found.withColumn("_all", totals).withColumn("_top", F.array_max("_all")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    heard = F.col("length") > 0
    best = F.element_at(F.array(*map(F.lit, classes)), F.array_position("_all", F.col("_top")).cast("int"))
    rest = F.aggregate("_all", F.lit(0.0), lambda a, x: a + F.exp((x - F.col("_top")) / F.col("length") * F.pow(F.col("length").cast("double"), F.lit(sharpness))))
    return found.select(*names, F.when(heard, best).otherwise(UNDETERMINED).alias("lang_pred"), F.when(heard, 1 / rest).otherwise(0.0).alias("score"), F.when(heard, -F.col("_top") / F.col("length")).alias("cross_entropy"))


def rejection_bounds(found: DataFrame, quantile: float) -> dict[str, float]:
    """For each language, that quantile of the cross-entropies of its training texts."""
    fitted = found.where("not held_out and cross_entropy is not null")
    return dict(fitted.groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", quantile, 10_000)).collect())


def identify(docs: DataFrame, order: int = ORDER, reject_beyond: float = 0.999, rejected_as: str | None = None, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``.

    Rows whose id has crc32 of 2 modulo 4 are held out; the others that have
    text and language train, null ids among them. Null texts and texts without a
    letter get ``und``, a score of 0 and ``rejected``. With no training row all do. ``rejected``:
    the cross-entropy is beyond that quantile of its language's training texts;
    with ``rejected_as`` such rows get that name for language. Of rows that
    give one text several languages each counts. Repeated rows train and are
    scored each; other columns are ignored; ties between languages go to
    the first in order of name. Texts are read whole, however long.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.withColumn("held_out", F.coalesce(fold_of(F.col("id")) == 2, F.lit(False)))
    model, classes = train(rows.where("not held_out"), order)
    wanted = rows.select("id", "held_out", "text")
    if not classes:
        found = score(wanted, None)
    elif model.rows() <= charlm.ARRAY_ROWS:
        found = score(wanted, charlm.as_arrays(model, classes))
    else:
        found = score_by_joins(wanted, model, classes)
    found = materialise(found, "languages")
    model.discard()
    bounds = rejection_bounds(found, reject_beyond)
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]) if bounds else F.lit(None).cast("map<string,double>")
    rejected = F.coalesce(F.col("cross_entropy") > bound[F.col("lang_pred")], F.lit(True))
    named = F.when(rejected, F.lit(rejected_as)).otherwise(F.col("lang_pred")) if rejected_as else F.col("lang_pred")
    return found.select(F.col("id").alias(id_column), "held_out", named.alias("lang_pred"), "score", "cross_entropy", rejected.alias("rejected"))
