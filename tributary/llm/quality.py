"""Quality by perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney n-gram model over the
characters of texts with evened white space, trained on all documents with a
label of good quality but a held-out fold. Its contexts reach over the ends of
words. All is done by joins of counts (``charlm``): the n-grams of all documents
are joined to the smoothed counts by context and by suffix, each document's
n-grams get their scores, and these are summed to its perplexity.

A document's cross-entropy a character spreads about its language's centre as
one over the root of its number of tokens. So the deviation is scaled by that
root, and the bounds are quantiles of trusted documents' deviations in each
language: the upper one of held-out documents, for trained ones look too
ordinary; the lower one of held-out and trained documents, for these are the
more ordinary ones and aren't to be rejected for it. Both tails are rejected:
text that the model finds too strange and text that repeats a few easy words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import charlm
from .common import discard, flagged, fold_of, if_small, materialise, without_nulls

#: Share of a language's trusted held-out documents within each bound.
QUANTILE = 0.9995
#: Characters of an n-gram.
ORDER = 5
#: Most rows (ids of trusted or poor documents, bounds of languages) that are sent to all tasks as a table; more ids go as an array, more bounds are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def evened(text: str) -> str:
    """The text with each run of white space as one space."""
    return " ".join(text.split())


def _key(doc_id, lang, text) -> F.Column:
    """Names a document by all that its judgement depends on; rows that repeat it share it."""
    marked = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in (doc_id, lang)]
    return F.xxhash64(*marked, without_nulls(text))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(id) of the documents with a label of good quality and none of poor quality."""
    rows = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("q"))
    return rows.where("q = 1").select("id")


def _comparable(*columns: tuple[DataFrame, str]) -> Callable[[F.Column], F.Column]:
    """How ids of these columns become longs that are equal if the ids are: integers are taken themselves, other ids' 64-bit hash."""
    kinds = {rows.schema[name].dataType.simpleString() for rows, name in columns}
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return lambda c: c.cast("long")
    return lambda c: F.when(c.isNotNull(), F.xxhash64(c if len(kinds) == 1 else c.cast("string")))


def scored(docs: DataFrame, labels: DataFrame, order: int = ORDER) -> DataFrame:
    """(k, doc_id, lang, trusted, held_out, n_tokens, copies, cross_entropy) of the distinct rows of ``docs`` (doc_id, text, lang).

    ``cross_entropy`` (nats a character) is null without tokens or without any trusted text.
    """
    ids = trusted_ids(labels)
    as_key = _comparable((docs, "doc_id"), (ids, "id"))
    keys = materialise(ids.select(as_key(F.col("id")).alias("_key")), "trusted")
    with_trust = lambda rows: flagged(rows.withColumn("_key", as_key(F.col("doc_id"))), "_key", keys, "trusted", BROADCAST_ROWS)
    key = _key(F.col("doc_id"), F.col("lang"), F.col("text"))
    rows = docs.select(key.alias("k"), "doc_id", without_nulls(F.col("text")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    rows = rows.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False)))
    role = F.when(F.col("trusted") & ~F.col("held_out"), "trusted")
    grams = materialise(charlm.gram_counts(with_trust(rows).select(role.alias("class"), "text"), evened, order), "grams")
    counts = grams.where("class = 'trusted' and gram <> ''")
    model = charlm.smoothed(counts, order)
    scores = charlm.scored_grams(grams.groupBy("gram").agg(F.sum("n").alias("n")), model, ["trusted"])
    model.discard()
    n_tokens = F.size(F.expr(r"filter(split(text, '\\s+'), w -> w <> '')"))
    found = charlm.score_by_joins(rows.select("k", "doc_id", "lang", "held_out", n_tokens.alias("n_tokens"), "text"), scores, evened, order, ["trusted"])
    entropy = F.when((F.col("length") > 0) & (F.col("total_0") < 0), -F.col("total_0") / F.col("length"))
    found = with_trust(found).select("k", "doc_id", "lang", "trusted", "held_out", "n_tokens", "copies", entropy.alias("cross_entropy"))
    found = materialise(found, "scored")
    discard(keys, grams, scores)
    return found


def bounds_of(rows: DataFrame, quantile: float) -> tuple[DataFrame, tuple]:
    """(lang, centre, low, high) from the trusted ones of the scored rows; and the same over all languages."""
    rows = rows.where("trusted and cross_entropy is not null")
    middle = F.percentile_approx(F.when(F.col("held_out"), F.col("cross_entropy")), 0.5, 10_000)
    low = F.percentile_approx("deviation", 1 - quantile, 10_000)
    high = F.percentile_approx(F.when(F.col("held_out"), F.col("deviation")), quantile, 10_000)
    tails = [low.alias("low"), high.alias("high")]
    deviation = (F.col("cross_entropy") - F.col("centre")) * F.sqrt("n_tokens")
    centres = materialise(rows.groupBy("lang").agg(middle.alias("centre")), "centres")
    bounds = rows.join(if_small(centres, BROADCAST_ROWS), "lang").withColumn("deviation", deviation).groupBy("lang").agg(F.first("centre").alias("centre"), *tails)
    centre = rows.agg(middle.alias("centre")).first()["centre"]
    overall = rows.withColumn("centre", F.lit(centre).cast("double")).withColumn("deviation", deviation).agg(*tails).first()
    return materialise(bounds, "bounds"), (centre, overall["low"], overall["high"])


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The scored rows of ``docs`` (doc_id, text, lang) with ``perplexity``, ``deviation``, ``low``, ``high`` and ``kept``."""
    rows = scored(docs, labels)
    bounds, (centre, low, high) = bounds_of(rows, quantile)
    joined = rows.join(if_small(bounds, BROADCAST_ROWS), "lang", "left")
    or_all = lambda c, x: F.coalesce(F.col(c), F.lit(x).cast("double"))
    joined = joined.withColumn("deviation", (F.col("cross_entropy") - or_all("centre", centre)) * F.sqrt("n_tokens"))
    joined = joined.withColumn("low", or_all("low", low)).withColumn("high", or_all("high", high)).withColumn("perplexity", F.exp("cross_entropy"))
    return joined.withColumn("kept", F.coalesce(F.col("deviation").between(F.col("low"), F.col("high")), F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Per row: id, ``perplexity`` (a character), ``n_tokens``, ``deviation``, its bounds ``low`` and ``high``, and ``kept``.

    Null, empty and blank texts have no perplexity and are kept: the model has
    nothing against them. Without trusted documents nothing can be judged and
    all are kept. A document with labels of both kinds isn't trusted. A language
    without held-out trusted documents takes the bounds of all trusted documents
    together; null and empty languages count as one of their own. Repeated rows are
    judged each, other columns are ignored, an empty table gives an empty
    result. Texts are scored whole, however long.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    found = judge(plain, labels, quantile).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select(F.col("doc_id").alias(id_column), "perplexity", "n_tokens", "deviation", "low", "high", "kept")


def drop_poor(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns.

    ``docs`` is a table that reads alike each time and has the columns doc_id,
    text and lang; others may have any name.
    """
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    doc_id, text, lang = (names.index(c) for c in ("doc_id", "text", "lang"))
    rows = docs.toDF(*own)
    plain = rows.select(F.col(own[doc_id]).alias("doc_id"), F.col(own[text]).alias("text"), F.col(own[lang]).cast("string").alias("lang"))
    poor = materialise(judge(plain, labels, quantile).where("not kept").select("k"), "poor")
    kept = flagged(rows.withColumn("k", _key(F.col(own[doc_id]), F.col(own[lang]), F.col(own[text]))), "k", poor, "_poor", BROADCAST_ROWS).where("not _poor")
    return kept.select(*[F.col(c).alias(n) for c, n in zip(own, names)])
