"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text is a weighted set: its lower-cased words, each with weight 1 + ln(count).
For each of SAMPLES samples every word draws, from hashes of itself, r and c of
the gamma distribution of shape 2 and b of the uniform one (Ioffe, 2010):

    t = floor(ln(weight) / r + b),   ln a = ln c - r (t - b + 1)

and the word of the least ``ln a`` is the sample. Two texts agree in a sample
with a probability of their generalised Jaccard similarity, the sum of smaller
weights over the sum of larger ones. As ``ln a`` follows from the word and t, its
value stands for the pair, and a signature is a row of minima: plain ``min``
aggregates that are combined before anything is shuffled.

Every text is dealt out once by its key; the words of a text stay in that
partition, are counted and sampled there, and no row leaves it but signatures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, without_nulls

#: Samples of a signature.
SAMPLES = 64
#: Samples that a word draws in one row.
BLOCK = 4
#: Hexadecimal digits of a sample in a fingerprint.
DIGITS = 4
#: Partitions of texts for each shuffle partition: words take more room than texts.
SPREAD = 4
#: Copies of a repeated row that are given back at once.
COPIES = 4096
#: Seed of the words' hashes.
SEED = 7
#: White space, as Java's ``\\s`` has it.
_WHITE = " \t\n\x0b\x0c\r"


def _uniform(h: Column, part: int) -> Column:
    """A number in (0, 1) from the part-th 21 bits of a hash."""
    bits = F.shiftrightunsigned(h, 21 * part).bitwiseAND(F.lit((1 << 21) - 1)) if part else h.bitwiseAND(F.lit((1 << 21) - 1))
    return (bits + F.lit(0.5)) * F.lit(2.0**-21)


def sample_value(term: Column, log_weight: Column, sample: Column) -> Column:
    """``ln a`` of a word (by its hash) in a sample (by its number)."""
    h, g = F.xxhash64(term, sample), F.xxhash64(sample, term)
    minus_r = F.log(_uniform(h, 0) * _uniform(h, 1))
    b = _uniform(h, 2)
    c = -F.log(_uniform(g, 0) * _uniform(g, 1))
    t = F.when(log_weight == 0.0, F.lit(0.0)).otherwise(F.floor(b - log_weight / minus_r).cast("double"))
    return F.log(c) + minus_r * (t - b + 1.0)


def terms(body: Column) -> Column:
    """A text's lower-cased words; of a blank text, the one empty word."""
    return F.split(F.lower(F.trim(body, F.lit(_WHITE))), r"\s+")


def _digits(value: Column) -> Column:
    code = F.shiftrightunsigned(F.xxhash64(value), 64 - 4 * DIGITS)
    return F.lower(F.lpad(F.hex(code), DIGITS, "0"))


def signatures(pairs: DataFrame, key: list[str], samples: int = SAMPLES) -> DataFrame:
    """(key, own, edited): the fingerprints, as bytes, of the columns ``text`` and ``edited``, by rows that are partitioned by the key.

    The two texts of a row share most of their words: a word that both have equally often
    draws its samples once for both.
    """
    bodies = pairs.select(*key, F.posexplode(F.array("text", "edited")).alias("which", "body"))
    words = bodies.select(*key, "which", F.explode(terms(F.col("body"))).alias("word")).select(*key, "which", F.xxhash64("word", F.lit(SEED)).alias("term"))
    counted = words.groupBy(*key, "term").agg(F.sum(1 - F.col("which")).alias("n0"), F.sum("which").alias("n1"))
    drawn = lambda n, own, edited: F.struct(F.col(n).alias("n"), F.lit(own).alias("own"), F.lit(edited).alias("edited"))
    draws = F.when(F.expr("n0 = n1"), F.array(drawn("n0", True, True))).when(F.expr("n0 = 0"), F.array(drawn("n1", False, True)))
    draws = draws.when(F.expr("n1 = 0"), F.array(drawn("n0", True, False))).otherwise(F.array(drawn("n0", True, False), drawn("n1", False, True)))
    weighed = counted.select(*key, "term", F.explode(draws).alias("d")).select(*key, "term", F.log(1.0 + F.log(F.col("d.n").cast("double"))).alias("log_weight"), "d.own", "d.edited")
    # a row for each word and few samples: one with all of them outgrows what the JVM compiles, one a sample looks its group up too often
    blocks = F.explode(F.array(*map(F.lit, range(-(-samples // BLOCK))))).alias("block")
    each = weighed.select(*key, "term", "log_weight", "own", "edited", blocks)
    values = [sample_value(F.col("term"), F.col("log_weight"), F.col("block") * BLOCK + k).alias(f"value{k}") for k in range(BLOCK)]
    minima = each.select(*key, "block", "own", "edited", *values).groupBy(*key, "block")
    minima = minima.agg(*[F.min(F.when(F.col(side), F.col(f"value{k}"))).alias(f"{side}{k}") for side in ("own", "edited") for k in range(BLOCK)])
    code = lambda side: F.concat(*[_digits(F.col(f"{side}{k}")) for k in range(BLOCK)]).alias(side)
    codes = minima.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("block", code("own"), code("edited")))).alias("codes"))  # as many as blocks
    # signatures travel as bytes, half as long as their spelling
    return codes.select(*key, *[F.unhex(F.array_join(F.col(f"codes.{side}"), "").substr(1, samples * DIGITS)).alias(side) for side in ("own", "edited")])


def likeness(left: Column, right: Column, samples: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints, given as bytes, agree."""
    width = DIGITS // 2
    part = lambda c, k: c.substr(k * width + 1, F.lit(width))
    agreeing = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: part(left, k) == part(right, k))
    return F.size(agreeing) / F.lit(float(samples))


def following(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, kid, h, ...) with the keys ``next_kid, next_h`` of the next row by descending doc_id.

    Rows with one id follow each other by ``h``. The row after the last is the
    first. Ranges of ids are ordered apart, and only each range's first row,
    one for each partition, is looked at to join them.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("h"), F.col("kid")]
    ranged = materialise(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_range").orderBy(*order)
    within = ranged.withColumn("_next", F.lead(F.struct("kid", "h")).over(own)).withColumn("_at", F.row_number().over(own))
    heads = within.where("_at = 1").select("_range", F.struct("kid", "h").alias("_head"))  # one row for each partition
    across = Window.partitionBy(F.lit(1)).orderBy("_range")
    ends = heads.select("_range", F.coalesce(F.lead("_head").over(across), F.first("_head").over(across)).alias("_over"))
    joined = within.join(F.broadcast(ends), "_range").withColumn("_next", F.coalesce("_next", "_over"))
    return joined.select(*rows.columns, F.col("_next.kid").alias("next_kid"), F.col("_next.h").alias("next_h"))


def _copied(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, in blocks that are dealt out where a row has many."""
    most = counted.agg(F.max("copies")).first()[0] or 1
    if most == 1:
        return rows
    first = F.lit(COPIES) * F.col("_block")
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    dealt = blocks.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if most > COPIES else blocks
    each = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - first))
    return dealt.withColumn("_copy", F.explode(each)).drop("_block", "_copy")


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the fingerprints of its text and of its edited text.

    Columns: id, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``: the likeness of
    the document's fingerprint to its edited text's and to the next document's.
    The edited text has the last third (rounded down) of the code points
    replaced by the first as many, or all, of the next document's, by
    descending id; after the last comes the first.

    Null texts are empty ones; empty and blank texts have the fingerprint of
    the empty word, so likenesses among them are 1. Rows with one id and
    different texts are documents of their own, in order of their texts'
    hashes; rows that repeat id and text are one document for the order, and each
    has a row of the result. A null id comes last. Equal texts have equal fingerprints. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).alias("doc_id"), without_nulls(F.col(text_column)).alias("text"))
    rows = rows.withColumn("kid", F.xxhash64("doc_id")).withColumn("h", F.xxhash64("text"))
    ids = rows.select("doc_id", "kid", "h", F.length("text").cast("long").alias("n_chars"))
    ids = materialise(following(ids.groupBy("doc_id", "kid", "h", "n_chars").agg(F.count("*").alias("copies"))), "order")

    texts = rows.select("kid", "h", "text").repartition(parts, "kid", "h").distinct()
    third = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = ids.select(F.col("next_kid").alias("kid"), F.col("next_h").alias("h"), F.col("kid").alias("to_kid"), F.col("h").alias("to_h"), third.alias("want"))
    leads = texts.join(wanted, ["kid", "h"]).select(F.col("to_kid").alias("kid"), F.col("to_h").alias("h"), F.expr("substring(text, 1, want)").alias("lead"))
    leads = leads.repartition(parts, "kid", "h")
    n = F.length("text")
    pairs = texts.join(leads, ["kid", "h"]).withColumn("edited", F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), "lead"))

    prints = signatures(pairs, ["kid", "h"], samples)
    digests = pairs.select("kid", "h", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    made = materialise(digests.join(prints, ["kid", "h"]), "fingerprints")

    after = made.select(F.col("kid").alias("next_kid"), F.col("h").alias("next_h"), F.col("own").alias("_after"))
    out = _copied(ids.join(made, ["kid", "h"]).join(after, ["next_kid", "next_h"]), ids)
    return out.select(
        F.col("doc_id").alias(id_column),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("own")).alias("fingerprint"),
        F.lower(F.hex("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("_after"), samples).alias("near_next"),
    )
