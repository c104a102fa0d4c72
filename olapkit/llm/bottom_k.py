"""Document fingerprints: the k least hashes of a text's word runs.

A fingerprint is the sorted list of the ``K`` least of the distinct hashes of all runs of five
words, and the number of runs where it has fewer. Fingerprints of parts merge into
that of the whole by taking the least K of both. Of two fingerprints the least K
of their union are a sample of the union of the run sets: the part of it that both hold estimates
resemblance; together with the estimated numbers of distinct runs it gives containment.

The query sets each document beside the next one by id. Neighbours are found by
numbering the ids (a range shuffle of ids and lengths); then only the halves of
texts that the edited text is made of move, each once.

Everything runs as DataFrame expressions.

Defined results: a null text counts as empty; a text of fewer than five words is
one run, a text without words has the empty fingerprint; two empty fingerprints
have likeness 1, an empty and another one 0. Documents are ordered by id (null first), then by a
hash of the text; rows equal in both are one document in that order, and each of
them is returned. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from olapkit.llm.common import let, text_of, words_of
from olapkit.operators.numbering import number_rows
from olapkit.workspace import materialize

K, SHINGLE_WORDS = 128, 5


def fingerprint(text: Column, k: int = K) -> Column:
    """array<bigint>: the least k distinct hashes of the text's runs of words, sorted."""
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return bottom(let(hashes, shingle_hashes), k)


def shingle_hashes(words: Column) -> Column:
    """Hashes of all runs of five word hashes; of a shorter text one hash, of none none."""

    def run(w: Column, i: Column) -> Column:
        return F.xxhash64(w, *[F.get(words, i + j) for j in range(1, SHINGLE_WORDS)])

    return F.slice(F.transform(words, run), 1, F.greatest(F.size(words) - SHINGLE_WORDS + 1, F.lit(1)))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together."""
    return bottom(F.concat(a, b), k)


def distinct_estimate(sketch: Column, k: int = K) -> Column:
    """The number of distinct runs: exact below k, else from the k-th least hash."""
    share = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the run sets behind two fingerprints."""

    def of(sample: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(sample, a), b))
        return F.when(F.size(sample) == 0, 1.0).otherwise(both / F.size(sample))

    return let(merge(a, b, k), of)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's run set that b holds, at most 1."""
    union = distinct_estimate(merge(a, b, k), k)
    own = distinct_estimate(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / own))


def as_text(sketch: Column) -> Column:
    """The hashes as hexadecimal numbers joined by commas."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def compare_with_next(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), and the fingerprints of the text, the edited and the next text.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first
    as many of the next document, or all of it if it is shorter; after the last comes the first.
    """
    text = text_of()
    key = [F.xxhash64(text).alias("k1"), F.xxhash64(F.col("doc_id"), F.length(text)).alias("k2")]
    rows = documents.select(text.alias("text"), *key)
    ids = documents.select("doc_id", F.length(text).alias("n_chars"), *key).distinct()
    order = materialize(number_rows(ids, ["doc_id", "k1", "n_chars"], "place", start=0), "places")
    # Beside each document: the key of the one before it, and how many code points that wants of it.
    behind = order.select(
        F.pmod(F.col("place") + 1, F.lit(max(order.count(), 1))).alias("place"),
        *[F.col(c).alias(f"before_{c}") for c in ("doc_id", "k1", "k2", "n_chars")],
    )
    asked = materialize(order.select("k1", "k2", "place").join(behind, "place").drop("place"), "asked")
    # Both joins below read the same shuffle of the texts; the second moves only prefixes and fingerprints.
    given = rows.join(asked, ["k1", "k2"]).select(
        F.col("before_k1").alias("k1"),
        F.col("before_k2").alias("k2"),
        F.col("before_doc_id").alias("doc_id"),
        F.col("before_n_chars").alias("n_chars"),
        F.substring("text", F.lit(1), F.floor(F.col("before_n_chars") / 2).cast("int")).alias("tail"),
        fingerprint(F.col("text")).alias("next_sketch"),
    )
    met = rows.join(given.dropDuplicates(["k1", "k2"]), ["k1", "k2"])
    head = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    return met.select(
        "doc_id",
        "n_chars",
        "next_sketch",
        fingerprint(F.col("text")).alias("sketch"),
        F.concat(head, F.col("tail")).alias("edited"),
    ).withColumn("edited_sketch", fingerprint(F.col("edited")))
