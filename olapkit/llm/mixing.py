"""Mixes sources to target weights: seats for equal blocks by highest quotients.

The words of a source, its documents in a seeded order, are cut into blocks of
``BLOCK_WORDS``. The blocks of the mix are its seats. Sainte-Lague gives seat after
seat to the source with the highest quotient target / (2 * seats + 1); the seats
of a shard are ``SHARD_SEATS`` consecutive ones, so that each shard gets its integer
quotas and any number of first shards is near the targets too. The k-th seat of a source
takes its block of seeded rank k modulo the number of blocks: no block comes
back before all others have been taken.

Targets share all words by weight and stop at ``REPEATS`` times a source's words;
the excess is shared by weight among the others until none is above.

Prefix sums and seat numbers come from range shuffles, not from a window over a
source: a source that holds most rows is many tasks. Quotas and targets are rows
of Spark tables.

Defined results: null texts and texts without words have size 0 and are not
taken; a null source is a source, the last one; rows may repeat, each is a
document; extra columns play no part; without any word nothing is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from olapkit.llm.common import SPACE_CLASS, WORD_CLASS, text_of
from olapkit.operators.numbering import number_rows
from olapkit.workspace import materialize

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
BLOCK_WORDS, SHARD_SEATS, SEED = 128, 4096, 11
#: Multiplication by a prime orders the blocks; the second serves where the first divides their number.
PRIMES = 2_147_483_647, 2_147_483_629
#: Shares of whole documents are counted in parts of 2^24, so that their running sums are exact whole numbers.
SHARE_BITS = 24
#: Seats that one row of the seat table is made from at a time.
RUN = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_CLASS)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, size), stored."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sources, [F.col("source").asc_nulls_last()], "rank", start=0)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight), "sources")
    most = F.col("source_size") * REPEATS
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, None
    # Each round one aggregate; the level only rises, so a source once held stays held.
    while True:
        is_held = most < F.col("weight") * level
        sums = ranked.agg(
            F.count_if(is_held).alias("held"),
            F.sum(F.when(is_held, most).otherwise(0)).alias("words"),
            F.sum(F.when(~is_held, F.col("weight"))).alias("weights"),
        ).first()
        if sums["held"] == held or not sums["weights"]:
            break
        held, level = sums["held"], (total - sums["words"]) / sums["weights"]
    return ranked.withColumn("target", F.least(most.cast("double"), F.col("weight") * F.lit(float(level))))


def seats(sources: DataFrame) -> DataFrame:
    """(seat, shard, rank, k): the source of each seat and which of its seats it is, stored.

    The targets add up to the words of all sources, as ``targets`` shares them.
    """
    facts = sources.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    total, many = facts[0] or 0, facts[1]
    wanted = max(1, round(total / BLOCK_WORDS)) if total else 0
    share = F.col("target") / BLOCK_WORDS
    # More quotients of each source than can win, but never more than its blocks repeated.
    enough = F.ceil(share * (1 + (many + 1) / max(wanted, 1))) + 2
    runs = (
        sources.where("target > 0")
        .withColumn("limit", F.least(enough, _blocks(F.col("source_size")) * REPEATS))
        .select("rank", "target", "limit", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("limit") - 1) / RUN))).alias("run"))
    )
    first = F.col("run") * RUN
    one = runs.repartition("rank", "run").select(
        "rank", "target", F.explode(F.sequence(first, F.least(first + RUN, F.col("limit")) - 1)).alias("k")
    )
    quotient = F.col("target") / (2 * F.col("k") + 1)
    ordered = number_rows(one.select("rank", "k", quotient.alias("quotient")), [F.desc("quotient"), "rank", "k"], "seat", start=0)
    return materialize(
        ordered.where(F.col("seat") < wanted).select(
            "seat", F.floor(F.col("seat") / SHARD_SEATS).alias("shard"), "rank", "k"
        ),
        "seats",
    )


def quotas(seat_rows: DataFrame) -> DataFrame:
    """(shard, rank, quota, first_k): the blocks of a source that a shard takes."""
    return seat_rows.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("quota"), F.min("k").alias("first_k"))


def _blocks(source_size: Column) -> Column:
    return F.ceil(source_size / BLOCK_WORDS)


def running_totals(rows: DataFrame, group: str, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the group, whatever the group's size."""
    numbered = materialize(number_rows(rows, [F.col(group).asc_nulls_first(), *order], "_n", start=0), "ordered")
    piece = numbered.withColumn("_piece", F.floor(F.col("_n") / 8192))
    sums = piece.groupBy("_piece", group).agg(F.sum(value).alias("_sum"))
    # One row for each piece of 8,192 rows and group that meets it.
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_piece", F.col(group).alias("_group"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_piece", group).orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    within = piece.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = (within["_piece"] == offsets["_piece"]) & within[group].eqNullSafe(offsets["_group"])
    return within.join(offsets, match).select(*rows.columns, (F.col("_own") + F.col("_offset")).alias(name))


def seeded_place(block: Column, blocks: Column, rank: Column) -> Column:
    """The seeded rank of a block among the blocks of its source, each rank once.

    The product is taken in two parts, as it passes 64 bits from some billions of blocks on; exact up to 2^46.
    """
    prime = F.when(blocks % PRIMES[0] == 0, F.lit(PRIMES[1])).otherwise(F.lit(PRIMES[0])).cast("long")
    high, low = F.shiftright(block, 16), block.bitwiseAND(F.lit(0xFFFF))
    shift = F.pmod(F.xxhash64(F.lit(SEED), rank), blocks)
    product = ((high * prime) % blocks * 65536 + low * prime) % blocks
    return (product + shift) % blocks


def times_taken(block: Column, blocks: Column, seats_won: Column, rank: Column) -> Column:
    """How often a block is taken: once more if its seeded rank is among the last seats."""
    place = seeded_place(block, blocks, rank)
    return F.floor(seats_won / blocks) + F.when(place < seats_won % blocks, 1).otherwise(0)


def mix(documents: DataFrame, tag: list[str] | None = None) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) and the columns of ``tag``, of every document."""
    names = ["doc_id", "source", *(tag or [])]
    sizes = materialize(documents.select(*names, word_count(text_of()).alias("size")), "sizes")
    sources = materialize(targets(sizes), "targets")
    won = seats(sources)
    shares = quotas(won).groupBy("rank").agg(F.sum("quota").alias("seats"))
    plan = materialize(
        sources.join(shares, "rank", "left").select(
            F.col("source").alias("_source"), "rank", "source_size", "target", F.coalesce("seats", F.lit(0)).alias("seats")
        ),
        "plan",
    )
    seeded = [F.xxhash64(F.lit(SEED), F.col("doc_id")), F.col("doc_id"), F.col("size"), *(tag or [])]
    placed = running_totals(sizes, "source", seeded, "size", "_offset_words")
    rows = placed.join(plan, placed["source"].eqNullSafe(plan["_source"]))
    begin, end = F.col("_offset_words"), F.col("_offset_words") + F.col("size")
    blocks = _blocks(F.col("source_size"))

    def words(total: Column, b: Column) -> Column:
        overlap = F.least((b + 1) * BLOCK_WORDS, end) - F.greatest(b * BLOCK_WORDS, begin)
        return total + overlap * times_taken(b, blocks, F.col("seats"), F.col("rank"))

    touched = F.sequence(F.floor(begin / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS))
    taken = F.when(F.col("size") > 0, F.aggregate(touched, F.lit(0).cast("long"), words)).otherwise(0)
    return rows.select(*names, "size", "source_size", "target", taken.cast("long").alias("taken"))


def whole_copies(taken: DataFrame) -> DataFrame:
    """(doc_id, source, _text_key, _times) from the rows of ``mix``: whole copies in place of words.

    A document's share is the words taken of it over its words. Within a source, smallest documents first and
    in seeded order among equals, the running sum of shares is rounded at each document, and a document
    comes as often as the rounded sum grows there. As sizes only rise along that order, the words of all copies
    differ from the words taken by less than the source's largest document.
    """
    who = ["doc_id", "source", "_text_key"]
    # Rows equal in id, source and text are interchangeable and come equally often; they count as one document.
    rows = F.count(F.lit(1))
    share = F.round(F.sum("taken") * F.lit(float(1 << SHARE_BITS)) / (F.first("size") * rows)).cast("long")
    each = taken.where("size > 0").groupBy(*who).agg(share.alias("_share"), (F.first("size") * rows).alias("_weight"))
    seeded = [F.col("_weight"), F.xxhash64(F.lit(SEED), "doc_id", "_text_key"), *who]
    summed = running_totals(each, "source", seeded, "_share", "_before")

    def rounded(sum_of_shares: Column) -> Column:
        return F.shiftright(sum_of_shares + (1 << SHARE_BITS - 1), SHARE_BITS)

    times = rounded(F.col("_before") + F.col("_share")) - rounded(F.col("_before"))
    return summed.select(*who, times.cast("int").alias("_times"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, each whole; see ``whole_copies``.

    Only ids, sources and text keys are ordered; each text moves once, to meet its number of copies.
    """
    key = F.unhex(F.md5(text_of()))
    taken = mix(documents.select("doc_id", "source", "text", key.alias("_text_key")), ["_text_key"])
    copies = whole_copies(taken).where("_times > 0")
    who = F.struct("doc_id", "source", "_text_key").alias("_who")
    copies = materialize(copies.select(who, "_times"), "copies")
    names = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*names).alias("_row"), F.struct("doc_id", "source", key.alias("_text_key")).alias("_me"))
    # Null ids and sources inside the structs are equal to each other.
    met = rows.join(copies, F.col("_me") == F.col("_who"))
    return met.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
