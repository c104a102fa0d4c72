"""Near-duplicate classes by DartMinHash signatures, banded joining and an exact check.

Weighted elements of a text are its runs of five words, weighted by how often
they occur. The plane above an element, weight by rank, is a field of darts:
hashed arrival times give the darts of each unit of weight in rising rank, and a
dart counts for a text if it lies below the element's weight there. Each dart
names one of ``COORDINATES`` coordinates; the dart of least rank is kept for
each. Ranks are thrown up to a limit that leaves a coordinate without a dart in
about two of a hundred texts, whose limit is then doubled. Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity. A text that
repeats elements has a second signature of the same elements with weight 1, which
agrees with the probability of the plain similarity; one without repeats has both in one.

Equal texts are one node from the start. Nodes whose signatures agree in all
coordinates of a band meet in a bucket. A bucket of at most ``PAIRED`` nodes gives all its
pairs. The members of a larger one are paired with a lead, the member that meets
most nodes; rounds of leads go on for what is outside the bucket's largest
component, until the pairs left are few or a round no longer halves them. What
is left then, such as texts of different contents around one common passage, goes by an
exact prefix filter: the elements of the texts concerned are ordered by how rare they
are among them. Two texts of a and b elements and similarity ``SIMILARITY`` share 4 (a + b) / 9,
so that the first one they share has so many after it in both: it is among the rarest ninth
of the shorter text and the rarest fifth of the longer one. A common passage, or what
all copies of a text have, is at the end of that order and makes no pairs. So every pair
of a bucket that can be a link is checked or already in one class. Every candidate is checked on
the exact element sets: it is a link if the weighted or the plain Jaccard similarity is
``SIMILARITY`` or more. Classes are the connected components of the links.

Defined results: a null text counts as empty; equal texts, empty ones too, form a
class; a text of fewer than five words is one element; a text without words is
near no other text; rows may repeat and ids may be null, the class of a row is
the least id in it (null only if it has no other).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from olapkit.llm.common import text_of
from olapkit.llm.components import connected_components
from olapkit.llm.hashing import mix, shingles, text_blocks, unit, word_hashes
from olapkit.workspace import materialize

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Coordinates of a signature and of a band: at a similarity of 0.8 a pair meets in
#: none of the twenty bands with a probability of 3 in 100,000.
COORDINATES, BAND = 80, 4
#: Nodes of a bucket up to which all its pairs are taken at once, and how many pairs for each
#: member of larger ones are few enough to go without another round of leads.
PAIRED, FEW = 8, 4
#: Elements are counted in 2^20 cells by their upper bits, so that the counts fit every task
#: (8 MB). Any order of elements makes the prefix filter exact; good counts make it small.
CELL_BITS = 20
#: Of 9 elements of two texts of similarity 0.8 they share at least 4; of a text's elements at most
#: one in 9 is rarer than all shared ones beside a text of its size or longer, one in 5 beside any.
NINTH, FIFTH, SHARED = 9, 5, 4

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def weighted_elements(owner: np.ndarray, element: np.ndarray):
    """Distinct elements of each text with their number of occurrences."""
    order = np.lexsort((element, owner))
    owner, element = owner[order], element[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])])
    return owner[first], element[first], np.diff(np.r_[first, len(owner)]).astype(np.float64)


def unit_regions(owner: np.ndarray, element: np.ndarray, weight: np.ndarray):
    """The element regions cut into units of weight: text, hashed name, and the part inside."""
    units = np.ceil(weight).astype(np.int64)
    level = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    name = mix(np.repeat(element, units) + level.astype(np.uint64) * _GOLDEN)
    return np.repeat(owner, units), name, np.minimum(np.repeat(weight, units) - level, 1.0), level


def dart_signatures(owner, element, weight, texts: int, coordinates: int = COORDINATES) -> np.ndarray:
    """texts x coordinates hashes of the earliest darts; rows of texts without elements stay 0."""
    out = np.zeros((texts, coordinates), dtype=np.uint64)
    owner, name, inside, _ = unit_regions(owner, element, weight)
    total = np.bincount(owner, weights=inside, minlength=texts)
    limit = coordinates * (np.log(coordinates) + 4) / np.maximum(total, 1e-12)
    todo = total > 0
    while todo.any():
        pick = todo[owner]
        own, region, part = owner[pick], name[pick], inside[pick]
        rank, cells, ranks, darts = np.zeros(len(own)), [], [], []
        while len(own):
            region = region + _GOLDEN
            dart = mix(region)
            rank = rank - np.log(unit(dart))
            early = rank < limit[own]
            own, region, part, rank, dart = own[early], region[early], part[early], rank[early], dart[early]
            place = mix(dart)
            hit = unit(mix(place + _GOLDEN)) < part
            coordinate = (place % np.uint64(coordinates)).astype(np.int64)
            cells.append((own * coordinates + coordinate)[hit])
            ranks.append(rank[hit])
            darts.append(dart[hit])
        cell, rank, dart = np.concatenate(cells), np.concatenate(ranks), np.concatenate(darts)
        order = np.lexsort((rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.r_[True, cell[1:] != cell[:-1]] if len(cell) else np.zeros(0, bool)
        full = np.bincount(cell[first] // coordinates, minlength=texts) == coordinates
        use = first & full[cell // coordinates]
        out.reshape(-1)[cell[use]] = dart[use]
        todo &= ~full
        limit = np.where(todo, 2 * limit, limit)
    return out


def _listed(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType, present: np.ndarray) -> pa.Array:
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[~present, False])
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def signature(texts: pa.Array) -> pa.Array:
    """The signature of a text, cut to 32 bits a coordinate; null for a text without words.

    A text that repeats an element has a second one after it, of its elements with weight 1.
    """
    rows = []
    for _, raw, begins in text_blocks(texts):
        owner, element, weight = weighted_elements(*shingles(*word_hashes(raw, begins), SHINGLE_WORDS))
        many = len(begins) - 1
        again = (np.bincount(owner, weights=weight > 1, minlength=many) > 0)[owner]
        plain = dart_signatures(owner[again], element[again], np.ones(again.sum()), many)
        rows.append(np.hstack([dart_signatures(owner, element, weight, many), plain]))
    found = np.concatenate(rows) if rows else np.zeros((0, 2 * COORDINATES), np.uint64)
    halves = np.stack([found[:, :COORDINATES].any(axis=1), found[:, COORDINATES:].any(axis=1)], axis=1)
    values = found[np.repeat(halves, COORDINATES, axis=1)]
    return _listed((values >> np.uint64(32)).astype(np.uint32).view(np.int32), halves.sum(axis=1) * COORDINATES, pa.int32(), halves[:, 0])


@F.arrow_udf(T.ArrayType(T.LongType()))
def element_set(texts: pa.Array) -> pa.Array:
    """One number for each unit of weight of a text; even for the first unit of an element."""
    values, sizes = [], []
    for _, raw, begins in text_blocks(texts):
        elements = weighted_elements(*shingles(*word_hashes(raw, begins), SHINGLE_WORDS))
        owner, name, _, level = unit_regions(*elements)
        values.append(((name & ~np.uint64(1)) | (level > 0).astype(np.uint64)).view(np.int64))
        sizes.append(np.bincount(owner, minlength=len(begins) - 1))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    values = np.concatenate(values) if values else np.zeros(0, np.int64)
    return _listed(values, sizes, pa.int64(), np.ones(len(sizes), bool))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _bands(signature: Column, seed: int) -> Column:
    """Keys of consecutive groups of coordinates, alike for both signatures of a text."""
    bands = F.sequence(F.lit(0), (F.size(signature) / BAND).cast("int") - 1)
    return F.array_distinct(
        F.transform(bands, lambda b: F.xxhash64(F.lit(seed), b % (COORDINATES // BAND), F.slice(signature, b * BAND + 1, BAND)))
    )


def _all_pairs(members: DataFrame) -> DataFrame:
    """The pairs of buckets of at most PAIRED nodes."""
    nodes = members.groupBy("bucket").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    return nodes.select(
        F.posexplode("keys").alias("i", "a"), "keys"
    ).select("a", F.explode(F.slice("keys", F.col("i") + 2, PAIRED)).alias("b"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _lead_pairs(members: DataFrame, choice: DataFrame) -> DataFrame:
    """Pairs of each bucket's lead with its members of other roots.

    The lead is the node of ``choice`` that meets most nodes over all buckets: an original meets
    its copies in more bands than they meet each other.
    """
    lead = F.max(F.struct("met", F.xxhash64("key").alias("h"), "key", "root")).alias("lead")
    leads = materialize(choice.groupBy("bucket").agg(lead).select("bucket", "lead.key", "lead.root"), "leads")
    leads = leads.select("bucket", F.col("key").alias("lead"), F.col("root").alias("lead_root"))
    return members.join(leads, "bucket").where("root != lead_root").select(*_pair("key", "lead"))


def _rarest(values: np.ndarray, sizes: np.ndarray, counts: np.ndarray):
    """The rarest fifth of each text: elements, their ranks in it, and how many each text has.

    Ranks are two, among all units of weight and among the first units, as either similarity
    counts; the second is beyond any size for other units.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, counts[values.view(np.uint64) >> np.uint64(64 - CELL_BITS)], owner))
    values = values[order]
    first = values % 2 == 0
    plain = np.bincount(owner, weights=first, minlength=len(sizes)).astype(np.int64)
    rank = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    plain_rank = np.cumsum(first) - first - np.repeat(np.cumsum(plain) - plain, sizes)
    plain_rank = np.where(first, plain_rank, np.iinfo(np.int32).max)
    take = (rank <= sizes[owner] // FIFTH) | (plain_rank <= plain[owner] // FIFTH)
    return values[take], rank[take], plain_rank[take], np.bincount(owner[take], minlength=len(sizes))


def _rare_elements(texts: DataFrame) -> DataFrame:
    """(element, rank, plain_rank, all columns of ``texts`` but its elements) of each text's rarest fifth."""
    cell = F.shiftrightunsigned("element", 64 - CELL_BITS).alias("cell")
    found = texts.select(F.explode("elements").alias("element")).groupBy(cell).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    @F.arrow_udf("array<struct<element: bigint, rank: bigint, plain_rank: bigint>>")
    def rarest(elements: pa.Array) -> pa.Array:
        sizes = elements.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        *columns, sizes = _rarest(elements.flatten().to_numpy(), sizes, shared.value)
        rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["element", "rank", "plain_rank"])
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), rows)

    return texts.select(F.inline(rarest("elements")), *[c for c in texts.columns if c != "elements"])


def _can_be_first(size: str, rank: str) -> Column:
    """Whether the shorter text and the other can be similar with this element as their first shared one."""
    a, b = F.col(size), F.col(f"other_{size}")
    # Ranks count from 0; whole numbers instead of a rounded-up share.
    after_a, after_b = (a - F.col(rank)) * NINTH, (b - F.col(f"other_{rank}")) * NINTH
    return (a <= b) & (F.least(after_a, after_b) >= (a + b) * SHARED)


def _rare_pairs(members: DataFrame, rest: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of a text of the rest and one of another root that the prefix filter leaves."""
    texts = members.select("key", "root").distinct().join(rest.select("key", F.lit(True).alias("left")).distinct(), "key", "left")
    plain = F.size(F.filter("elements", lambda e: e % 2 == 0)).alias("plain")
    texts = texts.join(sets, "key").select("key", "root", "left", F.size("elements").alias("units"), plain, "elements")
    rare = materialize(_rare_elements(materialize(texts, "open")), "rare")
    short = rare.where((F.col("rank") * NINTH <= F.col("units")) | (F.col("plain_rank") * NINTH <= F.col("plain")))
    other = rare.withColumnsRenamed({c: f"other_{c}" for c in rare.columns if c != "element"})
    similar = _can_be_first("units", "rank") | _can_be_first("plain", "plain_rank")

    def pairs(short: DataFrame, other: DataFrame) -> DataFrame:
        return short.join(other, "element").where("root != other_root").where(similar).select(*_pair("key", "other_key"))

    # At least one of a pair is of the rest.
    return pairs(short.where("left"), other).unionByName(pairs(short.where("left is null"), other.where("other_left")))


def _banded(nodes: DataFrame) -> DataFrame:
    """(bucket, key, n) of the buckets of two and more nodes, stored."""
    members = nodes.where("signature is not null").select("key", F.explode(_bands(F.col("signature"), 0)).alias("bucket"))
    sizes = materialize(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    # An explicit join of two stored tables, which Spark can split where a bucket is hot.
    return materialize(members.join(sizes, "bucket"), "members")


def _joined_buckets(large: DataFrame, links: DataFrame, sets: DataFrame, check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The links, and more until every pair of a large bucket that can be one is checked or in one component.

    Each round joins a bucket's rest, what is outside its largest component, through one more
    lead. When few pairs are left, or a round no longer halves them, the prefix filter finds
    those that can be links.
    """
    before = None
    while True:
        roots = connected_components(links).select(F.col("node").alias("key"), "root")
        members = materialize(large.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted")
        top = F.max(F.struct(F.col("count").alias("n"), "root")).alias("top")
        parts = members.groupBy("bucket", "root").count().groupBy("bucket").agg(F.sum("count").alias("n"), top)
        parts = materialize(parts.where("top.n < n"), "parts")
        left = parts.agg(F.sum((F.col("n") - F.col("top.n")) * F.col("n"))).first()[0]
        if not left:
            return links
        met = members.join(parts.select("bucket", "top"), "bucket")
        rest = materialize(met.where("root != top.root or top.n = 1").drop("top"), "rest")
        last = left <= FEW * members.count() or (before is not None and 2 * left > before)
        pairs = _rare_pairs(met, rest, sets) if last else _lead_pairs(members, rest)
        links = materialize(links.unionByName(check(pairs.distinct())).distinct(), "links")
        if last:
            return links
        before = left


def similarity(a: Column, b: Column) -> Column:
    """The larger of the weighted and the plain Jaccard similarity of two element sets."""
    both = F.array_intersect(a, b)
    plain = [F.size(F.filter(x, lambda e: e % 2 == 0)) for x in (both, a, b)]
    weighted = [F.size(both), F.size(a), F.size(b)]
    return F.greatest(*[m / (x + y - m) for m, x, y in (plain, weighted)])


def near_links(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct texts (key, least id, copies, signature) and the links (a, b, similarity) between them."""
    text = text_of()
    rows = documents.select("doc_id", text_key(text).alias("key"), signature(text).alias("signature"))
    nodes = materialize(
        rows.groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("signature").alias("signature")
        ),
        "nodes",
    )
    members = _banded(nodes)
    small, large = members.where(F.col("n") <= PAIRED), members.where(F.col("n") > PAIRED)
    large = materialize(large.join(large.groupBy("key").agg(F.sum("n").alias("met")), "key").drop("n"), "large")
    alone = large.withColumn("root", F.col("key"))
    pairs = materialize(_all_pairs(small).unionByName(_lead_pairs(alone, alone)).distinct(), "candidates")
    wanted = members.select("key").distinct().join(nodes.select("key", "least_id"), "key")
    # One row of each text is enough for its elements: the copies of a hot text leave before the shuffle.
    same_id = F.col("doc_id").eqNullSafe(F.col("least_id"))
    texts = (
        documents.select("doc_id", text.alias("_text"), text_key(text).alias("key"))
        .join(wanted, "key")
        .where(same_id)
        .select("key", element_set("_text").alias("elements"))
        .dropDuplicates(["key"])
    )
    sets = materialize(texts, "elements")

    def check(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(sets.select(F.col("key").alias("a"), F.col("elements").alias("_a")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("elements").alias("_b")), "b")
            .select("a", "b", similarity(F.col("_a"), F.col("_b")).alias("similarity"))
            .where(F.col("similarity") >= SIMILARITY)
        )

    return nodes, _joined_buckets(large, materialize(check(pairs), "links"), sets, check)


def near_duplicate_classes(documents: DataFrame) -> DataFrame:
    """(key, class_id, class_rows, copies, chosen) of every distinct text; ``text_key`` gives a row's key.

    ``chosen`` marks one text of each class, the one of least id.
    """
    nodes, links = near_links(documents)
    roots = connected_components(links).select(F.col("node").alias("key"), "root")
    rooted = materialize(
        nodes.drop("signature").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted"
    )
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "key"))
    classes = materialize(rooted.groupBy("root").agg(first.alias("first"), F.sum("copies").alias("class_rows")), "classes")
    return rooted.join(classes, "root").select(
        "key",
        F.col("first.least_id").alias("class_id"),
        "class_rows",
        "copies",
        (F.col("key") == F.col("first.key")).alias("chosen"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row for each document: doc_id, class_id, class_rows, copies of its very text."""
    classes = materialize(near_duplicate_classes(documents), "near-classes")
    rows = documents.select("doc_id", text_key(text_of()).alias("key"))
    return rows.join(classes, "key").select("doc_id", "class_id", "class_rows", "copies")


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents with one row of each class: one of those with its least id and that id's text."""
    classes = materialize(near_duplicate_classes(documents), "near-classes")
    chosen = classes.where("chosen").select("key", "class_id")
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "doc_id", text_key(text_of()).alias("key")
    )
    # The join leaves the rows of a text together, so that dropping repeats needs no shuffle of its own.
    return (
        rows.join(chosen, "key")
        .where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .dropDuplicates(["key"])
        .select("row.*")
    )
