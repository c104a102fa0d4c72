"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a document draws a hashed number for each child, -log(u) / weight,
and descends into the child with the least one, so that children get documents in
proportion to their weights. A draw depends on the document's id, the child's name and its weight alone.
When the weight of a child grows, documents only move into its subtree; a new
shard in a region of its own therefore takes rows only into itself.

Law: ``key``; the id and the number of shards decide. ``tree_of(n)`` lays out
shards of equal weight: whole regions of racks of shards, and a region
of its own for each shard that is left over, so that one more shard moves nothing between the others.

The draws are DataFrame expressions over a tree of bounded size; slots are numbered by a range
shuffle, not by a window over a shard.

Defined results: null ids are drawn like an id of their own; a null text has no
bytes and size 1; rows equal in id and text get neighbouring slots; extra columns
play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from olapkit.llm.common import text_of
from olapkit.operators.numbering import number_rows

SHARDS, RACKS_PER_REGION, SHARDS_PER_RACK, SEED = 16, 2, 2, 5


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    number: int
    weight: float = 1.0


def tree_of(shards: int, racks: int = RACKS_PER_REGION, per_rack: int = SHARDS_PER_RACK) -> list[Shard]:
    """``shards`` shards of weight 1: full regions, and for each of the rest a region of its own."""
    full = shards - shards % (racks * per_rack)
    regular = [Shard(f"region{i // (racks * per_rack)}", f"rack{i // per_rack}", i) for i in range(full)]
    return regular + [Shard(f"alone{i}", f"alone{i}", i) for i in range(full, shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard in a region of its own."""
    number = max(s.number for s in tree) + 1
    return [*tree, Shard(f"alone{number}", f"alone{number}", number, weight)]


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential number of rate ``weight``, fixed by key and name."""
    u = (F.pmod(F.xxhash64(F.lit(SEED), key, F.lit(name)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _least(children: dict[str, tuple[float, Column]], key: Column) -> Column:
    """What belongs to the child with the least draw; of equal draws the first name."""
    if len(children) == 1:
        return next(iter(children.values()))[1]
    # Only the chosen branch of the tree is drawn for.
    draws = F.array_sort(
        F.array(*[F.struct(_draw(key, name, w).alias("draw"), F.lit(name).alias("name")) for name, (w, _) in children.items()])
    )
    chosen = F.element_at(draws, 1)["name"]
    out = None
    for name, (_, inner) in children.items():
        out = F.when(chosen == name, inner) if out is None else out.when(chosen == name, inner)
    return out


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key: region, rack and shard drawn one after the other."""
    regions: dict[str, tuple[float, Column]] = {}
    for region in dict.fromkeys(s.region for s in tree):
        racks: dict[str, tuple[float, Column]] = {}
        for rack in dict.fromkeys(s.rack for s in tree if s.region == region):
            own = [s for s in tree if (s.region, s.rack) == (region, rack)]
            leaves = {f"{region}/{rack}/{s.number}": (s.weight, F.lit(s.number)) for s in own}
            racks[f"{region}/{rack}"] = (sum(s.weight for s in own), _least(leaves, key))
        regions[region] = (sum(w for w, _ in racks.values()), _least(racks, key))
    return _least(regions, key)


def place(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    tree, text = tree_of(shards), text_of()
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), grown(tree)).alias("grown_shard"),
    )
    numbered = number_rows(rows, ["doc_id", "text_crc32", "size"], "slot", within=["shard"], start=0)
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
