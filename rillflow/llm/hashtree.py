"""Placing documents by weighted hash draws down a tree of regions, racks and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.running import fraction, running_sum
from rillflow.session import materialize

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def regular_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2, base: int = 16) -> Tree:
    """A tree of equal shards 0, 1, ...: full regions up to ``base`` shards, then a region each.

    A shard beyond the base brings a region of its own, so no weight elsewhere
    changes and all that moves goes to it.
    """
    tree: Tree = {}
    per_region = racks_per_region * shards_per_rack
    for shard in range(shards):
        own = shard >= base
        region = f"region-{base // per_region + shard - base if own else shard // per_region}"
        rack = f"{region}/rack-{0 if own else shard % per_region // shards_per_rack}"
        tree.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _draw(key: Column, children: list[tuple], seed: int) -> Column:
    """The child with the smallest draw; a draw is exponential with the child's weight as rate.

    ``children`` holds (name, weight). Changing one weight leaves the draws of the
    others as they are: keys move to a child that grows, or away from one that shrinks.
    """
    if len(children) == 1:
        return F.lit(children[0][0])
    draws = []
    for name, weight in children:
        uniform = fraction(F.xxhash64(F.lit(seed), F.lit(str(name)), key)) + F.lit(2.0**-54)
        draws.append(F.struct((-F.log(uniform) / F.lit(float(weight))).alias("draw"), F.lit(name).alias("name")))
    return F.array_min(F.array(*draws))["name"]


def _chosen(at: Column, options: list[tuple]) -> Column:
    """``options`` holds (node, expression): the expression of the node that ``at`` names."""
    if len(options) == 1:
        return options[0][1]
    found = F.lit(None)
    for node, expression in options:
        found = F.when(at == F.lit(node), expression).otherwise(found)
    return found


def assign(df: DataFrame, key: str, tree: Tree, names: tuple[str, str, str], seed: int = 5) -> DataFrame:
    """Adds region, rack and shard of every row under the given names.

    A node's weight is the sum of its shards' weights; shards and subtrees without
    weight get nothing. The region is drawn first, then a rack in it, then a shard.
    Draws depend on the key and the node's name only. The expressions are built
    from the tree, so it must be of a size for one plan (hundreds of shards).
    A null key is a key like any other.
    """
    value = F.coalesce(F.col(key).cast("string"), F.lit("\0null"))
    weights = {
        region: {rack: {s: w for s, w in shards.items() if w > 0} for rack, shards in racks.items()}
        for region, racks in tree.items()
    }
    weights = {r: {k: s for k, s in racks.items() if s} for r, racks in weights.items()}
    weights = {r: racks for r, racks in weights.items() if racks}
    total = {k: sum(s.values()) for racks in weights.values() for k, s in racks.items()}
    region, rack, shard = names
    regions = [(r, sum(total[k] for k in racks)) for r, racks in weights.items()]
    df = df.withColumn(region, _draw(value, regions, seed))
    df = df.withColumn(
        rack,
        _chosen(F.col(region), [(r, _draw(value, [(k, total[k]) for k in racks], seed)) for r, racks in weights.items()]),
    )
    per_rack = [(k, _draw(value, list(s.items()), seed)) for racks in weights.values() for k, s in racks.items()]
    return df.withColumn(shard, _chosen(F.col(rack), per_rack).cast("int"))


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None, seed: int = 5) -> DataFrame:
    """``doc_id, size, text_crc32, region, rack, shard, slot`` and ``grown_shard`` under a second tree.

    The law is that of the key: doc_id and the tree decide. ``size`` is the bytes of
    the text plus 1, a null text counts as empty. ``slot`` numbers the rows of a
    shard from 0 without gaps, in a hash order; rows that repeat a doc_id share a
    shard and get slots of their own. Rows without doc_id go to one shard together.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = assign(rows, "doc_id", tree, ("region", "rack", "shard"), seed)
    if grown is not None:
        rows = assign(rows, "doc_id", grown, ("_region", "_rack", "grown_shard"), seed).drop("_region", "_rack")
    else:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    rows = materialize(
        rows.withColumn("_one", F.lit(1)).withColumn(
            "_h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
        ),
        "shard-rows",
    )
    placed = running_sum(rows, "shard", "_h", ["doc_id", "text_crc32"], "_one", "slot")
    return placed.withColumn("slot", F.col("slot").cast("long")).drop("_h", "_one")
