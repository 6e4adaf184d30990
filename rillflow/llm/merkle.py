"""A Merkle tree over a table, with a proof for every row.

Nodes of one level that stand side by side are kept as one string of hex digests,
so a run of siblings is a substring of fixed width: hashed, it is the parent; what
stands before and after a node in it are the node's siblings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.running import same
from rillflow.operators.numbering import dense_ids
from rillflow.session import materialize

#: Characters of a digest.
WIDE = 64


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    """The digest of a row with these values."""
    return F.sha2(F.concat(*(encoded(v) for v in values)), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["left"], node, run["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


def _joined(digests: Column) -> Column:
    """Digests as one string; as bytes, of which a part is taken without counting characters."""
    return F.array_join(digests, "").cast("binary")


def _part(level: Column, start: Column, count: Column) -> Column:
    """``count`` digests from number ``start`` on, as text; fewer at the end of the level."""
    return F.substring(level, (start * WIDE + 1).cast("int"), (count * WIDE).cast("int"))


def _parents(level: Column, arity: int) -> Column:
    last = F.floor((F.octet_length(level) - 1) / F.lit(WIDE * arity)).cast("int")
    return _joined(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(_part(level, i * arity, F.lit(arity)), 256))
    )


def _path(levels: Column, at: Column, arity: int, height: int) -> Column:
    """The siblings of leaf ``at`` on every level of a block but the last, as ``left`` and ``right``."""
    widths = F.array(*(F.lit(arity**j) for j in range(height)))

    def flanks(level: Column, j: Column) -> Column:
        node = F.floor(at / F.element_at(widths, j + 1)).cast("int")
        first = F.floor(node / F.lit(arity)).cast("int") * arity
        return F.struct(
            _part(level, first, node - first).cast("string").alias("left"),
            _part(level, node + 1, first + arity - 1 - node).cast("string").alias("right"),
        )

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), flanks)


def _blocks(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """``tree, n, block, rows, levels``: aligned blocks of arity ** height nodes and their levels.

    ``nodes`` has tree, n (nodes of the tree), pos, digest and others, which go to
    ``rows``. A block that is not alone in its tree goes up ``height`` levels; one
    that is, to the level of one node.
    """
    size = arity**height
    others = [c for c in nodes.columns if c not in ("tree", "n", "pos")]
    steps = F.size(F.filter(F.array(*(F.lit(arity**j).cast("long") for j in range(height))), lambda w: w < F.col("n")))
    none = F.array().cast("array<int>")
    grouped = (
        nodes.groupBy("tree", "n", F.floor(F.col("pos") / F.lit(size)).cast("long").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", *others))).alias("rows"))
        .withColumn("_level", _joined(F.transform("rows", lambda row: row["digest"])))
        .withColumn("_steps", F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(none))
    )
    levels = F.aggregate(
        "_steps",
        F.array("_level"),
        lambda found, _: F.concat(found, F.array(_parents(F.element_at(found, -1), arity))),
    )
    return grouped.select("tree", "n", "block", "rows", levels.alias("levels"))


def trees(nodes: DataFrame, arity: int = 2, height: int = 6) -> DataFrame:
    """``nodes`` with ``path`` and ``subroot``: the Merkle tree of every ``tree``.

    ``nodes`` has ``tree``, ``n`` (its nodes), ``pos`` (0 to n - 1), ``digest`` and
    any others but path and subroot. Levels are made in aligned blocks of
    arity ** height nodes, each one row; the roots of the blocks are the nodes of
    the next round, until every tree is one block. Then the paths come down the
    same way, block by block. A tree of one node is its own root, with no path.
    """
    size = arity**height
    most = nodes.agg(F.max("n")).first()[0] or 1
    names = [c for c in nodes.columns if c not in ("tree", "n", "pos")]
    rounds = []
    while True:
        rounds.append(materialize(_blocks(nodes, arity, height), "merkle-blocks"))
        if most <= size:
            break
        root = F.element_at("levels", -1).cast("string")
        nodes = rounds[-1].filter(F.col("n") > size).select(
            "tree", F.ceil(F.col("n") / F.lit(size)).cast("long").alias("n"), F.col("block").alias("pos"), root.alias("digest")
        )
        most = -(-most // size)
    above = None
    for number in range(len(rounds) - 1, -1, -1):
        found = rounds[number].withColumn("_root", F.element_at("levels", -1).cast("string"))
        if above is None:
            found = found.withColumns({"_tail": F.array().cast("array<struct<left:string,right:string>>"), "_top": F.col("_root")})
        else:
            higher = above.select(
                F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("path").alias("_tail"), F.col("subroot").alias("_top")
            )
            found = found.join(higher, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_pos")), "left")
            found = found.withColumns(
                {
                    "_tail": F.coalesce("_tail", F.array().cast("array<struct<left:string,right:string>>")),
                    "_top": F.coalesce("_top", "_root"),
                }
            )
        own = names if number == 0 else ["digest"]
        members = F.transform(
            "rows", lambda row, i: F.struct(row.alias("row"), _path(F.col("levels"), i, arity, height).alias("path"))
        )
        above = found.select("tree", "n", "_tail", "_top", F.explode(members).alias("_one")).select(
            "tree",
            "n",
            F.col("_one.row.pos").alias("pos"),
            *(F.col(f"_one.row.{c}").alias(c) for c in own),
            F.concat("_one.path", "_tail").alias("path"),
            F.col("_top").alias("subroot"),
        )
    return above


def manifest(leaves: DataFrame, group: str, order: list[str], arity: int = 2, height: int = 6) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``, the siblings from leaf to root.

    ``leaves`` has a hex ``digest`` in every row, the columns named and any others
    but tree, n, pos, path, subroot and root; it should be a stored, narrow table.
    The leaves of a group ascend by ``order`` (null first), then by digest, and
    make a tree; the roots of the groups, by ``group`` (null first), make the tree
    above. Rows that are equal in all of it are neighbours; which is first makes no
    difference to their digests. No group is ever in one task: positions come from
    a range sort, and blocks have arity ** height leaves at most. An empty table
    gives an empty table.
    """
    others = [c for c in leaves.columns if c not in (group, *order, "digest")]
    placed = dense_ids(leaves, [group, *order, "digest", *others], "_nr")
    groups = placed.groupBy(F.col(group).alias("_group")).agg(
        F.min("_nr").alias("_first"), F.count(F.lit(1)).alias("n")
    )
    groups = materialize(dense_ids(groups, ["_group"], "tree"), "merkle-groups")
    nodes = placed.join(groups, same(F.col(group), F.col("_group"))).select(
        "tree", "n", (F.col("_nr") - F.col("_first")).alias("pos"), *leaves.columns
    )
    below = materialize(trees(nodes, arity, height).drop("pos", "n"), "merkle-below")
    roots = below.groupBy("tree").agg(F.first("subroot").alias("digest"))
    count = groups.count()
    top = trees(
        roots.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("pos"), "digest"),
        arity,
        height,
    )
    top = top.select(F.col("pos").alias("_tree"), F.col("path").alias("_rest"), F.col("subroot").alias("root"))
    return below.join(top, F.col("tree") == F.col("_tree")).select(
        *leaves.columns, "subroot", "root", F.concat("path", "_rest").alias("path")
    )


def documents_manifest(docs: DataFrame, arity: int = 2, height: int = 6) -> DataFrame:
    """``doc_id, lang, leaf, changed, subroot, root, path`` of every document.

    A leaf holds doc_id, source, lang, n_chars and text, whatever is null among
    them; other columns do not count. ``changed`` is the leaf with n_chars one
    larger, null where n_chars is. Texts are hashed where they are read and move
    nowhere; very long ones too. Rows that repeat are leaves of their own.
    """
    kept = docs.select(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    before, after = [F.col(c) for c in ("doc_id", "source", "lang")], F.col("text")
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    leaves = kept.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        leaf_of(*before, F.col("n_chars"), after).alias("digest"),
        F.when(F.col("n_chars").isNotNull(), leaf_of(*before, more, after)).alias("changed"),
    )
    found = manifest(materialize(leaves, "merkle-leaves"), "lang", ["doc_id"], arity, height)
    return found.withColumnRenamed("digest", "leaf")
