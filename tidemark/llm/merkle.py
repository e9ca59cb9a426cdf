"""A Merkle manifest of a table: digests of rows, of runs of sixteen, of sources, of all.

Nodes of a level are rows (tree, idx, digest). Every level joins each node to its siblings
by equality: a node asks for the nodes at all other slots of its run, whose indices follow
from its own. What a node finds is its step of the proof; the rows at slot zero also emit
the parents, which are the next level. A run has sixteen nodes at most, so a node's list
is bounded, and nodes are dealt by run, so a source that holds most rows is spread evenly.
Each level is written before the next one, so a lost executor costs one level.

No Python runs on rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.joins import narrow_join, stored
from tidemark.operators.ranking import with_ordinal

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<left:string,right:string>"
# One shuffle by run serves the join and the aggregate of a level.
_BY_RUN = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Manifest:
    """The root of all, the subroot of every source, and every row's way up.

    ``proofs`` has key, leaf, changed, subroot and ``path``, the siblings to the left and to
    the right of the row and of each of its ancestors below the root.
    """

    root: str | None
    sources: DataFrame
    proofs: DataFrame


def field(value: Column) -> Column:
    """A value with its length before it, so that no two rows run together to equal bytes."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns.values()]), 256)


def fold(path: Column, start: Column) -> Column:
    """The digest at the top of the path when ``start`` is the digest at its foot."""
    return F.aggregate(path, start, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def _with_siblings(nodes: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Nodes (tree, idx, digest, carried columns) with the digests ``left`` and ``right`` of them in their run."""
    spark = nodes.sparkSession
    run, slot = F.expr(f"idx div {ARITY}").alias("run"), F.expr(f"cast(idx % {ARITY} as int)").alias("slot")
    placed = nodes.select("tree", run, slot, "digest", *carry).repartition("tree", "run")
    asking = placed.withColumn("shift", F.explode(F.sequence(F.lit(1), F.lit(ARITY - 1)))).select(
        "tree", "run", "slot", F.expr(f"(slot + shift) % {ARITY}").alias("sibling")
    )
    found = asking.join(placed.select("tree", "run", F.col("slot").alias("sibling"), F.col("digest").alias("other")), ["tree", "run", "sibling"])
    # A node's own row keeps nodes without siblings, and what is carried.
    own = F.struct(*carry, F.lit(0).alias("none"))
    rows = found.select("tree", "run", "slot", "sibling", "other").unionByName(
        placed.select("tree", "run", "slot", F.col("slot").alias("sibling"), F.col("digest").alias("other"), own.alias("own")), allowMissingColumns=True
    )
    lists = rows.groupBy("tree", "run", "slot").agg(F.sort_array(F.collect_list(F.struct("sibling", "other"))).alias("all"), F.max("own").alias("own"))
    side = lambda keep: F.concat_ws("", F.transform(F.filter("all", keep), lambda x: x["other"]))
    out = lists.select(
        "tree", (F.col("run") * ARITY + F.col("slot")).alias("idx"),
        F.expr("filter(all, x -> x.sibling = slot)[0].other").alias("digest"),
        side(lambda x: x["sibling"] < F.col("slot")).alias("left"), side(lambda x: x["sibling"] > F.col("slot")).alias("right"),
        *[F.col(f"own.{c}") for c in carry],
    ).sortWithinPartitions("tree", "idx")
    before = spark.conf.get(_BY_RUN)
    spark.conf.set(_BY_RUN, "false")
    try:
        return stored(out, "level")
    finally:
        spark.conf.set(_BY_RUN, before)


def _climb(nodes: DataFrame, carry: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Levels (tree, idx, digest, left, right) from the leaves up, and each tree's top (tree, digest).

    A level holds the trees that still have several nodes. ``nodes`` carries ``size``, the
    nodes of its tree, and the columns that the lowest level carries along.
    """
    levels, tops = [], []
    while True:
        tops.append(nodes.where("size = 1").select("tree", "digest"))
        open_ = nodes.where("size > 1")
        if not open_.limit(1).count():
            break
        level = _with_siblings(open_.select("tree", "idx", "digest", *(carry if not levels else ())), carry if not levels else ())
        levels.append(level)
        sizes = open_.where("idx = 0").select("tree", F.expr(f"(size + {ARITY - 1}) div {ARITY}").alias("size"))
        parents = level.where(f"idx % {ARITY} = 0").select(
            "tree", F.expr(f"idx div {ARITY}").alias("idx"), F.sha2(F.concat("left", "digest", "right"), 256).alias("digest")
        )
        nodes = stored(narrow_join(parents, stored(sizes, "sizes"), "tree"), "nodes")
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return levels, top


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest level with the path of its nodes; ``above`` has (tree, path) of each tree's top.

    Rows of a run are neighbours in a written level, so that their lists of siblings, which
    share all but one digest, are small when they are shuffled.
    """
    tops = above.select("tree", F.lit(0).cast("bigint").alias("idx"), "path")
    paths = tops
    for level in reversed(levels):
        step = F.array(F.struct("left", "right"))
        joined = level.withColumn("run", F.expr(f"idx div {ARITY}")).join(
            paths.select("tree", F.col("idx").alias("run"), "path"), ["tree", "run"]
        )
        rest = [c for c in level.columns if c not in ("left", "right")]
        below = joined.select(*rest, F.concat(step, "path").alias("path"))
        if level is levels[0]:
            return below
        below = below.drop("digest")
        # Trees that end at a lower level join in there.
        done = tops.join(level.select("tree").distinct(), "tree", "left_anti")
        paths = stored(below.unionByName(done), "paths")
    return paths


def build(rows: DataFrame, key: str, source: str, digest: str, changed: str | None = None) -> Manifest:
    """The manifest of rows with a leaf digest each.

    Within a source rows ascend by key (null first), then by digest. Sources ascend by
    their UTF-8 bytes, null first. Rows that are equal in key and digest take neighbouring
    places. A table without rows has no root. ``changed`` is a second digest that is
    carried along.
    """
    extra = [F.col(changed if changed else digest).alias("changed")]
    flat = stored(rows.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(digest).alias("digest"), *extra).withColumn("row", F.monotonically_increasing_id()), "leaves")
    flat = with_ordinal(flat, [F.col("source"), F.col("key"), F.col("digest"), F.col("row")], "n", 0)
    # One row per source; equal rows of one source are summed up before they are shuffled.
    found = flat.groupBy("source").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = stored(with_ordinal(found, [F.col("source")], "tree", 0), "trees")
    by_source = trees.select(F.col("source").alias("_source"), "tree", "first", "size")
    placed = narrow_join(flat, by_source, flat["source"].eqNullSafe(by_source["_source"])).select(
        "key", "changed", "tree", (F.col("n") - F.col("first")).alias("idx"), "digest", "size"
    )
    placed = stored(placed, "nodes")
    levels, tops = _climb(placed, ("key", "changed"))
    tops = stored(tops, "subroots")
    count = tops.count()
    crown = tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(count).cast("bigint").alias("size"))
    upper, root = _climb(crown)
    first = root.first()
    empty = F.array().cast(f"array<{_STEP}>")
    if upper:
        ways = _paths(upper, root.select("tree", empty.alias("path"))).select(F.col("idx").alias("tree"), "path")
    else:
        ways = tops.select("tree", empty.alias("path"))
    ways = stored(ways.join(tops.select("tree", F.col("digest").alias("subroot")), "tree"), "ways")
    subroots = trees.select("source", "size", "tree").join(ways, "tree").select("source", "size", "subroot")
    columns = ["key", "changed", "digest", "tree", "path"]
    below = placed.where("size = 1").join(ways.select("tree", "path"), "tree").select(*columns)
    if levels:
        below = below.unionByName(_paths(levels, ways.select("tree", "path")).select(*columns))
    proofs = narrow_join(below.withColumnRenamed("digest", "leaf"), ways.select("tree", "subroot"), "tree").drop("tree")
    return Manifest(first["digest"] if first else None, subroots, proofs)


def tampered(key: Column, text: Column) -> Column:
    """The text after the trial: A-Z lower-cased where 5 divides the CRC-32 of the key in decimals; a row without key is left alone."""
    hit = F.coalesce(F.crc32(key.cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def verify(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Every row's leaf, subroot, root and proof, and what its proof says after the trial.

    Null fields and empty texts are told apart. Rows that are equal in all fields are
    leaves of their own, whose results may differ only in the siblings of their places. An
    empty table gives no row. Only the named columns are read.
    """
    columns = {name: F.col(name) for name in fields}
    changed = columns | {text: tampered(F.col(key), F.col(text))}
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), leaf(columns).alias("leaf"), leaf(changed).alias("changed"))
    made = build(rows, "key", "source", "leaf", "changed")
    root = F.lit(made.root).cast("string")
    folded = fold(F.col("path"), F.col("changed"))
    return made.proofs.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"), proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
