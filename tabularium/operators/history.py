"""Attribute history of keys from full snapshots, by comparison of hash trees.

Each snapshot of a group gets a tree of digests over its keys: a leaf is a range
of key hashes, an inner node the digest of its children. Consecutive snapshots
are compared from the root; only children of differing nodes are looked at, and
only the rows of differing leaves are compared key by key. A key that is new or
differs opens a version, a key that vanishes or differs closes one.

The rows of the input are read and shuffled once, as hashes, by (group, leaf): the
latest row per key and the leaves, each with its digest and its few keys, are made
from that and written. The levels above read only the digests of that table; of
its rows only those of differing leaves are used. The depth of a tree follows the
largest snapshot of its group, so a group that holds a third of all rows has as
many more leaves, each about as small as any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import written

FANOUT_BITS = 4
LEAF_ROWS = 32
OPEN_END = "9999-12-31"
_FACTS = ("_depth", "_last", "_date", "_next_date")


def _differing(nodes: DataFrame, node: list[str]) -> DataFrame:
    """(node, position) wherever a node's digest differs from that of the position before, absence included."""
    w = Window.partitionBy("_group", *node).orderBy("_at")
    joined = nodes.withColumns({"_was": F.lag("_digest").over(w), "_was_at": F.lag("_at").over(w), "_then_at": F.lead("_at").over(w)})
    fresh = F.col("_was_at").isNull() | (F.col("_was_at") != F.col("_at") - 1) | (F.col("_was") != F.col("_digest"))
    gone = ~F.col("_last") & (F.col("_then_at").isNull() | (F.col("_then_at") != F.col("_at") + 1))
    at = F.explode(F.array_compact(F.array(F.when(fresh, F.col("_at")), F.when(gone, F.col("_at") + 1))))
    return joined.select("_group", *node, at.alias("_at")).distinct()


def _with_before(places: DataFrame) -> DataFrame:
    return places.withColumn("_at", F.explode(F.array(F.col("_at"), F.col("_at") - 1))).distinct()


def snapshot_tree(snapshots: DataFrame, *, snapshot: str, group: str, date: Column, order: list[Column], rows: Column, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Each snapshot's position in its group, its date, and the depth of its group's trees.

    Snapshots without id, group or date are left out; a repeated snapshot counts once. rows: the number of rows of the snapshot.
    """
    known = snapshots.withColumns({"_date": date, "_rows": F.coalesce(rows, F.lit(0)), "_group": F.xxhash64(group)}).filter(F.col(snapshot).isNotNull() & F.col(group).isNotNull() & F.col("_date").isNotNull()).dropDuplicates([snapshot])
    depth = known.groupBy("_group").agg(F.greatest(F.lit(0), F.ceil(F.log(2.0, F.greatest(F.max("_rows"), F.lit(1)) / F.lit(leaf_rows)) / FANOUT_BITS)).cast("int").alias("_depth"))
    w = Window.partitionBy("_group").orderBy("_date", *order, F.col(snapshot))
    placed = known.select(
        F.col(snapshot).alias("_snapshot"), "_group", (F.row_number().over(w) - 1).alias("_at"), "_date", F.lead("_date").over(w).alias("_next_date"), F.lead(snapshot).over(w).isNull().alias("_last")
    )
    return placed.join(depth, "_group")


def key_history(rows: DataFrame, tree: DataFrame, *, snapshot: str, key: str, digest: Column, version: Column, tie: Column) -> DataFrame:
    """The versions of each key: unbroken runs of snapshots of its group with equal digest.

    Result: ``key``, ``valid_from`` and ``valid_to`` as dates; ``valid_to`` is the date of the next snapshot
    of the group after the run, NULL if there is none. Of rows with equal snapshot and key the one of
    the greatest ``version`` counts, then of the greatest ``tie``; NULL is the least. Rows without key or
    of a snapshot outside ``tree`` are left out. Empty input gives no rows; other columns are ignored.

    tree: see ``snapshot_tree``. key: a bigint column; a key belongs to one group. digest: a bigint hash of what makes a version.
    """
    tree = written(tree, "tree")
    deepest = tree.agg(F.max("_depth")).first()[0] or 0
    leaf = F.xxhash64("_key").bitwiseAND(F.expr(f"shiftleft(1L, _depth * {FANOUT_BITS}) - 1"))
    placed = (
        rows.filter(F.col(key).isNotNull())
        .select(F.col(snapshot).alias("_snapshot"), F.col(key).cast("bigint").alias("_key"), version.alias("_version"), tie.alias("_tie"), digest.alias("_hash"))
        .join(tree, "_snapshot")
        .withColumn("_leaf", leaf)
        .select("_group", "_leaf", "_at", "_key", *_FACTS, F.struct("_version", "_tie", "_hash").alias("_row"))
        .repartition("_group", "_leaf")
        .groupBy("_group", "_leaf", "_at", "_key")
        .agg(F.max("_row")["_hash"].alias("_hash"), *[F.first(c).alias(c) for c in _FACTS])
    )
    leaves = placed.groupBy("_group", "_leaf", "_at").agg(F.bit_xor(F.xxhash64("_key", "_hash")).alias("_digest"), *[F.first(c).alias(c) for c in _FACTS], F.collect_list(F.struct("_key", "_hash")).alias("_rows"))
    leaves = written(leaves, "leaves")
    digests = leaves.select("_group", "_leaf", "_at", "_depth", "_last", "_digest")

    def level(depth: int) -> DataFrame:
        node = F.expr(f"shiftright(_leaf, (_depth - {depth}) * {FANOUT_BITS})")
        return (
            digests.filter(F.col("_depth") >= depth)
            .groupBy("_group", node.alias("_node"), "_at")
            .agg(F.bit_xor(F.xxhash64("_leaf", "_digest")).alias("_digest"), F.first("_depth").alias("_depth"), F.first("_last").alias("_last"))
        )

    depths = tree.select("_group", "_depth").distinct()
    front = written(_differing(level(0), ["_node"]), "differing")
    changed = [front.join(depths.filter("_depth = 0"), "_group", "left_semi")]
    for d in range(1, deepest + 1):
        up = front.withColumnRenamed("_node", "_up")
        below = level(d).withColumn("_up", F.shiftright("_node", FANOUT_BITS)).join(_with_before(up), ["_group", "_up", "_at"], "left_semi")
        front = _differing(below, ["_node"]).withColumn("_up", F.shiftright("_node", FANOUT_BITS)).join(up, ["_group", "_up", "_at"], "left_semi").drop("_up")
        front = written(front, "differing")
        changed.append(front.join(depths.filter(F.col("_depth") == d), "_group", "left_semi"))
    places = reduce(DataFrame.unionByName, changed).withColumnRenamed("_node", "_leaf")
    marks = places.select("_group", "_leaf", F.explode(F.array(F.struct(F.col("_at").alias("_at"), F.lit(True).alias("_now")), F.struct((F.col("_at") - 1).alias("_at"), F.lit(False).alias("_now")))).alias("m"))
    marks = marks.groupBy("_group", "_leaf", F.col("m._at").alias("_at")).agg(F.max("m._now").alias("_as_now"), F.max(~F.col("m._now")).alias("_as_before")).hint("merge")
    nothing = F.lit(None).cast("bigint")
    side = F.array_compact(
        F.array(
            F.when(F.col("_as_now"), F.struct(F.col("_at").alias("at"), F.col("_date").alias("date"), F.col("_hash").alias("now"), nothing.alias("before"))),
            F.when(F.col("_as_before"), F.struct((F.col("_at") + 1).alias("at"), F.col("_next_date").alias("date"), nothing.alias("now"), F.col("_hash").alias("before"))),
        )
    )
    sides = (
        leaves.drop("_digest", "_depth", "_last")
        .join(marks, ["_group", "_leaf", "_at"])
        .select("_group", "_leaf", "_at", "_date", "_next_date", "_as_now", "_as_before", F.inline("_rows"))
        .withColumn("_side", F.explode(side))
        .repartition("_group", "_leaf")
        .groupBy("_group", "_leaf", "_key", F.col("_side.at").alias("_at"))
        .agg(F.max("_side.now").alias("_now"), F.max("_side.before").alias("_before"), F.max("_side.date").alias("_date"))
        .filter(~F.col("_now").eqNullSafe(F.col("_before")))
    )
    w = Window.partitionBy("_group", "_leaf", "_key").orderBy("_at")
    bounds = sides.withColumn("_until", F.lead("_date").over(w)).filter(F.col("_now").isNotNull())
    return bounds.select(F.col("_key").alias(key), F.col("_date").alias("valid_from"), F.col("_until").alias("valid_to"))


LEAVES_DDL = "_group bigint, _depth int, _leaf bigint, _digest bigint, _rows array<struct<_key:bigint,_hash:bigint>>"


def newest_leaves(rows: DataFrame, *, group: str, key: str, digest: Column, version: Column, tie: Column, stored: DataFrame | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The leaves of the trees over one snapshot of each group (see ``LEAVES_DDL``), as they are kept from run to run.

    rows: of one snapshot per group; which row of a key counts is as in ``key_history``. stored: leaves of the former snapshots, whose depths are kept, so that
    trees can be compared. Rows without group or key are left out.
    """
    known = rows.filter(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.xxhash64(group).alias("_group"), F.col(key).cast("bigint").alias("_key"), F.struct(version.alias("v"), tie.alias("t"), digest.alias("_hash")).alias("_row"))
    once = known.groupBy("_group", "_key").agg(F.max("_row")["_hash"].alias("_hash"))
    depth = once.groupBy("_group").agg(F.greatest(F.lit(0), F.ceil(F.log(2.0, F.count("*") / F.lit(leaf_rows)) / FANOUT_BITS)).cast("int").alias("_depth"))
    if stored is not None:
        kept = stored.groupBy("_group").agg(F.first("_depth").alias("_kept"))
        depth = depth.join(kept, "_group", "left").select("_group", F.coalesce("_kept", "_depth").alias("_depth"))
    placed = once.join(depth, "_group").withColumn("_leaf", F.xxhash64("_key").bitwiseAND(F.expr(f"shiftleft(1L, _depth * {FANOUT_BITS}) - 1")))
    return placed.groupBy("_group", "_depth", "_leaf").agg(F.bit_xor(F.xxhash64("_key", "_hash")).alias("_digest"), F.collect_list(F.struct("_key", "_hash")).alias("_rows"))


def appended_versions(versions: DataFrame, stored: DataFrame, fresh: DataFrame, dates: DataFrame, key: str) -> DataFrame:
    """The history after one more snapshot of some groups: versions of changed or vanished keys closed, versions of changed or new keys appended.

    versions: ``key``, ``valid_from``, ``valid_to`` (NULL while open). stored, fresh: ``newest_leaves`` before and now. dates: ``_group``, ``_date`` of the
    groups with a new snapshot; groups without one stay as they are. Trees are compared from the root, and only rows of differing leaves are looked at, so
    a run costs its new snapshots and no former one is read again.
    """
    both = [written(x.join(dates.select("_group"), "_group", "left_semi"), "sides") for x in (stored, fresh)]
    deepest = max((x.agg(F.max("_depth")).first()[0] or 0) for x in both)

    def level(leaves: DataFrame, depth: int) -> DataFrame:
        node = F.expr(f"shiftright(_leaf, (_depth - {depth}) * {FANOUT_BITS})")
        return leaves.filter(F.col("_depth") >= depth).groupBy("_group", "_depth", node.alias("_node")).agg(F.bit_xor(F.xxhash64("_leaf", "_digest")).alias("_digest"))

    front, places = None, []
    for d in range(deepest + 1):
        was, now = (level(x, d) for x in both)
        if front is not None:
            up = front.select("_group", F.col("_node").alias("_up"))
            was, now = (x.withColumn("_up", F.shiftright("_node", FANOUT_BITS)).join(up, ["_group", "_up"], "left_semi").drop("_up") for x in (was, now))
        on = ["_group", "_depth", "_node"]
        differ = was.withColumnRenamed("_digest", "_was").join(now.withColumnRenamed("_digest", "_now"), on, "full_outer").filter(~F.col("_was").eqNullSafe(F.col("_now")))
        front = written(differ.select(*on), "front")
        places.append(front.filter(F.col("_depth") == d).select("_group", F.col("_node").alias("_leaf")))
    leaves = reduce(DataFrame.unionByName, places)
    was, now = (x.join(leaves, ["_group", "_leaf"], "left_semi").select("_group", F.inline("_rows")).withColumnRenamed("_hash", n) for x, n in zip(both, ("_was", "_now"), strict=True))
    changed = was.join(now, ["_group", "_key"], "full_outer").filter(~F.col("_was").eqNullSafe(F.col("_now"))).join(dates, "_group")
    changed = written(changed.select(F.col("_key").alias(key), F.col("_date"), F.col("_was").isNotNull().alias("_closes"), F.col("_now").isNotNull().alias("_opens")), "changed")
    ended = versions.join(changed.filter("_closes").select(key, "_date"), key, "left")
    end = F.when(F.col("valid_to").isNull(), F.col("_date")).otherwise(F.col("valid_to"))
    kept = ended.select(key, "valid_from", end.alias("valid_to"))
    return kept.unionByName(changed.filter("_opens").select(key, F.col("_date").alias("valid_from"), F.lit(None).cast(versions.schema["valid_to"].dataType).alias("valid_to")))
