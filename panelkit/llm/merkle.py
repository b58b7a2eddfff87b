"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf; the leaves of a group (a language) stand in key order,
and ``FANOUT`` consecutive nodes at a time become their digest until one is
left, the group's subroot.  The subroots are the leaves of a second tree of
the same form, whose top is the root.

Leaves are dealt into aligned blocks of ``FANOUT ** levels`` consecutive ones
and each block hashes its own subtree.  Then follow rounds: in round ``r`` the
blocks at distance ``FANOUT ** r`` within an aligned group of that many times
``FANOUT`` swap the subtree roots they hold, and *each* of them hashes the
parent, redundantly.  So after the last round every block holds the top and
the siblings of all its ancestors: proofs need no pass from the top down.  A
round moves one row a block (a digest and the proof so far), never a leaf.

The last subtree of a level may have fewer blocks than partners that need its
root; its blocks then serve several, together at most one row a partner.

Everything is DataFrame functions: groups of at most ``FANOUT`` rows in the
exchange, of ``FANOUT ** levels`` leaves in a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialize

FANOUT = 8
HEX = 64  # characters of a digest

_STATE = ("block", "blocks", "node", "proof", "places", "counts")


def row_digest(cells: Sequence[Column]) -> Column:
    """Digest of one row: each cell as ``-`` if null, else its number of UTF-8
    bytes, a colon and its value."""
    texts = [c.cast("string") for c in cells]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold_proof(leaf: Column, proof: Column, places: Column, counts: Column) -> Column:
    """The root that a leaf digest and a proof (see :func:`manifest`) lead to."""
    siblings = proof.cast("binary")

    def up(acc, step):
        left = HEX * step["places"]
        right = HEX * (step["counts"] - 1 - step["places"])
        run = F.concat(F.substr(siblings, acc["at"], left), acc["node"].cast("binary"),
                       F.substr(siblings, acc["at"] + left, right))
        return F.struct(F.sha2(run, 256).alias("node"), (acc["at"] + left + right).alias("at"))

    start = F.struct(leaf.alias("node"), F.lit(1).alias("at"))
    return F.aggregate(F.arrays_zip(places.alias("places"), counts.alias("counts")), start, up,
                       lambda acc: acc["node"])


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, 2, ... per ``group`` in ``order``) and
    ``total`` (rows of the group), without a task that sees a whole group."""
    keys = ["group", *order, "leaf", "_row"]
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
                         .withColumn("_at", F.monotonically_increasing_id()), "sorted_leaves")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_part", part).withColumn("_at", at)
    runs = placed.groupBy("group", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    parts = Window.partitionBy("group")  # one row a partition that holds some of the group
    earlier = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("group").alias("_g"), F.col("_part").alias("_p"), F.sum("_n").over(parts).alias("total"),
                       (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"))
    return (placed.join(runs, (F.col("group") == F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_g", "_p", "_part", "_at", "_shift"))


def _parents(level: Column) -> Column:
    """Digests of the runs of an array of digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(level) / FANOUT).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(level, i * FANOUT + 1, FANOUT), ""), 256))


def _blocks(rows: DataFrame, order: Sequence[str], levels: int) -> DataFrame:
    """One row per block of ``FANOUT ** levels`` leaves: its ``members`` in
    order, the digests of its levels (``level1``, ...; null above the group's
    top) and its top ``node``."""
    size = FANOUT ** levels
    carried = [c for c in rows.columns if c != "group"]
    out = (_numbered(rows, order)
           .groupBy("group", F.floor(F.col("pos") / size).alias("block"))
           .agg(F.sort_array(F.collect_list(F.struct("pos", *carried))).alias("members"),
                F.min("total").alias("total"))
           .withColumn("blocks", F.ceil(F.col("total") / size))
           .withColumn("level0", F.transform("members", lambda m: m["leaf"])))
    for k in range(levels):
        out = out.withColumn(f"level{k + 1}", F.when(F.col("total") > FANOUT ** k, _parents(F.col(f"level{k}"))))
    top = F.coalesce(*[F.col(f"level{k}") for k in range(levels, -1, -1)])
    return materialize(out.withColumn("node", top[0]).drop("level0"), "blocks")


def exchange(blocks: DataFrame) -> DataFrame:
    """The rounds: ``group, block, blocks, node`` in, one row per block out
    with the group's top as ``node`` and the siblings met on the way
    (``proof``, ``places``, ``counts``)."""
    none = F.array().cast("array<int>")
    state = blocks.select("group", "block", "blocks", "node", F.lit("").alias("proof"),
                          none.alias("places"), none.alias("counts"))
    most = state.agg(F.max("blocks")).first()[0] or 0
    done, width = [], 1
    while width < most:
        done.append(state.filter(F.col("blocks") <= width))
        state = materialize(_swap(state.filter(F.col("blocks") > width), width), "swapped")
        width *= FANOUT
    for d in done:
        state = state.unionByName(d)
    return state


def _swap(state: DataFrame, width: int) -> DataFrame:
    """One round: subtrees of ``width`` blocks become those of ``FANOUT`` times."""
    place = F.col("block") % width
    tree = F.floor(F.col("block") / width)
    have = F.least(F.lit(width), F.col("blocks") - tree * width)  # blocks of this subtree
    digit = (tree % FANOUT).cast("int")
    alone = (digit == 0) & ((tree + 1) * width >= F.col("blocks"))
    partners = F.when((have == width) | alone, F.array(place)).otherwise(
        F.sequence(place, F.lit(width).cast("long") - 1, have))
    sent = (state.withColumn("_place", place).withColumn("_digit", digit).withColumn("_node", F.col("node"))
            .withColumn("_high", F.floor(tree / FANOUT)).withColumn("_to", F.explode(partners)))
    mine = F.when(F.col("_to") == F.col("_place"), F.struct(*_STATE))
    met = (sent.groupBy("group", "_high", "_to")
           .agg(F.sort_array(F.collect_list(F.struct("_digit", "_node", mine.alias("own")))).alias("run")))
    held = met.select("group", "run", F.explode(F.filter("run", lambda m: m["own"].isNotNull())).alias("me"))
    others = F.filter("run", lambda m: m["_digit"] != F.col("me")["_digit"])
    own = F.col("me")["own"]
    return held.select(
        "group", own["block"].alias("block"), own["blocks"].alias("blocks"),
        F.sha2(F.array_join(F.transform("run", lambda m: m["_node"]), ""), 256).alias("node"),
        F.concat(own["proof"], F.array_join(F.transform(others, lambda m: m["_node"]), "")).alias("proof"),
        F.concat(own["places"], F.array(F.col("me")["_digit"])).alias("places"),
        F.concat(own["counts"], F.array(F.size("run"))).alias("counts"))


def _proofs(blocks: DataFrame, upper: DataFrame, levels: int) -> DataFrame:
    """One row per leaf: ``group``, its own columns, the ``top`` and its whole
    proof: siblings inside the block, then those of the block (``upper``)."""
    up = upper.select(F.col("group").alias("_g"), F.col("block").alias("_b"),
                      *[c for c in upper.columns if c not in ("group", "block", "blocks")])
    rows = (blocks.drop("node", "blocks").withColumnRenamed("block", "_block")
            .join(up, (F.col("group") == F.col("_g")) & (F.col("_block") == F.col("_b")))
            .withColumn("level0", F.transform("members", lambda m: m["leaf"])))

    def step(k, i):  # place, run length and siblings of leaf i at level k
        at = F.floor(i / FANOUT ** k).cast("int")
        place, level = at % FANOUT, F.col(f"level{k}")
        run = F.slice(level, at - place + 1, FANOUT)
        others = F.concat(F.slice(run, F.lit(1), place), F.slice(run, place + 2, F.lit(FANOUT)))
        return F.when(F.col("total") > FANOUT ** k, F.struct(
            place.alias("place"), F.size(run).alias("count"), F.array_join(others, "").alias("siblings")))

    def proven(m, i):
        return F.struct(m.alias("leaf"), F.filter(F.array(*[step(k, i) for k in range(levels)]),
                                                  lambda x: x.isNotNull()).alias("steps"))

    # proofs are made inside the block's row, so that its levels are not copied per leaf
    out = rows.withColumn("_leaf", F.explode(F.transform("members", proven)))
    steps = F.col("_leaf")["steps"]
    extra = [c for c in up.columns if c not in ("_g", "_b", "node", "proof", "places", "counts")]
    return out.select("group", "_leaf.leaf.*", F.col("node").alias("top"),
                      F.concat(F.array_join(F.transform(steps, lambda x: x["siblings"]), ""), "proof").alias("proof"),
                      F.concat(F.transform(steps, lambda x: x["place"]), "places").alias("places"),
                      F.concat(F.transform(steps, lambda x: x["count"]), "counts").alias("counts"), *extra)


def manifest(rows: DataFrame, cells: Sequence[str], key: str = "doc_id", group: str = "lang",
             carry: dict[str, Column] | None = None, levels: int = 3, salt_blocks: int = 4096) -> DataFrame:
    """Leaf, subroot, root and proof of every row.

    Returns one row per input row: ``key`` and ``group`` under their names,
    ``leaf, subroot, root`` (lowercase hex), ``proof`` (digests of the
    siblings, left to right, level by level up to the root, in one string),
    ``places`` and ``counts`` (per level the row's place in its run and the
    run's length; :func:`fold_proof` takes the three), and the columns of
    ``carry`` (computed from the input row; names of your own, orderable).

    Leaves ascend by key (null first); equal keys by leaf digest, so equal
    rows are exchangeable; a null group is a group of its own, the first.
    Null, empty and very long cells are hashed whole; a lone leaf is its
    group's subroot, a lone subroot the root, with an empty proof.  Other
    columns are ignored; an empty table gives an empty result.
    """
    carry = carry or {}
    name = F.col(group).cast("string")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("group"),  # null sorts first
        F.col(key).alias("_key"), row_digest([F.col(c) for c in cells]).alias("leaf"),
        *[c.alias(f"_c{i}") for i, c in enumerate(carry.values())])
    blocks = _blocks(leaves, ["_key"], levels)
    upper = materialize(exchange(blocks), "upper")
    # the second tree, over the subroots
    tops = upper.filter("block = 0").select(
        F.lit("").alias("group"), F.col("group").alias("_name"), F.col("node").alias("leaf"), "blocks")
    over = _blocks(tops, ["_name"], levels)
    joined = _proofs(over, exchange(over), levels)
    # its proofs join the blocks'; a group with many blocks is salted
    salts = lambda: F.ceil(F.col("blocks") / salt_blocks)
    known = joined.select(F.col("_name").alias("_g"), F.col("top").alias("root"), F.col("proof").alias("_proof"),
                          F.col("places").alias("_places"), F.col("counts").alias("_counts"),
                          F.explode(F.sequence(F.lit(0).cast("long"), salts() - 1)).alias("_s"))
    full = (upper.withColumn("_salt", F.col("block") % salts())
            .join(known, (F.col("group") == F.col("_g")) & (F.col("_salt") == F.col("_s")))
            .select("group", "block", "node", F.concat("proof", "_proof").alias("proof"),
                    F.concat("places", "_places").alias("places"),
                    F.concat("counts", "_counts").alias("counts"), "root"))
    out = _proofs(blocks, full, levels)
    back = F.when(F.col("group") != "-", F.expr("substring(group, 2)"))
    return out.select(F.col("_key").alias(key), back.alias(group), "leaf", F.col("top").alias("subroot"), "root",
                      "proof", "places", "counts", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])
