"""Mixing sources to target weights, with capped repetition.

Budgets run down a tree (by default domain, language, source). A leaf's weight is
its source's target share, spread over the source's leaves by what they can give.
A node that can't use its budget gives the shortage to its siblings first, by
weight, and only what they can't take goes up to the next level.

A leaf's budget is met from seeded epochs: whole passes over its records, then
the token-prefix of one more pass in an order drawn by hash. The prefix needs no
sort of the leaf: token sums per slice of the hash range, as many as the number of
records asks for, find the slice in which the budget ends, slices before it are
taken whole, and only that one is ranked. The order is the same for any number of
slices.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import lookup_rows, materialize

#: Records of a slice of the hash range, about.
SLICE_RECORDS = 5_000
MAX_LEAVES = 10_000
#: Records that a source may get beyond its leaves' prefixes.
TOP_UPS = 5


@dataclass
class Node:
    weight: float = 0.0
    room: float = 0.0
    budget: float = 0.0
    children: dict[str, Node] = field(default_factory=dict)


def share_out(weights: np.ndarray, rooms: np.ndarray, budget: float) -> np.ndarray:
    """The budget by weight, none above its room; shortages go to the others by weight, those without weight last."""
    given = np.zeros(len(weights))
    budget = min(budget, float(rooms.sum()))
    for active_weights in (weights, rooms):  # rooms: nothing with weight has room left
        open_ = (rooms - given > 1e-9) & (active_weights > 0)
        while budget - given.sum() > 1e-6 and open_.any():
            rest = budget - given.sum()
            part = np.where(open_, active_weights, 0.0)
            given = np.minimum(rooms, given + rest * part / part.sum())
            open_ = (rooms - given > 1e-9) & (active_weights > 0)
    return given


def spread(node: Node, budget: float) -> None:
    """Budgets for a tree: siblings take each other's shortages, and a child never gets more than its subtree can give."""
    node.budget = budget
    kids = list(node.children.values())
    if kids:
        shares = share_out(np.array([k.weight for k in kids]), np.array([k.room for k in kids]), budget)
        for k, b in zip(kids, shares, strict=True):
            spread(k, float(b))


def budget_tree(leaves: list[tuple[tuple[str, ...], str, int]], targets: dict[str, tuple[float, int]], total: float | None) -> Node:
    """Budgets of all nodes over the leaves (path, source, tokens); without a total, the largest at which every source with tokens meets its share."""
    supply: dict[str, float] = {}
    for _, source, tokens in leaves:
        supply[source] = supply.get(source, 0.0) + tokens * targets[source][1]
    sources = {s: w for s, (w, _) in targets.items() if w > 0 and supply.get(s, 0) > 0}
    weight_all = sum(sources.values())
    root = Node()
    if total is None:
        total = min((supply[s] * weight_all / w for s, w in sources.items()), default=0.0)
    for path, source, tokens in leaves:
        room = tokens * targets[source][1] if source in sources else 0.0
        weight = sources.get(source, 0.0) * room / supply[source] if supply.get(source) else 0.0
        node = root
        for step in ((), *((x,) for x in path)):
            if step:
                node = node.children.setdefault(step[0], Node())
            node.weight += weight
            node.room += room
    spread(root, min(total, root.room))
    return root


def leaf_budget(root: Node, path: tuple[str, ...]) -> float:
    for x in path:
        root = root.children[x]
    return root.budget


BUDGETS = "level int, node string, weight double, room double, asked double, budget double, shortage double, received double"


def _budget_rows(node: Node, path: tuple[str, ...] = ()) -> list[tuple]:
    """For every node what it may give (`room`), its part of its parent's budget by weight (`asked`), its budget, and by how much it falls short or takes over from siblings."""
    out = []
    weights = sum(k.weight for k in node.children.values())
    for name, kid in sorted(node.children.items()):
        asked = node.budget * kid.weight / weights if weights else 0.0
        out.append((len(path) + 1, "/".join((*path, name)), kid.weight, kid.room, *(round(x, 3) for x in (asked, kid.budget, max(0.0, asked - kid.budget), max(0.0, kid.budget - asked)))))
        out += _budget_rows(kid, (*path, name))
    return out


@dataclass(frozen=True)
class Mix:
    """The chosen records (`rows`), and the budgets of the tree's nodes (`budgets`)."""

    rows: DataFrame
    budgets: DataFrame


def mix(records: DataFrame, targets: DataFrame, id_col: str, size_col: str, source_col: str, path: dict[str, Column], total_tokens: float | None = None, seed: int = 7) -> Mix:
    """Rows of id, source, the path's columns, tokens, uses and used_tokens of every record that is chosen, and the budgets of the tree's nodes.

    `targets` has source, target_share and max_repeats. `path` names the tree's
    columns from the top, the last one telling sources apart. `total_tokens` is
    the size of the mix; by default the largest at which the shares are met.
    Records are used whole: a leaf's prefix stops before the record that would
    exceed its budget, and then each source gets a few more records that fit what
    is left of its budgets. The same seed gives the same mix.

    Defined cases: records without an id, of unknown source or of a source without
    a target, and records without tokens, are not chosen; repeated rows of one id
    count once, at their greatest size (of ties, the last source). A null share counts as 0, null repeats as 1. A source without
    records leaves its share to the others. Null path values are a value of their
    own. Empty tables give an empty mix.
    """
    spark = records.sparkSession
    wanted = {r[0]: (float(r[1] or 0.0), int(1 if r[2] is None else r[2])) for r in lookup_rows(targets.select("source", "target_share", "max_repeats").filter("source is not null"))}
    names = list(path)
    rows = records.select(F.col(id_col).cast("bigint").alias("id"), F.col(source_col).alias("source"), F.col(size_col).cast("bigint").alias("tokens"), *(F.coalesce(c.cast("string"), F.lit("")).alias(f"_{n}") for n, c in path.items()))
    leaf_columns = [f"_{n}" for n in names]
    rows = rows.filter("id is not null and tokens > 0").filter(F.col("source").isin(list(wanted)))
    rows = rows.groupBy("id").agg(F.max(F.struct("tokens", "source", *leaf_columns)).alias("x")).select("id", "x.source", "x.tokens", *(f"x.{c}" for c in leaf_columns))
    rows = materialize(rows, "records-to-mix")
    sums = rows.groupBy("source", *leaf_columns).agg(F.sum("tokens").alias("tokens"))
    leaves = [(tuple(r[1:-1]), r[0], r[-1]) for r in sorted(lookup_rows(sums, MAX_LEAVES))]
    root = budget_tree(leaves, wanted, total_tokens)
    budgets = {where: leaf_budget(root, where) for where, _, _ in leaves}
    plan = []
    for where, source, supply in leaves:
        passes = min(int(budgets[where] // supply), wanted[source][1])
        rest = budgets[where] - passes * supply if passes < wanted[source][1] else 0.0
        plan.append((*where, source, passes, float(rest)))
    types = ", ".join([*(f"{c} string" for c in leaf_columns), "source string, passes int, rest double"])
    keyed = rows.join(F.broadcast(spark.createDataFrame(plan, types)), [*leaf_columns, "source"])
    slices_wanted = max(1, -(-rows.count() // SLICE_RECORDS))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "passes", "id"), 1)
    keyed = keyed.withColumn("draw", draw).withColumn("slice", F.expr(f"cast(draw div {-(-(1 << 63) // slices_wanted)} as int)") if slices_wanted > 1 else F.lit(0))
    leaf = [*leaf_columns, "source"]
    slices = keyed.groupBy(*leaf, "rest", "slice").agg(F.sum("tokens").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = slices.select(*leaf, "slice", before.alias("before"), (before + F.col("sum")).alias("after"))
    placed = keyed.join(slices, [*leaf, "slice"])
    edge = (F.col("before") < F.col("rest")) & (F.col("after") > F.col("rest"))
    whole = placed.filter(~edge).withColumn("last", (F.col("after") <= F.col("rest")).cast("int"))
    running = F.coalesce(F.sum("tokens").over(Window.partitionBy(*leaf, "slice").orderBy("draw", "id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.filter(edge).withColumn("last", (F.col("before") + running + F.col("tokens") <= F.col("rest")).cast("int"))
    placed = whole.unionByName(ranked).withColumn("uses", F.col("passes") + F.col("last"))
    placed = materialize(placed.select("id", "source", *leaf_columns, "tokens", "draw", "uses"), "prefixes")
    budget_of: dict[str, float] = {}
    for where, source, _ in leaves:
        budget_of[source] = budget_of.get(source, 0.0) + budgets[where]
    extra = _top_up(placed, budget_of, {s: n for s, (_, n) in wanted.items()})
    added = spark.createDataFrame([(i,) for i in extra], "id bigint").withColumn("more", F.lit(1))
    chosen = placed.join(F.broadcast(added), "id", "left").withColumn("uses", F.col("uses") + F.coalesce("more", F.lit(0))).filter("uses > 0")
    out = [F.when(F.col(f"_{n}") != "", F.col(f"_{n}")).alias(n) for n in names if n != "source"]
    chosen = chosen.select("id", "source", *out, "tokens", "uses", (F.col("uses") * F.col("tokens")).alias("used_tokens"))
    return Mix(chosen, spark.createDataFrame(_budget_rows(root), BUDGETS))


def _top_up(placed: DataFrame, budget_of: dict[str, float], repeats: dict[str, int]) -> list[int]:
    """One more use of a few records, so that each source's tokens come close to its budget: round by round the largest that fits, one a source."""
    used = {r[0]: r[1] for r in placed.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens"))).collect()}
    gap = {s: b - used.get(s, 0) for s, b in budget_of.items()}
    spark = placed.sparkSession
    taken: list[int] = []
    for _ in range(TOP_UPS):
        open_ = [(s, float(g), repeats[s]) for s, g in gap.items() if g >= 1]
        if not open_:
            break
        gaps = F.broadcast(spark.createDataFrame(open_, "source string, gap double, most int"))
        fitting = placed.join(gaps, "source").filter("tokens <= gap and uses < most").filter(~F.col("id").isin(taken) if taken else F.lit(True))
        best = fitting.groupBy("source").agg(F.max(F.struct("tokens", "draw", "id")).alias("x")).select("source", "x.tokens", "x.id").collect()
        if not best:
            break
        for source, tokens, i in best:
            gap[source] -= tokens
            taken.append(i)
    return taken


def mix_shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target and actual share, records, tokens and the most uses of one record."""
    sums = chosen.groupBy("source").agg(F.count("*").alias("records"), F.sum("used_tokens").alias("used_tokens"), F.max("uses").alias("most_uses"))
    total = chosen.agg(F.sum("used_tokens").alias("total"))
    wanted = targets.select("source", "target_share", "max_repeats").filter("source is not null")
    rows = wanted.join(sums, "source", "left").join(F.broadcast(total))
    share = F.coalesce(F.col("used_tokens") / F.col("total"), F.lit(0.0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return rows.select("source", "target_share", "max_repeats", F.round(share, 6).alias("actual_share"), zero("records"), zero("used_tokens"), zero("most_uses"))
