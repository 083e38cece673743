"""Parent-child links to full hierarchies: depth, root, path, nested-set ranges, descendants and cycles.

The links need not form trees: a node may have several parents and links may lead back. One parent of each node (the
smallest) makes a forest; a cycle of these links, which climbing reveals as nodes that never arrive, is cut at its
smallest node. On the forest, subtree sizes are computed upward, preorder ranges are given out to siblings by prefix
sums and summed downward, both by pointer doubling: logarithmically many passes. Besides its nodes, each subtree's
links that aren't in the forest are counted in the same passes, so that they get ranks of their own, and those that
leave a subtree are one range of ranks.

What a node reaches is then a set of ranges: its own subtree, and the subtrees that links outside the forest enter
from one that is known, until nothing is new or nearer (as many passes as a way has such links). Ranges are opened
into positions and ranks, which are unique keys, so that a subtree of any size is spread evenly.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratework.operators.skew import running_sums
from cratework.session import settle

MERGE_LEVELS = 8
BLOCK = 4096


@dataclass
class Forest:
    """``nodes``: node, up (null for the top of a tree), depth, size, first, leaving, rank. ``links``: rank, source, depth, to.

    A node u is above v (or v itself) exactly if u.first <= v.first < u.first + u.size. The links outside the forest
    that leave u's subtree are those with u.rank <= rank < u.rank + u.leaving; a link has its source and its depth.
    """

    nodes: DataFrame
    links: DataFrame


def clean_edges(links: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct links with both ends present, as (parent, child)."""
    return (
        links.select(F.col(parent).alias("parent"), F.col(child).alias("child")).dropna().distinct()
    )


def roots_of(edges: DataFrame) -> DataFrame:
    """node: the parents that are never a child."""
    return edges.select(F.col("parent").alias("node")).distinct().join(edges.select(F.col("child").alias("node")).distinct(), "node", "left_anti")


def _first_parents(edges: DataFrame) -> DataFrame:
    """node, up: the smallest parent of each node other than itself, null for those without one; cycles are cut.

    Each node climbs by doubling and carries the smallest node on its way. Where another doubling lets no node arrive
    and changes no smallest node, what hasn't arrived leads into a cycle, which its smallest node then leaves.
    """
    other = F.when(F.col("parent") != F.col("child"), F.col("parent"))
    kind = edges.schema["parent"].dataType
    ends = edges.select(F.col("child").alias("node"), other.alias("up")).unionAll(edges.select(F.col("parent").alias("node"), F.lit(None).cast(kind).alias("up")))
    nodes = settle(ends.groupBy("node").agg(F.min("up").alias("up")))

    def climb(state: DataFrame) -> DataFrame:
        above = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("least").alias("other"))
        joined = state.select("node", "at", "least").join(above, "at", "left")
        return joined.select("node", F.col("further").alias("at"), F.least("least", "other").alias("least"), F.coalesce(F.col("other") < F.col("least"), F.lit(False)).alias("changed"))

    state, last = nodes.select("node", F.col("up").alias("at"), F.col("node").alias("least")), None
    while True:
        state = settle(climb(climb(state)))
        waiting = state.filter(F.col("at").isNotNull())
        n = waiting.agg(F.count(F.lit(1)), F.count_if("changed")).first()
        if not n[0]:
            return nodes
        if n[0] == last and not n[1]:
            break
        last = n[0]
    cut = waiting.filter("least = node").select("node", F.lit(True).alias("cut"))
    return settle(nodes.join(cut, "node", "left").select("node", F.when(F.col("cut").isNull(), F.col("up")).alias("up")))


def _grown(nodes: DataFrame) -> tuple[DataFrame, int]:
    """Adds depth, size and leaving (the sums of 1 and ``own`` over the subtree) to node, up, own; and the rounds it took.

    With s(v) the sum over v's subtree less than 2^k levels below and a(v) its ancestor 2^k levels above,
    s(v) + sum of s(u) over a(u) = v covers twice the levels.
    """

    def step(state: DataFrame) -> DataFrame:
        below = state.filter(F.col("at").isNotNull()).groupBy(F.col("at").alias("node")).agg(F.sum("size").alias("s"), F.sum("leaving").alias("l"))
        above = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("depth").alias("d"))
        joined = state.join(below, "node", "left").join(above, "at", "left")
        plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        return joined.select("node", "up", "own", F.col("further").alias("at"), plus("depth", "d"), plus("size", "s"), plus("leaving", "l"))

    depth = F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth")
    state = settle(nodes.select("node", "up", "own", F.col("up").alias("at"), depth, F.lit(1).cast("long").alias("size"), F.col("own").alias("leaving")))
    rounds = 0
    while not state.filter(F.col("at").isNotNull()).isEmpty():
        state, rounds = settle(step(step(state))), rounds + 1
    return state.drop("at"), rounds


def _placed(nodes: DataFrame, rounds: int) -> DataFrame:
    """Adds first and rank: places among siblings by prefix sums (bounded parts), summed down from the top by doubling."""
    placed = running_sums(nodes, ["up"], ["node"], ["size", "leaving"], ["first", "rank"], buckets=64)
    parents = nodes.select(F.col("node").alias("up"), F.col("own").alias("before"))
    under = F.col("up").isNotNull().cast("int")
    start = placed.join(parents, "up", "left").select(
        "node", F.col("up").alias("at"), (F.col("first") + under).alias("first"), (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank")
    )

    def step(state: DataFrame) -> DataFrame:
        above = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("first").alias("f"), F.col("rank").alias("r"))
        plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        return state.join(above, "at", "left").select("node", F.col("further").alias("at"), plus("first", "f"), plus("rank", "r"))

    state = settle(start)
    for _ in range(rounds):
        state = settle(step(step(state)))
    return settle(nodes.join(state.drop("at"), "node"))


def forest(edges: DataFrame) -> Forest:
    """The forest of (parent, child) links with its ranges and the links outside it. No links give an empty forest."""
    first = _first_parents(edges)
    aside = edges.join(first.select(F.col("node").alias("child"), "up"), "child").filter(~F.col("up").eqNullSafe(F.col("parent"))).select("parent", "child")
    own = aside.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("own"))
    nodes = _placed(*_grown(first.join(own, "node", "left").na.fill(0, ["own"])))
    sources = nodes.select(F.col("node").alias("parent"), F.col("rank").alias("start"), "depth")
    at = running_sums(aside, ["parent"], ["child"], F.lit(1), "at", buckets=64)
    links = at.join(sources, "parent").select((F.col("start") + F.col("at")).alias("rank"), F.col("parent").alias("source"), "depth", F.col("child").alias("to"))
    return Forest(nodes.drop("own"), settle(links))


def _opened(df: DataFrame, start: Column, size: Column, name: str) -> DataFrame:
    """A row for each number of start .. start + size - 1, in blocks, so that no array grows with the range."""
    blocks = df.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((size - 1) / BLOCK))))
    low = start + F.col("__b") * BLOCK
    return blocks.withColumn(name, F.explode(F.sequence(low, F.least(low + BLOCK, start + size) - 1))).drop("__b")


def _leaving(f: Forest, entries: DataFrame) -> DataFrame:
    """The links outside the forest that leave the subtree of each entry's node: columns of ``entries``, top (the node's depth), inside (the source's depth below it), source, to."""
    here = entries.join(f.nodes.select("node", F.col("depth").alias("top"), "leaving", F.col("rank").alias("__r")), "node").filter("leaving > 0")
    ranks = _opened(here, F.col("__r"), F.col("leaving"), "rank")
    return ranks.join(f.links, "rank").select(*entries.columns, "top", (F.col("depth") - F.col("top")).alias("inside"), "source", "to")


def reach(f: Forest, starts: DataFrame, ways: DataFrame | None = None) -> DataFrame:
    """start, node, depth: all nodes that each of ``starts`` (node) reaches, itself included, with the fewest links.

    With ``ways`` (the ``paths`` of the forest) also way, the nodes from the start to the node on one such way.
    """
    more = [] if ways is None else ["way"]
    tail = lambda path, top, n: F.slice(path, F.col(top).cast("int") + 2, n.cast("int"))

    def nearest(df: DataFrame) -> DataFrame:
        if not more:
            return df.groupBy("start", "node").agg(F.min("depth").alias("depth"))
        return df.groupBy("start", "node").agg(F.min(F.struct("depth", "way")).alias("__m")).select("start", "node", "__m.depth", "__m.way")

    def along(df: DataFrame, key: str, top: str, n: Column, last: list[Column]) -> DataFrame:
        """Lengthens way by the n nodes of the forest that lead down to ``key`` from depth ``top``."""
        if not more:
            return df
        on = ways.select(F.col("node").alias(key), "path")
        return df.join(on, key).withColumn("way", F.concat("way", tail(F.col("path"), top, n), *last)).drop("path")

    first = [F.array("node").alias("way")] if more else []
    known = settle(starts.select(F.col("node").alias("start"), "node", F.lit(0).cast("long").alias("depth"), *first))
    new = known
    while True:
        hops = along(_leaving(f, new.withColumnRenamed("depth", "base")), "source", "top", F.col("inside"), [F.array("to")])
        hops = hops.select("start", F.col("to").alias("node"), (F.col("base") + F.col("inside") + 1).alias("depth"), *more)
        old = known.select("start", "node", F.col("depth").alias("old"))
        new = settle(nearest(hops).join(old, ["start", "node"], "left").filter("old is null or depth < old").drop("old"))
        if new.isEmpty():
            break
        known = settle(nearest(known.unionByName(new)))
    inner = known.join(f.nodes.select("node", F.col("depth").alias("top"), "first", "size"), "node")
    opened = _opened(inner.select("start", F.col("depth").alias("base"), "top", "first", "size", *more), F.col("first"), F.col("size"), "at")
    found = opened.join(f.nodes.select("node", F.col("first").alias("at"), F.col("depth").alias("deep")), "at").withColumn("inside", F.col("deep") - F.col("top"))
    found = along(found, "node", "top", F.col("inside"), []).select("start", "node", (F.col("base") + F.col("inside")).alias("depth"), *more)
    return nearest(found).withColumn("depth", F.col("depth").cast("int"))


def paths(f: Forest) -> DataFrame:
    """node, path: the nodes from the top of the node's tree to itself, by doubling."""

    def step(state: DataFrame) -> DataFrame:
        above = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("path").alias("head"))
        head = F.coalesce("head", F.array().cast(state.schema["path"].dataType))
        return state.join(above, "at", "left").select("node", F.col("further").alias("at"), F.concat(head, "path").alias("path"))

    state = settle(f.nodes.select("node", F.col("up").alias("at"), F.array("node").alias("path")))
    while not state.filter(F.col("at").isNotNull()).isEmpty():
        state = settle(step(step(state)))
    return state.drop("at")


def unprocessed(edges: DataFrame) -> DataFrame:
    """The links left when nodes without incoming or without outgoing links are peeled off again and again.

    All cycles are in what is left (with the ways from one cycle to another); acyclic links leave nothing. Each
    round takes one aggregation of the nodes and peels from above and below at once.
    """
    left = settle(edges)
    n = left.count()
    while n:
        ends = left.select(F.col("parent").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
            left.select(F.col("child").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
        )
        inner = ends.groupBy("node").agg(F.max("out").alias("out"), F.max("into").alias("into")).filter("out = 1 and into = 1").select("node")
        left = settle(
            left.join(inner.select(F.col("node").alias("parent")), "parent", "left_semi")
            .join(inner.select(F.col("node").alias("child")), "child", "left_semi")
            .select("parent", "child")
        )
        m = left.count()
        if m == n:
            break
        n = m
    return left


def strong_classes(edges: DataFrame) -> DataFrame:
    """node, least: each node that can reach itself, with the smallest node of its class of mutual reach.

    On the unprocessed links every node takes the smallest node that reaches it as its colour; a node that has
    its own colour is the smallest of its class, and the class is what reaches it backward inside the colour.
    Found classes are taken out and the rest is peeled and coloured again. All tables stay as long as the links.
    """
    found = []
    rest = unprocessed(edges)
    while not rest.isEmpty():
        nodes = rest.select(F.col("parent").alias("node")).union(rest.select(F.col("child").alias("node"))).distinct()
        colour = settle(nodes.withColumn("colour", F.col("node")))
        while True:
            sent = rest.join(colour, rest["parent"] == colour["node"]).groupBy("child").agg(F.min("colour").alias("sent"))
            nxt = settle(
                colour.join(sent, colour["node"] == sent["child"], "left").select(
                    "node", F.least("colour", "sent").alias("colour"), (F.col("sent") < F.col("colour")).alias("moved")
                )
            )
            colour = nxt.select("node", "colour")
            if nxt.filter("moved").isEmpty():
                break
        one = colour.select(F.col("node").alias("parent"), F.col("colour").alias("cp"))
        two = colour.select(F.col("node").alias("child"), F.col("colour").alias("cc"))
        inside = settle(rest.join(one, "parent").join(two, "child").filter("cp = cc").select("parent", "child", F.col("cp").alias("colour")))
        wave = settle(colour.filter("node = colour").select("node", "colour"))
        waves = [wave]
        while True:
            if len(waves) > MERGE_LEVELS:
                waves = [settle(reduce(DataFrame.unionAll, waves))]
            seen = reduce(DataFrame.unionAll, waves)
            wave = settle(
                inside.join(wave.select(F.col("node").alias("child"), "colour"), ["child", "colour"])
                .select(F.col("parent").alias("node"), "colour")
                .distinct()
                .join(seen, ["node", "colour"], "left_anti")
            )
            if wave.isEmpty():
                break
            waves.append(wave)
        members = settle(reduce(DataFrame.unionAll, waves).select("node", F.col("colour").alias("least")))
        loops = members.join(inside.select(F.col("parent").alias("node"), F.col("child").alias("to")), "node")
        real = loops.join(members.select(F.col("node").alias("to"), F.col("least").alias("to_least")), "to").filter("least = to_least")
        found.append(settle(real.select("node", "least").distinct()))
        gone = members.select("node")
        rest = rest.join(gone.select(F.col("node").alias("parent")), "parent", "left_anti")
        rest = unprocessed(rest.join(gone.select(F.col("node").alias("child")), "child", "left_anti").select("parent", "child"))
    if not found:
        return edges.select(F.col("parent").alias("node"), F.col("parent").alias("least")).filter(F.lit(False))
    return reduce(DataFrame.unionAll, found)


def entry_classes(f: Forest) -> DataFrame:
    """node, least: the nodes that links outside the forest enter and that lie on a cycle, with the smallest such node of their class.

    Every cycle has a link outside the forest, so that the cycles of the small graph of entered nodes (from one to
    another if a link leaves the subtree of the one and enters the other) stand for all cycles. It has at most a row
    for each such link and node above its source.
    """
    entered = f.links.select(F.col("to").alias("node")).distinct()
    return settle(strong_classes(settle(_leaving(f, entered).select(F.col("node").alias("parent"), F.col("to").alias("child")).distinct())))


def class_starts(classes: DataFrame) -> DataFrame:
    """node: one node of each class of ``entry_classes``."""
    return classes.filter("node = least").select("node")


def cycles(f: Forest, classes: DataFrame, reached: DataFrame) -> DataFrame:
    """node, least: each node that reaches itself, with the smallest node of its class of mutual reach.

    ``reached`` holds what each of ``class_starts`` reaches (and may hold more). Of that, a node is of the class if a
    link that leaves its subtree enters a node of the class.
    """
    starts = classes.select(F.col("least").alias("start")).distinct()
    back = classes.select(F.col("node").alias("to"), F.col("least").alias("class"))
    inside = reached.join(starts, "start", "left_semi").select("start", "node")
    members = _leaving(f, inside).join(back, "to").filter("start = class").select("start", "node").distinct()
    least = members.groupBy("start").agg(F.min("node").alias("least"))
    return members.join(least, "start").select("node", "least")


def rootless_starts(f: Forest, classes: DataFrame, on_cycles: DataFrame, reached: DataFrame) -> DataFrame:
    """node: the smallest node of each cycle that nothing outside it reaches; ``reached``: from the roots and class_starts."""
    tops = classes.filter("node = least").select("node")
    outside = reached.filter("start <> node").join(tops, "node", "left_semi").select("node").distinct()
    free = tops.join(outside, "node", "left_anti")
    return on_cycles.join(free, "node").select(F.col("least").alias("node")).distinct()
