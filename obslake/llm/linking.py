"""Connected components, and links between similar sets from banding, without all pairs of a group.

Nodes are distinct sets. Sets in one bucket of a band are candidates. They are not paired with
each other but with the bucket's first node, its pivot:

1. each node is checked against the pivot of its largest bucket, and linked nodes are joined;
2. in buckets that still hold several components, every node is checked against the pivot;
3. where non-pivot nodes of one pivot's buckets still lie in different components, they are compared by
   what they change in P, the items that most of them hold. With D = x xor P and
   w = 6 |x| + 7 |P| - 14 |x & P|, x and y are similar if and only if 14 |D_x & D_y| >= w_x + w_y, for
   any P. So pairs whose w add to 0 or less need not be sought: both are similar to the one of least w.
   Others share (w_x + w_y) / 14 changes, which a prefix filter over the rarest changes finds.
   Sets that share a change are first checked against the one of them of least w, which joins
   those with a common change; the pairs that pass the filter and still lie in different components are
   then verified.

Step 3 skips only pairs that are not similar, so no link between bucket mates is lost. Beyond work in
proportion to a group's members only pairs that stay apart, though they share one of their rarest
changes, are compared. P may be any set, as a poor one only leaves more of these; so it is told from a few
of the nodes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, Window

from obslake.llm.common import cut

TELLING = 9  # sets of a pivot that tell what most of them hold

def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (a, b: long): comp is the smallest node reachable.

    Each round maps a node to its smallest neighbour, halves these paths, and contracts the edges;
    every component at least halves, so rounds grow with the logarithm of its size.
    """
    e = cut(edges.select("a", "b").where("a <> b").distinct(), "edges")
    maps = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("up"))
        up = cut(up, "up")
        up = cut(up.join(up.select(F.col("v").alias("up"), F.col("up").alias("up2")), "up")
                 .select("v", F.col("up2").alias("up")), "up")
        maps.append(up)
        e = e.join(up.select(F.col("v").alias("a"), F.col("up").alias("ua")), "a") \
            .join(up.select(F.col("v").alias("b"), F.col("up").alias("ub")), "b") \
            .select(F.col("ua").alias("a"), F.col("ub").alias("b")).where("a <> b").distinct()
        e = cut(e, "edges")
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    labels = maps[0].select(F.col("v").alias("node"), F.col("up").alias("comp"))
    for m in maps[1:]:
        m = m.select(F.col("v").alias("comp"), F.col("up").alias("_up"))
        labels = labels.join(m, "comp", "left").select("node", F.coalesce("_up", "comp").alias("comp"))
    return labels


def labelled(d: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """d with the component c<column> of each of these columns of nodes."""
    for c in columns:
        d = d.join(labels.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")), c)
    return d


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (node, comp) with the components of these edges (a, b) joined."""
    between = labelled(edges, labels, "a", "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(between).select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
    return cut(labels.join(merged, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp")), "labels")


def _similar(common: Column, n: Column, m: Column) -> Column:
    """|x & y| of at least 3/4 of |x | y|, in integers: 7 |x & y| >= 3 (|x| + |y|)."""
    return 7 * common >= 3 * (n + m)


def _could(n: Column, m: Column) -> Column:
    """Whether two sets of these sizes could be similar."""
    return 4 * F.least(n, m) >= 3 * F.greatest(n, m)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (x, q, ...) with both sets."""
    return pairs.join(sets.select(F.col("node").alias("x"), F.col("items").alias("sx")), "x") \
        .join(sets.select(F.col("node").alias("q"), F.col("items").alias("sq")), "q")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges (a, b) of those pairs (x, q) whose full sets are similar."""
    d = _with_sets(pairs.select("x", "q"), sets)
    common = F.size(F.array_intersect("sx", "sq"))
    return d.where(_similar(common, F.size("sx"), F.size("sq"))).select(F.col("x").alias("a"), F.col("q").alias("b"))


def similar_components(nodes: DataFrame, load_sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, comp) for nodes (node, n, bands: array of keys) that are linked to another one.

    load_sets gets the nodes (node) that share a bucket and returns (node, items: distinct longs).
    """
    rows = nodes.select(F.explode("bands").alias("band"), "node", "n")
    # all in one shuffle by band; nodes alone in their bucket, most of them, are gone before pivots are sought
    bucket = Window.partitionBy("band")
    mates = rows.withColumn("size", F.count("*").over(bucket)).where("size > 1")
    members = cut(mates.withColumn("pivot", F.min(F.struct("node", "n")).over(bucket)).where("node <> pivot.node")
                  .select("band", F.col("node").alias("x"), "n", F.col("pivot.node").alias("q"),
                          F.col("pivot.n").alias("nq"), "size"), "members")
    near = members.where(_could(F.col("n"), F.col("nq")))
    seen = members.select(F.col("x").alias("node")).union(members.select("q")).distinct()
    sets = cut(load_sets(seen), "sets")

    first = near.groupBy("x").agg(F.max_by("q", F.struct("size", -F.col("q"))).alias("q"))
    labels = joined(sets.select("node", F.col("node").alias("comp")), cut(_verified(first, sets), "links"))
    again = labelled(near.select("x", "q").distinct(), labels, "x", "q").where("cx <> cq").select("x", "q")
    labels = joined(labels, cut(_verified(again, sets), "links"))

    # buckets whose nodes besides the pivot lie in several components
    told = labelled(members.where("size > 2"), labels, "x")
    split = told.groupBy("band").agg(F.min("cx").alias("lo"), F.max("cx").alias("hi")).where("lo <> hi").select("band")
    group = told.join(split, "band", "left_semi").select("x", "q").distinct()
    rel = cut(_changes(group, sets), "changes")
    for pairs_of in (_to_closest, _all_left):
        now = labelled(rel, labels, "x")
        open_ = now.groupBy("q").agg(F.min("cx").alias("lo"), F.max("cx").alias("hi")).where("lo <> hi").select("q")
        pairs = pairs_of(cut(now.join(open_, "q", "left_semi"), "open"))
        labels = joined(labels, cut(_verified(pairs, sets), "links"))
    return labels


def _changes(group: DataFrame, sets: DataFrame) -> DataFrame:
    """(q, x, n, w, d) for the sets x of pivot q: their sizes, weights and changes of what most have."""
    few = group.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.xxhash64("x"), "x"))) \
        .where(F.col("k") <= TELLING)
    items = sets.select(F.col("node").alias("x"), "items")
    most = few.join(items, "x").select("q", F.explode("items").alias("s")).groupBy("q", "s").agg(F.count("*").alias("df")) \
        .join(few.groupBy("q").agg(F.count("*").alias("many")), "q").where("2 * df > many").groupBy("q").agg(F.collect_list("s").alias("p"))
    d = group.join(items, "x").join(most, "q", "left").withColumn("p", F.coalesce("p", F.expr("array()").cast("array<long>")))
    d = d.select("q", "x", F.size("items").alias("n"), F.size("p").alias("np"),
                 F.array_except("items", "p").alias("more"), F.array_except("p", "items").alias("less"))
    common = F.col("n") - F.size("more")
    return d.select("q", "x", "n", (6 * F.col("n") + 7 * F.col("np") - 14 * common).alias("w"), F.concat("more", "less").alias("d"))


def _prefixes(rel: DataFrame) -> DataFrame:
    """Changes s by which a set may meet another: (q, s, x, cx, n, w, left). Changes that only one
    component has cannot count. `left` is how many of the set's changes, s included, come no sooner
    in the common order, rarest first; a change with fewer than the set must share is no prefix."""
    # the least weight of another component: the second least one for the component that has the least
    by_weight = Window.partitionBy("q").orderBy("least", "cx")
    least = rel.groupBy("q", "cx").agg(F.min("w").alias("least")) \
        .withColumn("next", F.lead("least").over(by_weight)).withColumn("k", F.row_number().over(by_weight)).where("k = 1") \
        .select("q", F.col("cx").alias("first"), "least", "next")
    other = F.when(F.col("cx") == F.col("first"), F.col("next")).otherwise(F.col("least"))
    items = rel.join(least, "q").withColumn("t", F.greatest(F.lit(1), F.ceil((F.col("w") + other) / 14))) \
        .where(F.size("d") >= F.col("t")).select("q", "x", "cx", "n", "w", "t", F.explode("d").alias("s"))
    of_change = Window.partitionBy("q", "s")
    useful = items.withColumns({"df": F.count("*").over(of_change), "several": F.min("cx").over(of_change) != F.max("cx").over(of_change)}) \
        .where("several")
    own = Window.partitionBy("q", "x")
    left = F.count("*").over(own) - F.row_number().over(own.orderBy("df", "s")) + 1
    return useful.withColumn("left", left).where("left >= t").drop("t", "df", "several")


def _meet(d: DataFrame) -> DataFrame:
    """Pairs of x and y_x that may be similar, given that s is the first change that both have:
    they then share min(left, y_left) changes at most."""
    d = d.where("cx <> y_cx").where(_could(F.col("n"), F.col("y_n"))).where(14 * F.least("left", "y_left") >= F.col("w") + F.col("y_w"))
    return d.select(F.greatest("x", "y_x").alias("x"), F.least("x", "y_x").alias("q")).distinct()


def _with_least(d: DataFrame, *by: str) -> DataFrame:
    """d with the set of least weight, y_x and its columns, of those that agree in these columns."""
    columns = [c for c in ("w", "x", "cx", "n", "left") if c in d.columns]
    least = d.groupBy(*by).agg(F.min(F.struct(*columns)).alias("y"))
    return d.join(least.select(*by, *(F.col(f"y.{c}").alias(f"y_{c}") for c in columns)), [*by])


def _to_closest(rel: DataFrame) -> DataFrame:
    """Sets that are similar to the one of least weight by weight alone; and of the sets that share a
    change, each with the one of least weight: one pair for a change. Sets that share a change are
    mostly joined by that, however many they are."""
    by_weight = _with_least(rel, "q").where("cx <> y_cx and w + y_w <= 0").select("x", F.col("y_x").alias("q"))
    return by_weight.unionByName(_meet(_with_least(cut(_prefixes(rel), "prefixes"), "q", "s"))).distinct()


def _all_left(rel: DataFrame) -> DataFrame:
    """All pairs that share enough changes, of the one of more weight with the other. They share 2 w / 14
    for the lesser weight, so the other one needs fewer of its rows."""
    prefix = cut(_prefixes(rel), "prefixes")
    other = prefix.where("7 * left >= w").select("q", "s", *(F.col(c).alias(f"y_{c}") for c in ("x", "cx", "n", "w", "left")))
    return _meet(prefix.join(other, ["q", "s"]).where("w > y_w or w = y_w and x > y_x"))
