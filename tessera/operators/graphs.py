"""Graph operators: components, ids, tree reachability and leak-proof allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import position
from ..sources.storage import Tables, cut
from .windows import first_per

#: Partitions in the order in which fractions accumulate, and in which minimums are filled.
FRACTION_ORDER = ("train", "validation", "development", "system_test")
MINIMUM_ORDER = ("system_test", "development", "validation", "train")


class AllocationError(ValueError):
    """An allocation that can't meet its minimums."""


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """(node, component): the least node reachable. Stars are contracted in alternating directions; rounds grow with the logarithm of the diameter,
    and each deletes what it supersedes."""
    tables = Tables(nodes.sparkSession)
    e = tables.saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    last = None
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = tables.saved(e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        tables.drop(keep=1)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last or not now[0]:
            break
        last = now
    return nodes.select(F.col(node).alias("node")).distinct().join(e.select(F.col("u").alias("node"), F.col("v").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("component"))


#: Members up to which a component's id is one digest.
ONE_DIGEST = 50_000


def component_ids(members: DataFrame, component: str = "component", node: str = "node", most: int = ONE_DIGEST) -> DataFrame:
    """(component, cid): 16 hex digits of a digest over the sorted members, so an id depends on membership alone.

    A component of more than `most` members is digested in 4096 slices of its members by their own digests, then over the slices' digests in
    order, so no row holds all of a large one.
    """
    text = F.col(node).cast("string")
    sizes = members.groupBy(component).agg(F.count("*").alias("_n"))
    large = F.col("_n") > most
    parts = members.join(sizes, component).withColumn("_slice", F.when(large, F.substring(F.sha2(text, 256), 1, 3)).otherwise(F.lit("")))
    digest = lambda lines: F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256)
    parts = parts.groupBy(component, "_slice").agg(digest(text).alias("_digest"))
    whole = F.max(F.when(F.col("_slice") == "", F.col("_digest")))
    return parts.groupBy(component).agg(F.substring(F.coalesce(whole, digest(F.concat_ws(":", "_slice", "_digest"))), 1, 16).alias("cid"))


def ordered_digest(rows: DataFrame, group: str, order: str, line: Column, width: int = 10_000) -> DataFrame:
    """(group, digest) over the lines of a group in the order of a number: lines of `width` consecutive numbers have a digest, and those digests
    in order make the group's, so no row holds a whole group."""
    joined = lambda at, text: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, text.alias("line")))), lambda x: x["line"]), "\n"), 256)
    slices = rows.groupBy(group, F.floor(F.col(order) / width).alias("slice")).agg(joined(F.col(order), line).alias("digest"))
    return slices.groupBy(group).agg(joined(F.col("slice"), F.concat_ws(":", F.col("slice").cast("string"), F.col("digest"))).alias("digest"))


def reachable(edges: DataFrame, roots: DataFrame, parent: str = "parent", child: str = "child", most_depth: int = 64) -> DataFrame:
    """(root, node, depth) of a forest; a node met twice under one root is a cycle and refused."""
    found = roots.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth"))
    front = found
    steps = edges.select(F.col(parent).alias("node"), F.col(child).alias("next"))
    for depth in range(1, most_depth + 1):
        front = cut(front.join(steps, "node").select("root", F.col("next").alias("node"), F.lit(depth).alias("depth")))
        if not front.take(1):
            return found
        if front.join(found, ["root", "node"], "left_semi").take(1):
            raise ValueError("the tree has a cycle")
        found = cut(found.unionByName(front))
    raise ValueError("the tree is deeper than allowed")


def by_fraction(place: Column, fractions: dict[str, float]) -> Column:
    """The first partition whose cumulative edge lies above the place; the last nonzero one catches rounding."""
    upto, out, last = 0.0, None, None
    for name in FRACTION_ORDER:
        share = fractions.get(name, 0.0)
        if share <= 0:
            continue
        upto, last = upto + share, name
        out = F.when(place < upto, name) if out is None else out.when(place < upto, name)
    return out.otherwise(last)


def check_fractions(fractions: dict[str, float]) -> None:
    if set(fractions) - set(FRACTION_ORDER) or any(v < 0 for v in fractions.values()) or abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("fractions must name partitions, be 0 or more and sum to 1")


def check_minimums(minimums: dict[str, int]) -> None:
    if set(minimums) - set(MINIMUM_ORDER) or any(isinstance(n, bool) or not isinstance(n, int) or n < 0 for n in minimums.values()):
        raise ValueError("minimums must name partitions and be whole numbers of 0 or more")


def allocate(components: DataFrame, seed, fractions: dict[str, float], minimums: dict[str, int] | None = None, stratum: str = "stratum", holdout: str = "holdout") -> DataFrame:
    """(cid, stratum, partition): a component's declared partition (`holdout`) first, then minimums of each stratum in hash order, then fractions.

    `components` has one row a component: cid, stratum, holdout (a partition or null). Held components count towards their stratum's minimums;
    strata too small for the rest are refused, each with what it lacks. Only as many components a stratum as the minimums take are ranked; the
    others go by their own place in the hash order.
    """
    check_fractions(fractions)
    minimums = minimums or {}
    check_minimums(minimums)
    placed = components.withColumn("place", position(seed, F.col("cid")))
    held = placed.where(F.col(holdout).isNotNull()).select("cid", stratum, F.col(holdout).alias("partition"))
    free = placed.where(F.col(holdout).isNull()).select("cid", stratum, "place")
    rest = by_fraction(F.col("place"), fractions)
    most = sum(minimums.values())
    if not most:
        return held.unionByName(free.select("cid", stratum, rest.alias("partition")))
    # strata are few: what each still needs of every partition, after its held components
    have = held.groupBy(F.col(stratum).alias("s")).agg(*(F.count_if(F.col("partition") == p).alias(f"held_{p}") for p in MINIMUM_ORDER))
    needs = free.groupBy(stratum).agg(F.count("*").alias("n")).join(have, F.col(stratum).eqNullSafe(F.col("s")), "left")
    need = {p: F.greatest(F.lit(minimums.get(p, 0)) - F.coalesce(f"held_{p}", F.lit(0)), F.lit(0)) for p in MINIMUM_ORDER}
    upto, edges = F.lit(0).cast("long"), []
    for p in MINIMUM_ORDER:
        upto = upto + need[p]
        edges.append(upto.alias(f"upto_{p}"))
    needs = cut(needs.select(F.col(stratum).alias("s"), "n", *edges))
    last = f"upto_{MINIMUM_ORDER[-1]}"
    if short := sorted((str(r["s"]), r[last] - r["n"]) for r in needs.where(F.col(last) > F.col("n")).collect()):
        raise AllocationError("too few components: " + ", ".join(f"{s} lacks {n}" for s, n in short), dict(short))
    top = first_per(free, [stratum], [F.col("place"), F.col("cid")], k=most, rank="rank")
    top = top.join(needs, F.col(stratum).eqNullSafe(F.col("s")))
    filled = F.coalesce(*(F.when(F.col("rank") <= F.col(f"upto_{p}"), p) for p in MINIMUM_ORDER))
    top = top.select(F.col("cid"), filled.alias("filled")).where("filled is not null")
    return held.unionByName(free.join(top, "cid", "left").select("cid", stratum, F.coalesce("filled", rest).alias("partition")))


def declaration_conflicts(nodes: DataFrame, facts: list[str], node: str = "node") -> DataFrame:
    """(node, fact): nodes declared more than once with different facts; a null beside a value is no conflict, it inherits."""
    found = nodes.groupBy(node).agg(*(F.countDistinct(f).alias(f) for f in facts))
    return found.select(node, F.explode(F.array_compact(F.array(*(F.when(F.col(f) > 1, F.lit(f)) for f in facts)))).alias("fact"))


def single_valued(members: DataFrame, component: str, value: str) -> DataFrame:
    """Components whose members disagree on a fact that must be one (nulls don't count)."""
    return members.groupBy(component).agg(F.countDistinct(value).alias("n")).where("n > 1")


def descendants(edges: DataFrame, nodes: DataFrame, facts: list[str], parent: str = "parent", child: str = "child") -> DataFrame:
    """Every node with its root's facts."""
    roots = nodes.join(edges.select(F.col(child).alias("node")), "node", "left_anti").select(F.col("node").alias("root"))
    tree = reachable(edges, roots, parent, child)
    return tree.join(nodes.select(F.col("node").alias("root"), *facts), "root")
