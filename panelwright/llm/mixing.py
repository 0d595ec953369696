"""Mixing overlapping sources to target weights by a min-cost flow of words.

Documents that belong to the same sources form one pattern, so a corpus is a small graph: patterns supply their words,
sources have a target. Taking a pattern's words a first time costs nothing, a second time more and a third time more
again; costs are the same for all patterns and convex. So the cheapest flow comes in rounds: as much as can be routed with
one use of every pattern, rerouting where that makes room, then with two uses, and so on.

Sources that no document links have nothing to do with each other: each linked group of sources is routed
in a task of its own, and its patterns are all that is needed there.

Of the documents of a pattern all are taken as often as the flow uses the whole pattern; the rest of its words comes from
its documents in a seeded random order (by checksum), the last of which is cut. The cut is found by sums over slices of the
checksum, twice, then in the one slice left, so no task sorts a whole source.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.graph import components
from panelwright.operators.numbering import numbered
from panelwright.session import store

WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, total: int, most: int) -> DataFrame:
    """Adds ``target`` and ``quota`` (whole words) to sources (number, source_size, weight).

    The total is shared by weight; no target passes ``most`` times its source's size, and what is too much for one
    is shared again by the rest. Each round sends two sums to the driver.
    """
    wide = "decimal(38,0)"
    open_ = F.lit(True)
    while True:
        left, weight, n = sources.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(~open_, F.col("source_size") * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0)), F.count_if(open_)).first()
        share = F.col("weight").cast(wide) * F.lit(int(left)).cast("decimal(20,0)")
        fits = share <= F.col("source_size").cast(wide) * F.lit(most * int(weight)).cast("decimal(20,0)")
        now = open_ & fits
        if sources.where(now).count() == n:
            break
        open_ = now
    weight = max(int(weight), 1)
    return sources.withColumn("target", F.when(open_, share.cast("double") / F.lit(float(weight))).otherwise(
        (F.col("source_size") * most).cast("double"))).withColumn(
        "quota", F.when(open_, F.floor(share / F.lit(weight).cast("decimal(20,0)"))).otherwise(
            F.col("source_size") * most).cast("long"))


def route(words: list[int], members: list[list[int]], quota: dict[int, int], most: int) -> list[int]:
    """How many words of each pattern to take; patterns are lists of sources.

    Augmenting paths from patterns with unused words to sources that lack some, shortest first, with one more use
    of all patterns allowed in each round.
    """
    lack = dict(quota)
    used = [0] * len(words)
    sent: list[dict[int, int]] = [dict.fromkeys(m, 0) for m in members]
    users: dict[int, set[int]] = {s: set() for s in lack}
    for use in range(1, most + 1):
        while True:
            # Breadth first over patterns and sources.
            came: dict[tuple[str, int], tuple[str, int] | None] = {}
            queue: deque = deque()
            for p, size in enumerate(words):
                if used[p] < size * use and members[p]:
                    came["p", p] = None
                    queue.append(("p", p))
            end = None
            while queue and end is None:
                kind, at = node = queue.popleft()
                for other in members[at] if kind == "p" else users[at]:
                    step = ("s", other) if kind == "p" else ("p", other)
                    if step in came:
                        continue
                    came[step] = node
                    if kind == "p" and lack[other] > 0:
                        end = step
                        break
                    queue.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            first = path[0][1]
            amount = min(words[first] * use - used[first], lack[end[1]])
            for (_, source), (_, pattern) in zip(path[1::2], path[2::2]):
                amount = min(amount, sent[pattern][source])
            used[first] += amount
            lack[end[1]] -= amount
            for i in range(0, len(path) - 1, 2):
                pattern, source = path[i][1], path[i + 1][1]
                sent[pattern][source] += amount
                users[source].add(pattern)
                if i + 2 < len(path):
                    other = path[i + 2][1]
                    sent[other][source] -= amount
                    if not sent[other][source]:
                        users[source].discard(other)
    return used


def routed(patterns: DataFrame, most: int) -> DataFrame:
    """(pattern, take) from patterns (pattern, words, part, members with number and quota)."""

    def run(table: pa.Table) -> pa.Table:
        members = table["members"].to_pylist()
        quota = {m["number"]: m["quota"] for row in members for m in row}
        take = route(table["words"].to_pylist(), [[m["number"] for m in row] for row in members], quota, most)
        return pa.table({"pattern": table["pattern"], "take": pa.array(take, pa.int64())})

    return patterns.groupBy("part").applyInArrow(run, "pattern string, take long")


def boundary(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(pattern, cut, cut_words): documents with a checksum below ``cut`` are in the rest, those with it in part.

    ``rows`` has pattern, size, checksum; ``plan`` has pattern and rest, which is below the pattern's words.
    """
    below = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    at = plan.where("rest > 0").select("pattern", "rest", F.lit("").alias("prefix"))
    for place, length in ((1, 3), (4, 3), (7, 26)):
        own = rows.join(at, "pattern").where(F.substring("checksum", 1, place - 1) == F.col("prefix"))
        sums = own.groupBy("pattern", "rest", "prefix", F.substring("checksum", place, length).alias("slice")).agg(
            F.sum("size").alias("words"), F.count("*").alias("copies"))
        sums = sums.withColumn("before", F.coalesce(F.sum("words").over(below), F.lit(0)))
        hit = sums.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words")))
        at = store(hit.select("pattern", (F.col("rest") - F.col("before")).alias("rest"),
                              F.concat("prefix", "slice").alias("prefix"), "copies"), "cuts")
    return at.select("pattern", F.col("prefix").alias("cut"), F.floor(F.col("rest") / F.col("copies")).alias("cut_words"))


def mixture(docs: DataFrame, sources: Column, weight: Callable[[Column, Column], Column], most: int = 3,
            seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, sources, size, pattern, taken) and sources (source, number, source_size, weight, target, quota).

    ``docs`` has doc_id and text, ``sources`` gives the array of its sources' names, where null is a source like others;
    repeats in it count once. ``weight`` makes a whole number from a source's name and its number, from 1 by code point, null
    last. The mix has as many words as all documents; a source's share of it goes by weight, up to ``most`` times its own
    words. ``taken`` are the words the mix takes of a document, repeats counted: at most ``most`` times ``size``, words
    being ``[^\\x20\\x09-\\x0D]+``. A null, empty or blank text has none. Documents without a source aren't taken.
    Rows that agree in doc_id and text share the cut evenly. Other columns are ignored; an empty table gives no rows.
    """
    names = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number_ = F.col("doc_id").cast("long")
    sized = store(docs.select(
        number_.alias("doc_id"), names.alias("sources"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(number_.cast("string"), F.lit("")), F.lit("|"), text)).alias("checksum")
    ).withColumn("pattern", F.array_join(F.transform("sources", lambda s: F.when(s.isNull(), "-").otherwise(
        F.concat(F.length(s).cast("string"), F.lit(":"), s))), "")), "sized")
    patterns = store(sized.groupBy("pattern").agg(
        F.first("sources").alias("sources"), F.sum("size").alias("words")), "patterns")
    each = patterns.select("pattern", "words", F.explode("sources").alias("source"))
    listed = numbered(each.groupBy("source").agg(F.sum("words").alias("source_size")),
                      [F.col("source").isNull(), F.col("source")], "number")
    listed = store(listed.withColumn("weight", weight(F.col("source"), F.col("number")).cast("long")), "sources")
    total = patterns.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    listed = store(targets(listed, int(total), most), "targets")
    each = each.join(listed.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    graph = store(each.groupBy("pattern").agg(
        F.first("words").alias("words"), F.sort_array(F.collect_list(F.struct("number", "quota"))).alias("members")), "graph")
    first = F.col("members")[0]["number"]
    links = graph.where(F.size("members") > 1).select(
        first.alias("b"), F.explode(F.slice("members", 2, F.size("members") - 1)).alias("a")).select("a.number", "b")
    links = links.toDF("a", "b")
    graph = graph.withColumn("part", first)
    if not links.isEmpty():
        joined = components(links).withColumnRenamed("id", "part")
        graph = graph.join(joined, "part", "left").withColumn("part", F.coalesce("component", "part")).drop("component")
    plan = routed(graph, most).join(patterns.select("pattern", "words"), "pattern", "right")
    take = F.coalesce("take", F.lit(0))
    uses = F.when(F.col("words") > 0, F.floor(take / F.col("words"))).otherwise(F.lit(0))
    plan = store(plan.select("pattern", uses.alias("uses"), (take - uses * F.col("words")).alias("rest")), "plan")
    cuts = boundary(sized.select("pattern", "size", "checksum"), plan)
    plan = store(plan.join(cuts, "pattern", "left").drop("rest"), "uses")
    part = F.when(F.col("checksum") < F.col("cut"), F.col("size")).when(
        F.col("checksum") == F.col("cut"), F.col("cut_words")).otherwise(F.lit(0))
    taken = sized.join(plan, "pattern").withColumn("taken", (F.col("uses") * F.col("size") + part).cast("long"))
    return taken.select("doc_id", "sources", "size", "pattern", "taken"), listed


def by_source(docs: DataFrame, most: int = 3) -> DataFrame:
    """Mixes by the one source of every document, weighing 1, 2, 3, 1, ...: doc_id, size, source_size, target, taken."""
    taken, listed = mixture(docs, F.array(F.col("source").cast("string")), lambda _, n: 1 + (n - 1) % 3, most)
    listed = listed.select(F.col("source").alias("_source"), "source_size", "target")
    taken = taken.join(listed, F.col("sources")[0].eqNullSafe(F.col("_source")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')) as h from documents),
s as (select source, cast(sum(size) as bigint) as z from d group by source),
w as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w, 3 * z as cap from s),
o as (select *, row_number() over (order by cap::hugeint * 6 // w, cap, source nulls last) as i from w),
c as (select *, cast((select sum(z) from s) - coalesce(sum(cap) over (order by i rows between unbounded preceding and 1 preceding), 0) as hugeint) as rest,
             cast(sum(w) over (order by i rows between current row and unbounded following) as hugeint) as weight from o),
l as (select coalesce(min(i), 1 << 40) as first from c where w * rest <= cap::hugeint * weight),
u as (select source, z, case when i < first then cap::double else (w * (select rest from c where i = l.first))::double
               / (select weight from c where i = l.first)::double end as target,
             cast(case when i < first then cap else (w * (select rest from c where i = l.first))
               // (select weight from c where i = l.first) end as bigint) as quota from c, l),
m as (select doc_id, size, z as source_size, target, h, d.source, case when z > 0 then quota // z else 0 end as uses,
             case when z > 0 then quota % z else 0 end as rest
      from d join u on d.source is not distinct from u.source),
t as (select *, cast(sum(size) over (partition by source order by h) as bigint) as upto,
             cast(sum(size) over (partition by source, h) as bigint) as own, count(*) over (partition by source, h) as copies from m)
select doc_id, size, source_size, target,
  cast(uses * size + case when rest = 0 then 0 when upto <= rest then size when upto - own < rest then (rest - upto + own) // copies
       else 0 end as bigint) as taken from t"""
