"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed pseudo-random order, form blocks of
``BLOCK_ROWS``. With target weight ``w`` (the weights add up to one) block
``j = 0, 1, ...`` of a source may be placed from slot ``floor(j / w)`` on and
is due before slot ``ceil((j + 1) / w)``. In every slot the released block
with the earliest deadline goes next.

A schedule is worked out in periods of ``D`` slots, side by side. With ``W``
the weights added up in a fixed order, a source has got
``floor(W_s * t) - floor(W_(s-1) * t)`` blocks by the end ``t`` of a period.
These counts add up to ``t``, are less than one block away from ``w * t`` for
any ``t``, and never fall from one period to the next, as a period is at least
as long as the rarest source's ``1 / w``. So at the end of every period each
source is less than one block away from its exact target share, however long
the corpus. Inside a period the blocks between two ends are placed by the
windows above. At the start of a period more blocks can be due at once than
there are slots; then some are late, and a source can be more than one block
away for a while: never more than 1.4 blocks, and in one period of a hundred
at all, over the random weights of the tests (which hold it below two).

When a source runs out, a new phase starts there with the others' weights
scaled up; no document is dropped. There are at most as many phases as
scheduled sources; the driver only finds where they end. Of more than
``MAX_SOURCES`` sources those of the least weight are scheduled as one, with
their weights added up. Its documents are put in order by Spark: the ``k``-th
document of a source comes at ``(k + 1/2) / w``, which mixes them to their
weights too.

Spark numbers the documents of each source (a source may hold most rows: its
rows are spread over range partitions), works out the periods side by side,
each from its number alone, and joins blocks and slots, which both grow with
the documents.

Defined cases: a null source is a source of its own (''); rows that share id
and source take one place together; sources without a weight get weight from
their size (its square root, as all sources do by default); a weight that is
not positive is an error; an empty table gives an empty result; extra columns
are kept (``mix_slot`` and ``mix_offset`` replace columns of that name).
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm.common import map_texts, stage
from cdclake.operators.numbering import sequence_number

BLOCK_ROWS = 16
PERIOD = 1000
#: Sources that are scheduled each for itself, whose counts and phases are kept on the driver; the others share one schedule.
MAX_SOURCES = 1000
#: The others' name (no text of a source begins like this: SQL text holds no such character).
OTHERS = "\x00others"
#: Weights as whole numbers that add up to this.
WHOLE = 1 << 62


def cumulated(weights: Mapping[str, float]) -> list[tuple[str, int, int]]:
    """``source, from, to``: where each source's share begins and ends on a line of length ``WHOLE``, rarest first."""
    total, at, edge, out = sum(weights.values()), 0.0, 0, []
    order = sorted(weights, key=lambda s: (weights[s], s))
    for s in order:
        at += weights[s]
        end = WHOLE if s == order[-1] else max(edge + 1, min(WHOLE - len(order), int(at / total * WHOLE)))
        out.append((s, edge, end))
        edge = end
    return out


def quotas(shares: list[tuple[str, int, int]], slots: int) -> dict[str, int]:
    """Blocks of every source in the first ``slots`` slots: they add up to ``slots``, each less than one from its share."""
    return {s: b * slots // WHOLE - a * slots // WHOLE for s, a, b in shares}


def earliest_deadline_first(shares: list[tuple[str, int, int]], start: int, size: int) -> tuple[dict[str, int], dict[str, list[int]]]:
    """Blocks of every source before slot ``start``, and the slots (from 0) in the period after it of the sources that have any."""
    before, after = quotas(shares, start), quotas(shares, start + size)
    weight = {s: b - a for s, a, b in shares}
    slots: dict[str, list[int]] = {s: [] for s in before if after[s] > before[s]}
    release = lambda s, j: j * WHOLE // weight[s] - start
    deadline = lambda s, j: -(-(j + 1) * WHOLE // weight[s]) - start
    waiting = [(release(s, before[s]), s) for s in slots]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []  # by deadline
    for t in range(size):
        # no slot stays empty: the next to be released comes early rather
        while waiting and (waiting[0][0] <= t or not ready):
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, before[s] + len(slots[s])), s))
        _, s = heapq.heappop(ready)
        slots[s].append(t)
        if (j := before[s] + len(slots[s])) < after[s]:
            heapq.heappush(waiting, (release(s, j), s))
    return before, slots


def outline(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> list[dict]:
    """``base, size, end, done, shares`` of every phase: its first slot, slots a period, slots, blocks before it, shares."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, base, out = dict.fromkeys(left, 0), 0, []
    while left:
        total = sum(weights[s] for s in left)
        rarest = min(weights[s] for s in left)
        # long enough for the rarest source; no longer than all blocks that are left, which are one period then
        size = min(max(period, math.ceil(total / rarest)), sum(left.values()) + 1)
        shares = cumulated({s: weights[s] for s in left})
        # the last period: the first at whose end a source would have more blocks than are left
        low, high = 0, 1 + int(min((n + 3) * total / weights[s] / size for s, n in left.items()))
        while low < high:
            k = (low + high) // 2
            got = quotas(shares, (k + 1) * size)
            low, high = (low, k) if any(got[s] > n for s, n in left.items()) else (k + 1, high)
        before, slots = earliest_deadline_first(shares, low * size, size)
        # the first slot that asks for a block a source no longer has
        end = low * size + min(x[left[s] - before[s]] for s, x in slots.items() if before[s] + len(x) > left[s])
        out.append({"base": base, "size": size, "end": end, "done": dict(done), "shares": shares})
        for s in list(left):
            used = before[s] + sum(low * size + x < end for x in slots.get(s, ()))
            done[s] += used
            left[s] -= used
            if not left[s]:
                del left[s]
        base += end
    return out


def period_rows(phase: Mapping, k: int) -> Iterator[dict]:
    """Rows ``source, first, last, base, weight, period, slots`` of period ``k`` of a phase."""
    start = k * phase["size"]
    before, slots = earliest_deadline_first(phase["shares"], start, phase["size"])
    for s, x in slots.items():
        if used := sum(start + t < phase["end"] for t in x):
            first = phase["done"][s] + before[s]
            yield {
                "source": s, "first": first, "last": first + used, "base": phase["base"] + start,
                "weight": len(x), "period": phase["size"], "slots": x,
            }


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> list[dict]:
    """The rows of all periods: the blocks ``first`` to ``last`` of a source and their slots from ``base`` on."""
    return [r for p in outline(blocks, weights, period) for k in range(-(-p["end"] // p["size"])) for r in period_rows(p, k)]


def _slots(spark: SparkSession, plan: list[dict]) -> DataFrame:
    """``_source, _block, mix_slot`` of every block. Each period is worked out where its number lies."""
    ends = list(accumulate(-(-p["end"] // p["size"]) for p in plan))  # periods up to the end of each phase
    total = ends[-1] if ends else 0
    parts = max(1, min(total, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def make():
        def work(numbers):
            out: dict[str, list] = {"_source": [], "_block": [], "mix_slot": []}
            for i in numbers:
                at = bisect_right(ends, i)
                for r in period_rows(plan[at], i - (ends[at - 1] if at else 0)):
                    n = r["last"] - r["first"]
                    out["_source"] += [r["source"]] * n
                    out["_block"] += range(r["first"], r["last"])
                    out["mix_slot"] += [r["base"] + t for t in r["slots"][:n]]
            return out

        return work

    return map_texts(spark.range(0, total, 1, parts), make, "_source string, _block bigint, mix_slot bigint", "id")


def _keys(id_col: str, source_col: str):
    text = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    return text(id_col, "_id"), text(source_col, "_source")


def _places(docs: DataFrame, id_col: str, source_col: str, weights: Mapping[str, float] | None, block_rows: int) -> DataFrame:
    """``_id, _source, mix_slot, mix_offset`` of every distinct id and source."""
    spark = docs.sparkSession
    keys = docs.select(*_keys(id_col, source_col)).distinct()
    numbered = sequence_number(keys.withColumn("_h", F.xxhash64("_id", F.lit(11))), ["_h", "_id"], ["_source"], out="_n")
    numbered = stage(numbered.withColumn("_n", F.col("_n") - 1), "numbered")
    given = dict(weights or {})
    if any(not w > 0 for w in given.values()):
        raise ValueError("weights must be positive")
    target = F.sqrt("n")
    if given:
        known = spark.createDataFrame([(s, float(w)) for s, w in given.items()], "_source string, given double")
    sizes = numbered.groupBy("_source").agg(F.count("*").alias("n"))
    if given:
        sizes, target = sizes.join(F.broadcast(known), "_source", "left"), F.coalesce("given", target)
    # one row a source, however many there are
    sizes = stage(sizes.select("_source", "n", target.alias("w")), "sources")
    first = sizes.orderBy(F.desc("w"), "_source").limit(MAX_SOURCES + 1).collect()
    if len(first) > MAX_SOURCES:
        first = first[: MAX_SOURCES - 1]
        own = spark.createDataFrame([(r._source,) for r in first], "_source string")  # at most MAX_SOURCES names
        rest = stage(sizes.join(F.broadcast(own), "_source", "left_anti"), "other-sources")
        n, w = rest.agg(F.sum("n"), F.sum("w")).first()
        others = numbered.join(rest.select("_source", "w"), "_source").withColumn("_at", (F.col("_n") + 0.5) / F.col("w"))
        others = sequence_number(others.select("_id", "_source", "_at"), ["_at", "_source", "_id"], out="_n")
        others = stage(others.select("_id", "_source", (F.col("_n") - 1).alias("_n"), F.lit(OTHERS).alias("_scheduled")), "others")
        numbered = numbered.join(F.broadcast(own), "_source", "left_semi").select("_id", "_source", "_n", F.col("_source").alias("_scheduled"))
        numbered = numbered.unionByName(others)
        counts, aims = {r._source: r.n for r in first} | {OTHERS: n}, {r._source: r.w for r in first} | {OTHERS: w}
    else:
        numbered = numbered.withColumn("_scheduled", F.col("_source"))
        counts, aims = {r._source: r.n for r in first}, {r._source: r.w for r in first}
    plan = outline({s: -(-n // block_rows) for s, n in counts.items()}, aims)
    block = F.floor(F.col("_n") / block_rows).cast("bigint")
    slots = _slots(spark, plan).withColumnRenamed("_source", "_scheduled")
    found = numbered.withColumn("_block", block).join(slots.hint("merge"), ["_scheduled", "_block"])
    return found.select("_id", "_source", "mix_slot", (F.col("_n") % block_rows).cast("int").alias("mix_offset"))


def _placed(docs: DataFrame, weights: Mapping[str, float] | None, id_col: str, source_col: str, block_rows: int) -> DataFrame:
    """``doc`` (the row), ``mix_slot``, ``mix_offset``."""
    places = stage(_places(docs, id_col, source_col, weights, block_rows), "places")
    # the places grow with the documents, so they are never broadcast
    return docs.select(F.struct("*").alias("doc"), *_keys(id_col, source_col)).join(places.hint("merge"), ["_id", "_source"])


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs`` with ``mix_slot`` (of the document's block) and ``mix_offset`` (inside the block): the mixing order."""
    placed = _placed(docs.drop("mix_slot", "mix_offset"), weights, id_col, source_col, block_rows)
    return placed.select("doc.*", "mix_slot", "mix_offset")


def in_order(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs`` sorted into the mixing order over all partitions, so written files follow the mix."""
    placed = _placed(docs, weights, id_col, source_col, block_rows)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["mix_slot", "mix_offset"]
    return placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc.*")
