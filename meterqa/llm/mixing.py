"""Mix sources to target weights by Pfair scheduling.

A source's documents form blocks. In a period of P slots a source of weight a/P has a blocks; block i may not start before
floor(i*P/a) and must be placed before ceil((i+1)*P/a). Earliest deadline first meets all these windows, so at any slot
a source is less than one block away from its share. The period depends on the weights alone, so it is scheduled once
and every document finds its slot from its number in its source. When a source has no blocks left, the others go on with
their weights, which gives another period from that slot on; nothing is dropped or repeated.

Any number of sources keep a weight each. Up to CHILDREN sources are scheduled together. More are put into buckets of about
half as many, by weight (a factor of two) and hash; a bucket is scheduled inside itself by one task and then stands for its
sources, with their weights and blocks added up, among the other buckets; so on, until CHILDREN are left. The deviation is
then less than one block of the source inside its bucket, and less than one block of a bucket inside the next. The share of a
source that has ended goes to the others of its bucket.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterqa.llm.base import numbered, ship_code, written

BLOCK = 16
#: Slots of a period, as far as the rounding of weights that are not whole goes.
PERIOD = 8192
#: Sources or buckets that are scheduled together; bounds what a task or the driver holds, not the number of sources.
CHILDREN = 128
#: Target weights are the sources' sizes to this power.
FLATTEN = 0.5
#: Hash parts in which the documents of a source are numbered.
PARTS = 1024

Phase = tuple[int, int, int, int, int, int, list[int]]


def quanta(weights: list[float], period: int = PERIOD) -> list[int]:
    """Whole weights, at least 1 each: the same where they are whole and at most ``period`` in all, else rounded to about that."""
    total = sum(weights)
    if total <= period and all(w >= 1 and w == int(w) for w in weights):
        return [int(w) for w in weights]
    return [max(1, round(period * (w / total))) for w in weights]


def pfair_period(weights: list[int], left: list[int] | None = None) -> list[list[int]]:
    """The slots of each source's blocks in one period of ``sum(weights)`` slots.

    With ``left`` blocks of each source the period ends early, with the slot that takes the last block of a source.
    """
    period = sum(weights)
    released: dict[int, list[int]] = {0: list(range(len(weights)))}
    placed: list[list[int]] = [[] for _ in weights]
    ready: list[tuple[int, int]] = []
    for slot in range(period):
        for source in released.pop(slot, ()):
            done, weight = len(placed[source]), weights[source]
            heapq.heappush(ready, (-(-(done + 1) * period // weight), source))
        _, source = heapq.heappop(ready)
        placed[source].append(slot)
        done, weight = len(placed[source]), weights[source]
        if left is not None and done == left[source]:
            break
        if done < weight:
            released.setdefault(max(done * period // weight, slot + 1), []).append(source)
    return placed


def phases(blocks: list[int], weights: list[int]) -> list[Phase]:
    """(source, first block, block after the last, first slot, period, weight, slots in the period).

    A phase lasts until a source has no blocks left. A source of weight 0 starts when all others have ended; several of these
    have equal weights then.
    """
    left, used, slot = list(blocks), [0] * len(blocks), 0
    rows: list[Phase] = []
    while active := [s for s, n in enumerate(left) if n > 0]:
        if weighty := [s for s in active if weights[s] > 0]:
            active = weighty
        shrink = math.gcd(*(weights[s] for s in active)) or 1
        share = [weights[s] // shrink or 1 for s in active]
        period, placed = sum(share), pfair_period(share, [left[s] for s in active])
        # The slot after each source's last block, and the first of these.
        last = [divmod(left[s] - 1, a) for s, a in zip(active, share, strict=True)]
        end = min(
            whole * period + p[rest] + 1 for (whole, rest), p in zip(last, placed, strict=True) if rest < len(p)
        )
        for s, a, p in zip(active, share, placed, strict=True):
            taken = end // period * a + sum(x < end % period for x in p)
            if taken:
                rows.append((s, used[s], used[s] + taken, slot, period, a, p))
            used[s] += taken
            left[s] -= taken
        slot += end
    return rows


PLANNED = "_child string, _first long, _after long, _slot0 long, _period long, _weight long, _slots array<int>"


def _planned(children: pd.DataFrame) -> pd.DataFrame:
    """The phases of one bucket's children."""
    ordered = children.sort_values(["_rows", "_child"], ascending=[False, True])
    weights = ordered["_w"].tolist()
    heavy = [w for w in weights if w > 0]
    whole = iter(quanta(heavy))
    share = [next(whole) if w > 0 else 0 for w in weights]
    names = ordered["_child"].tolist()
    plan = phases([int(n) for n in ordered["_blocks"]], share)
    columns = [c.split()[0] for c in PLANNED.split(", ")]
    return pd.DataFrame([(names[s], *row) for s, *row in plan], columns=columns)


def _bucketed(children: DataFrame, level: int) -> DataFrame:
    """Add _node: one for all of up to CHILDREN rows, else buckets of about half as many of similar weight."""
    # The binary exponent of a weight: some 2 100 at most. Weights of 0 have none and stay apart.
    rated = children.withColumn("_cell", F.floor(F.log2("_w")).cast("int"))
    cells = sorted((r["_cell"], r["count"]) for r in rated.groupBy("_cell").count().collect() if r["_cell"] is not None)
    zeros = children.where("_w = 0").count()
    if sum(n for _, n in cells) + zeros <= CHILDREN:
        return children.withColumn("_node", F.lit(f"{level}"))
    half = CHILDREN // 2
    lowest = cells[-(half - 1) :][0][0] if cells else 0
    at_least: dict[int | None, int] = {None: zeros}
    for cell, n in cells:
        at_least[max(cell, lowest)] = at_least.get(max(cell, lowest), 0) + n
    parts = children.sparkSession.createDataFrame(
        [(c, -(-n // half)) for c, n in at_least.items() if n], "_cell int, _parts long"
    )
    cell = F.when(F.col("_cell").isNotNull(), F.greatest("_cell", F.lit(lowest)))
    part = F.pmod(F.xxhash64("_child", F.lit(level)), F.col("_parts"))
    # At most half of CHILDREN rows of parts.
    joined = rated.withColumn("_cell", cell).alias("c").join(
        F.broadcast(parts).alias("p"), F.col("c._cell").eqNullSafe(F.col("p._cell"))
    )
    node = F.concat_ws("/", F.lit(level), F.coalesce(F.col("c._cell").cast("string"), F.lit("zero")), part)
    return joined.select("_child", "_rows", "_blocks", "_w", node.alias("_node"))


def schedules(sources: DataFrame) -> list[DataFrame]:
    """Per level: _child, _node, _phases, until one node is left. ``sources`` has _child, _rows, _blocks, _w."""
    ship_code(sources.sparkSession)
    found, children = [], sources
    while True:
        level = len(found)
        dealt = written(_bucketed(children, level))
        flat = dealt.groupBy("_node").applyInPandas(_planned, PLANNED)
        phase = F.struct("_first", "_after", "_slot0", "_period", "_weight", "_slots")
        plan = flat.groupBy("_child").agg(F.collect_list(phase).alias("_phases"))
        found.append(written(plan.join(dealt.select("_child", "_node"), "_child")))
        nodes = dealt.groupBy(F.col("_node").alias("_child")).agg(
            F.sum("_rows").alias("_rows"), F.sum("_blocks").alias("_blocks"), F.sum("_w").alias("_w")
        )
        children = written(nodes)
        if children.count() <= 1:
            return found


def _slot_in_node(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Replace _child by its node and _slot by the slot in that node."""
    number = F.col("_slot")
    inside = F.filter("_phases", lambda p: (number >= p["_first"]) & (number < p["_after"]))
    met = rows.join(plan, "_child").withColumn("_phase", F.get(inside, F.lit(0)))
    phase = F.col("_phase")
    ahead = number - phase["_first"]
    slot = (
        phase["_slot0"]
        + F.floor(ahead / phase["_weight"]) * phase["_period"]
        + F.get(phase["_slots"], F.pmod(ahead, phase["_weight"]).cast("int"))
    )
    return met.withColumn("_slot", slot).withColumn("_child", F.col("_node")).drop("_phases", "_phase", "_node")


def placed(
    docs: DataFrame,
    source: Column,
    key: list[str],
    weights: dict[str | None, float] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Add _block, _slot and _place to ``docs``: the order of the mix is the order of _place.

    ``weights`` gives weights by source, 1 where one is missing; without it they follow the sources' sizes. Weights
    may be fractions; those scheduled together keep their ratios exactly if they are whole and at most PERIOD in all, else
    they are rounded to shares of PERIOD, of which each has at least one. A source of weight 0 comes after all others; a weight
    below 0, or none that is finite, is an error. ``key`` columns decide the order within a source. A null source is a
    source like others. An empty table stays empty.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))
    named = docs.withColumn("_child", name)
    sizes = named.groupBy("_child").agg(F.count("*").alias("_rows"))
    if weights is None:
        weighed = sizes.withColumn("_w", F.pow(F.col("_rows"), F.lit(FLATTEN)))
    else:
        if bad := {s: w for s, w in weights.items() if not (math.isfinite(w) and w >= 0)}:
            raise ValueError(f"weights must be finite and 0 or more: {bad}")
        given = spark.createDataFrame(
            [("" if s is None else f"={s}", float(w)) for s, w in weights.items()], "_child string, _w double"
        )
        weighed = sizes.join(given, "_child", "left").fillna(1.0, ["_w"])
    sources = weighed.withColumn("_blocks", F.ceil(F.col("_rows") / block)).select("_child", "_rows", "_blocks", "_w")
    rows = numbered(named, ["_child"], PARTS, [F.col(c) for c in key], "_number")
    rows = rows.withColumn("_block", F.floor(F.col("_number") / block)).withColumn("_slot", F.col("_block"))
    for plan in schedules(written(sources)):
        rows = _slot_in_node(rows, plan)
    return rows.select(
        *docs.columns,
        "_block",
        "_slot",
        (F.col("_slot") * block + F.pmod(F.col("_number"), F.lit(block))).alias("_place"),
    )


def mix_order(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, source, block (within the source), slot (in the mix), place (order of the mix).

    Repeated rows are separate documents; a null id is an id like others.
    """
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("source").alias("_of_source"))
    return placed(rows, F.col("_of_source"), ["_id"], weights, block).select(
        F.col("_id").alias("doc_id"),
        F.col("_of_source").alias("source"),
        F.col("_block").alias("block"),
        F.col("_slot").alias("slot"),
        F.col("_place").alias("place"),
    )


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, block: int = BLOCK) -> DataFrame:
    """All documents in their own columns, dealt to files and sorted by their place in the mix."""
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("source").alias("_of_source")
    )
    ordered = placed(rows, F.col("_of_source"), ["_id"], weights, block).select("_row", "_place")
    dealt = ordered.repartitionByRange("_place").sortWithinPartitions("_place")
    return dealt.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
