"""Mixing sources to target weights: Pfair windows for blocks of each source, scheduled earliest deadline first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import partial, reduce
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.common import materialise, ship

BLOCK = 16
_ROWS = 50_000  # of the schedule, in a batch


def _checked(weights: Mapping[str | None, float]) -> None:
    if any(not 0 < w < float("inf") for w in weights.values()):
        raise ValueError("every source needs a finite weight above zero")


def whole_weights(weights: Mapping[str | None, float], parts: int) -> dict[str | None, int]:
    """Shares of `parts` for each source by largest remainders, but one at least."""
    _checked(weights)
    if len(weights) > parts:
        raise ValueError(f"{len(weights)} sources need as many parts at least, not {parts}")
    total = sum(weights.values())
    exact = {s: w / total * parts for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    while (left := parts - sum(shares.values())) > 0:
        for s in sorted(exact, key=lambda s: (shares[s] - exact[s], s is not None, s))[:left]:
            shares[s] += 1
    while sum(shares.values()) > parts:  # taken where most is over
        shares[max((s for s in shares if shares[s] > 1), key=lambda s: shares[s] - exact[s])] -= 1
    return shares


def _integers(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the given proportions."""
    exact = [Fraction(w) for w in weights]
    scale = lcm(*(x.denominator for x in exact))
    return [int(x * scale) for x in exact]


def slots(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot, for sources 0, 1, … with whole `weights` and `blocks` above zero.

    Sources with blocks left take part in a phase, with weights w scaled to add up to one. Block j (from 0) of a source in
    the phase is released at its slot floor(j / w) and due at ceil((j + 1) / w); each slot goes to the released block that is
    due first. As the weights add up to one, no block misses its deadline: before and after every slot of the phase, each
    source has had less than one block more or less than its weight times the slots so far. The phase ends when a source
    has no block left.

    Weights are used as they are, in whole-number arithmetic. Sources that have had no block in a phase are due in order
    of their weights, whatever the phase, so a new phase costs nothing for them; a slot costs a few heap operations.
    """
    order = sorted(range(len(weights)), key=lambda s: (-weights[s], s))
    had = [0] * len(weights)
    total = sum(weights)
    while order:
        taken: dict[int, int] = {}  # blocks of sources that have had any in this phase
        waiting: list[tuple[int, int]] = []  # (release, source)
        ready: list[tuple[int, int]] = []  # (deadline, source)
        fresh, slot, ended = 0, 0, None
        while ended is None:
            while waiting and waiting[0][0] <= slot:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-((taken[s] + 1) * total // -weights[s]), s))
            if fresh < len(order) and (not ready or (-(total // -weights[order[fresh]]), order[fresh]) < ready[0]):
                s, fresh = order[fresh], fresh + 1
            else:
                s = heapq.heappop(ready)[1]
            yield s, had[s]
            had[s] += 1
            slot += 1
            j = taken[s] = taken.get(s, 0) + 1
            heapq.heappush(waiting, (j * total // weights[s], s))
            if had[s] == blocks[s]:
                ended = s
        order.remove(ended)
        total -= weights[ended]


def period(shares: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """Slots of each source in one period of sum(shares) slots; after it every source stands at zero again."""
    names = sorted(shares, key=lambda s: (s is not None, s))
    out: dict[str | None, list[int]] = {s: [] for s in names}
    forever = [shares[s] + 1 for s in names]
    for slot, (n, _) in enumerate(islice(slots([shares[s] for s in names], forever), sum(shares.values()))):
        out[names[n]].append(slot)
    return out


def _schedule(stream: Iterator[pa.RecordBatch], names: list, weights: list[int], blocks: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        if not batch.num_rows:
            continue
        rows, at = slots(weights, blocks), 0
        while some := list(islice(rows, _ROWS)):
            sources, numbers = zip(*some, strict=True)
            of = pa.array([names[s] for s in sources], pa.string())
            yield pa.record_batch([of, pa.array(numbers, pa.int64()), pa.array(range(at, at + len(some)), pa.int64())], names=["of", "its_block", "slot"])
            at += len(some)


def _numbered(rows: DataFrame, source: Column, order: list[str], per_bucket: int) -> DataFrame:
    """Rows with their place in their source, from 0, in a random but fixed order.

    Rows are spread over buckets of about `per_bucket` by a hash of `order`; the number of rows in the buckets before
    comes from their counts, so no task sorts a whole source.
    """
    stored = materialise(rows.withColumns({"source_key": source, "_spread": F.xxhash64(*order)}), "mix")
    buckets = stored.count() // per_bucket + 1
    stored = stored.withColumn("_bucket", F.pmod("_spread", F.lit(buckets)))
    sizes = stored.groupBy("source_key", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source_key").orderBy("_bucket")) - F.col("_n")
    offsets = sizes.select(F.col("source_key").alias("_s"), F.col("_bucket").alias("_b"), before.alias("_before"))
    joined = stored.join(offsets, stored["source_key"].eqNullSafe(offsets["_s"]) & (stored["_bucket"] == offsets["_b"]))
    within = F.row_number().over(Window.partitionBy("source_key", "_bucket").orderBy("_spread", *order))
    return joined.withColumn("nth", F.col("_before") + within - 1).drop("_spread", "_bucket", "_s", "_b", "_before")


def interleave(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block: int = BLOCK,
    parts: int | None = None,
    temperature: float = 0.5,
    per_bucket: int = 50_000,
) -> DataFrame:
    """(doc_id, source, text_hash, block, slot, place): where each row of `docs` stands in the mix.

    Blocks of `block` rows of one source are interleaved to the target `weights`; before and after each slot every
    source is less than one block from its weight. Sorting by (slot, place) gives the mix. Without `weights`, a source
    counts by its number of rows to the power `temperature`. When a source ends, the others go on with their weights
    scaled up, so every row is in the mix once and none is repeated. Any number of sources will do; one without a weight is
    an error. The schedule, a row for each block, is written by one task that keeps a few numbers for each source. `parts`
    has no effect: weights are not rounded.

    Null is a source like others. Null ids and repeated rows are rows each; rows equal in id, source and text share
    their places in either order. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    )
    numbered = _numbered(rows, F.col("source"), ["doc_id", "source", "text_hash"], per_bucket).drop("source_key")
    return _placed(numbered, weights, block, temperature)


def _placed(numbered: DataFrame, weights: Mapping | None, block: int, temperature: float) -> DataFrame:
    spark = numbered.sparkSession
    ship(spark)
    numbered = materialise(numbered, "numbered")
    sizes = numbered.groupBy("source").agg(F.count("*").alias("n")).collect()
    sizes = {r["source"]: r["n"] for r in sorted(sizes, key=lambda r: (r["source"] is not None, r["source"]))}
    weights = {s: n**temperature for s, n in sizes.items()} if weights is None else dict(weights)
    if missing := [s for s in sizes if s not in weights]:
        raise ValueError(f"sources without a weight: {missing}")
    _checked(weights)
    blocks = [-(-n // block) for n in sizes.values()]
    plan = partial(_schedule, names=list(sizes), weights=_integers([weights[s] for s in sizes]), blocks=blocks)
    table = materialise(spark.range(0, 1, 1, 1).mapInArrow(plan, "of string, its_block long, slot long"), "schedule")
    rows = numbered.withColumns({"block": F.floor(F.col("nth") / block), "place": (F.col("nth") % block).cast("int")})
    met = rows.join(table, rows["source"].eqNullSafe(table["of"]) & (rows["block"] == table["its_block"]))
    return met.select("doc_id", "source", "text_hash", "block", "slot", "place")


def mixed_rows(docs: DataFrame, position: str | None = None, **options) -> DataFrame:
    """Rows of `docs`, with all columns, in the order of the mix.

    That order is lost when a table of several files is read again, as Spark deals files out by size. With `position`, rows
    come in any order instead and carry their rank key under that name: unique, and sorting by it gives the mix.
    """
    if position in docs.columns:
        raise ValueError(f"the documents have a column {position} already")
    block = options.get("block", BLOCK)
    same = ["doc_id", "source", "text_hash"]
    number = lambda order: F.row_number().over(Window.partitionBy(*same).orderBy(*order))
    placed = interleave(docs, **options).withColumn("at", F.col("slot") * block + F.col("place"))
    placed = placed.withColumn("copy", number(["at"])).select(*[F.col(c).alias(f"its_{c}") for c in (*same, "copy")], "at")
    keys = {
        "doc_id": F.col("row.doc_id").cast("long"),
        "source": F.col("row.source").cast("string"),
        "text_hash": F.xxhash64(F.col("row.text").cast("string")),
    }
    keyed = docs.select(F.struct("*").alias("row")).withColumns(keys).withColumn("copy", number([F.lit(0)]))
    met = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in (*same, "copy")]
    rows = keyed.join(placed, reduce(Column.__and__, met))
    return rows.orderBy("at").select("row.*") if position is None else rows.select("row.*", F.col("at").alias(position))
