"""Best-fit-decreasing packing into sequences of several permitted lengths.

Lengths are whole numbers up to the largest capacity, so the packing of any number of pieces is decided from their
histogram: equal bins are handled together as ranges of bin numbers. Lengths are taken from the largest down; all pieces
of a length go to the fullest bins that hold them; where none does, new bins are opened, of the permitted size whose cost
per expected token is least (expected: the piece, and what the pieces still to come can fill of the rest). In the end
each bin shrinks to the smallest permitted size that holds its contents. The histogram and the plan are bounded by the
largest capacity, whatever the number of documents. Pieces then find their places by their rank among the pieces of their
length, which is counted in parts, so that a frequent length is not ranked in one task.

A text's length is its words and one end token. Longer texts than the largest capacity are split; nothing is cut off.

Defined results: null and empty texts are one end token; repeated rows are packed one by one; null ids are packed too; an
empty table gives an empty table; `place` keeps other columns, except that those named like an output give way.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.llm import _common as c

CAPACITIES = (512, 1024, 2048, 4096)
#: Parts in which the pieces of one length are ranked.
PARTS = 256


def cost(capacity: int) -> float:
    """Work on a sequence: in proportion to its length, and to its square for attention."""
    return capacity * (1 + capacity / 16_384)


@dataclass
class Plan:
    """spots: length -> rows (first rank, first bin, pieces per bin, offset); bins: rows (first bin, capacity, used)."""

    spots: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    bins: list[tuple[int, int, int]] = field(default_factory=list)
    n_bins: int = 0


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    """The packing of histogram[length] pieces of each length."""
    sizes, out = sorted(capacities), Plan()
    free: dict[int, list[tuple[int, int, int]]] = {}  # room left -> (first bin, bins, capacity)
    rooms: list[int] = []
    lengths = sorted((n for n, k in histogram.items() if k), reverse=True)
    tokens = np.zeros(sizes[-1] + 2, dtype=object)  # tokens in pieces of at most this length that are still to come
    for n in lengths:
        tokens[n] += n * histogram[n]
    below = np.concatenate([[0], np.cumsum(tokens)])

    def keep(room: int, first: int, bins: int, capacity: int) -> None:
        if room not in free:
            free[room] = []
            insort(rooms, room)
        free[room].append((first, bins, capacity))

    for n in lengths:
        left, rank, spots = histogram[n], 0, out.spots.setdefault(n, [])
        while left:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                first, bins, capacity = free[room].pop()
                if not free[room]:
                    del free[room], rooms[at]
            else:
                def per_token(size: int) -> float:
                    filled = n * min(size // n, left)
                    room = size - filled
                    return cost(size) / (filled + min(room, below[min(room, n - 1) + 1]))

                capacity = min((s for s in sizes if s >= n), key=lambda s: (per_token(s), s))
                room, first, bins = capacity, out.n_bins, -(-left // (capacity // n))
                out.n_bins += bins
            fit = room // n
            full = min(bins, left // fit)
            if full:
                spots.append((rank, first, fit, capacity - room))
                keep(room - fit * n, first, full, capacity)
                rank, left = rank + full * fit, left - full * fit
            rest = bins - full
            if rest and left:  # fewer pieces than one more bin holds
                spots.append((rank, first + full, fit, capacity - room))
                keep(room - left * n, first + full, 1, capacity)
                rank, left, full, rest = rank + left, 0, full + 1, rest - 1
            if rest:
                keep(room, first + full, rest, capacity)
    for room, ranges in free.items():
        for first, _, capacity in ranges:
            out.bins.append((first, min(s for s in sizes if s >= capacity - room), capacity - room))
    out.bins.sort()
    return out


def pieces(df: DataFrame, text: str = "text", capacity: int = CAPACITIES[-1]) -> DataFrame:
    """df without the text, a row for each piece: `piece` from 0 and `n_tokens`."""
    df = df.drop("piece", "n_tokens").withColumn("__n", F.size(c.words(c.text_or_empty(text))) + 1).drop(text)
    df = df.withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) DIV {capacity}").cast("int"))))
    return df.withColumn("n_tokens", F.least(F.lit(capacity), F.col("__n") - F.col("piece") * capacity).cast("int")).drop("__n")


def place(rows: DataFrame, order: list[str], capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """rows (with n_tokens) with `bin_id`, `bin_capacity` and `bin_offset`. `order` are the columns that tell rows apart."""
    rows = rows.drop("bin_id", "bin_capacity", "bin_offset")
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int")
    rows = c.cut(rows.withColumn("__part", part))
    counts = c.cut(rows.groupBy("n_tokens", "__part").count())
    histogram = {r[0]: r[1] for r in counts.groupBy("n_tokens").agg(F.sum("count")).collect()}  # at most the largest capacity
    found = plan(histogram, capacities)
    first = {n: np.array(v, dtype=np.int64).reshape(-1, 4) for n, v in found.spots.items()}
    bins = np.array(found.bins, dtype=np.int64).reshape(-1, 3)
    shared = rows.sparkSession.sparkContext.broadcast((first, bins))

    @F.pandas_udf("bin_id long, bin_capacity int, bin_offset int")
    def spot(n: pd.Series, rank: pd.Series) -> pd.DataFrame:
        first, bins = shared.value
        lengths, ranks = n.to_numpy(), rank.to_numpy()
        bin_id, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            table = first[length]
            row = table[np.searchsorted(table[:, 0], ranks[own], "right") - 1]
            past = ranks[own] - row[:, 0]
            bin_id[own] = row[:, 1] + past // row[:, 2]
            offset[own] = row[:, 3] + past % row[:, 2] * length
        size = bins[np.searchsorted(bins[:, 0], bin_id, "right") - 1, 1] if len(n) else bin_id
        return pd.DataFrame({"bin_id": bin_id, "bin_capacity": size.astype(np.int32), "bin_offset": offset.astype(np.int32)})

    before = Window.partitionBy("n_tokens").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("n_tokens", "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("n_tokens", "__part").orderBy(*order)))
    ranked = ranked.join(offsets, ["n_tokens", "__part"]).withColumn("__spot", spot("n_tokens", F.col("__before") + F.col("__rank") - 1))
    return ranked.select(*[x for x in rows.columns if x != "__part"], "__spot.*")


def pack(df: DataFrame, id_col: str = "doc_id", text: str = "text", capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """df without the text: a row for each piece, with its bin."""
    return place(pieces(df, text, max(capacities)), [id_col, "piece"], capacities)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(c.documents(spark, sf_dir).select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs.select("doc_id", "text"))
