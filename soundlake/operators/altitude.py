"""Gated altitude filter: sequential along a line, parallel across pieces of it.

The filter state is two numbers, so a line is cut into chunks that run side by side from a guessed
start state: all chunks of a task advance together, one array step for each position. Chunks whose
predecessor ended elsewhere run again from there, until no start changes. The filter forgets its start
within a few hundred pings, so two or three rounds settle, and the answer equals one sequential pass
exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundlake import constants as K
from soundlake.operators.along import Track, ordinals
from soundlake.operators.lineage import cut, release
from soundlake.operators.stats import quantiles


def lockstep(obs: np.ndarray, length: np.ndarray, x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Run the random-walk filter over all columns of ``obs`` (position x chunk, NaN = missing) at once, one step a position.

    Columns come by falling ``length``; the state after each position, accepted flags, and the state each column ends with.
    """
    x, p = x.copy(), p.copy()
    state, taken = np.empty(obs.shape), np.zeros(obs.shape, bool)
    live = np.searchsorted(-length, -np.arange(len(obs)), "left")  # columns longer than the position
    for i, m in enumerate(live.tolist()):
        here, var = x[:m], p[:m] + K.KALMAN_Q
        s = var + K.KALMAN_R
        d = obs[i, :m] - here
        use = np.abs(d) < K.KALMAN_GATE * np.maximum(np.sqrt(s), 1e-6)
        g = var / s
        x[:m] = np.where(use, here + g * d, here)
        p[:m] = np.where(use, (1 - g) * (1 - g) * var + g * g * K.KALMAN_R, var)
        state[i, :m], taken[i, :m] = x[:m], use
    return state, taken, x, p


def _over_chunks(carry: bool, values: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Filter pings (_chunk, x0, p0, obs, ...) whose chunks come whole and in order, many chunks side by side.

    ``values`` gives every ping its value; else each chunk gives the state it ends with.
    """

    def solve(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        number, x0, p0, obs = (t[c].to_numpy() for c in ("_chunk", "x0", "p0", "obs"))
        size = np.diff(np.append(starts, len(number)))
        order = np.argsort(-size, kind="stable")
        lanes = np.full((int(size.max()), len(starts)), np.nan)
        lane = np.empty(len(starts), np.int64)
        lane[order] = np.arange(len(starts))
        at, col = np.arange(len(number)) - np.repeat(starts, size), np.repeat(lane, size)
        lanes[at, col] = obs
        state, taken, x, p = lockstep(lanes, size[order], x0[starts][order], p0[starts][order])
        if not values:
            return pa.record_batch([pa.array(number[starts]), pa.array(x[lane]), pa.array(p[lane])], names=["_chunk", "x1", "p1"])
        kept = state[at, col] if carry else np.where(taken[at, col], state[at, col], np.nan)
        out = t.drop_columns(["_chunk", "x0", "p0"]).append_column("smoothed", pa.array(kept, from_pandas=True))
        return out.combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= TOGETHER:
                t = pa.Table.from_batches(held).combine_chunks()
                starts = _starts(t)
                if len(starts) > 1:
                    yield solve(t.slice(0, starts[-1]).combine_chunks(), starts[:-1])
                    held = t.slice(starts[-1]).combine_chunks().to_batches()
                    rows = sum(b.num_rows for b in held)
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield solve(t, _starts(t))

    def _starts(t: pa.Table) -> np.ndarray:
        number = t["_chunk"].to_numpy()
        return np.flatnonzero(np.append(True, number[1:] != number[:-1]))

    return run


#: Pings of one run of the filter in a task.
TOGETHER = 1 << 18


def smooth(
    df: DataFrame, track: Track, value: str, carry: bool = False, chunk: int = 2000, out: str = "smoothed"
) -> DataFrame:
    """Filtered altitude per ping.

    Rejected or missing pings give NULL, or with ``carry`` the current state. Lines with fewer than five
    values stay unchanged. Start state: the line's median with variance 10.

    Chunks are stored as one row each. Rounds carry nothing but the states that chunks end with, one small table for
    all lines; when no start changes any more, one last pass gives the values.
    """
    line = list(track.line)
    obs = df.select(*line, *track.order, F.col(value).cast("double").alias("obs"))
    obs = ordinals(obs, track).withColumn("chunk", F.floor((F.col("ord") - 1) / chunk))
    med = cut(quantiles(obs, line, "obs", {"med": 0.5}, count="cnt").where("cnt >= 5").drop("cnt"), "medians")
    pings = F.transform(F.array_sort(F.collect_list(F.struct("ord", *track.order, "obs"))), lambda p: F.struct(*[p[c].alias(c) for c in (*track.order, "obs")]))
    rows = obs.groupBy(*line, "chunk").agg(pings.alias("pings")).join(med, line, "left")
    rows = cut(rows.withColumn("_chunk", F.monotonically_increasing_id()), "chunks")

    def each(starts: DataFrame, columns: list[str]) -> DataFrame:
        """Pings of the chunks that have a start, chunk by chunk."""
        met = rows.where("med is not null").select("_chunk", *columns, "pings").join(starts, "_chunk")
        of = [c for c in track.order if c not in line] if columns else []
        return met.select("_chunk", *columns, "x0", "p0", F.explode("pings").alias("_p")).select("_chunk", "x0", "p0", *columns, *[F.col(f"_p.{c}").alias(c) for c in (*of, "obs")])

    states = cut(rows.where("med is not null").select(*line, "chunk", "_chunk", F.col("med").alias("x0"), F.lit(K.KALMAN_P0).cast("double").alias("p0"),
                                                      F.lit(None).cast("double").alias("x1"), F.lit(None).cast("double").alias("p1"), F.lit(True).alias("moved")), "states")
    over = Window.partitionBy(*line).orderBy("chunk")
    while not states.where("moved").isEmpty():
        active = states.where("moved").select("_chunk", "x0", "p0")
        ran = each(active, []).mapInArrow(_over_chunks(carry, False), "_chunk long, x1 double, p1 double")
        new = states.select(*line, "chunk", "_chunk", "x0", "p0", F.col("x1").alias("_x"), F.col("p1").alias("_p")).join(ran, "_chunk", "left")
        new = new.withColumns({"x1": F.coalesce("x1", "_x"), "p1": F.coalesce("p1", "_p")}).drop("_x", "_p")
        new = new.withColumns({"_x": F.coalesce(F.lag("x1").over(over), "x0"), "_p": F.coalesce(F.lag("p1").over(over), "p0")})
        new = new.withColumn("moved", (F.col("_x") != F.col("x0")) | (F.col("_p") != F.col("p0")))
        new = cut(new.withColumns({"x0": F.col("_x"), "p0": F.col("_p")}).select(*states.columns), "states")
        release(states)
        states = new
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*line, *[c for c in track.order if c not in line]).schema]
    done = each(states.select("_chunk", "x0", "p0"), line).mapInArrow(_over_chunks(carry, True), ", ".join([*kinds, "obs double", "smoothed double"]))
    few = rows.where("med is null").select(*line, F.explode("pings").alias("_p"))
    few = few.select(*line, *[F.col(f"_p.{c}").alias(c) for c in track.order if c not in line], F.col("_p.obs").alias("obs"), F.col("_p.obs").alias("smoothed"))
    both = done.unionByName(few)
    return both.select(*line, *track.order, F.col("obs").alias(value), F.col("smoothed").alias(out))
