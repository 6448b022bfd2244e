"""Rolling order statistics over long segments: blocks of rows with a halo, selected in Arrow batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logharrow.sources.workspace import materialise

#: Rows of a block. A segment of any length is cut into blocks, each of which also gets the rows before it that its frames need.
BLOCK = 4096
#: Values that are sorted at once.
AT_ONCE = 1 << 20


def rolling_median(values: np.ndarray, first: np.ndarray, rows: int) -> np.ndarray:
    """Median of each column over the last `rows` rows from first[i], the start of row i's segment, on; NaN ranks last."""
    out = np.empty_like(values)
    step = max(1, AT_ONCE // (rows * values.shape[1]))
    for at in range(0, len(values), step):
        i = np.arange(at, min(at + step, len(values)))
        frame = i[:, None] - np.arange(rows)
        inside = frame >= first[i, None]
        held = np.where(inside[:, :, None], values[np.maximum(frame, 0)], np.nan)
        held.sort(axis=1)
        n = inside.sum(1)
        low, high = (np.take_along_axis(held, k[:, None, None], 1)[:, 0] for k in ((n - 1) // 2, n // 2))
        out[i] = np.where(low == high, low, 0.5 * low + 0.5 * high)
    return out


def robust_distance(values: np.ndarray, segment: np.ndarray, rows: int) -> np.ndarray:
    """Distance of each value from its rolling median over 1.4826 times the rolling median of such distances; rows go by segment and time."""
    starts = np.concatenate(([True], segment[1:] != segment[:-1]))
    first = np.maximum.accumulate(np.where(starts, np.arange(len(segment)), 0))
    far = np.abs(values - rolling_median(values, first, rows))
    return far / np.maximum(1.4826 * rolling_median(far, first, rows), 1e-8)


def robust_z_blocks(df: DataFrame, columns: list[str], rows: int = 36, key: str = "segment_id") -> DataFrame:
    """All columns of df and z_<column> of each, equal to robust_z().

    A range sort by segment, time and endpoint, written once, gives every row its place in the whole table; blocks are made of
    so many places, and the 2 * (rows - 1) places before a block go to it as well. So a hot segment spreads over tasks, no
    frame is sorted in the JVM, and only the window table is shuffled. Null values count as 0; a null key is a segment.
    """
    halo, names, order = 2 * (rows - 1), df.columns, [key, "window_start", "endpoint_group"]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed, "ordered-windows")
    part = F.shiftright("_at", 33)
    # one row a partition: where its places begin
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    begin, offsets = 0, []
    for number, n in sizes:
        offsets.append((number, begin))
        begin += n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _begin long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("_place", F.col("_begin") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    block, rest = F.floor(F.col("_place") / BLOCK), F.col("_place") % BLOCK
    # a halo may reach back over several blocks if blocks are small
    homes = F.transform(F.sequence(F.lit(0), F.floor((rest + halo) / BLOCK).cast("int")), lambda k: block + k)
    dealt = numbered.select(*[F.col(f"`{c}`") for c in names], "_place", F.explode(homes).alias("_block"))
    dealt = dealt.repartition("_block").sortWithinPartitions("_block", "_place")

    def score(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def done(held):
            table = pa.Table.from_batches(held).combine_chunks()
            values = np.column_stack([pc.fill_null(pc.cast(table.column(c), pa.float64()), 0.0).to_numpy() for c in columns])
            segment = pc.fill_null(pc.cast(pc.dictionary_encode(table.column(key).combine_chunks()).indices, pa.int64()), -1).to_numpy(zero_copy_only=False)
            z = robust_distance(values, segment, rows)
            own = np.flatnonzero(table.column("_place").to_numpy() // BLOCK == table.column("_block").to_numpy())
            kept = table.select(names).take(pa.array(own))
            for c, column in zip(columns, z.T):
                kept = kept.append_column(f"z_{c}", pa.array(column[own]))
            return kept.to_batches()

        held, now = [], None
        for batch in batches:
            blocks = batch.column("_block").to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and blocks[a] != now:
                    yield from done(held)
                    held = []
                now = blocks[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from done(held)

    schema = StructType([*df.schema.fields, *[StructField(f"z_{c}", DoubleType()) for c in columns]])
    return dealt.mapInArrow(score, schema)
