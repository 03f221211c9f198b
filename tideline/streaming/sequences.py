"""Quality of the sequence numbers of channels over a stream, with bounded state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Numbers that share one entry of the map state, as a bit each.
BLOCK = 4096
#: The channel of rows without one.
UNNAMED = "__global__"
COUNTS = ("n", "n_non_numeric", "n_duplicates", "n_backwards", "n_gaps", "gap_span")


class SequenceQuality(StatefulProcessor):
    """State of a channel: the last number and the counters (one value), and the numbers seen (a map from blocks of numbers
    to bits), of which at most `cap` are kept. Beyond that duplicates of further numbers are not seen, and truncated says
    so."""

    def __init__(self, channel: str, cap: int):
        self.channel, self.cap = channel, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "last long, tracked long, truncated boolean, " + ", ".join(f"{c} long" for c in COUNTS))
        self.seen = handle.getMapState("seen", "block long", "bits binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, tracked, truncated, *counts = self.held.get() if self.held.exists() else (None, 0, False, *[0] * len(COUNTS))
        total = dict(zip(COUNTS, counts, strict=True))
        # numbers only, in the order that they came in
        frames = [f[["seq", "bad", "at"]] for f in rows]
        batch = pd.concat(frames).sort_values("at", kind="stable") if frames else pd.DataFrame({"seq": [], "bad": [], "at": []})
        x = batch["seq"][~batch["bad"].astype(bool)].to_numpy("int64")
        total["n"] += len(batch)
        total["n_non_numeric"] += len(batch) - len(x)
        if len(x):
            steps = np.diff(x if last is None else np.concatenate(([last], x)))
            total["n_backwards"] += int((steps < 0).sum())
            total["n_gaps"] += int((steps > 1).sum())
            total["gap_span"] += int((steps[steps > 1] - 1).sum())
            values, first, times = np.unique(x, return_index=True, return_counts=True)
            known = np.zeros(len(values), bool)
            blocks = {}
            for b in np.unique(values // BLOCK).tolist():
                bits = np.frombuffer(self.seen.getValue((b,))[0], np.uint8) if self.seen.containsKey((b,)) else np.zeros(BLOCK // 8, np.uint8)
                blocks[b] = np.unpackbits(bits)
                own = values // BLOCK == b
                known[own] = blocks[b][values[own] % BLOCK] == 1
            new = np.flatnonzero(~known)[np.argsort(first[~known])]
            kept = new[: max(0, self.cap - tracked)]
            total["n_duplicates"] += int(times[known].sum() + (times[kept] - 1).sum())
            truncated, tracked, last = truncated or len(kept) < len(new), tracked + len(kept), int(x[-1])
            for b in np.unique(values[kept] // BLOCK).tolist():
                own = values[kept][values[kept] // BLOCK == b]
                blocks[b][own % BLOCK] = 1
                self.seen.updateValue((b,), (np.packbits(blocks[b]).tobytes(),))
        self.held.update((last, tracked, truncated, *total.values()))
        yield pd.DataFrame({self.channel: [key[0]], **{c: [v] for c, v in total.items()}, "tracked": [tracked], "truncated": [truncated]})

    def close(self) -> None:
        pass


def sequence_quality(stream: DataFrame, channel: str, sequence: str, order: str, cap: int = 1_000_000) -> DataFrame:
    """Counters of each channel after each batch, in update mode: n, n_non_numeric, n_duplicates, n_backwards, n_gaps,
    gap_span, tracked and truncated. Rows of one batch are taken in `order` (a number), batches in theirs.

    Needs the RocksDB state store (flows.drain(..., keyed_state=True) sets it).
    """
    number = F.col(sequence).try_cast("long")
    rows = stream.select(F.coalesce(F.col(channel).cast("string"), F.lit(UNNAMED)).alias(channel), F.coalesce(number, F.lit(0)).alias("seq"), number.isNull().alias("bad"), F.col(order).cast("long").alias("at"))
    schema = f"{channel} string, " + ", ".join(f"{c} long" for c in (*COUNTS, "tracked")) + ", truncated boolean"
    return rows.groupBy(channel).transformWithStateInPandas(SequenceQuality(channel, cap), outputStructType=schema, outputMode="update", timeMode="none")
