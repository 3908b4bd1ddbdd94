"""Frame features of signals whose samples arrive in pieces, in any order.

A piece has signal_id, start (position of its first sample), x (samples), total (samples of the whole signal, NULL while unknown) and ts
(event time). ``FrameAssembler`` keeps, for every signal, the frames that still miss samples; a frame is described and forgotten as soon as
its last sample is there, so state holds incomplete frames only, and which frames are done: all below a number, and single ones above it.
State is read and written in blocks of BLOCK frames, as every call to it goes over a socket: a piece costs a few calls, not some per frame.
Samples that come again change nothing. A signal that has been quiet for ``idle`` of event time is closed: its incomplete frames are
described from what is there, with their count, and all state goes.

With ``total`` known the frames are those of ``operators.frames.frame_rms``: frame j holds samples j * hop up to length - 1 more, the last
ones are shorter. Without, a signal's last frames come when it is closed. State is kept by RocksDB on the executors' disks and checkpointed with the stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sigspark.operators.frames import KEY

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Frames that lie together in one entry of the state.
BLOCK = 64


class FrameAssembler(StatefulProcessor):
    def __init__(self, length: int, hop: int, idle_ms: int):
        self.length, self.hop, self.idle_ms = length, hop, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # per block: which frames are open, their samples and which of these are there, one after the other; which frames are done
        self.blocks = handle.getMapState("blocks", "block long", "frames binary, data binary, seen binary, done binary")
        self.about = handle.getValueState("about", "upto long, total long, timer long")

    def needed(self, frame: int, total: int | None) -> int:
        return self.length if total is None else min(self.length, total - frame * self.hop)

    def load(self, block: int) -> tuple[dict, set]:
        """The open frames of a block (data, seen) and those that are done, by number."""
        if not self.blocks.containsKey((block,)):
            return {}, set()
        frames, data, seen, done = self.blocks.getValue((block,))
        data, seen = np.frombuffer(data, "<f8").reshape(-1, self.length), np.frombuffer(seen, bool).reshape(-1, self.length)
        return {int(f): (d.copy(), s.copy()) for f, d, s in zip(np.frombuffer(frames, "<i8"), data, seen)}, set(np.frombuffer(done, "<i8").tolist())

    def keep(self, block: int, opened: dict, done: set) -> None:
        if not opened and not done:
            self.blocks.removeKey((block,))
            return
        held = sorted(opened)
        data, seen = (b"".join(opened[f][i].astype(kind).tobytes() for f in held) for i, kind in ((0, "<f8"), (1, bool)))
        self.blocks.updateValue((block,), (np.array(held, "<i8").tobytes(), data, seen, np.array(sorted(done), "<i8").tobytes()))

    def described(self, key, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
        made = [(*key, frame, int(seen.sum()), float(np.sqrt(np.mean(data[seen] ** 2))), float(np.mean(data[seen]))) for frame, data, seen in rows]
        return pd.DataFrame(made, columns=[KEY, "frame_idx", "n", "rms", "mean"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        upto, total, timer = self.about.get() if self.about.exists() else (0, None, None)
        known, latest, held, touched = total is not None, None, {}, set()
        for pdf in rows:
            for start, x, whole, ts in zip(pdf["start"], pdf["x"], pdf["total"], pdf["ts"]):
                total = total if whole is None or pd.isna(whole) else int(whole)
                latest = ts if latest is None else max(latest, ts)
                x, start = np.asarray(x, "float64"), int(start)
                first, last = max(-(-(start - self.length + 1) // self.hop), upto, 0), (start + len(x) - 1) // self.hop
                for frame in range(first, last + 1):
                    block = frame // BLOCK
                    if block not in held:
                        held[block] = self.load(block)
                    opened, done = held[block]
                    if frame in done:
                        continue
                    a, b = max(start, frame * self.hop), min(start + len(x), frame * self.hop + self.length)
                    if a < b:
                        # frames may have gaps between them
                        data, seen = opened.setdefault(frame, (np.zeros(self.length), np.zeros(self.length, bool)))
                        data[a - frame * self.hop : b - frame * self.hop] = x[a - start : b - start]
                        seen[a - frame * self.hop : b - frame * self.hop] = True
                        touched.add(frame)
        if total is not None and not known:
            for (block,) in list(self.blocks.keys()):
                if block not in held:
                    held[block] = self.load(block)
            touched = {frame for opened, _ in held.values() for frame in opened}
        whole, changed = [], {frame // BLOCK for frame in touched}
        for frame in sorted(touched):
            opened, done = held[frame // BLOCK]
            data, seen = opened[frame]
            if seen.sum() >= self.needed(frame, total):
                whole.append((frame, data, seen))
                done.add(frame)
                del opened[frame]
        while True:
            block = upto // BLOCK
            if block not in held:
                held[block] = self.load(block)
            if upto not in held[block][1]:
                break
            held[block][1].remove(upto)
            changed.add(block)
            upto += 1
        for block in sorted(changed):
            self.keep(block, *held[block])
        if latest is not None and not pd.isna(latest):
            due = int(pd.Timestamp(latest).timestamp() * 1000) + self.idle_ms
            if timer is None or due > timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
                timer = due
        self.about.update((upto, total, timer))
        if whole:
            yield self.described(key, whole)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        left = sorted((frame, *held) for (block,) in list(self.blocks.keys()) for frame, held in self.load(block)[0].items())
        for state in (self.blocks, self.about):
            state.clear()
        if left:
            yield self.described(key, left)

    def close(self) -> None:
        pass


@contextmanager
def disk_state(spark: SparkSession):
    """The settings that streams started inside take their state store from; afterwards the session is as before."""
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_frames(pieces: DataFrame, length: int, hop: int | None = None, idle: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(signal_id, frame_idx, n, rms, mean) of a stream of pieces; rows later than ``delay`` are dropped."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    kind = pieces.schema[KEY].dataType.simpleString()
    watched = pieces.select(KEY, "start", "x", "total", "ts").withWatermark("ts", delay)
    return watched.groupBy(KEY).transformWithStateInPandas(
        FrameAssembler(length, hop or length, idle_ms), f"{KEY} {kind}, frame_idx long, n long, rms double, mean double", "append", "EventTime"
    )


def run_frames(pieces: DataFrame, out: str, checkpoint: str, length: int, hop: int | None = None, idle: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Describe all that has arrived since the last call and stop; the rows written so far."""
    spark = pieces.sparkSession
    with disk_state(spark):
        made = stream_frames(pieces, length, hop, idle, delay)
        made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(made.schema).parquet(out)
