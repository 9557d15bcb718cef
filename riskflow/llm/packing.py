"""Packing of tokenized documents into sequences of a fixed size, online and in bounded space.

Each partition keeps at most `open_windows` unfinished windows. A document's full windows are cut off at once; its rest
goes to the open window that it fills best. When none has room, the fullest is completed with the head of the rest (if
at least `least_cut` ids fit) and emitted. At the end of a partition the open windows are refilled gaplessly, so one
unfinished window at most is left; these leftovers of `merge_span` neighbouring partitions are then merged, best fit
decreasing. A partition's result depends on its own rows alone, and leftovers are merged from a written table, so a
repeated task gives the same windows.

Nulls and odd input: a null or empty text is a document of the end id alone; a null doc_id stays null; repeated rows are
documents of their own; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import crc, encoder
from .shared import Scratch, slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """The windows of one partition. `emit(window)` gets the pieces of each finished window: (doc, start, ids)."""

    def __init__(self, size: int, most: int, least_cut: int, emit):
        self.size, self.most, self.least_cut, self.emit = size, most, least_cut, emit
        self.free: list[tuple[int, int]] = []  # (room, window), by room
        self.held: dict[int, list] = {}
        self.made = 0

    def _place(self, k: int, doc, start: int, ids: np.ndarray) -> None:
        room, window = self.free.pop(k)
        self.held[window].append((doc, start, ids))
        if room == len(ids):
            self.emit(self.held.pop(window))
        else:
            insort(self.free, (room - len(ids), window))

    def add(self, doc, ids: np.ndarray) -> None:
        start = len(ids) // self.size * self.size
        for at in range(0, start, self.size):
            self.emit([(doc, at, ids[at : at + self.size])])
        rest = ids[start:]
        while len(rest):
            if (k := bisect_left(self.free, (len(rest), -1))) < len(self.free):
                self._place(k, doc, start, rest)
                return
            if len(self.free) < self.most:
                self.free.append((self.size, self.made))
                self.held[self.made] = []
                self.made += 1
                continue
            room, window = self.free[0]
            if room >= self.least_cut:
                self._place(0, doc, start, rest[:room])
                start, rest = start + room, rest[room:]
            else:
                self.free.pop(0)
                self.emit(self.held.pop(window))

    def close(self) -> list:
        """Refills the open windows without gaps; returns the pieces of the last, unfinished one."""
        room, window = self.size, []
        for doc, start, ids in (piece for w in sorted(self.held) for piece in self.held[w]):
            while len(ids):
                window.append((doc, start, ids[:room]))
                taken = min(room, len(ids))
                start, ids, room = start + taken, ids[taken:], room - taken
                if not room:
                    self.emit(window)
                    room, window = self.size, []
        self.free, self.held = [], {}
        return window


def _row(doc: tuple, start: int, ids: np.ndarray, sequence: int, offset: int, is_open: bool, with_ids: bool) -> tuple:
    row = (doc[0], start, len(ids), crc(ids), doc[1], sequence, offset, is_open)
    return (*row, ids.tolist()) if with_ids else row


def _merge(size: int):
    """Leftover windows of a group of partitions -> common windows, best fit decreasing; a window's first piece has offset 0."""

    def merge(table: pa.Table) -> pa.Table:
        pdf = table.to_pandas(types_mapper=pd.ArrowDtype)
        used = pdf.groupby("sequence_id")["length"].sum().reset_index().sort_values(["length", "sequence_id"], ascending=[False, True])
        bins: list[tuple[int, int, int]] = []  # (room, target, used)
        target, shift = {}, {}
        for sequence, n in zip(used["sequence_id"].tolist(), used["length"].tolist(), strict=True):
            k = bisect_left(bins, (n, -1, 0))
            room, to, at = bins.pop(k) if k < len(bins) else (size, sequence, 0)
            target[sequence], shift[sequence] = to, at
            insort(bins, (room - n, to, at + n))
        old = pdf["sequence_id"].tolist()
        names = table.column_names
        columns = {n: table.column(n) for n in names}
        columns["sequence_id"] = pa.array([target[s] for s in old], pa.int64())
        columns["offset"] = pa.array([o + shift[s] for o, s in zip(pdf["offset"].tolist(), old, strict=True)], pa.int64())
        return pa.table(columns).drop_columns(["is_open", "span"])

    return merge


def pack(docs: DataFrame, path: str, end: int, size: int = 2048, open_windows: int = 64, least_cut: int = 32, merge_span: int = 64, with_ids: bool = False) -> DataFrame:
    """One row for each piece of docs (doc_id, text): where it lies in its document and in its sequence; with its ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, task = [], TaskContext.get().partitionId()
        made = task << 32

        def emit(window: list, is_open: bool = False) -> None:
            nonlocal made
            at = 0
            for doc, start, ids in window:
                rows.append(_row(doc, start, ids, made, at, is_open, with_ids))
                at += len(ids)
            made += bool(window)

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            return batch

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "is_open"] + ["ids"] * with_ids
        kinds = [pa.int64()] * 7 + [pa.bool_()] + [pa.list_(pa.int64())] * with_ids
        windows = OpenWindows(size, open_windows, least_cut, emit)
        for batch in slices(batches):
            ids, counts = encoder(path).encode(batch.column("text").to_pylist(), end)
            at = 0
            for doc, n in zip(batch.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                windows.add((doc, n), ids[at : at + n].copy())
                at += n
            if rows:
                yield out()
        emit(windows.close(), True)
        encoder(path).release()
        if rows:
            yield out()

    scratch = Scratch(docs.sparkSession, "packing")
    schema = PIECES + ", is_open boolean" + (", ids array<long>" if with_ids else "")
    pieces = scratch.keep(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "pieces")
    span = F.shiftright("sequence_id", 32) / F.lit(merge_span)
    left = pieces.filter("is_open").withColumn("span", F.floor(span))
    merged = left.groupBy("span").applyInArrow(_merge(size), PIECES + (", ids array<long>" if with_ids else ""))
    return pieces.filter("not is_open").drop("is_open").unionByName(merged)
