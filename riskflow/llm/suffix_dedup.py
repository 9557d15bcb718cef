"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A suffix counts through its first THRESHOLD bytes; suffixes equal to that depth are the repeated windows. Three steps keep all
but a few suffixes out of the sort, and none of them can part equal suffixes:

1. Anchors. A suffix's anchor is the leftmost of its GRAM-byte strings with the smallest hash. Neighbouring suffixes with one
   anchor are a run, and a run is one row; its context is all bytes of its suffixes. An anchor string that only one run has
   has no second suffix, so the run retires. Only hashes and counts are shuffled for that.
2. Copies. Of runs with equal contexts (128-bit digests) one goes on, and only if its anchor string has other contexts; all
   suffixes of the copies are repeated anyway.
3. The sort. The suffixes of the contexts that share an anchor string are ordered by passes over DIGIT bytes each, most
   significant first: a pass orders the live suffixes of each group by their next digit, groups split, and suffixes alone in
   a group retire. What is live after the pass that reaches THRESHOLD bytes is repeated. Digits are ranks of the bytes
   themselves, so this step compares bytes, not hashes.

A task sorts whole groups of at most GROUP contexts. A larger group is first split by how many bytes of a suffix lie before
the anchor: suffixes with lo to hi bytes before it share the lo bytes before and the rest - hi bytes after it, so these bytes
are the group's next digit and the group falls apart by them; halves of the range go on until groups are small or the range
is one number, where all members of a group are equal. No group is gathered, and plans are the same at every size.

Rows are known by a 128-bit digest of id and text; equal rows share it, and each counts for itself.

Nulls and odd input: null text is empty; texts under THRESHOLD bytes stay whole; equal rows repeat each other; rows that
repeat a doc_id with different texts keep apart by their text; a null doc_id stays null; an empty table gives no row; other
columns are not read. Long texts are cut into overlapping blocks, so a worker's memory doesn't follow a text's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import PrefixHash, char_hash
from .shared import Scratch, ragged, slices

THRESHOLD, GRAM, GROUP, DIGIT = 200, 64, 4096, 32
#: Bytes that a worker turns into arrays at once.
BLOCK = 1 << 20
PARTS = "g binary, ctx binary, data binary, anchor int, n int, lo int, hi int, members long"
SPANS = "ctx binary, offset int, n int"


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each window of w values."""
    n = len(h)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    rows = padded.reshape(-1, w)
    head = np.minimum.accumulate(rows, 1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[: n - w + 1], head[w - 1 : n])


def blocks(texts: list[str | None], threshold: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Pieces of the texts of about BLOCK bytes together; the text of each and where it begins there. Each window is in one piece."""
    held, doc, at, size = [], [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode()
        for start in range(0, len(data) - threshold + 1, BLOCK):
            held.append(data[start : start + BLOCK + threshold - 1])
            doc.append(i)
            at.append(start)
            size += len(held[-1])
            if size >= BLOCK:
                yield held, np.array(doc), np.array(at)
                held, doc, at, size = [], [], [], 0
    if held:
        yield held, np.array(doc), np.array(at)


def runs(pieces: list[bytes], threshold: int, gram: int) -> tuple[np.ndarray, ...]:
    """The runs of all pieces: hash of the anchor string, piece, first window in it, windows before the anchor, windows."""
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.cumsum(length) - length
    h = PrefixHash(char_hash()[np.frombuffer(b"".join(pieces), np.uint8)]).windows(gram)
    # The leftmost of equal minima: the place in the low bits decides.
    placed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    window = ragged(begin, length - threshold + 1)
    anchor = (sliding_min(placed, threshold - gram + 1)[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]))
    n = np.diff(np.append(first, len(window)))
    piece = np.searchsorted(begin, window[first], side="right") - 1
    return h[anchor[first]], piece, window[first] - begin[piece], anchor[first] - window[first], n


def repeated(data: np.ndarray, start: np.ndarray, group: np.ndarray, threshold: int) -> np.ndarray:
    """Numbers of the suffixes (from `start`, in groups) that equal another of their group in `threshold` bytes: the sort's passes."""
    size = 8
    padded = np.concatenate([data, np.zeros(DIGIT, np.uint8)])
    word = np.zeros(len(data), np.uint64)
    for k in range(size):
        word = word << np.uint64(8) | padded[k : k + len(data)]
    digit = np.unique(word, return_inverse=True)[1]
    while 2 * size <= min(DIGIT, threshold):  # the rank of twice as many bytes: the rank of the first half, then of the second
        rest = np.append(digit[size:], np.zeros(min(size, len(digit)), np.int64))
        digit = np.unique(digit.astype(np.uint64) << np.uint64(32) | rest.astype(np.uint64), return_inverse=True)[1]
        size *= 2
    live, group = np.arange(len(start)), group.astype(np.uint64)
    for depth in [*range(0, threshold - size, size), threshold - size]:
        if not len(live):
            break
        key = group << np.uint64(32) | digit[start[live] + depth].astype(np.uint64)
        order = np.argsort(key)
        key, live = key[order], live[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        number = np.cumsum(new) - 1
        keep = np.bincount(number)[number] > 1
        live, group = live[keep], number[keep].astype(np.uint64)
    return np.sort(live)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables of about BLOCK bytes of data that end where a group ends."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held["data"].nbytes >= BLOCK:
            g = held["g"].to_pylist()
            k = len(g) - 1
            while k and g[k - 1] == g[-1]:
                k -= 1
            if k:
                yield held.slice(0, k)
                held = held.slice(k).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _sort(threshold: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches):
            data = table["data"].to_pylist()
            size = np.fromiter(map(len, data), np.int64, len(data))
            group = np.unique(np.array([x.hex() for x in table["g"].to_pylist()]), return_inverse=True)[1]
            anchor, n, lo, hi = (np.asarray(table[c]).astype(np.int64) for c in ("anchor", "n", "lo", "hi"))
            first, last = np.maximum(0, anchor - hi), np.minimum(n - 1, anchor - lo)
            count = np.maximum(0, last - first + 1)
            row = np.repeat(np.arange(len(data)), count)
            offset = ragged(first, count)
            live = repeated(np.frombuffer(b"".join(data), np.uint8), (np.cumsum(size) - size)[row] + offset, group[row], threshold)
            row, offset = row[live], offset[live]
            head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])) if len(row) else row
            yield pa.RecordBatch.from_arrays([table["ctx"].combine_chunks().take(pa.array(row[head])), pa.array(offset[head].astype(np.int32)), pa.array(np.diff(np.append(head, len(row))).astype(np.int32))], names=["ctx", "offset", "n"])

    return sort


def _split(threshold: int, gram: int):
    """Halves of the ranges of large groups, each with the bytes that its suffixes share as the next digit."""
    rest = threshold - gram

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mid = (r["lo"] + r["hi"]) // 2
                for lo, hi in ((r["lo"], mid), (mid + 1, r["hi"])):
                    if max(lo, r["anchor"] - r["n"] + 1) <= min(hi, r["anchor"]):
                        part = r["data"][r["anchor"] - lo : r["anchor"] + gram + rest - hi]
                        out.append((hashlib.md5(b"%d-%d " % (lo, hi) + part).digest(), r["ctx"], r["data"], r["anchor"], r["n"], lo, hi))
            if out:
                kinds = [pa.binary()] * 3 + [pa.int32()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["g", "ctx", "data", "anchor", "n", "lo", "hi"])

    return split


def sort_groups(parts: DataFrame, scratch: Scratch, threshold: int, gram: int, most: int) -> DataFrame:
    """(ctx, offset, n): the repeated windows among the contexts of each group of parts."""
    found, level = [], 0
    while True:
        small = parts.filter(F.col("members") <= most).repartition("g").sortWithinPartitions("g")
        found.append(scratch.keep(small.mapInArrow(_sort(threshold), SPANS), f"found-{level}"))
        large = parts.filter(F.col("members") > most)
        found.append(large.filter("lo = hi").select("ctx", (F.col("anchor") - F.col("lo")).alias("offset"), F.lit(1).alias("n")))
        wide = large.filter("lo < hi")
        if not wide.limit(1).count():
            break
        level += 1
        halves = scratch.keep(wide.drop("members").mapInArrow(_split(threshold, gram), PARTS.rpartition(",")[0]), f"halves-{level}")
        members = halves.groupBy("g").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        members = scratch.keep(members, f"members-{level}")
        parts = scratch.keep(halves.join(members.hint("merge"), "g").select(*PARTS.replace(",", "").split(" ")[::2]), f"parts-{level}")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def row_key() -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))))


def repeated_windows(docs: DataFrame, scratch: Scratch, threshold: int, gram: int, most: int) -> DataFrame:
    """(row, first, n): runs of repeated windows of each row, rows of docs being (row, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for pieces, _, _ in blocks(batch.column("text").to_pylist(), threshold):
                keys, n = np.unique(runs(pieces, threshold, gram)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for pieces, doc, at in blocks(batch.column("text").to_pylist(), threshold):
                key, piece, first, anchor, n = runs(pieces, threshold, gram)
                ctx = [hashlib.md5(pieces[p][a:b]).digest() for p, a, b in zip(piece.tolist(), first.tolist(), (first + n + threshold - 1).tolist(), strict=True)]
                rows = batch.column("row").take(pa.array(doc[piece]))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ctx, pa.binary()), rows, pa.array((at[piece] + first) << 32 | anchor << 16 | n)], names=["key", "ctx", "row", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = threshold - gram
        for batch in batches:
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data, out = (text or "").encode(), []
                for w in wanted:
                    first, anchor, n = w["place"] >> 32, w["place"] >> 16 & 0xFFFF, w["place"] & 0xFFFF
                    out.append((w["key"].to_bytes(8, "big", signed=True), w["ctx"], data[first : first + n + threshold - 1], anchor, n, 0, rest, w["members"]))
                kinds = [pa.binary()] * 3 + [pa.int32()] * 4 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=PARTS.replace(",", "").split(" ")[::2])

    # Anchor strings that more than one run has, and these runs.
    often = docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    often = scratch.keep(often, "often")  # a table, as skew is split only between two shuffled sides
    placed = docs.select("row", "text").mapInArrow(place, "key long, ctx binary, row binary, place long")
    placed = scratch.keep(placed.join(often.hint("merge"), "key"), "placed")
    # Distinct contexts, and those with others of their anchor string.
    contexts = placed.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "place")).alias("sample"))
    contexts = scratch.keep(contexts, "contexts")
    mixed = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    mixed = scratch.keep(mixed, "mixed")
    going = contexts.join(mixed.hint("merge"), "key").select("sample.row", F.struct("key", "ctx", "sample.place", "members").alias("w"))
    wanted = going.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    # Their bytes: each text travels once. Equal rows share a key, so one of them is taken.
    texts = docs.join(wanted.hint("merge"), "row").groupBy("row").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))
    parts = scratch.keep(texts.select("text", "wanted").mapInArrow(cut, PARTS), "parts")
    some = sort_groups(parts, scratch, threshold, gram, most)
    whole = contexts.filter("copies > 1").select("ctx", F.lit(0).alias("offset"), F.col("sample.place").bitwiseAND(0xFFFF).cast("int").alias("n"))
    spans = some.unionByName(whole).groupBy("ctx").agg(F.collect_set(F.struct("offset", "n")).alias("spans"))  # few for each context
    spans = scratch.keep(spans, "spans")
    at = placed.select("ctx", "row", F.shiftright("place", 32).alias("at")).join(spans.hint("merge"), "ctx")
    return at.select("row", "at", F.explode("spans").alias("s")).select("row", (F.col("at") + F.col("s.offset")).alias("first"), F.col("s.n").cast("long").alias("n"))


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) for each row of docs (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = docs.select("doc_id", "text", row_key().alias("row"))
    found = repeated_windows(rows, scratch, threshold, gram, group)
    merged = found.groupBy("row").agg(F.collect_set(F.struct("first", "n")).alias("spans"))
    merged = scratch.keep(merged.withColumnRenamed("row", "own"), "merged")
    for name in ("placed", "contexts", "parts"):
        scratch.drop(name)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = np.frombuffer((text or "").encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int32)
                for s in spans or ():
                    edge[s["first"]] += 1
                    edge[s["first"] + s["n"] + threshold - 1] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                out.append((len(data), int(gone.sum()), int((np.diff(gone.view(np.int8), prepend=0) == 1).sum()), data[~gone].tobytes()))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(merged.hint("merge"), F.col("row") == F.col("own"), "left").select(F.col("doc_id").cast("long"), "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
