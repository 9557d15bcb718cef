"""Benchmark passages in documents, by SimHash over item-sized windows; DataFrame operations only.

Texts are sequences of words (letters and digits, lower case) and of five-word shingles. A window has as many words as its
item; a shorter text is one window. A window and an item without a common shingle have similarity 0, so windows are taken
around shared shingles, at every start, and only those of which at least half the shingles occur in the item (others have a
similarity of a third at most). They get a 64-bit SimHash of their shingles, each weighted by its occurrences. With
RADIUS + 1 blocks of bits, two fingerprints within RADIUS agree in one block at least, so the equi-join on
(item, block, bits) misses none of them. Candidates within RADIUS are then verified: the weighted similarity, sum of smaller
over sum of larger occurrence counts, must be 0.8 or more.

Texts are known by a 128-bit digest, so copies are searched once; equal windows for an item are fingerprinted, joined and
verified once.

Nulls and odd input: null or empty text, and documents or items of under five words, have no shingle and match nothing;
a null doc_id or item_id takes no part in `contaminated`; of rows that repeat a doc_id, each text counts, and the id is
reported once for each item, with its best window; rows that repeat an item_id are matched each and reported once; an empty
table gives no row; other columns are not read. `decontaminated` goes by the text, so rows without a doc_id go too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, maybe_broadcast

SHINGLE, RADIUS, LEAST = 5, 18, 0.8


def words(text: str) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def shingles(words: str) -> Column:
    """64-bit hashes of the shingles of an array of words, in order; empty if there are too few words."""
    own = ", ".join(f"{words}[i + {k}]" for k in range(SHINGLE))  # by element: slice() copies the whole array each time
    return F.expr(f"CASE WHEN size({words}) >= {SHINGLE} THEN transform(sequence(0, size({words}) - {SHINGLE}), i -> xxhash64({own})) ELSE cast(array() AS array<bigint>) END")


def fingerprint(hashes: str) -> Column:
    """SimHash: bit b is set if it is set in more than half of the hashes."""
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> f | shiftleft(if(2 * aggregate({hashes}, 0L, (n, h) -> n + (shiftrightunsigned(h, b) & 1L)) > size({hashes}), 1L, 0L), b))")


def blocks(fp: str) -> Column:
    """The bits of each of RADIUS + 1 blocks."""
    n, out, at = RADIUS + 1, [], 0
    for k in range(n):
        width = 64 // n + (k < 64 % n)
        out.append(f"shiftrightunsigned({fp}, {at}) & {(1 << width) - 1}L")
        at += width
    return F.expr(f"array({', '.join(out)})")


def similarity(a: str, b: str) -> Column:
    """Weighted similarity of two arrays of hashes: occurrences that both have, over those that either has."""
    both = f"aggregate(array_intersect({a}, {b}), 0, (n, x) -> n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"
    return F.expr(f"{both} / cast(size({a}) + size({b}) - {both} AS double)")


def digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """t (the text's digest), item_id, similarity and start (in words, from 0) of each window that matches an item."""
    scratch = Scratch(docs.sparkSession, "leaks")
    items = benchmark.filter("item_id is not null").select("item_id", words("text").alias("w"))
    items = items.select("item_id", F.size("w").alias("n"), shingles("w").alias("s")).filter(F.col("n") >= SHINGLE)
    items = items.withColumn("item", F.xxhash64("item_id", "s")).dropDuplicates(["item"])
    items = scratch.keep(items.withColumn("fp", fingerprint("s")), "items")
    wanted = scratch.keep(items.select("item", "n", F.explode("s").alias("h")).distinct(), "shingles")

    texts = docs.select(digest("text").alias("t"), words("text").alias("w"))
    hashed = texts.select("t", F.size("w").alias("size"), shingles("w").alias("s"))
    # Not posexplode: it lets the optimizer filter by size(s) below, with the split of the text copied into each shingle.
    places = hashed.select("t", "size", F.posexplode_outer("s").alias("pos", "h")).filter("h is not null")
    hits = places.join(maybe_broadcast(wanted, wanted.count(), 24), "h").select("t", "size", "item", "n", "pos").distinct()
    # Each hit counts for all windows that it lies in.
    first, last = F.greatest(F.lit(0), F.col("pos") - F.col("n") + SHINGLE), F.least(F.col("pos"), F.greatest(F.lit(0), F.col("size") - F.col("n")))
    around = hits.select("t", "item", F.least("n", "size").alias("n"), F.explode(F.sequence(F.least(first, last), last)).alias("start"))
    windows = around.groupBy("t", "item", "n", "start").agg(F.count(F.lit(1)).alias("hits")).filter(2 * F.col("hits") >= F.col("n") - (SHINGLE - 1))
    by_text = scratch.keep(windows.groupBy("t").agg(F.collect_list(F.struct("item", "n", "start")).alias("windows")), "places")

    # The hashes are made again for texts with windows only, after the join, so that no text without one moves far.
    side = maybe_broadcast(by_text, by_text.select(F.coalesce(F.sum(F.size("windows")), F.lit(0))).first()[0], 32)
    held = docs.select(digest("text").alias("t"), "text").join(side, "t").groupBy("t").agg(F.first("text").alias("text"), F.first("windows").alias("windows"))
    held = held.select("t", words("text").alias("w"), "windows").select("t", shingles("w").alias("s"), "windows")
    cut = held.select("t", "s", F.explode("windows").alias("v")).select("t", F.col("v.item").alias("item"), F.col("v.start").alias("start"), F.expr(f"slice(s, v.start + 1, v.n - {SHINGLE - 1})").alias("s"))
    cut = cut.withColumn("key", F.md5(F.concat_ws(",", F.transform("s", lambda x: x.cast("string")))))
    cut = scratch.keep(cut, "windows")

    distinct = cut.groupBy("item", "key").agg(F.first("s").alias("s")).withColumn("fp", fingerprint("s"))
    distinct = scratch.keep(distinct, "distinct")
    mine = distinct.select("item", "key", "fp", F.posexplode(blocks("fp")).alias("block", "bits"))
    theirs = items.select("item", F.col("fp").alias("item_fp"), F.posexplode(blocks("fp")).alias("block", "bits"))
    near = mine.join(maybe_broadcast(theirs, items.count() * (RADIUS + 1), 40), ["item", "block", "bits"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    near = near.select("item", "key").distinct()
    weight = items.agg(F.coalesce(F.sum(F.size("s") + 4), F.lit(0))).first()[0]
    pairs = near.join(distinct.select("item", "key", "s"), ["item", "key"]).join(maybe_broadcast(items.select("item", "item_id", F.col("s").alias("item_s")), weight, 8), "item")
    found = pairs.select("item", "key", "item_id", similarity("s", "item_s").alias("similarity")).filter(F.col("similarity") >= LEAST)
    found = scratch.keep(found, "found")
    return cut.select("t", "item", "start", "key").join(maybe_broadcast(found, found.count(), 80), ["item", "key"]).select("t", "item_id", "similarity", "start")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity and start (in words, from 0) of the best window, and the number of windows that match."""
    matches = leaks(docs.select("doc_id", "text"), benchmark)
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start"))).alias("best")
    by_text = Scratch(docs.sparkSession, "leaks-by-text").keep(matches.groupBy("t", "item_id").agg(best, F.count_distinct("start").alias("n")), "found")
    ids = docs.filter("doc_id is not null").select("doc_id", digest("text").alias("t")).distinct()
    rows = ids.join(maybe_broadcast(by_text, by_text.count(), 64), "t").groupBy("doc_id", "item_id").agg(F.max_by("best", F.struct("best.similarity", -F.col("best.start"))).alias("best"), F.sum("n").alias("n"))
    return rows.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), F.col("best.start").cast("long").alias("start"), F.col("n").cast("long").alias("n_windows"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows whose text holds a benchmark passage; all columns as they are."""
    bad = Scratch(docs.sparkSession, "bad").keep(leaks(docs.select("text"), benchmark).select(F.col("t").alias("_rf_t")).distinct(), "texts")
    return docs.join(maybe_broadcast(bad, bad.count(), 24), digest("text") == F.col("_rf_t"), "left_anti")
