"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its sequence of words (runs of letters and digits, lower case) and the multiset of its five-word
shingles, each labelled with the number of its occurrence. A sketch takes the `TAKE` smallest labelled shingles under one
hash and keeps them in the order of the text; two documents are candidates if two of `SKETCHES` sketches agree, so a bucket
is a pair of sketches. (Two documents at the least similarity agree in half of the sketches on average, and with
probability 0.9998 in two or more; one agreement alone comes mostly from a passage that many documents share.)
A candidate pair is a near duplicate if the multiset Jaccard similarity of the shingles is 0.8 or more and an
alignment of the words inside a band has at most a fifth of the words unmatched.

Documents with the same words (by a 128-bit digest of them) are collapsed first, so that groups of copies never meet in one
task; each distinct sequence of words is a node with a number of its own, whatever its doc_ids. Each node is compared
with the hub (the smallest member) that it meets most often; the classes that follow leave most buckets with one class,
and these are done. In all other buckets every pair of members is compared unless its ends are in one class already, so
no link between classes is missed. A pair belongs to the first sketch in which it agrees, so one task alone meets it. The
members of a sketch are dealt to blocks of `GROUP` texts and `BLOCK_CHARS` characters at most, on average, and a task
takes two blocks. Rounds end in written tables. Classes are connected components of verified pairs; the class id is the
smallest doc_id.

Nulls and odd input: a null or empty text, or one without words, has the empty sequence; all of these are copies of
each other. Texts of one to four words have one shingle of all their words. Rows that repeat a doc_id keep a row each, each
with the class of its own text; a null doc_id stays null and gives a class no id: a class without any other has a null id.
An empty table gives no row; other columns are not read by `near_duplicates` and kept by `one_of_each`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import FlatTexts, PrefixHash, PrimeHash
from .shared import Scratch, maybe_broadcast, mix, ragged, slices

SHINGLE, TAKE, SKETCHES, LEAST = 5, 3, 16, 0.8
#: Texts, and characters of all texts, of a block.
GROUP, BLOCK_CHARS = 1024, 8 << 20
#: A sketch's hash in a bucket has its band above so many bits.
BAND_BITS = 56
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
SKETCHED = "doc_id long, t binary, h binary, sketches array<long>"


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the text of each."""
    flat = FlatTexts(texts)
    start, end = flat.words("alnum")
    return flat.hashes().ranges(start, end), flat.doc_of(start)


def shingles(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles and the text of each, in order; a text of fewer words has one of all of them."""
    n = len(words)
    if not n:
        return words, doc
    hashes = PrefixHash(words)
    count = np.bincount(doc)
    end_of = np.cumsum(count)
    first = np.arange(n)
    whole = first + SHINGLE <= end_of[doc]
    short = (count[doc] < SHINGLE) & (first == end_of[doc] - count[doc])
    keep = np.flatnonzero(whole | short)
    return hashes.ranges(keep, np.minimum(keep + SHINGLE, end_of[doc[keep]])), doc[keep]


def occurrence(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The number of each shingle among the equal ones of its text, from 0, in the order of the text."""
    both = mix(keys ^ mix(doc.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    s = both[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    out = np.empty(len(s), np.int64)
    at = np.flatnonzero(first)
    out[order] = np.arange(len(s)) - np.repeat(at, np.diff(np.append(at, len(s))))
    return out


def sketch(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(texts with shingles, SKETCHES) hashes of the ordered minima; texts in rising order."""
    items = mix(keys ^ mix(occurrence(keys, doc).astype(np.uint64) + np.uint64(77)))
    have, begin = np.unique(doc, return_index=True)
    group = np.repeat(np.arange(len(have)), np.diff(np.append(begin, len(doc))))
    out = np.zeros((len(have), SKETCHES), np.uint64)
    for k in range(SKETCHES):
        values = mix(items ^ mix(np.array([k + 1], np.uint64)))
        chosen = []
        for _ in range(TAKE):
            least = np.minimum.reduceat(values, begin)
            at = np.flatnonzero((values == least[group]) & (values != _TOP))
            own, where = np.unique(group[at], return_index=True)
            position = np.full(len(have), len(values))
            position[own] = at[where]
            chosen.append(position)
            values[at[where]] = _TOP
        places = np.sort(np.stack(chosen, 1), 1)
        ordered = np.append(items, np.uint64(0))[places]
        h = np.full(len(have), np.uint64(k + 1))
        for j in range(TAKE):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ ordered[:, j])
        out[:, k] = h
    return out


def word_digests(flat: FlatTexts, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """A 128-bit digest of the words of each text."""
    keep = np.zeros(len(flat.codes), bool)
    keep[ragged(start, end - start)] = True
    keep[end] = True  # what follows a word parts it from the next
    codes = np.where(keep, flat.codes, 0).astype("<u4")
    codes[end] = 0
    upto = np.append(0, np.cumsum(keep))
    data, ends = codes[keep].tobytes(), 4 * upto[flat.end + 1]
    return [hashlib.md5(data[a:b]).digest() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        flat, n = FlatTexts(batch.column("text").to_pylist()), batch.num_rows
        start, end = flat.words("alnum")
        keys, own = shingles(flat.hashes().ranges(start, end), flat.doc_of(start))
        rows = np.zeros((n, SKETCHES), np.uint64)
        if len(keys):
            rows[np.unique(own)] = sketch(keys, own, n)
        lists = pa.ListArray.from_arrays(np.arange(0, n * SKETCHES + 1, SKETCHES, dtype=np.int32), pa.array(rows.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), pa.array(word_digests(flat, start, end), pa.binary()), lists], names=["doc_id", "t", "h", "sketches"])


def labelled(words: np.ndarray) -> np.ndarray:
    """The shingles of one text, labelled with their occurrence, so that each is there once."""
    keys, doc = shingles(words, np.zeros(len(words), np.int64))
    return mix(keys ^ mix(occurrence(keys, doc).astype(np.uint64) + np.uint64(77)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset similarity of two texts' shingles, from their word hashes."""
    return similarity(labelled(a), labelled(b))


def unmatched(a: np.ndarray, b: np.ndarray, most: int, few: int = 64) -> int | None:
    """Words of both sequences that the best alignment leaves unmatched; None if over `most`.

    Furthest-reaching points are kept on the diagonals of the band of half-width `most` alone. The first `few` rounds go point
    by point; later ones move all diagonals at once and find how far equal words go by halving, so a round takes a few
    array operations whatever the texts repeat.
    """
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    la, lb = len(a), len(b)
    if not la or not lb:
        return la + lb if la + lb <= most else None
    x_of, y_of = a.tolist(), b.tolist()
    reach = {1: 0}
    for d in range(min(few, most + 1)):
        for k in range(-min(d, lb), min(d, la) + 1):
            if (k + d) % 2:
                continue
            x = max(reach.get(k + 1, -1), reach.get(k - 1, -2) + 1)
            if x < 0 or x > la or x - k > lb or x - k < 0:
                continue
            while x < la and x - k < lb and x_of[x] == y_of[x - k]:
                x += 1
            reach[k] = x
            if x >= la and x - k >= lb:
                return d
    if few > most:
        return None
    first, second, prime_a, prime_b = PrefixHash(a), PrefixHash(b), PrimeHash(a), PrimeHash(b)
    at = np.full(la + lb + 3, -1, np.int64)  # at[k + lb + 1] is the point on diagonal k
    for k, x in reach.items():
        at[k + lb + 1] = x
    steps = [1 << j for j in reversed(range(max(1, min(la, lb)).bit_length()))]
    for d in range(few, most + 1):
        k = np.arange(-min(d, lb), min(d, la) + 1)
        k = k[(k + d) % 2 == 0]
        right = at[k + lb]
        x = np.maximum(at[k + lb + 2], np.where(right >= 0, right + 1, -1))
        good = (x >= 0) & (x <= la) & (x - k <= lb) & (x - k >= 0)
        k, x = k[good], x[good]
        going = np.flatnonzero((x < la) & (x - k < lb))
        going = going[a[x[going]] == b[x[going] - k[going]]]
        for step in steps if len(going) else ():
            near = going[(x[going] + step <= la) & (x[going] - k[going] + step <= lb)]
            p, q = x[near], x[near] - k[near]
            equal = (first.ranges(p, p + step) == second.ranges(q, q + step)) & (prime_a.ranges(p, p + step) == prime_b.ranges(q, q + step))
            x[near[equal]] += step
        at[k + lb + 1] = x
        if ((x >= la) & (x - k >= lb)).any():
            return d
    return None


def aligned(x: np.ndarray, y: np.ndarray) -> bool:
    return unmatched(x, y, int((1 - LEAST) * (len(x) + len(y)))) is not None


def alike(a: str | None, b: str | None) -> bool:
    x, y = word_hashes([a])[0], word_hashes([b])[0]
    return jaccard(x, y) >= LEAST and aligned(x, y)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [alike(a, b) for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], names=["a", "b", "good"])


def _inside(table: pa.Table) -> pa.Table:
    """The near-duplicate pairs that join classes, among the pairs of two blocks (or inside one) whose first common sketch is x.

    All pairs with a member are counted at once, by the shingles that they share; pairs whose ends have become one class here are skipped.
    """
    table = table.combine_chunks()
    ids, second = table["rep"].to_numpy(), table["second"].to_numpy()
    order = np.lexsort((ids, second))
    ids, second = ids[order], second[order]
    label, n = table["label"].to_numpy()[order].tolist(), len(ids)
    own = table["s"].to_pylist()
    bands = np.full((n, SKETCHES), -1, np.int64)
    for row, at in enumerate(order.tolist()):
        values = np.array(own[at], np.int64)
        bands[row, values >> BAND_BITS] = values
    band = int(table["x"][0].as_py()) >> BAND_BITS
    words, doc = word_hashes(table["text"].take(pa.array(order)).to_pylist())
    keys, doc_of = shingles(words, doc)
    _, keys = np.unique(mix(keys ^ mix(occurrence(keys, doc_of).astype(np.uint64) + np.uint64(77))), return_inverse=True)
    count, end_of = np.bincount(doc_of, minlength=n), np.cumsum(np.bincount(doc, minlength=n))
    start = np.cumsum(count) - count
    text = [words[a:b] for a, b in zip([0, *end_of[:-1]], end_of, strict=True)]
    two, begin = bool(second.any() and not second.all()), int(np.searchsorted(second, True))
    known: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := known.get(x, x)) != x:
            known[x] = known.get(up, up)
            x = up
        return x

    found, mark = [], np.zeros(int(keys.max()) + 1 if len(keys) else 1, bool)
    for i in range(begin if two else n):
        j = np.arange(begin if two else i + 1, n)
        same = (bands[j] == bands[i]) & (bands[i] >= 0)
        j = j[(same.sum(1) > 1) & (same.argmax(1) == band)]
        j = j[np.minimum(count[j], count[i]) >= LEAST * np.maximum(count[j], count[i])]
        mine = root(label[i])
        j = j[np.fromiter((root(label[k]) != mine for k in j.tolist()), bool, len(j))]
        if not len(j):
            continue
        mark[keys[start[i] : start[i] + count[i]]] = True
        both = np.add.reduceat(mark[keys[ragged(start[j], count[j])]].astype(np.int64), np.cumsum(count[j]) - count[j])
        mark[keys[start[i] : start[i] + count[i]]] = False
        for k in j[both / (count[j] + count[i] - both) >= LEAST].tolist():
            a, b = root(label[i]), root(label[k])
            if a != b and aligned(text[i], text[k]):
                known[a] = b
                found.append((max(ids[i], ids[k]), min(ids[i], ids[k])))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _verified(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """pairs (a, b) with `good`. Each text travels once for all its pairs on the side of `b`, once for each pair on that of `a`."""
    left = texts.join(maybe_broadcast(pairs, n, 24), F.col("rep") == F.col("a")).select("a", "b", F.col("text").alias("text_a"))
    right = texts.join(maybe_broadcast(pairs.select(F.col("b").alias("own")).distinct(), n, 16), F.col("rep") == F.col("own")).select("own", F.col("text").alias("text_b"))
    return left.join(right, F.col("b") == F.col("own")).select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, good boolean")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): for each node of the edges (a, b), the smallest node of its component. Each round is written and read again."""
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = scratch.keep(both, f"{name}-links")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    n, step = labels.count(), 0
    while True:
        step += 1
        near = both.join(maybe_broadcast(labels.select(F.col("node").alias("b"), "label"), n, 16), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hop = near.join(maybe_broadcast(labels, n, 16), "node").select("node", "label", F.least("label", "near").alias("low"))
        jump = hop.join(maybe_broadcast(labels.select(F.col("node").alias("low"), F.col("label").alias("far")), n, 16), "low").select("node", F.least("low", "far").alias("new"), "label")
        new = scratch.keep(jump, f"{name}-{step}")
        changed = new.filter("new <> label").limit(1).count()
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, t, label) for each row of docs (doc_id, text): the text's digest and the number of its class."""
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = scratch.keep(docs.withColumn("t", digest("text")).mapInArrow(_sketch_rows, SKETCHED), "sketched")
    # A node for each sequence of words, numbered in a written table, and the text that stands for it.
    nodes = rows.groupBy("h").agg(F.min("t").alias("t"), F.first("sketches").alias("sketches"))
    nodes = scratch.keep(nodes.withColumn("rep", F.monotonically_increasing_id()), "nodes")
    single = nodes.select("rep", F.posexplode("sketches").alias("band", "sketch")).filter("sketch <> 0")
    met = single.groupBy("band", "sketch").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "sketch")
    code = F.shiftleft(F.col("band").cast("long"), BAND_BITS).bitwiseOR(F.xxhash64("sketch").bitwiseAND((1 << BAND_BITS) - 1))
    shared = single.join(met, ["band", "sketch"]).groupBy("rep").agg(F.array_sort(F.collect_list(code)).alias("s")).filter("size(s) > 1")
    shared = scratch.keep(shared, "shared")
    pair = F.flatten(F.transform("s", lambda x: F.transform(F.filter("s", lambda y: y > x), lambda y: F.struct(x.alias("x"), F.xxhash64(x, y).alias("bucket")))))
    buckets = shared.select("rep", F.explode(pair).alias("pair")).select("rep", "pair.x", "pair.bucket")
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hubs = scratch.keep(hubs.select("bucket", "hub"), "hubs")
    members = scratch.keep(buckets.join(maybe_broadcast(hubs, hubs.count(), 24), "bucket"), "members")
    wanted = nodes.select("t", "rep").join(maybe_broadcast(members.select("rep").distinct(), members.count(), 16), "rep")
    wanted = scratch.keep(wanted, "wanted")
    texts = docs.select(digest("text").alias("t"), "text").join(maybe_broadcast(wanted, wanted.count(), 48), "t").dropDuplicates(["rep"]).select("rep", "text")
    texts = scratch.keep(texts, "texts")
    # First, each node with the hub that it meets most often; most other pairs then need no look.
    pairs = members.filter("rep <> hub").groupBy(F.col("rep").alias("a"), F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    pairs = scratch.keep(pairs.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b")), "pairs")
    labels = None
    if n := pairs.count():
        good = scratch.keep(_verified(pairs, texts, n), "verified").filter("good").select("a", "b")
        labels = components(good, scratch, "labels-hubs")
        more = scratch.keep(_between(members, labels, shared, texts, scratch), "between")
        if more.limit(1).count():
            labels = components(good.union(more).distinct(), scratch, "labels")
    if labels is None:
        found = nodes.select("h", F.col("rep").alias("label"))
    else:
        found = nodes.join(labels, F.col("rep") == F.col("node"), "left").select("h", F.coalesce("label", "rep").alias("label"))
    found = scratch.keep(rows.select("doc_id", "t", "h").join(found, "h").select("doc_id", "t", "label"), "classes")
    for name in ("sketched", "shared", "members", "texts"):
        scratch.drop(name)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id for each row of docs (doc_id, text)."""
    own = classes(docs)
    ids = own.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return own.select("doc_id", "label").join(ids.hint("merge"), "label").select("doc_id", "class_id")


def _between(members: DataFrame, labels: DataFrame, shared: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Verified pairs (a, b) between the classes that meet in a bucket; a text without links is its own class."""
    known = maybe_broadcast(labels.select(F.col("node").alias("rep"), "label"), labels.count(), 16)
    own = members.join(known, "rep", "left").select("rep", "x", "bucket", F.coalesce("label", "rep").alias("label"))
    open_ = own.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    open_ = scratch.keep(open_, "open")
    left = own.join(maybe_broadcast(open_, open_.count(), 16), "bucket").select("x", "rep", "label").distinct()
    left = scratch.keep(left.join(texts.select("rep", F.length("text").alias("chars")), "rep"), "left")
    blocks = left.groupBy("x").agg(F.ceil(F.greatest(F.count(F.lit(1)) / max(GROUP, 1), F.sum("chars") / BLOCK_CHARS, F.lit(1))).cast("int").alias("blocks"))
    blocks = scratch.keep(blocks, "blocks")
    dealt = left.join(maybe_broadcast(blocks, blocks.count(), 12), "x").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("x", "rep", "label", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("second"))
    return dealt.join(texts.join(shared, "rep").select("rep", "text", "s"), "rep").groupBy("x", "lo", "hi").applyInArrow(_inside, "a long, b long").distinct()


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, that with the smallest doc_id (a null counts as the largest); of equal rows, one."""
    own = classes(docs)
    scratch = Scratch(docs.sparkSession, "chosen")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("best")
    chosen = scratch.keep(own.groupBy("label").agg(best).select(F.col("best.doc_id").alias("_rf_id"), F.col("best.t").alias("_rf_t")), "rows")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_rf_id")) & (digest("text") == F.col("_rf_t"))
    left = docs.join(maybe_broadcast(chosen, chosen.count(), 40), same, "left_semi").withColumn("_rf_t", digest("text"))
    twice = own.groupBy(F.col("doc_id").alias("_rf_id"), F.col("t").alias("_rf_own")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    twice = scratch.keep(twice, "twice")
    again = F.col("doc_id").cast("long").eqNullSafe(F.col("_rf_id")) & (F.col("_rf_t") == F.col("_rf_own"))
    side = maybe_broadcast(twice, twice.count(), 40)
    once = left.join(side, again, "left_anti").unionByName(left.join(side, again, "left_semi").dropDuplicates(["doc_id", "_rf_t"]))
    return once.select(*docs.columns)
