"""Toxicity scores over text that a noisy-channel decoder has restored.

1. A character trigram model is counted over all documents.
2. Obfuscated tokens - letters written as look-alike digits or signs, letters spaced or dotted out, letters repeated
   three times or more, letters masked by a star - become lattices of the letters that each sign may stand for;
   Viterbi decoding under the trigram model picks the likeliest word. Other tokens have a single path and stay.
3. Each restored word, and each n-gram of it (of 4 to 7 characters, the word's borders counted), has the smoothed share
   of toxic documents among the labelled documents with it; a document's score is the largest of these shares.

Labels are learned from a bounded sample of labelled rows, `SAMPLE` at most, picked by a hash of doc_id; documents
with the same smallest hash of three words count once there, so that a group of copies doesn't make its own words look toxic.
Statistics of the character model cover all documents. What reaches the driver is bounded by the size of the trigram
table and by the number of n-grams of the sample that mark toxic text.

Nulls and odd input: null and empty text has the lowest score; a null label teaches nothing; contradicting labels of a
doc_id count as toxic; without labels every score is the lowest; repeated rows are scored each; other columns of the
input are kept by `score` and never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import FlatTexts, PrefixHash, char_class, char_hash
from .shared import Scratch, mix, slices

#: Most labelled rows that the classifier is fitted on.
SAMPLE = 20_000
#: Tokens of up to so many characters are remembered with their decoding.
REMEMBERED = 64
#: A longer run of masks stands for no word.
MOST_MASKS = 3
#: Sizes of the tables of character trigrams, bigrams and single characters.
TRIGRAMS, BIGRAMS, UNIGRAMS = 1 << 18, 1 << 14, 1 << 12
#: Lengths of n-grams, borders counted.
SIZES = (4, 5, 6, 7)
#: Weight of the overall share of toxic documents in an n-gram's share, in documents.
PRIOR_DOCS = 6.0
#: Share of toxic documents, unsmoothed, from which an n-gram is evidence; pieces that toxic words share with others fall below.
LEAST_SHARE = 0.96
#: The same for whole words, which share no pieces; a few labels are wrong.
LEAST_WORD_SHARE = 0.85
LOWEST = 0.01

#: The letters that a sign may stand for. A star stands for any letter.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
MASKS = "*#"
ANY = "abcdefghijklmnopqrstuvwxyz"

#: Mean log probability of a restored character below which a token is taken for no word (a key, a number) and stays.
LEAST_LOG = -4.0

_SIGN = re.escape("".join(LOOKALIKES) + MASKS)
_EDGE = r"0-9@$€"
_SPACED = re.compile(rf"(?<![^\s])(?:[^\W_]|[{_SIGN}])(?:[ ._\-](?:[^\W_]|[{_SIGN}])){{2,}}(?![^\s.,;:?])")
_MIXED = re.compile(rf"(?<![^\W\d_])(?=[^\W\d_]*[{_SIGN}])(?:[^\W\d_]|[{_EDGE}])(?:[^\W\d_]|[{_SIGN}])*(?:[^\W\d_]|[{_EDGE}])")
_WORD = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_DOTTED = re.compile(r"[ ._\-]")
_MASKED = re.compile(rf"[{re.escape(MASKS)}]{{{MOST_MASKS + 1}}}")


def _trigram(a, b, c):
    return mix((a.astype(np.uint64) << np.uint64(42)) ^ (b.astype(np.uint64) << np.uint64(21)) ^ c) >> np.uint64(46)


def _bigram(b, c):
    return mix((b.astype(np.uint64) << np.uint64(21)) ^ c) >> np.uint64(50)


def _unigram(c):
    return mix(c.astype(np.uint64)) >> np.uint64(52)


def _letters(flat: FlatTexts) -> np.ndarray:
    """The characters, 0 for all but letters; the sequence has a 0 at its end."""
    return np.where(char_class("alpha")[flat.codes], flat.codes, 0).astype(np.uint32)


def _count_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    three, two, one = np.zeros(TRIGRAMS, np.int64), np.zeros(BIGRAMS, np.int64), np.zeros(UNIGRAMS, np.int64)
    for batch in slices(batches):
        c = np.concatenate([np.zeros(2, np.uint32), _letters(FlatTexts(batch.column("text").to_pylist()))])
        before, last, own = c[:-2], c[1:-1], c[2:]
        keep = (last | own) > 0
        last, own = last[keep], own[keep]
        before = np.where(last > 0, before[keep], 0)
        three += np.bincount(_trigram(before, last, own).view(np.int64), minlength=TRIGRAMS)
        two += np.bincount(_bigram(last, own).view(np.int64), minlength=BIGRAMS)
        one += np.bincount(_unigram(last).view(np.int64), minlength=UNIGRAMS)
    both = np.concatenate([three, two, one])
    at = np.flatnonzero(both)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at])], names=["bucket", "n"])


class CharModel:
    """log P(c | a, b) from the hashed counts; 0 is a word's border."""

    def __init__(self, counts: np.ndarray):
        self.three, self.two, self.one = np.split(counts, [TRIGRAMS, TRIGRAMS + BIGRAMS])
        self.cached = lru_cache(1 << 16)(self._log)

    def _log(self, a: str, b: str, c: str) -> float:
        x, y, z = (np.array([ord(i) if i else 0], np.uint64) for i in (a, b, c))
        last = self.one[int(_unigram(y)[0])]
        context = self.two[int(_bigram(x, y)[0])] if b else last
        backoff = (self.two[int(_bigram(y, z)[0])] + 0.05) / (last + 2.0)
        return math.log((self.three[int(_trigram(x, y, z)[0])] + 5.0 * backoff) / (context + 5.0))


def lattice(token: str) -> list[list[str]]:
    """The strings that each part of a token may stand for, in order."""
    out, i = [], 0
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        letters = LOOKALIKES.get(token[i], ANY if token[i] in MASKS else token[i])
        repeat = j - i
        out.append([x * n for x in letters for n in ((1, 2) if repeat >= 3 else (repeat,))])
        i = j
    return out


class Restorer:
    """Restores the obfuscated tokens of lower-case texts."""

    def __init__(self, model: CharModel):
        self.model, self.remembered = model, lru_cache(1 << 14)(self._decode)

    def decode(self, token: str) -> str:
        return self.remembered(token) if len(token) <= REMEMBERED else self._decode(token)

    def _decode(self, token: str) -> str:
        """The likeliest path through the token's lattice; exact, as the state is the last two characters. Each step keeps a
        back pointer for each state, so time and memory follow the token's length."""
        if _MASKED.search(token):
            return token
        best, steps = {("", ""): 0.0}, []
        log = self.model.cached
        for choices in lattice(token):
            nxt: dict = {}
            came: dict = {}
            for state, score in best.items():
                for s in choices:
                    p, (x, y) = score, state
                    for c in s:
                        p, x, y = p + log(x, y, c), y, c
                    if (x, y) not in nxt or p > nxt[x, y]:
                        nxt[x, y], came[x, y] = p, (state, s)
            best = nxt
            steps.append(came)
        p, state = max((p + log(*state, ""), state) for state, p in best.items())
        out = []
        for came in reversed(steps):
            state, s = came[state]
            out.append(s)
        text = "".join(reversed(out))
        return text if p >= LEAST_LOG * (len(text) + 1) else token

    def _joined(self, match: re.Match) -> str:
        word = _DOTTED.sub("", match[0])
        text = self.decode(word)
        return match[0] if text == word and not _WORD.fullmatch(word) else text

    def __call__(self, text: str) -> str:
        text = _SPACED.sub(self._joined, text)
        text = _MIXED.sub(lambda m: m[0] if _WORD.fullmatch(m[0]) or m[0].isdigit() else self.decode(m[0]), text)
        return _WORD.sub(lambda m: self.decode(m[0]) if _TRIPLE.search(m[0]) else m[0], text) if _TRIPLE.search(text) else text


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[ord(c) for c in [*LOOKALIKES, *MASKS]]] = True
    return out


def suspicious(flat: FlatTexts) -> np.ndarray:
    """Whether each text has a place where a token may be obfuscated: a superset of what the restorer's patterns match."""
    c = flat.codes
    letter, sign = char_class("letter")[c], _signs()[c]
    digit, own = (c >= ord("0")) & (c <= ord("9")), letter | sign
    edge = sign & ~np.isin(c, [ord(x) for x in "!|+*#"])
    at = np.zeros(len(c), bool)
    # A token with signs holds neighbours that are neither both letters nor both digits; signs that can't end it lie inside.
    ends = letter | edge
    at[1:] |= ends[1:] & ends[:-1] & ~(letter[1:] & letter[:-1]) & ~(digit[1:] & digit[:-1])
    at[2:] |= own[:-2] & (sign & ~edge)[1:-1] & own[2:]
    at[2:] |= letter[2:] & (c[2:] == c[1:-1]) & (c[1:-1] == c[:-2])
    if len(c) > 4:  # three single characters with gaps
        gap = np.isin(c, [ord(x) for x in " ._-"])
        at[4:] |= own[4:] & gap[3:-1] & own[2:-2] & gap[1:-3] & own[:-4]
    return np.add.reduceat(at, flat.start) > 0 if len(flat.start) else at[:0]


def restored(texts: list[str | None], restore: Restorer) -> FlatTexts:
    flat = FlatTexts(texts)
    odd = np.flatnonzero(suspicious(flat))
    if not len(odd):
        return flat
    texts = list(texts)
    for i in odd.tolist():
        texts[i] = restore(texts[i].lower())
    return FlatTexts(texts)


def features(flat: FlatTexts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, one after the other: the hashes of the n-grams inside a word with its borders, and where they start; at
    last those of whole words with both borders. A border is a 0."""
    c = np.concatenate([np.zeros(1, np.uint32), _letters(flat)])
    hashes, gaps = PrefixHash(char_hash()[c]), np.concatenate([np.zeros(1, np.int32), np.cumsum(c == 0, dtype=np.int32)])
    for n in SIZES:
        if len(c) >= n:
            inner = gaps[n - 1 : len(c)] - gaps[1 : len(c) - n + 2]
            at = np.flatnonzero(inner == 0)
            yield hashes.windows(n)[at], np.maximum(at - 1, 0)
    start, end = flat.words("alpha")
    long = end - start + 2 > max(SIZES)
    yield hashes.ranges(start[long], end[long] + 2), start[long]


@dataclass
class Model:
    """counts: of characters, for the decoder. keys, shares: n-grams that mark toxic text."""

    counts: np.ndarray
    keys: np.ndarray
    shares: np.ndarray


def char_counts(docs: DataFrame) -> np.ndarray:
    rows = docs.select("text").mapInArrow(_count_chars, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(TRIGRAMS + BIGRAMS + UNIGRAMS)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy()
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic); labels of rows for which `learn` isn't true aren't used."""
    counts = char_counts(docs)
    chars = docs.sparkSession.sparkContext.broadcast(counts)
    known = labels.select("doc_id", "toxic").filter(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded, so it may be broadcast

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat = FlatTexts(batch.column("text").to_pylist())
            start, end = flat.words("alpha")
            least = np.full(batch.num_rows, np.iinfo(np.int64).max)
            if len(start):
                doc, words = flat.doc_of(start), PrefixHash(flat.hashes().ranges(start, end))
                np.minimum.at(least, doc, words.windows(1).view(np.int64) // 2)  # of texts under three words
                three = words.windows(3).view(np.int64)
                same = doc[2:] == doc[: len(three)]
                least[doc[2:][same]] = np.iinfo(np.int64).max
                np.minimum.at(least, doc[2:][same], three[same])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("toxic"), pa.array(least)], names=["doc_id", "text", "toxic", "least"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(CharModel(chars.value))
        for batch in slices(batches):
            flat, toxic = restored(batch.column("text").to_pylist(), restore), batch.column("toxic").to_numpy() > 0
            for size, (keys, at) in enumerate(features(flat)):
                doc = flat.doc_of(at)
                order = np.lexsort((doc, keys))
                keys, doc = keys[order], doc[order]
                once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])[: len(keys)]
                keys, bad = keys[once], toxic[doc[once]]
                first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
                if len(first):
                    hits, total = np.add.reduceat(bad.astype(np.int64), first), np.diff(np.append(first, len(keys)))
                    yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(hits), pa.array(total), pa.array(np.full(len(first), size == len(SIZES)))], names=["key", "hits", "total", "word"])

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").mapInArrow(sign, "doc_id long, text string, toxic int, least long")
    rows = rows.groupBy("least", "toxic").agg(F.min_by("text", "doc_id").alias("text")).select("text", "toxic")
    rows = Scratch(docs.sparkSession, "toxicity").keep(rows, "sample")
    share = rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    total = rows.mapInArrow(count, "key long, hits long, total long, word boolean").groupBy("key", "word").agg(F.sum("hits").alias("hits"), F.sum("total").alias("total"))
    least = F.when(F.col("word"), LEAST_WORD_SHARE).otherwise(LEAST_SHARE)
    found = total.filter((F.col("hits") >= 3) & (F.col("hits") >= least * F.col("total"))).select("key", ((F.col("hits") + PRIOR_DOCS * share) / (F.col("total") + PRIOR_DOCS)).alias("share")).orderBy("key").toPandas()
    keys = found["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(counts, keys[order], found["share"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a score column; all other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != name]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col("text").alias("_rf_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + f", `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        restore = Restorer(CharModel(own.counts))
        bits = np.zeros(1 << 20, bool)
        bits[(own.keys >> np.uint64(44)).astype(np.int64)] = True
        for batch in slices(batches, "_rf_text"):
            flat = restored(batch.column("_rf_text").to_pylist(), restore)
            best = np.full(batch.num_rows, LOWEST)
            for h, at in features(flat) if len(own.keys) else ():
                may = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
                h, at = h[may], at[may]
                k = np.minimum(np.searchsorted(own.keys, h), len(own.keys) - 1)
                hit = own.keys[k] == h
                np.maximum.at(best, flat.doc_of(at[hit]), own.shares[k[hit]])
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(np.minimum(best, 1.0))], names=[*names, name])

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    model = fit(docs, labels, ~held_out())
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
