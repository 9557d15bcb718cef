"""Language identification by unigram pieces, summed over all segmentations.

A text counts as its words (runs of letters, lower case), each with the mark of a word's start before it. For each
language, every piece of a fixed public vocabulary has a probability; the probability of a word is the sum, over all
ways of cutting it into pieces, of the product of the pieces' probabilities, which the forward algorithm gives. Pieces
never cross a word, so the sum over all segmentations of a text is the product over its words.

Piece counts start from how often each piece occurs in the words of a language, wherever it lies, and are then
re-estimated once by expected counts over all segmentations (forward and backward). All labelled rows are counted.
What reaches the driver has a row for each language and piece at most, however large the corpus is.

Nulls and odd input: null text, or text without letters, is `und` with score 0; a null label teaches nothing; without
any label every text is `und`; letters that no piece covers get a small probability, the same in all languages; ties go
to the language that sorts first; repeated rows are counted and predicted each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import FlatTexts, PrefixHash, char_hash
from .shared import ragged, slices

#: Probability of a single letter that the language's pieces don't have.
FLOOR = 1e-9
#: Words up to so many characters are scored side by side, longer ones one by one.
SIDE_BY_SIDE = 24
#: Bytes of text that are cut into words at once.
SLICE = 4 << 20
#: Characters of distinct words that are scored together, and that a worker holds before it scores them.
TOGETHER, MOST = 1 << 20, 8 << 20
COUNTS = "lang string, piece int, n double"
_MARK = ord("▁")


class Pieces:
    """The vocabulary's pieces by length: sorted hashes and piece numbers."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        own = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        # Only pieces of lower-case letters, with the mark before them or not, can occur in a word.
        own = [p for p in own if p == p.lower() and (body := p.removeprefix("▁")).isalpha() or p == "▁"]
        self.size, by = len(own), {}
        for k, p in enumerate(own):
            by.setdefault(len(p), []).append((int(PrefixHash(char_hash()[[ord(c) for c in p]]).windows(len(p))[0]), k))
        self.by = {}
        for n, own in by.items():
            own.sort()
            keys, bits = np.array([h for h, _ in own], np.uint64), np.zeros(1 << 16, bool)
            bits[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.by[n] = (keys, np.array([k for _, k in own], np.int64), bits)

    def match(self, hashes: PrefixHash, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of the places `at` where a piece of n characters begins, and its number."""
        keys, pieces, bits = self.by[n]
        h = hashes.ranges(at, at + n)
        may = np.flatnonzero(bits[(h >> np.uint64(48)).astype(np.int64)])
        h = h[may]
        near = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[near] == h
        return at[may[hit]], pieces[near[hit]]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class Words:
    """Words as characters, the mark before each: from the characters of all and the length of each."""

    def __init__(self, codes: np.ndarray, length: np.ndarray):
        self.n = length + 1
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        flat = np.empty(int(self.n.sum()), np.uint32)
        body = np.ones(len(flat), bool)
        body[self.start] = False
        flat[self.start] = _MARK
        flat[body] = codes
        self.hashes = PrefixHash(char_hash()[flat])

    def occurrences(self, pieces: Pieces) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """For each length: word, flat start and piece of all occurrences of pieces, and the length."""
        word = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(word))
        rest = self.end[word] - at
        for n in sorted(pieces.by):
            at = at[rest[at] >= n]  # no longer piece fits where this one doesn't
            found, piece = pieces.match(self.hashes, at, n)
            yield word[found], found, piece, n


def forward(words: Words, pieces: Pieces, prob: np.ndarray, expected: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each word in each language, (words, languages).

    prob: (pieces, languages). With `expected`, (pieces, languages), each word's expected piece counts times its
    weights, (words, languages), are added to it.
    """
    k, total = prob.shape[1], int(words.n.sum())
    step: dict[int, tuple[np.ndarray, np.ndarray]] = {n: (at, piece) for _, at, piece, n in words.occurrences(pieces)}
    index = {n: np.full(total + 1, pieces.size, np.int32) for n in step}
    for n, (at, piece) in step.items():
        index[n][at] = piece
    index.setdefault(1, np.full(total + 1, pieces.size, np.int32))
    table = np.vstack([prob, np.zeros((1, k))])
    single = np.maximum(table, FLOOR)
    out, used, mass = np.zeros((len(words.n), k)), [], []
    groups = [np.flatnonzero(words.n == n) for n in range(2, SIDE_BY_SIDE + 1)] + [np.array([w]) for w in np.flatnonzero(words.n > SIDE_BY_SIDE)]
    for group in groups:
        if not len(group):
            continue
        start, length = words.start[group], int(words.n[group[0]])
        reach = [n for n in index if n <= length]
        scale = np.zeros((length + 1, len(group), k))  # logs of the forward sums
        if length <= SIDE_BY_SIDE:  # FLOOR ** SIDE_BY_SIDE is still a double
            alpha = np.zeros((length + 1, len(group), k))
            alpha[0] = 1.0
            for i in range(1, length + 1):
                alpha[i] = alpha[i - 1] * single[index[1][start + i - 1]]
                for n in reach:
                    if 1 < n <= i:
                        piece = index[n][start + i - n]
                        has = np.flatnonzero(piece < pieces.size)
                        alpha[i][has] += alpha[i - n][has] * table[piece[has]]
            scale = np.log(alpha)
        else:
            for i in range(1, length + 1):
                value = np.zeros((len(group), k))
                for n in reach:
                    if n <= i:
                        value += np.exp(scale[i - n] - scale[i - 1]) * (single if n == 1 else table)[index[n][start + i - n]]
                scale[i] = scale[i - 1] + np.log(value)
        out[group] = scale[length]
        if expected is None:
            continue
        if length <= SIDE_BY_SIDE:
            beta = np.zeros((length + 1, len(group), k))
            beta[length] = weights[group] / alpha[length]
            for i in range(length - 1, -1, -1):
                for n in reach:
                    if i + n <= length:
                        piece = index[n][start + i]
                        has = np.flatnonzero(piece < pieces.size)
                        if n == 1:
                            ahead = single[piece] * beta[i + 1]
                            beta[i] += ahead
                            ahead = ahead[has]
                        else:
                            ahead = table[piece[has]] * beta[i + n][has]
                            beta[i][has] += ahead
                        used.append(piece[has])
                        mass.append(alpha[i][has] * ahead * (table[piece[has]] > 0))
        else:
            beta = np.full((length + 1, len(group), k), -np.inf)  # logs
            beta[length] = 0.0
            for i in range(length - 1, -1, -1):
                for n in reach:
                    if i + n <= length:
                        piece = index[n][start + i]
                        with np.errstate(divide="ignore"):
                            ahead = np.log((single if n == 1 else table)[piece]) + beta[i + n]
                        beta[i] = np.logaddexp(beta[i], ahead)
                        has = np.flatnonzero(piece < pieces.size)
                        used.append(piece[has])
                        mass.append(np.exp(scale[i][has] + ahead[has] - scale[length][has]) * weights[group][has] * (table[piece[has]] > 0))
    if used:
        piece, value = np.concatenate(used), np.concatenate(mass)
        for lang in range(k):
            expected[:, lang] += np.bincount(piece, value[:, lang], pieces.size)
    return out


def _distinct(flat: FlatTexts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the first occurrence of each, and each word's number among them."""
    return np.unique(flat.hashes().ranges(start, end), return_index=True, return_inverse=True)


def _codes(flat: FlatTexts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of some words, one after the other, and their lengths."""
    return flat.codes[ragged(start, end - start)], end - start


class _Tally:
    """The distinct words of a worker's texts and how often each occurs in each language, until they are taken."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.names, self.keys, self.place = [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.codes, self.length, self.weights, self.chars = [], [], np.zeros((0, 0)), 0

    def add(self, flat: FlatTexts, own: list[str]) -> None:
        start, end = flat.words("alpha")
        if not len(start):
            return
        self.names += sorted(set(own).difference(self.names))
        number_of = {name: k for k, name in enumerate(self.names)}
        lang, k = np.array([number_of[x] for x in own])[flat.doc_of(start)], len(self.names)
        keys, first, number = _distinct(flat, start, end)
        weights = np.bincount(number * k + lang, minlength=len(keys) * k).reshape(-1, k).astype(float)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        old = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~old)
        before = len(self.keys)
        grown = np.zeros((before + len(new), k))
        grown[:before, : self.weights.shape[1]] = self.weights
        grown[self.place[at[old]]] += weights[old]
        grown[before:] = weights[new]
        codes, length = _codes(flat, start[first[new]], end[first[new]])
        self.codes.append(codes)
        self.length.append(length)
        self.chars += len(codes) + len(length)
        both = np.concatenate([self.keys, keys[new]])
        order = np.argsort(both, kind="stable")
        self.keys, self.weights = both[order], grown
        self.place = np.concatenate([self.place, np.arange(before, len(grown))])[order]

    def take(self) -> Iterator[tuple[Words, np.ndarray]]:
        """All words with their weights, in parts of about TOGETHER characters; they are forgotten then."""
        if self.codes:
            codes, length = np.concatenate(self.codes), np.concatenate(self.length)
            end = np.cumsum(length)
            part = np.cumsum(length + 1) // TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(length)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield Words(codes[end[a] - length[a] : end[b - 1]], length[a:b]), self.weights[a:b]
        self.clear()


def _counter(path: str, langs: list[str] | None, prob: np.ndarray | None):
    """Counts pieces by language: occurrences, or expected counts under prob (pieces, languages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total, tally = pieces_of(path), {}, _Tally()

        def count() -> None:
            names = list(tally.names)
            sums = np.zeros((pieces.size, len(names)))
            for words, weights in tally.take():
                if prob is None:
                    for word, _, piece, _ in words.occurrences(pieces):
                        for k in range(len(names)):
                            sums[:, k] += np.bincount(piece, weights[word, k], pieces.size)
                else:
                    forward(words, pieces, prob[:, [langs.index(x) for x in names]], sums, weights)
            for k, name in enumerate(names):
                total[name] = total.get(name, 0) + sums[:, k]

        for batch in slices(batches, most=SLICE):
            tally.add(FlatTexts(batch.column("text").to_pylist()), batch.column("lang").to_pylist())
            if tally.chars > MOST:
                count()
        count()
        for name, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[at])], names=["lang", "piece", "n"])

    return run


def _gather(labelled: DataFrame, path: str, langs: list[str] | None, prob: np.ndarray | None) -> tuple[list[str], np.ndarray]:
    size = pieces_of(path).size
    rows = labelled.mapInArrow(_counter(path, langs, prob), COUNTS).groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = langs or sorted(rows["lang"].unique().tolist())
    sums = np.zeros((size, len(langs)))
    for k, name in enumerate(langs):
        own = rows[rows["lang"] == name]
        sums[own["piece"].to_numpy(), k] = own["n"].to_numpy()
    return langs, sums / np.maximum(sums.sum(0), 1e-300)


def learn(labelled: DataFrame, path: str, rounds: int = 1) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces, languages) from rows (text, lang)."""
    labelled = labelled.select("text", "lang").filter("text is not null and lang is not null")
    langs, prob = _gather(labelled, path, None, None)
    for _ in range(rounds if langs else 0):
        langs, prob = _gather(labelled, path, langs, prob)
    return langs, prob


class _Known:
    """Log probabilities of the words seen so far in this worker, by hash; starts anew beyond `limit`."""

    def __init__(self, k: int, limit: int = 400_000):
        self.limit, self.keys, self.values = limit, np.zeros(0, np.uint64), np.zeros((0, k))

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(self.keys) > self.limit:
            self.keys, self.values = self.keys[:0], self.values[:0]
        keys, values = np.concatenate([self.keys, keys]), np.concatenate([self.values, values])
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)


def predict(docs: DataFrame, langs: list[str], prob: np.ndarray, path: str, keep: list[str | Column]) -> DataFrame:
    """The kept columns with lang_pred and score, the posterior under equal priors."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(prob)
    rows = docs.select(*keep, F.col("text").alias("_rf_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, prob, known = pieces_of(path), model.value, _Known(len(langs))
        names = np.array([*langs, "und"], object)
        for batch in slices(batches, "_rf_text", SLICE):
            n = batch.num_rows
            flat = FlatTexts(batch.column("_rf_text").to_pylist())
            start, end = flat.words("alpha")
            sums, best, score = np.zeros((n, len(langs))), np.full(n, len(langs)), np.zeros(n)
            if len(start) and langs:
                keys, first, number = _distinct(flat, start, end)
                if len(new := np.flatnonzero(known.find(keys) < 0)):
                    words = Words(*_codes(flat, start[first[new]], end[first[new]]))
                    if len(known.keys) > known.limit:  # what is dropped is scored again with the rest
                        known = _Known(len(langs))
                        new = np.arange(len(keys))
                        words = Words(*_codes(flat, start[first], end[first]))
                    known.add(keys[new], forward(words, pieces, prob))
                value = known.values[known.find(keys)][number]
                doc = flat.doc_of(start)
                for k in range(len(langs)):
                    sums[:, k] = np.bincount(doc, value[:, k], n)
                has = np.bincount(doc, minlength=n) > 0
                best[has] = sums[has].argmax(1)
                score[has] = 1 / np.exp(sums[has] - sums[has].max(1, keepdims=True)).sum(1)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=[f.name for f in batch.schema][:-1] + ["lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, path: str, rounds: int = 1) -> DataFrame:
    """Learns from the rows of docs (doc_id, text, lang) that are not held out; predicts all."""
    langs, prob = learn(docs.filter(~held_out()), path, rounds)
    return predict(docs, langs, prob, path, ["doc_id", held_out().alias("held_out")])
