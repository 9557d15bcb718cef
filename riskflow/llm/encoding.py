"""Token ids of whole texts through a tokenizers file.

A text is cut before each single space that follows a non-space character. Such a place is always a border
between pre-tokens, both for byte-level files, which keep the space with the next word, and for files that drop
white space; so the ids of a text are the ids of its chunks in order, and each distinct chunk is encoded once.
Chunks are cut again beside marks and line feeds, so that a word is encoded once whatever follows it.
Texts that have a space after another white-space character are cut by a slower rule with the same property.
Texts that hold the string of a special token go to the library whole, which gives them that token's id.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np

from .shared import ragged, tidy

_CUT = re.compile(r"(?<=\S)(?= )")
#: Borders inside a chunk: between a letter and one of these marks, and between a lone line feed and a letter.
_INNER = re.compile(r"(?<=[^\W\d_])(?=[.,!?;:\n])|(?<=\S\n)(?=[^\W\d_])")
_IRREGULAR = 0


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Codes(dict):
    """chunk -> code; makes new chunks known to `owner`."""

    def __init__(self, owner, prefix):
        super().__init__()
        self.owner, self.prefix = owner, prefix

    def __missing__(self, chunk):
        if self.prefix and (not chunk or chunk[-1].isspace()):
            code = _IRREGULAR
        else:
            code = self.owner.chunk(self.prefix + chunk)
        self[chunk] = code
        return code


class ChunkEncoder:
    """Encodes batches of texts; memory is bounded by about `limit` distinct chunks, after which the cache starts anew."""

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        kind = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (kind["normalizer"] or {}).get("normalizers", [])]
        self.model = self.tokenizer.model
        self.model._resize_cache(0)
        self.lower = steps == ["NFC", "Replace", "Lowercase"]
        self.direct = "ByteLevel" in json.dumps(kind["pre_tokenizer"]) and (self.lower or kind["normalizer"] is None)
        self._reset()

    def release(self) -> None:
        """Gives the memory of a well-filled cache back, as at the end of a task, after which the worker may sit idle."""
        if self.count > self.limit // 4:
            self._reset()
            tidy()

    def _reset(self):
        self.spaced, self.plain = _Codes(self, " "), _Codes(self, "")
        self.pending, self.pending_codes, self.joined, self.joined_codes, self.count, self.used = [], [], [], [], 1, 0
        self.whole, self.whole_codes = [], []
        self.start, self.length, self.pool = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.uint32)

    def new_code(self) -> int:
        self.count += 1
        return self.count - 1

    def text(self, text: str) -> int:
        """The code of a whole text, which isn't remembered."""
        self.whole.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.whole_codes.append(self.new_code())
        return self.whole_codes[-1]

    def chunk(self, text: str) -> int:
        """The code of a chunk; its ids come from its parts if it has several, else from the vocabulary, before the next use."""
        parts = _INNER.split(text)
        if len(parts) == 1:
            code = self.new_code()
            self.pending.append(text)
            self.pending_codes.append(code)
            return code
        self.joined.append(" ".join([str(self.spaced[x[1:]] if x[0] == " " and not x[-1].isspace() else self.plain[x]) for x in parts if x]))
        self.joined_codes.append(self.new_code())
        return self.joined_codes[-1]

    def _ids(self, piece: str) -> list[int]:
        """A piece of letters, with a space before it or not, is one pre-token and goes to the model at once."""
        word = piece.removeprefix(" ")
        if self.direct and word.isalpha():
            if not self.lower:
                return [x.id for x in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
            if (word := unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()).isalpha():  # no final form
                return [x.id for x in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _store(self, codes: list[int], lengths: np.ndarray, ids: np.ndarray):
        while self.count > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(ids)] = ids
        self.length[codes] = lengths
        self.start[codes] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)

    def _encode_pending(self):
        if self.whole:
            self._store(self.whole_codes, np.array([len(x) for x in self.whole]), np.fromiter(chain.from_iterable(self.whole), np.uint32))
            self.whole, self.whole_codes = [], []
        if self.pending:
            encoded = [self._ids(x) for x in self.pending]
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self._store(self.pending_codes, lengths, np.fromiter(chain.from_iterable(encoded), np.uint32, int(lengths.sum())))
        if self.joined:
            counts = np.fromiter((x.count(" ") + 1 for x in self.joined), np.int64, len(self.joined))
            parts = np.array(" ".join(self.joined).split(" "), np.int64)
            lengths = self.length[parts]
            self._store(self.joined_codes, np.add.reduceat(lengths, np.cumsum(counts) - counts), self.pool[ragged(self.start[parts], lengths)])
        self.pending, self.pending_codes, self.joined, self.joined_codes = [], [], [], []

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by `end`, and the number of ids of each text. None counts as empty."""
        if self.count > 2 * self.limit:
            self._reset()
        plain, spaced = self.plain, self.spaced.__getitem__
        own, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text and any(x in text for x in self.special):
                own.append(self.text(text))
                counts[i] = 1
                continue
            parts = (text or "").split(" ")
            counts[i] = len(parts)
            own.append(plain[parts[0]] if len(parts) == 1 or not parts[0][-1:].isspace() else _IRREGULAR)
            own += map(spaced, parts[1:])
        codes = np.asarray(own, np.int64)
        if (codes == _IRREGULAR).any():
            odd = np.unique(np.searchsorted(np.cumsum(counts), np.flatnonzero(codes == _IRREGULAR), side="right"))
            parts = np.split(codes, np.cumsum(counts)[:-1])
            for i in odd.tolist():
                parts[i] = np.asarray([plain[x] for x in _CUT.split(texts[i])], np.int64)
                counts[i] = len(parts[i])
            codes = np.concatenate(parts)
        self._encode_pending()
        lengths = self.length[codes]
        ids = self.pool[ragged(self.start[codes], lengths)]
        if not len(texts):
            return ids, counts
        per_text = np.add.reduceat(lengths, np.cumsum(counts) - counts)
        return np.insert(ids, np.cumsum(per_text), np.uint32(end)), per_text + 1


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process and file."""
    return ChunkEncoder(path)


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
