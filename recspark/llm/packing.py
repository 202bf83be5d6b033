"""Operator 2: vector bin packing of documents into training sequences.

Every example is a vector of three sizes: tokens, segments (1) and loss-bearing tokens
(all of them where `loss` holds, else none).  A sequence is filled under all three limits at
once: of the waiting examples that fit, the one with the largest dot product of its vector
and the sequence's remaining room (each relative to its limit) is placed, until none fits;
then the one with the largest dot product is cut to fill the room that is left and its rest
goes on waiting.  A sequence that closes below the full length is cut into lengths that
are powers of two, so that it needs no padding.

A task packs its own partition in one pass (`mapInArrow`, no shuffle): it holds at most
``WAITING`` examples, each shorter than a sequence (whole sequences of long documents leave
at once), and what waits is carried over batches, so a task has one unfilled sequence at its
end.  Sequence ids are (partition, number), so a repeated task gives the same ids.

Token ids come from the vocabulary file.  Usual texts are cut into the vocabulary's pieces, all
others at blanks, which no piece crosses; the ids of a part are remembered within a task
(emptied when full, which changes no result).

Defined results: a null text is the empty text and consists of the end id alone; repeated
rows are packed each on its own; an empty table gives no rows; other columns are ignored and
may have any name.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

MAX_TOKENS = 2048
MAX_SEGMENTS = 512
MAX_LOSS = 2048
END_ID = 1
WAITING = 256
MEMORY = 200_000
#: Letters that need no composition and whose lower case is one letter: texts of these, ASCII
#: and common blanks fall into the vocabulary's pieces by one pattern.
_LOWER = "a-zß-öø-ÿā-įı-ſ"
_UNUSUAL = re.compile(f"[^\t\n\r -~À-ÖØ-öø-įı-ſ]")
_PIECE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LOWER}]+|[0-9]|[^\t\n\r 0-9{_LOWER}]+")
_CORE = re.compile(f"[{_LOWER}]{{1,32}}")      # longer words would take many rounds of merges
_WORD_END = "</w>"


class Merges:
    """The byte-pair merges of many words at once: in a round every word makes its merge of lowest
    rank, the leftmost of equal ones, until no word has any."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.none = len(key)
        self.rank = np.append(np.argsort(key, kind="stable"), self.none)
        self.key = np.append(key[self.rank[:-1]], np.iinfo(np.int64).max)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # a byte's letter: itself if it is visible in Latin-1, else one from 256 on
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in seen)}
        self.inner, self.last = (np.array([vocab[letter[b] + end] for b in range(256)], np.int64) for end in ("", _WORD_END))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], self.none)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (none empty) in their order, and where each word's begin."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        start = np.cumsum(size) - size
        symbol = np.frombuffer(b"".join(raw), np.uint8)
        end = start + size - 1
        symbol, tail = self.inner[symbol], self.last[symbol[end]]
        symbol[end] = tail
        word = np.repeat(np.arange(len(raw)), size)
        rank = np.append(self._ranks(symbol[:-1], symbol[1:]), self.none)
        rank[end] = self.none
        while True:
            best = np.minimum.reduceat(rank, start)
            at = np.flatnonzero((rank == best[word]) & (rank < self.none))
            if not len(at):
                return symbol, start
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])]
            symbol[at] = self.made[rank[at]]
            ends = np.append(word[1:] != word[:-1], True)[at + 1]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            at -= np.arange(len(at))
            rank[at] = self.none
            right, left = at[~ends], at[(at > 0) & (word[at] == word[at - 1])]
            rank[right] = self._ranks(symbol[right], symbol[right + 1])
            rank[left - 1] = self._ranks(symbol[left - 1], symbol[left])


class WordIds:
    """Ids of texts under a vocabulary whose pieces never hold white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_WORD_END)]] = True
        self.merges = Merges(json.loads(self.library.to_str())["model"])
        self.parts: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn_cores(self, cores: list[str]) -> None:
        """Purely alphabetic words, each one piece: encoded as one text, cut at word ends."""
        for k in range(0, len(cores), 2000):
            part = cores[k:k + 2000]
            ids = np.asarray(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                raw, at = ids.tobytes(), 0
                for word, e in zip(part, (ends * 4).tolist()):
                    self.parts[word] = raw[at:e]
                    at = e
            else:
                self.parts.update(zip(part, self._encode(part)))

    def _merge_cores(self, cores: list[str]) -> None:
        """Short words of lower-case letters that need no composition, as many at once as a core's cache holds."""
        for k in range(0, len(cores), 2000):
            part = cores[k:k + 2000]
            ids, start = self.merges.of(part)
            raw, cut = ids.astype("<u4").tobytes(), [*(start * 4).tolist(), len(ids) * 4]
            self.parts.update(zip(part, [raw[a:b] for a, b in zip(cut, cut[1:])]))

    def _known(self, parts: set[str]) -> None:
        """Learns the ids of the parts that are not known yet."""
        if len(self.parts) >= MEMORY:
            self.parts.clear()
        new = parts.difference(self.parts)
        core = list(filter(_CORE.fullmatch, new))
        if core:
            self._merge_cores(core)
            new.difference_update(core)
        # a purely alphabetic part is one piece, if lower case and composition leave it so
        plain = [w for w in new if w.isalpha() and (w.isascii() or w.lower().isalpha() and unicodedata.is_normalized("NFC", w))]
        self._learn_cores(plain)
        other = list(new.difference(plain))
        self.parts.update(zip(other, self._encode(other)))

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        cut = []
        for t in batch:
            if _UNUSUAL.search(t) or "<|" in t:
                cut.append(t.replace("\n", " ").split(" "))
            else:
                cut.append(_PIECE.findall(t.lower()))
        self._known(set(chain.from_iterable(cut)))
        get = self.parts.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), "<u4") for c in cut]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def powers_of_two(total: int, full: int) -> list[int]:
    """Lengths that need no padding: one full sequence, or the powers of two that make up ``total``."""
    return [total] if total == full else [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1]


class Packer:
    """Fills one task's sequences; `out` holds the pieces that are placed for good."""

    def __init__(self, first_id: int, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS):
        self.next_id, self.limits = first_id, np.array([max_tokens, max_segments, max_loss], float)
        self.out: list[tuple] = []
        self.docs: dict[int, tuple] = {}   # waiting examples: slot -> (doc_id, ids, start)
        self.size = np.zeros((3, 2 * WAITING))
        self.free = list(range(2 * WAITING))

    def _close(self, pieces: list[tuple]) -> None:
        total = sum(p[3] for p in pieces)
        lengths, at = powers_of_two(total, int(self.limits[0])), 0
        room = lengths[0]
        for doc_id, ids, start, length in pieces:
            while length:
                take = min(length, room)
                self.out.append((doc_id, start, take, zlib.crc32(ids[start:start + take].tobytes()), len(ids), self.next_id, lengths[0] - room))
                start, length, room = start + take, length - take, room - take
                if not room:
                    self.next_id += 1
                    lengths = lengths[1:]
                    room = lengths[0] if lengths else 0

    def add(self, doc_id, ids: np.ndarray, loss: bool) -> None:
        step = int(min(self.limits[0], self.limits[2]) if loss else self.limits[0])
        start = 0
        while len(ids) - start >= step:
            self._close([(doc_id, ids, start, step)])
            start += step
        if start < len(ids):
            slot = self.free.pop()
            self.docs[slot] = (doc_id, ids, start)
            n = len(ids) - start
            self.size[:, slot] = n, 1, n if loss else 0
            if len(self.docs) >= 2 * WAITING - 1:
                self.fill(WAITING)

    def fill(self, until: int) -> None:
        """Closes sequences until at most ``until`` examples wait."""
        size, limits = self.size, self.limits
        while len(self.docs) > until:
            room, pieces = limits.copy(), []
            slots = np.fromiter(self.docs, int, len(self.docs))
            mine = size[:, slots]
            rel = mine / limits[:, None]
            waits = np.ones(len(slots), bool)
            while room.min() > 0 and waits.any():
                score = np.where(waits, (room / limits) @ rel, -1.0)
                fits = np.where((mine <= room[:, None]).all(axis=0), score, -1.0)
                k = int(fits.argmax())
                if fits[k] >= 0:
                    length = int(mine[0, k])
                else:
                    k = int(score.argmax())
                    length = int(min(room[0], room[2]) if mine[2, k] else room[0])
                doc_id, ids, start = self.docs[slots[k]]
                pieces.append((doc_id, ids, start, length))
                room -= (length, 1, length if mine[2, k] else 0)
                if length == mine[0, k]:
                    waits[k] = False
                    del self.docs[slots[k]]
                    self.free.append(int(slots[k]))
                else:
                    self.docs[slots[k]] = (doc_id, ids, start + length)
                    mine[0, k] -= length
                    mine[2, k] -= length if mine[2, k] else 0
                    rel[:, k] = mine[:, k] / limits
                    size[:, slots[k]] = mine[:, k]
            self._close(pieces)


_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", loss: Column | None = None,
         max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.
    ``loss`` says which rows bear loss (all by default); a null is no."""
    names = [f.split()[0] for f in _OUT.split(", ")]

    def rows(packer: Packer) -> pa.RecordBatch:
        cols = list(zip(*packer.out)) or [()] * len(names)
        packer.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(vocabulary)
        packer = Packer(TaskContext.get().partitionId() << 40, max_tokens, max_segments, max_loss)
        end = np.array([end_id], "<u4")
        for batch in slices(batches, 256):
            ids, text, bears = (c.to_pylist() for c in batch.columns)
            for doc_id, got, b in zip(ids, words.encode([t or "" for t in text]), bears):
                packer.add(doc_id, np.concatenate([got, end]), b)
            if packer.out:
                yield rows(packer)
        words.parts.clear()      # a worker waits for its next task without them
        packer.fill(0)
        if packer.out:
            yield rows(packer)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         (F.lit(True) if loss is None else F.coalesce(loss, F.lit(False))).alias("loss"))
    return picked.mapInArrow(run, _OUT)
