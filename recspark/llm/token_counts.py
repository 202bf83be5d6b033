"""Operator 9: token counts at every prefix by dynamic programming.

For a byte-level BPE the encoding of a piece's prefix is the encoding of a shorter prefix
plus one last token: among the vocabulary tokens that end at a position exactly one is
compatible with the last token of the prefix before it (the merges would leave that pair
apart).  So one pass gives the exact token count of *every* prefix.  A document's counts
are stored as one signed byte per code point (the change of the count; counts may fall when a
longer token replaces several), `prefix_tokens`; truncation and budget questions are
answered from it without encoding again (`tokens_at`, `longest_prefix`, `truncate`).

The work runs in `mapInArrow` on the scan's own partitions: no shuffle, one Arrow batch in
memory.  Texts are cut where no piece can cross (from a non-blank to a blank
character), and the changes of a chunk are remembered within a task; the memory of chunks is
emptied when it is full, which changes no result.

Defined results: a null text is the empty text (0 tokens, an empty table); repeated rows
get a row each; an empty table gives no rows; other columns are ignored and may have any
name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

LIMIT = 512
MEMORY = 600_000
#: Unicode White_Space, as the vocabulary's pattern has it.
SPACE = "\t-\r \x85\xa0  -     　"
#: Closing punctuation that is a piece of its own after a letter (no apostrophe: it starts contractions).
CLOSING = ".,!?;:|$%&*#)"
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_LEAD = re.compile(f"[{SPACE}]*")
_SPLIT_CONTRACTIONS = {"'re", "'ve", "'ll"}


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


class _Chunks(dict):
    """Changes over a chunk of text, worked out when first asked for."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, chunk: str) -> bytes:
        got = self.work(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got


class PrefixCounter:
    """Exact token counts of all prefixes under a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        raw = {t: bytes(chars[c] for c in t) for t in spec["model"]["vocab"] if all(c in chars for c in t)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        ids = {b: k for k, b in enumerate(raw.values())}
        self.ids, self.longest = ids, max(map(len, ids))
        # of each token: the time of the merge that forms it, and its halves
        self.time, self.left, self.right = [-1] * len(ids), [-1] * len(ids), [-1] * len(ids)
        self.merge: dict[tuple[int, int], int] = {}
        for k, m in enumerate(spec["model"]["merges"]):
            a, b = (raw[x] for x in (m.split(" ") if isinstance(m, str) else m))
            t = ids[a + b]
            self.merge[ids[a], ids[b]] = k
            if self.time[t] < 0:
                self.time[t], self.left[t], self.right[t] = k, ids[a], ids[b]
        self.apart: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.chunks = _Chunks(self._chunk)
        self.pieces: dict[str, bytes] = {}

    def _meet(self, a: int, b: int) -> int:
        """Time of the first merge across the boundary of tokens a and b side by side, or
        -1 if they stay apart.  Going back in time from the finished pair, the parts that
        touch at the boundary merge if their merge comes before the ones in which they
        went on (at the same time the left of two places goes first)."""
        time, merge, ends, from_right, found = self.time, self.merge, 1 << 60, False, -1
        while True:
            m = merge.get((a, b))
            if m is not None and (m < ends or (m == ends and from_right)):
                found = m
            if time[a] < 0 and time[b] < 0:
                return found
            if time[a] > time[b]:
                ends, a, from_right = time[a], self.right[a], False
            else:
                ends, b, from_right = time[b], self.left[b], True

    def _is_whole(self, t: int) -> bool:
        """Whether the bytes of token t encode to t alone (its halves are whole and meet
        only at its own merge)."""
        got = self.whole.get(t)
        if got is None:
            a, b = self.left[t], self.right[t]
            got = self.whole[t] = self.time[t] < 0 or (
                self._is_whole(a) and self._is_whole(b) and self._meet(a, b) == self.time[t])
        return got

    def _follows(self, pair: tuple[int, int]) -> bool:
        if len(self.apart) > 1_000_000:
            self.apart.clear()
        got = self.apart[pair] = self._is_whole(pair[1]) and self._meet(*pair) < 0
        return got

    def counts(self, piece: bytes) -> list[int]:
        """Token count of piece[:i] for i = 0..len(piece)."""
        n, token, apart = len(piece), self.ids.get, self.apart.get
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(1, n + 1):
            stop, j = max(0, i - self.longest), i
            while j > stop:
                j -= 1
                t = token(piece[j:i])
                if t is not None:
                    if j:
                        ok = apart((last[j], t))
                        if ok is None:
                            ok = self._follows((last[j], t))
                    else:
                        ok = self._is_whole(t)
                    if ok:
                        count[i], last[i] = count[j] + 1, t
                        break
        return count

    def _piece(self, piece: str) -> bytes:
        """Changes of the count per code point over one piece."""
        got = self.pieces.get(piece)
        if got is None:
            raw = piece.encode()
            count = self.counts(raw)
            if len(raw) != len(piece):
                count = [count[i] for i in range(len(raw)) if raw[i] & 0xC0 != 0x80] + [count[-1]]
            if piece in _SPLIT_CONTRACTIONS:  # their first two characters are two pieces
                count[2] = count[1] + self.counts(raw[1:2])[-1]
            got = _changes(count)
            if len(piece) <= 64:
                if len(self.pieces) >= MEMORY:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def _ordinary(self, text: str) -> bytes:
        """Changes over a chunk without special tokens: blanks, then non-blanks."""
        m = _LEAD.match(text).end()
        if m == len(text):
            return self._piece(text)
        lead = _changes_sum(self._piece(text[:m])) if m else 0
        out = [self._piece(text[:m])] if m else []
        inside = text[m:]
        if m and text[m - 1] == " ":
            inside = text[m - 1:]
            base = _changes_sum(self._piece(text[:m - 1])) if m > 1 else 0
        else:
            base = lead
            if m > 1:  # all blanks but the last, then the last
                base = _changes_sum(self._piece(text[:m - 1])) + _changes_sum(self._piece(text[m - 1:m]))
        body = b"".join(self._piece(inside[a:b]) for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(inside))
        if len(inside) > len(text) - m:  # its first blank has been told with the others
            first, body = np.frombuffer(body, np.int8)[:2].astype(int), body[1:]
            step = base + int(first.sum()) - lead
        else:
            step = base + int(np.frombuffer(body[:1], np.int8)[0]) - lead
        return b"".join([*out, _one(step), body[1:]])

    def _chunk(self, text: str) -> bytes:
        word = text[1:] if text[0] == " " else text
        core = word.rstrip(CLOSING)
        if core.isalpha():
            if len(core) == len(word):
                return self._piece(text)
            return self._piece(text[:len(text) - len(word) + len(core)]) + self._piece(word[len(core):])
        out, rest = [], text
        while True:
            at, name = min(((rest.find(s), s) for s in self.special if s in rest), default=(-1, ""))
            if at < 0:
                out.append(self._ordinary(rest) if rest else b"")
                return b"".join(out)
            # up to its last character a special token is ordinary text
            upto = self._ordinary(rest[:at + len(name) - 1])
            before = _changes_sum(self._ordinary(rest[:at])) if at else 0
            out += [upto, _one(before + 1 - _changes_sum(upto))]
            rest = rest[at + len(name):]

    def prefixes(self, batch: list[str]) -> list[bytes]:
        """Of each text: the change of the token count per code point."""
        out = []
        for t in batch:
            if len(self.chunks) >= MEMORY:
                self.chunks.clear()
            out.append(b"".join(map(self.chunks.__getitem__, _CHUNK.findall(t))))
        return out


def _one(step: int) -> bytes:
    if not -128 <= step <= 127:
        raise ValueError("a token of this vocabulary is too long for one signed byte")
    return np.int8(step).tobytes()


def _changes(count: list[int]) -> bytes:
    steps = [b - a for a, b in zip(count, count[1:])]
    if steps and not -128 <= min(steps) <= max(steps) <= 127:
        raise ValueError("a token of this vocabulary is too long for one signed byte")
    return bytes([x & 255 for x in steps])


def _changes_sum(changes: bytes) -> int:
    return int(np.frombuffer(changes, np.int8).sum(dtype=np.int64))


def tokens_at(prefix_tokens: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` code points."""
    return int(np.frombuffer(prefix_tokens, np.int8)[:n_chars].sum(dtype=np.int64))


def longest_prefix(prefix_tokens: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    run = np.cumsum(np.frombuffer(prefix_tokens, np.int8), dtype=np.int64)
    fits = np.flatnonzero(run <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                  budget: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, n_fit, prefix_tokens``: the stored counts of all
    prefixes, their last one, and the code points that fit into ``budget`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in slices(batches):
            text = [t or "" for t in batch.column(1).to_pylist()]
            tables = counter.prefixes(text)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t.encode()) for t in text], pa.int64()),
                pa.array([_changes_sum(p) for p in tables], pa.int64()),
                pa.array([len(p) if len(p) <= budget else longest_prefix(p, budget) for p in tables], pa.int64()),
                pa.array(tables, pa.binary())], ["doc_id", "n_bytes", "n_tokens", "n_fit", "prefix_tokens"])
        counter.chunks.clear()   # a worker waits for its next task without them
        counter.pieces.clear()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, n_fit long, prefix_tokens binary")


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    return prefix_counts(docs, vocabulary).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "n_fit")
