"""Byte-level BPE by prefix dynamic programming: encoding, decoding, exact appends and edits.

Every prefix of a byte string has one BPE encoding, and so one last token.  A
token t that ends at position i is that last token exactly if merging t's bytes
alone gives t and the last token of the prefix before t can stand beside t, that
is, no merge across their border would have come before one inside them.  So one
table of last tokens, a position after another, holds the encoding of all
prefixes: appending extends the table, and after an edit the table is rewritten
from there until it agrees with the old one for a longest token's length.  The
tables of a batch's new short pieces are worked out side by side with NumPy.

Texts are split by the tokenizer's pattern first, and each piece is encoded for
itself; a piece that is itself a token is that token.  There are no special
tokens.  Time is linear in the text, also for pieces without spaces.

Defined results: a null text counts as empty and has no ids; null ids decode to
no bytes; a null key is passed through; repeated rows give repeated results; an
empty table gives none.  Vocabularies are read from a file and never trained.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 500_000  # per worker
CACHED_PAIRS = 400_000
SHORT = 32  # bytes of pieces whose tables are worked out side by side
SIDE_BY_SIDE = 20_000  # pieces at a time
TEXT = 1 << 21  # characters of text whose new pieces are looked up together
_BASE = 0x9E3779B97F4A7C15


class Vocabulary:
    """Tokens by rank, and which tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, ranks))
        # Lengths of the tokens that end in three bytes, longest first; any place may have tokens of two bytes and one.
        sizes: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                sizes.setdefault(token[-3:], set()).add(len(token))
        self.sizes = {tail: (*sorted(own, reverse=True), 2, 1) for tail, own in sizes.items()}
        # Tokens of each length by the hash of their bytes.
        rng = np.random.default_rng(50257)
        self._value = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self._sizes = np.array([len(t) for t in self.bytes_of])
        self._ends = np.cumsum(self._sizes)
        self._flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._hashes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in range(1, SHORT + 1):
            ids = np.array([r for t, r in ranks.items() if len(t) == size], np.int64)
            if len(ids):
                first = self._ends[ids] - size
                keys = sum((self._value[self._flat[first + k]] * np.uint64(pow(_BASE, k, 2**64)) for k in range(size)), np.zeros(len(ids), np.uint64))
                order = np.argsort(keys)
                self._hashes[size] = keys[order], ids[order]
        self._is_whole = np.full(len(self.bytes_of), -1, np.int8)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._whole: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())})

    def _merge(self, data: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """Plain merging of a short string: its tokens, and the two that the last merge joined."""
        parts = [self.ranks[data[k : k + 1]] for k in range(len(data))]
        joined = None
        while len(parts) > 1:
            options = (
                (r, k) for k in range(len(parts) - 1)
                if (r := self.ranks.get(self.bytes_of[parts[k]] + self.bytes_of[parts[k + 1]])) is not None
            )
            best = min(options, default=None)
            if best is None:
                break
            rank, k = best
            joined = (parts[k], parts[k + 1])
            parts[k : k + 2] = [rank]
        return parts, joined

    def whole(self, token: int) -> bool:
        """Whether merging the token's bytes gives the token."""
        known = self._whole.get(token)
        if known is None:
            parts, joined = self._merge(self.bytes_of[token])
            known = self._whole[token] = parts == [token]
            self._halves[token] = joined if known else None
        return known

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens.

        Merges are undone from the last to the first; at each moment the two
        parts at the border must not have a merge that comes before the one
        that used up either of them.
        """
        pair = left * len(self.bytes_of) + right
        known = self._pairs.get(pair)
        if known is not None:
            return known
        x, y, before = left, right, len(self.bytes_of) + 1
        while True:
            across = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
            if across is not None and across < before:
                known = False
                break
            of_x = self._halves[x] if self.whole(x) else None
            of_y = self._halves[y] if self.whole(y) else None
            if of_x is None and of_y is None:
                known = True
                break
            if of_y is None or of_x is not None and x > y:
                x, before = of_x[1], x
            else:
                y, before = of_y[0], y + 1  # of equal merges the left one comes first
        if len(self._pairs) >= CACHED_PAIRS:
            self._pairs.clear()
        self._pairs[pair] = known
        return known

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Add the last tokens of the prefixes of ``data`` up to ``end`` to those in ``last``."""
        rank, sizes, pairs, whole, many = self.ranks.get, self.sizes.get, self._pairs.get, self._whole.get, len(self.bytes_of)
        for at in range(len(last) + 1, end + 1):
            for size in sizes(data[at - 3 : at], (2, 1)) if at > 2 else (2, 1):
                start = at - size
                if start < 0 or (token := rank(data[start:at])) is None:
                    continue
                alone = whole(token)
                if not (self.whole(token) if alone is None else alone):
                    continue
                if start:
                    fits = pairs(last[start - 1] * many + token)
                    if not (self.beside(last[start - 1], token) if fits is None else fits):
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"no token for byte {data[at - 1]}")

    def tables(self, pieces: list[bytes]) -> list[list[int]]:
        """The tables of last tokens of many short pieces, a prefix length after another for all of them.

        Tokens that end at a place are looked up by hash, longest first, and compared
        byte by byte; which of them is the last token is decided as in ``extend``.
        """
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        start = np.cumsum(n) - n
        data = np.frombuffer(b"".join(pieces), np.uint8)
        up, down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(data), b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 2**64)))
        run = np.concatenate(([np.uint64(0)], np.cumsum(self._value[data] * up[:-1])))
        last = np.full(len(data), -1, np.int64)
        for j in range(1, int(n.max(initial=0)) + 1):
            at = start[n >= j] + j - 1
            for size in range(j, 0, -1):
                if size not in self._hashes or not len(at):
                    continue
                keys, ids = self._hashes[size]
                lo = at - size + 1
                key = (run[at + 1] - run[lo]) * down[lo]
                k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[k] == key)
                token, lo = ids[k[hit]], lo[hit]
                first = self._ends[token] - size
                same = np.ones(len(hit), bool)
                for b in range(size):
                    same &= self._flat[first + b] == data[lo + b]
                fits = same & self._wholes(token)
                if size < j:
                    fits[fits] = self._besides(last[lo[fits] - 1], token[fits])
                last[at[hit[fits]]] = token[fits]
                at = np.delete(at, hit[fits])
            if len(at):
                raise ValueError(f"no token for byte {data[at[0]]}")
        return [x.tolist() for x in np.split(last, start[1:])] if pieces else []

    def _wholes(self, tokens: np.ndarray) -> np.ndarray:
        for token in np.unique(tokens[self._is_whole[tokens] < 0]).tolist():
            self._is_whole[token] = self.whole(token)
        return self._is_whole[tokens] == 1

    def _besides(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs, back = np.unique(left * len(self.bytes_of) + right, return_inverse=True)
        fits = list(map(self._pairs.get, pairs.tolist()))
        for k, known in enumerate(fits):
            if known is None:
                fits[k] = self.beside(*divmod(int(pairs[k]), len(self.bytes_of)))
        return np.array(fits, bool)[back]

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of all ids one after another, the number of bytes of each)."""
        n = self._sizes[ids]
        return gathered(self._flat, self._ends[ids] - n, n), n

    def path(self, last: list[int], end: int) -> list[int]:
        """The tokens of the prefix up to ``end``, from the table."""
        out = []
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[out[-1]])
        return out[::-1]


def gathered(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs flat[first : first + n], one after another."""
    ends = np.cumsum(n)
    return flat[np.repeat(first - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class PrefixEncoding:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for data[start:end]; returns how many table entries were worked out anew."""
        data = self.data[:start] + new + self.data[end:]
        last, old, shift = self.last[:start], self.last, len(new) - (end - start)
        same = 0
        for at in range(start + 1, len(data) + 1):
            self.vocabulary.extend(data, last, at)
            same = same + 1 if at > start + len(new) and last[-1] == old[at - 1 - shift] else 0
            if same >= self.vocabulary.longest:
                last += old[at - shift :]
                self.data, self.last = data, last
                return at - start
        self.data, self.last = data, last
        return len(data) - start

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the prefix up to ``end``."""
        return self.vocabulary.path(self.last, len(self.data) if end is None else end)


class _Pieces(dict):
    """Ids of pieces, worked out when first asked for; pieces not asked for of late are forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.before = vocabulary, {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Know all of ``pieces``, until the next call at least."""
        if len(self) >= CACHED_PIECES // 2:
            self.before = dict(self)
            self.clear()
        new, v = [], self.vocabulary
        for piece in pieces:
            if piece not in self:
                ids = self.before.get(piece)
                if ids is not None:
                    self[piece] = ids
                elif (token := v.ranks.get(data := piece.encode())) is not None:
                    self[piece] = (token,)
                elif len(data) <= SHORT:
                    new.append((piece, data))
        for k in range(0, len(new), SIDE_BY_SIDE):
            own = new[k : k + SIDE_BY_SIDE]
            for (piece, data), last in zip(own, v.tables([d for _, d in own]), strict=True):
                self[piece] = tuple(v.path(last, len(data)))

    def of(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one after another, the number of ids of each) of texts in pieces."""
        names = set(chain.from_iterable(parts))
        self.learn(names)
        rows = [self[p] for p in names]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        place = dict(zip(names, range(len(rows)), strict=True))
        which = np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64)
        n = sizes[which]
        flat = np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum()))
        ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([0, *map(len, parts)])]
        return gathered(flat, (np.cumsum(sizes) - sizes)[which], n), np.diff(ends)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data, v = piece.encode(), self.vocabulary
        token = v.ranks.get(data)
        if token is not None:
            return (token,)
        last: list[int] = []
        v.extend(data, last, len(data))
        return tuple(v.path(last, len(data)))


_SHARED: dict[str, _Pieces] = {}  # of this worker process, by the vocabulary's path


def _pieces(path: str) -> _Pieces:
    if path not in _SHARED:
        _SHARED[path] = _Pieces(Vocabulary.load(path))
    return _SHARED[path]


class TextEncoding:
    """A text's ids that can be appended to: only the last pieces are split anew."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.pieces: list[str] = []
        self.ids: list[tuple[int, ...]] = []
        self._known = _Pieces(vocabulary)
        self.append(text)

    def append(self, more: str) -> None:
        # What is added can lengthen the last piece and, in white space, move the border before it.
        keep = max(0, len(self.pieces) - 2)
        tail = "".join(self.pieces[keep:]) + more
        del self.pieces[keep:], self.ids[keep:]
        for piece in self.pattern.findall(tail):
            self.pieces.append(piece)
            self.ids.append(self._known[piece])

    def tokens(self) -> list[int]:
        return list(chain.from_iterable(self.ids))


def _some(column: pa.Array) -> Iterator[list[str]]:
    """The texts, about ``TEXT`` characters at a time."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= TEXT:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(documents: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False,
           with_decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of each row; ``path`` is a rank file that every executor has.

    If asked for, with its text (null: empty), and with ``decoded``, the bytes that
    its ids stand for, worked out from the ids in the same pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = regex.compile(pattern).findall, _pieces(path)
        for batch in batches:
            flat, counts, data, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], [np.empty(0, np.uint8)], [np.zeros(1, np.int64)]
            for texts in _some(batch.column(1)):
                ids, n = known.of([split(text) for text in texts])
                flat.append(ids)
                counts.append(n)
                if with_decoded:
                    own, size = known.vocabulary.decoded(ids)
                    data.append(own)
                    sizes.append(np.diff(np.concatenate(([0], np.cumsum(size)))[np.cumsum(np.concatenate(([0], n)))]))
            ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
            own = {"id": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat)))}
            if keep_text:
                own["text"] = batch.column(1)
            if with_decoded:
                ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
                own["decoded"] = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(data))])
            yield pa.RecordBatch.from_arrays([*own.values()], [*own])

    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "id long, ids array<int>" + ", text string" * keep_text + ", decoded binary" * with_decoded
    return docs.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``, the bytes of the ids."""

    @F.arrow_udf("binary")
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _pieces(path).vocabulary.bytes_of.__getitem__
        for batch in batches:
            yield pa.array([b"".join(map(token, row.values.to_numpy().tolist())) if row.is_valid else b"" for row in batch], pa.binary())

    return encoded.withColumn("decoded", joined(F.col(ids_col)))
