"""SentencePiece BPE in vectorised merge rounds, and back from ids to text.

Text is cut into words where no piece of the vocabulary spans the cut, so words never depend
on each other, and equal words of a slice are merged once. All symbols lie in one flat array.
A round finds the best pair of every word by a segmented minimum, joins all its leftmost
occurrences at once, closes the gaps and drops the words that have no pair left.

The library joins one pair at a time: the best score first, then the leftmost. A round gives
the same, because it stops behind the first join that makes a pair as good as the one being
joined. Pieces of equal score are the exception (in the model at hand runs of white space):
their order depends on every step, so such words are finished by a heap.

Covered models: BPE, with or without byte fallback, with an identity normaliser, white space
escaped and kept. Others raise ``ValueError``. Null texts count as empty; an empty text has no
ids besides the end id. Rows and other columns stay as they are; a column that has the name of
the result is replaced. Working memory follows ``SLICE_CHARS`` or the longest word, the result
the longest text.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelflow.llm.arrays import Substrings, mixed, slices

SLICE_CHARS = 1_000_000
SPACE = 0x2581
NONE = np.int32(2**31 - 1)

# Field numbers and piece types of the public model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BPE = 3, 2
CHARS_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
SUFFIX_SPACES, BYTE_FALLBACK = 24, 35
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class PieceModel:
    """Vocabulary and merge tables of a model file, given as its bytes."""

    def __init__(self, data: bytes):
        rows, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == PIECES:
                own = dict(_fields(value))
                score = struct.unpack("<f", own.get(2, bytes(4)))[0]
                rows.append((own[1].decode(), score, own.get(3, NORMAL)))
            elif number == TRAINER:
                trainer = dict(_fields(value))
            elif number == NORMALIZER:
                normalizer = dict(_fields(value))
        kinds = {kind for _, _, kind in rows}
        if trainer.get(MODEL_TYPE) != BPE or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("Only BPE models of normal, control and byte pieces are covered.")
        if (
            normalizer.get(CHARS_MAP)
            or normalizer.get(REMOVE_SPACES, 1)
            or not normalizer.get(ESCAPE_SPACES, 1)
            or trainer.get(SUFFIX_SPACES, 0)
        ):
            raise ValueError("Only models that keep the text as it is are covered.")
        self.prefix = bool(normalizer.get(DUMMY_PREFIX, 1))
        self.size = len(rows)
        self.unknown = next(i for i, (_, _, kind) in enumerate(rows) if kind == UNKNOWN)
        self.end = next((i for i, (p, _, k) in enumerate(rows) if k == CONTROL and p == "</s>"), -1)
        self.byte_ids = np.full(256, -1, np.int32)
        for i, (piece, _, kind) in enumerate(rows):
            if kind == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
        self.fallback = bool(trainer.get(BYTE_FALLBACK, 0)) and (self.byte_ids >= 0).all()
        self._merges(rows)
        self._surfaces(rows, trainer.get(44, " ⁇ ".encode()))

    def _merges(self, rows: list[tuple[str, float, int]]) -> None:
        """Symbols of single characters, which characters may share a word, and all pairs."""
        ids = {piece: i for i, (piece, _, kind) in enumerate(rows) if kind == NORMAL}
        inside = sorted({c for piece in ids if len(piece) > 1 for c in piece})
        # Characters that occur in longer pieces only get symbols above the vocabulary.
        symbols = {c: ids.get(c, self.size + i) for i, c in enumerate(inside)}
        self.lone = {self.size + i: c for i, c in enumerate(inside) if c not in ids}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for piece, i in [*ids.items(), *symbols.items()]:
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self.class_of = np.zeros(0x110000, np.int16)
        place = {c: i + 1 for i, c in enumerate(inside)}
        for c, i in place.items():
            self.class_of[ord(c)] = i
        self.joins = np.zeros((len(inside) + 1, len(inside) + 1), bool)
        scores = sorted({score for _, score, kind in rows if kind == NORMAL}, reverse=True)
        order = {score: i for i, score in enumerate(scores)}
        self.rank_of = np.full(self.size + len(inside) + 1, NONE, np.int32)
        for i in ids.values():
            self.rank_of[i] = order[rows[i][1]]
        lefts, rights, wholes = [], [], []
        for piece, whole in ids.items():
            for k in range(1, len(piece)):
                self.joins[place[piece[k - 1]], place[piece[k]]] = True
                left, right = piece[:k], piece[k:]
                left = symbols.get(left, -1) if k == 1 else ids.get(left, -1)
                right = symbols.get(right, -1) if len(right) == 1 else ids.get(right, -1)
                if left >= 0 and right >= 0:
                    lefts.append(left)
                    rights.append(right)
                    wholes.append(whole)
        lefts, rights, wholes = (np.array(x, np.int64) for x in (lefts, rights, wholes))
        self._hash_pairs(lefts << 32 | rights, wholes)
        # Pieces that could at once join at a rank as good as their own.
        own = self.rank_of[wholes]
        self.risky = np.zeros(len(self.rank_of), bool)
        for part in (lefts, rights):
            ranks = np.where(self.rank_of[part] == NONE, -1, self.rank_of[part])
            self.risky[part[ranks >= own]] = True
        held = np.bincount(self.rank_of[np.fromiter(ids.values(), np.int64)])
        self.tied = np.append(held > 1, False)

    def _hash_pairs(self, keys: np.ndarray, wholes: np.ndarray) -> None:
        """Open addressing in a table of which at most a quarter is used."""
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.wholes = np.full(1 << self.bits, -1, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            taken, first = np.unique(slot[free], return_index=True)
            self.keys[taken], self.wholes[taken] = keys[free[first]], wholes[free[first]]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slots(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.keys[slot[open_]]
            same = found == keys[open_]
            out[open_[same]] = self.wholes[slot[open_[same]]]
            open_ = open_[~same & (found >= 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def _surfaces(self, rows: list[tuple[str, float, int]], unknown: bytes) -> None:
        """Bytes of every id, one after the other."""
        surfaces = []
        for piece, _, kind in rows:
            if kind == BYTE:
                surfaces.append(bytes([int(piece[3:5], 16)]))
            elif kind == UNKNOWN:
                surfaces.append(unknown)
            elif kind == CONTROL:
                surfaces.append(b"")
            else:
                surfaces.append(piece.replace(chr(SPACE), " ").encode())
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_at = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(s) for s in surfaces], out=self.surface_at[1:])
        self.is_byte = np.array([kind == BYTE for _, _, kind in rows])
        self.is_control = np.array([kind == CONTROL for _, _, kind in rows])
        self.opens = np.array([k == NORMAL and p[:1] == chr(SPACE) for p, _, k in rows])


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(total)


def _tied(model: PieceModel, symbols: list[int]) -> list[int]:
    """Join one pair at a time, the best rank first and then the leftmost."""
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(at: int) -> None:
        other = after[at] if at >= 0 else -1
        if at >= 0 and other >= 0:
            pair = np.array([symbols[at]]), np.array([symbols[other]])
            whole = int(model.join(*pair)[0])
            if whole >= 0:
                rank = int(model.rank_of[whole])
                heapq.heappush(heap, (rank, at, symbols[at], symbols[other], whole))

    for at in range(len(symbols)):
        offer(at)
    while heap:
        _, at, left, right, whole = heapq.heappop(heap)
        other = after[at]
        if other < 0 or symbols[at] != left or symbols[other] != right:
            continue
        symbols[at], symbols[other] = whole, -1
        after[at] = after[other]
        if after[at] >= 0:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [s for s in symbols if s >= 0]


def merged(
    model: PieceModel, symbols: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of every word and their number, for words of ``sizes`` symbols each."""
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    words = np.arange(len(sizes))
    starts = np.cumsum(sizes) - sizes
    first = np.zeros(len(symbols) + 1, bool)
    first[starts] = first[-1] = True

    def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of the pairs that begin there."""
        whole = np.full(len(at), -1, np.int32)
        inner = np.flatnonzero(~first[at + 1])
        whole[inner] = model.join(symbols[at[inner]], symbols[at[inner] + 1])
        return whole, model.rank_of[whole]

    whole, rank = pairs(np.arange(len(symbols)))
    while len(words):
        starts = np.flatnonzero(first[:-1])
        widths = np.diff(np.append(starts, len(symbols)))
        best = np.minimum.reduceat(rank, starts)
        tied = (best < NONE) & model.tied[np.minimum(best, len(model.tied) - 1)]
        for k in np.flatnonzero(tied):
            own = _tied(model, symbols[starts[k] : starts[k] + widths[k]].tolist())
            done.append((words[k : k + 1], np.array([len(own)]), np.array(own, np.int32)))
        ended = (best == NONE) | tied
        if ended.any():
            own = np.repeat(best == NONE, widths)
            done.append((words[best == NONE], widths[best == NONE], symbols[own]))
            own = np.repeat(~ended, widths)
            symbols, whole, rank = symbols[own], whole[own], rank[own]
            first = np.append(first[:-1][own], True)
            words, widths, best = words[~ended], widths[~ended], best[~ended]
            if not len(words):
                break
        owner = np.repeat(np.arange(len(words)), widths)
        at = np.flatnonzero(rank == best[owner])
        # Of pairs that overlap, every second one, from the left.
        new_run = np.append(True, np.diff(at) != 1)
        run_start = np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        at = at[~_held_back(model, symbols, first, at, whole[at], owner[at])]
        symbols[at] = whole[at]
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        symbols, whole, rank = symbols[left], whole[left], rank[left]
        first = np.append(first[:-1][left], True)
        at -= np.arange(len(at))
        changed = np.concatenate([at, at[~first[at]] - 1])
        whole[changed], rank[changed] = pairs(changed)
    order = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    counts = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int64)
    flat = np.concatenate([d[2] for d in done]) if done else np.zeros(0, np.int32)
    begins = np.cumsum(counts) - counts
    by_word = np.argsort(order)
    return flat[_ranges(begins[by_word], counts[by_word])], counts[by_word]


def _held_back(
    model: PieceModel,
    symbols: np.ndarray,
    first: np.ndarray,
    at: np.ndarray,
    whole: np.ndarray,
    owner: np.ndarray,
) -> np.ndarray:
    """Joins that have to wait: behind a join of their word that makes a better pair."""
    makes = np.zeros(len(at), bool)
    look = np.flatnonzero(model.risky[whole])
    if len(look):
        left = np.flatnonzero(~first[at[look]])
        own = look[left]
        before = symbols[at[own] - 1]
        beside = (own > 0) & (at[own - 1] == at[own] - 2)
        before = np.where(beside, whole[own], before)
        ranks = model.rank_of[model.join(before, whole[own])]
        makes[own] |= ranks <= model.rank_of[whole[own]]
        own = look[~first[at[look] + 2]]
        ranks = model.rank_of[model.join(whole[own], symbols[at[own] + 2])]
        makes[own] |= ranks <= model.rank_of[whole[own]]
    earlier = np.cumsum(makes) - makes
    start = np.append(True, owner[1:] != owner[:-1])
    return earlier > earlier[np.flatnonzero(start)[np.cumsum(start) - 1]]


def _distinct(codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
    """Words that differ, as indices, and for every word the one it equals."""
    hashes = Substrings(mixed(codes.astype(np.uint64) + np.uint64(1))).between(
        begins, begins + sizes
    )
    _, chosen, same = np.unique(hashes, return_index=True, return_inverse=True)
    like = chosen[same]
    if (sizes[like] == sizes).all():
        if (codes[_ranges(begins[like], sizes)] == codes[_ranges(begins, sizes)]).all():
            return chosen, same
    return np.arange(len(begins)), np.arange(len(begins))


def _word_ids(model: PieceModel, codes: np.ndarray, starts: np.ndarray):
    """Ids of all texts in one array, for texts of code points that begin at ``starts``, and
    where the ids of each begin."""
    kinds = model.class_of[codes]
    joined = np.zeros(len(codes), bool)
    joined[1:] = model.joins[kinds[:-1], kinds[1:]]
    joined[starts] = False
    begins = np.flatnonzero(~joined)
    sizes = np.diff(np.append(begins, len(codes)))
    chosen, same = _distinct(codes, begins, sizes)
    spread = _ranges(begins[chosen], sizes[chosen])
    symbols = model.symbol_of[codes[spread]]
    ids, counts = merged(model, symbols, sizes[chosen])
    # A character without a piece is a word of its own, or keeps its symbol.
    odd = np.flatnonzero((ids < 0) | (ids >= model.size))
    if len(odd):
        word = np.repeat(np.arange(len(counts)), counts)[odd]
        points = codes[begins[chosen[word]]]
        parts = [ids[:0]] * len(ids)
        blank = np.array([model.unknown], np.int32)
        for i, point in zip(odd.tolist(), points.tolist()):
            c = model.lone.get(int(ids[i]), chr(point))
            raw = np.frombuffer(c.encode("utf-8", "surrogatepass"), np.uint8)
            parts[i] = model.byte_ids[raw] if model.fallback else blank
        extra = np.array([max(1, len(p)) for p in parts])
        at = np.cumsum(extra) - extra
        wide = np.repeat(ids, extra)
        for i in odd.tolist():
            wide[at[i] : at[i] + extra[i]] = parts[i]
        counts = np.add.reduceat(extra, np.cumsum(counts) - counts) if len(counts) else counts
        ids = wide
    offsets = np.cumsum(counts) - counts
    flat = ids[_ranges(offsets[same], counts[same])]
    word_at = np.append(0, np.cumsum(counts[same]))
    return flat, word_at[np.searchsorted(begins, np.append(starts, len(codes)))]


def encode(model: PieceModel, texts: list[str | None], end: bool = False) -> list[np.ndarray]:
    """Ids of every text."""
    texts = [t or "" for t in texts]
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for which, codes, starts in _slices(model, texts):
        ids, at = _word_ids(model, codes, starts)
        for k, i in enumerate(which):
            parts[i].append(ids[at[k] : at[k + 1]])
    last = [np.array([model.end], np.int32)] if end else []
    return [np.concatenate([*p, *last, np.zeros(0, np.int32)]) for p in parts]


def _slices(model: PieceModel, texts: list[str]):
    """Numbers of texts with their code points, in slices of about ``SLICE_CHARS``; a longer
    text is cut between words."""
    which: list[int] = []
    held: list[np.ndarray] = []
    size = 0

    def out():
        sizes = np.array([len(h) for h in held])
        return list(which), np.concatenate(held), np.cumsum(sizes) - sizes

    for i, text in enumerate(texts):
        rest = np.zeros(0, np.uint32)
        for begin in range(0, len(text), SLICE_CHARS):
            part = text[begin : begin + SLICE_CHARS]
            if begin == 0 and model.prefix:
                part = " " + part
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = np.concatenate([rest, np.where(codes == 32, SPACE, codes)])
            rest = codes[len(codes) :]
            if begin + SLICE_CHARS < len(text):
                kinds = model.class_of[codes]
                cuts = np.flatnonzero(~model.joins[kinds[:-1], kinds[1:]])
                cut = int(cuts[-1]) + 1 if len(cuts) else 0
                codes, rest = codes[:cut], codes[cut:]
            if len(codes):
                which.append(i)
                held.append(codes)
                size += len(codes)
            if size >= SLICE_CHARS:
                yield out()
                which.clear()
                held.clear()
                size = 0
    if held:
        yield out()


def _readable(raw: bytes) -> bytes:
    """A run of byte pieces: each byte outside a whole character becomes U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            size = next((n for n in (1, 2, 3, 4) if _is_char(raw[at : at + n], n)), 0)
            out.append(raw[at : at + size] if size else "�".encode())
            at += max(1, size)
        return b"".join(out)


def _is_char(raw: bytes, size: int) -> bool:
    try:
        return len(raw) == size and len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """The text of a sequence of ids."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= model.size):
        raise ValueError("An id lies outside the vocabulary.")
    sizes = np.diff(model.surface_at)[ids]
    raw = model.surface[_ranges(model.surface_at[ids], sizes)].tobytes()
    at = np.append(0, np.cumsum(sizes))
    shown = np.flatnonzero(~model.is_control[ids])
    skip = 0
    if model.prefix and len(shown) and model.opens[ids[shown[0]]]:
        skip = 1  # the space that encoding puts first
    edge = np.diff(np.concatenate([[False], model.is_byte[ids], [False]]).astype(np.int8))
    begins, ends = at[np.flatnonzero(edge == 1)], at[np.flatnonzero(edge == -1)]
    out, last = [], skip
    for begin, end in zip(begins.tolist(), ends.tolist()):
        own = raw[begin:end]
        fixed = _readable(own)
        if fixed is not own:
            out += [raw[last:begin], fixed]
            last = end
    return b"".join([*out, raw[last:]]).decode()


def _listed(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    values = np.concatenate([*parts, np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _with_column(df: DataFrame, name: str, kind: T.DataType, values) -> DataFrame:
    """``df`` with one more column, which ``values`` makes of an Arrow batch."""
    kept = [f for f in df.schema.fields if f.name != name]
    schema = T.StructType([*kept, T.StructField(name, kind)])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, column in values(batches):
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, column], names=[*names, name])

    return df.mapInArrow(run, schema)


def with_ids(
    df: DataFrame, model: PieceModel, column: str = "text", name: str = "ids", end: bool = False
) -> DataFrame:
    """``df`` with the ids of a text column; the model travels with the tasks."""

    def values(batches):
        for batch in slices(batches, column):
            yield batch, _listed(encode(model, batch.column(column).to_pylist(), end))

    return _with_column(df, name, T.ArrayType(T.IntegerType()), values)


def with_text(
    df: DataFrame, model: PieceModel, column: str = "ids", name: str = "decoded"
) -> DataFrame:
    """``df`` with the text of a column of ids; null ids give an empty text."""

    def values(batches):
        for batch in batches:
            ids = batch.column(column)
            texts = [decode(model, x.values.to_numpy(False) if x.is_valid else []) for x in ids]
            yield batch, pa.array(texts, pa.string())

    return _with_column(df, name, T.StringType(), values)
