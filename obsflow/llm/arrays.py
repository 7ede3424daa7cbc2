"""Whole texts as byte arrays: words, lines and their hashes for many texts at once.

A block holds texts of about `BLOCK_BYTES` in all (a longer text is a block of its own), each followed by one line feed,
so every line ends with one and no word runs into the next text. Memory per task is a small multiple of a block.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 22

SPACES = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)
_powers = {}


class Block:
    def __init__(self, texts):
        """texts: one bytes object per document."""
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
        self.space = SPACES[self.data]

    def owner(self, positions):
        """Index of the text at each position."""
        return np.searchsorted(self.starts, positions, "right") - 1

    def words(self):
        """(starts, ends) of the runs without space."""
        edge = np.diff(self.space.astype(np.int8), prepend=np.int8(1))
        return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)

    def lines(self):
        ends = np.flatnonzero(self.data == 10)
        return np.concatenate([[0], ends[:-1] + 1]).astype(np.int64), ends

    def hashes(self, starts, ends):
        """64-bit hashes of the spans, which stand in order."""
        out, a = np.zeros(len(starts), np.uint64), 0
        while a < len(starts):
            b = max(int(np.searchsorted(ends, starts[a] + HASH_BYTES, "right")), a + 1)
            out[a:b] = _span_hashes(self.data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
            a = b
        return out

    def per_text(self, flags):
        """How many bytes of each text are flagged."""
        return np.add.reduceat(flags.astype(np.int64), self.starts) if self.n else np.zeros(0, np.int64)


def _power(base, n):
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, np.uint64(base))
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= HASH_BYTES:
            _powers[base] = have
    return have[:n]


def _span_hashes(data, starts, ends):
    """Prefix sums of byte codes times powers of an odd base give every span's polynomial, modulo 2^64."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _power(_BASE, len(data)), dtype=np.uint64)])
    at = _power(_INVERSE, len(data) + 1)[starts]
    return mixed((sums[ends] - sums[starts]) * at + (ends - starts).astype(np.uint64))


def mixed(x):
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(codes, size):
    """Hash of every run of `size` neighbouring codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 1
    for k in range(size):
        out += codes[k : k + n] * np.uint64(factor)
        factor = factor * _BASE % (1 << 64)
    return mixed(out)


def repeated(keys):
    """Whether each key occurs twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)


def within(codes, owner):
    """One key for a code and the text it stands in."""
    return mixed(codes + mixed(owner.astype(np.uint64) + np.uint64(1)))


def repeat_words(codes, owner, size=8):
    """Whether each word stands in a window of `size` words that its text has twice or more."""
    covered = np.zeros(len(codes) + 1, np.int64)
    keys = windows(codes, size)
    if len(keys):
        inside = np.flatnonzero(owner[: len(keys)] == owner[size - 1 :])
        at = inside[repeated(within(keys[inside], owner[inside]))]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + size, -1)
    return np.cumsum(covered)[:-1] > 0


def later_copies(codes, owner):
    """Whether each code stands earlier in its text too."""
    keys = within(codes, owner)
    _, first = np.unique(keys, return_index=True)
    out = np.ones(len(keys), bool)
    out[first] = False
    return out


def map_blocks(docs, id_type, work, fields):
    """One row per document of (doc_id, text): its id and the arrays that `work(Block)` returns, in order of `fields`."""
    from .texts import _arrow_fields

    arrow = _arrow_fields(docs.sparkSession, fields)
    names, types = [n for n, _ in arrow], [t for _, t in arrow]

    def run(batches):
        for ids, texts in blocks(batches):
            columns = work(Block(texts))
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=["doc_id", *names])

    return docs.mapInArrow(run, f"doc_id {id_type}, {fields}")


def filter_blocks(docs, text_col, keep):
    """The rows of `docs`, all columns as they are and whatever their names, for which `keep(Block)` has true."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a, part in _cuts(batch.column(at)):
                wanted = keep(Block([t or b"" for t in part.to_pylist()]))
                yield batch.slice(a, len(part)).filter(pa.array(wanted))

    plain = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def blocks(batches):
    """(ids, texts as bytes) of batches with columns id and text, about a block at a time."""
    for batch in batches:
        for a, part in _cuts(batch.column(1)):
            yield batch.column(0).slice(a, len(part)), part.to_pylist()


def _cuts(texts, limit=BLOCK_BYTES):
    """(place, slice) of a column of texts, as bytes, cut to about `limit` bytes each."""
    texts = texts.cast(pa.large_binary())
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        before = total[a - 1] if a else 0
        b = max(int(np.searchsorted(total, before + limit, "right")), a + 1)
        yield a, texts.slice(a, b - a)
        a = b
