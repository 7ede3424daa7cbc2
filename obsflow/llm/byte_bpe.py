"""Byte-level BPE by a monoid tree: halves are encoded, neighbours joined by re-encoding a window at their boundary.

Two levels, the same idea. A text is cut in half down to leaves of `LEAF_CHARS`; a leaf is split into pieces by the
tokenizer's pattern. Two neighbours are joined by splitting a window again: it starts at a piece that the left half has
settled (its match, lookahead included, ends in the left half) and grows until one of its piece ends is also a piece end
of the right half; from there on both splits read the same characters, so they agree. Inside a piece, long byte strings
are halved down to `LEAF_BYTES`, and two encodings are joined by merging a window of boundary tokens, which grows until
the pairs at both its ends are encodings of their own bytes. A token sequence whose neighbouring pairs all are is the
encoding of the whole, so the tokens outside have settled. Decoding concatenates bytes, which any tree gives alike.

Encodings of short pieces are kept in a table of bounded size per task. Null and empty texts have no tokens. Repeated
rows are encoded each. The vocabulary (tens of thousands of ranks, whatever the data) is sent to the tasks once.
"""

import base64
import re
from hashlib import sha256
from heapq import heapify, heappop, heappush

import public_tokenizers
import regex

from .texts import map_texts

LEAF_CHARS = 8_192
LEAF_BYTES = 64
SHORT_BYTES = 24
NONE = 1 << 60
KEPT_CHARS = 64
KEPT_PIECES = 300_000
LOOKAHEAD = 3  # no match of the pattern reads more than two characters past its end

# Fixed value: the pattern's meaning on ASCII text, where Python's own engine is quicker.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def read_ranks(path):
    """Token bytes to rank from a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(data, ranks):
    """Token ids of a byte string: the adjacent pair of lowest rank is merged first, the leftmost among equals."""
    n = len(data)
    if n <= SHORT_BYTES:
        return merge_short(data, ranks)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[data[i : i + 2]], i, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
    heapify(heap)
    while heap:
        _, i, to = heappop(heap)
        j = after[i] if end[i] else n
        if j >= n or end[j] != to:
            continue  # one of the two has been merged meanwhile
        end[i], end[j], after[i] = to, 0, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (rank := ranks.get(data[i : end[after[i]]])) is not None:
                heappush(heap, (rank, i, end[after[i]]))
        if (h := before[i]) >= 0 and (rank := ranks.get(data[h:to])) is not None:
            heappush(heap, (rank, h, to))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[data[i : end[i]]])
        i = end[i]
    return ids


def merge_short(data, ranks):
    """The same for few bytes, where scanning all pair ranks beats a heap."""
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [ranks.get(data[i : i + 2], NONE) for i in range(len(data) - 1)]
    while pairs and (lowest := min(pairs)) != NONE:
        i = pairs.index(lowest)
        parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(joined + parts[i + 1], NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + joined, NONE)
    return [ranks[p] for p in parts]


class TreeEncoder:
    def __init__(self, ranks, pattern=public_tokenizers.PATTERN, leaf_chars=LEAF_CHARS, leaf_bytes=LEAF_BYTES):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in ranks.values()}
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.unicode = regex.compile(pattern).findall
        same = pattern == public_tokenizers.PATTERN
        self.ascii = re.compile(ASCII_PATTERN, re.ASCII).findall if same else self.unicode
        self.fitting, self.kept = {}, {}

    # texts to pieces

    def scan(self, text):
        return self.ascii(text) if text.isascii() else self.unicode(text)

    def pieces(self, text):
        if len(text) <= self.leaf_chars:
            return self.scan(text)
        half = len(text) // 2
        return self.join_pieces(self.pieces(text[:half]), self.pieces(text[half:]))

    def join_pieces(self, left, right):
        back, tail = 0, 0
        while tail < LOOKAHEAD and back < len(left):
            back += 1
            tail += len(left[-back])
        keep, ahead = left[: len(left) - back], 8
        while ahead < len(right):
            window = "".join(left[len(left) - back :] + right[:ahead])
            ends, at = {}, tail
            for k, piece in enumerate(right[:ahead]):
                ends[at] = k
                at += len(piece)
            at, again = 0, self.scan(window)
            for k, piece in enumerate(again):
                at += len(piece)
                if at + LOOKAHEAD > len(window):
                    break
                if at in ends:
                    return keep + again[: k + 1] + right[ends[at] :]
            ahead *= 2
        return keep + self.scan("".join(left[len(left) - back :] + right))

    # pieces to tokens

    def fits(self, a, b):
        """Whether the two tokens are the encoding of their bytes."""
        if (a, b) not in self.fitting:
            if len(self.fitting) >= KEPT_PIECES:
                self.fitting.clear()
            self.fitting[a, b] = merge(self.bytes_of[a] + self.bytes_of[b], self.ranks) == [a, b]
        return self.fitting[a, b]

    def tokens(self, data):
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) <= self.leaf_bytes:
            return merge(data, self.ranks)
        half = len(data) // 2
        return self.join_tokens(self.tokens(data[:half]), self.tokens(data[half:]))

    def join_tokens(self, left, right):
        if self.fits(left[-1], right[0]):
            return left + right
        back = ahead = 1
        while True:
            window = merge(self.decode(left[len(left) - back :] + right[:ahead]), self.ranks)
            left_fits = back == len(left) or self.fits(left[-back - 1], window[0])
            right_fits = ahead == len(right) or self.fits(window[-1], right[ahead])
            if left_fits and right_fits:
                return left[: len(left) - back] + window + right[ahead:]
            if not left_fits:
                back = min(2 * back, len(left))
            if not right_fits:
                ahead = min(2 * ahead, len(right))

    def encode(self, text):
        return [token for piece in self.pieces(text) for token in self.tokens(piece.encode())]

    def decode(self, ids):
        return b"".join([self.bytes_of[i] for i in ids])

    # whole texts, with short pieces looked up

    def lookup(self, piece):
        found = self.kept.get(piece)
        if found is None:
            ids = self.tokens(piece.encode())
            found = (" ".join([self.decimal[i] for i in ids]), len(ids), self.decode(ids))
            if len(piece) <= KEPT_CHARS:
                if len(self.kept) >= KEPT_PIECES:
                    self.kept.clear()
                self.kept[piece] = found
        return found

    def digests(self, text):
        """Number of tokens, SHA-256 of the ids as text, SHA-256 of the bytes the ids decode to."""
        parts = [self.kept.get(p) or self.lookup(p) for p in self.pieces(text)]
        ids = " ".join([p[0] for p in parts])
        data = b"".join([p[2] for p in parts])
        return sum([p[1] for p in parts]), sha256(ids.encode()).hexdigest(), sha256(data).hexdigest()


def _sent(spark, vocabulary):
    return spark.sparkContext.broadcast(read_ranks(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")))


def encode(docs, id_col="doc_id", text_col="text", vocabulary=None):
    """doc_id, n_tokens, ids."""
    ranks = _sent(docs.sparkSession, vocabulary)

    def start():
        encoder = TreeEncoder(ranks.value)

        def work(text):
            ids = encoder.encode(text)
            return len(ids), ids

        return work

    return map_texts(docs, id_col, text_col, start, "n_tokens bigint, ids array<int>")


def decode(encoded, id_col="doc_id", ids_col="ids", vocabulary=None):
    """doc_id, text of the ids (null ids: empty); bytes that are not UTF-8 become U+FFFD."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    ranks = _sent(encoded.sparkSession, vocabulary)
    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        table = {rank: token for token, rank in ranks.value.items()}
        for batch in batches:
            texts = [b"".join([table[i] for i in ids or ()]).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs, id_col="doc_id", text_col="text", vocabulary=None):
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (bytes the ids decode to)."""
    ranks = _sent(docs.sparkSession, vocabulary)

    def start():
        return TreeEncoder(ranks.value).digests

    return map_texts(docs, id_col, text_col, start, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
