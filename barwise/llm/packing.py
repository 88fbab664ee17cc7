"""Best-fit packing of documents into fixed-length token sequences.

Method: bound-certified repacking.  Every document is tokenised whole and
closed by an end id; one longer than a sequence is cut into full sequences,
the first piece taking what is left over.  Pieces shorter than a sequence are
spread over partitions, each partition packs its own by best-fit decreasing
(the fullest sequence that still has room), and dual feasible functions give a
lower bound of its number of sequences.  A partition that meets its bound is
certified.  The others give back their least full sequences, the pooled pieces
are dealt to fewer partitions, and best-fit decreasing runs again, until the
pool is certified, is one partition, or no longer gets better.

Results for odd input: a null text is an empty document, which is the end id
alone.  Each row is packed, repeated ones too; a null doc_id stays null.  An
empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm import textblocks as tb
from barwise.session import written

LENGTH = 1024
END_ID = 2
#: Pieces that one partition packs at a time.
PIECES = 40_000
#: Words whose ids a worker remembers before it starts afresh (about 40 MB).
CACHE_WORDS = 150_000
#: Fixed value: the byte-level vocabulary's pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of Latin letters, ASCII marks and line ends, for which both tokenizer libraries cut alike.
PLAIN = re.compile(r" ?[\n!-~\u00a1-\u02af]*")
#: Rounds of exchange at most; each has about an eighth of the pieces of the last.
ROUNDS = 6
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _words(ranks: str):
    """The same vocabulary as ranks, for single words: several times faster, equal ids."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


class Ids(dict):
    """Token ids (little-endian, 32 bits) of the space-separated parts of texts.

    A space before a visible character always begins a new pre-token, so a text
    may be cut there.  A part that ends in white space has no entry of its own
    (None): the space after it may belong to its last pre-token, so a text with
    such a part is encoded whole, and so is one that holds an added token's string.
    """

    def __init__(self, path: str, ranks: str | None):
        super().__init__()
        self.path, self.ranks, self.first = path, ranks, {}
        self.added = [x.content for x in _tokenizer(path).get_added_tokens_decoder().values()]

    def encode(self, texts: list[str]) -> list[bytes]:
        got = _tokenizer(self.path).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in got]

    def learn(self, known: dict, parts: set[str], before: str) -> None:
        new = [before + p for p in parts.difference(known)]
        plain = [p for p in new if PLAIN.fullmatch(p)] if self.ranks else []
        rest = list(set(new).difference(plain)) if plain else new
        found = chain(zip(plain, (array("I", ids).tobytes() for ids in map(_words(self.ranks).encode_ordinary, plain)) if plain else ()),
                      zip(rest, self.encode(rest)))
        known.update((p[len(before):], None if p[-1:].isspace() else ids) for p, ids in found)

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self) + len(self.first) > CACHE_WORDS:
            self.clear()
            self.first.clear()
        odd = [any(x in t for x in self.added) for t in texts]
        cut = [[""] if whole else t.split(" ") for t, whole in zip(texts, odd)]
        heads = [c.pop(0) for c in cut]
        self.learn(self.first, set(heads), "")
        self.learn(self, set(chain.from_iterable(cut)), " ")
        out: list[bytes] = []
        for text, head, parts, whole in zip(texts, heads, cut, odd):
            if whole:
                out.append(self.encode([text])[0])
                continue
            ids = [self.first[head], *map(self.__getitem__, parts)]
            out.append(self.encode([text])[0] if None in ids else b"".join(ids))
        return out


@lru_cache(maxsize=1)
def _ids(path: str, ranks: str | None) -> Ids:
    return Ids(path, ranks)


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, ranks: str | None = None) -> DataFrame:
    """The pieces of every row, in order: start and length in ids, and the ids' CRC-32."""
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in tb.blocks(tb.utf8(batch.column(1))[1], 1 << 20):
                part = batch.slice(a, b - a)
                out = []
                for doc_id, ids in zip(part.column(0).to_pylist(), _ids(tokenizer, ranks).of([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    n, at, k = len(ids) // 4, 0, 0
                    while at < n:
                        size = (n - at) % length or length
                        out.append((doc_id, k, at, size, zlib.crc32(ids[4 * at: 4 * (at + size)])))
                        at, k = at + size, k + 1
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: bin and offset of every piece, and the number of bins.

    Bins are kept by room left; the rooms in use are the bits of one integer,
    so the fullest bin with enough room is the lowest bit from the size on.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms, count = 0, 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fit = rooms >> size
        if fit:
            room = size + ((fit & -fit).bit_length() - 1)
            same = by_room[room]
            b = same.pop()
            if not same:
                rooms &= ~(1 << room)
        else:
            room, b, count = capacity, count, count + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins, offsets, count


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions.

    One rounds down multiples of capacity / (k + 1), k = 1..20; the other, for
    each threshold, counts pieces over ``capacity - threshold`` as whole
    sequences and drops pieces under the threshold.
    """
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    weight, many = np.cumsum(count * size), np.cumsum(count)
    for t in range(1, capacity // 2 + 1):
        large = int(many[-1] - many[capacity - t])
        middle = int(weight[capacity - t] - weight[t - 1])
        best = max(best, large + -(-middle // capacity))
    return best


def _pack(capacity: int):
    """Packs each partition of (pid, length): sequence, offset, fill and whether it is certified."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            pid, size = np.concatenate(held, axis=1)
            order = np.argsort(pid, kind="stable")
            pid, size = pid[order], size[order]
            bins, offset, n = best_fit(size, capacity)
            fill = np.zeros(n, np.int64)
            np.add.at(fill, bins, size)
            name = np.zeros(n, np.int64)
            name[bins[offset == 0]] = pid[offset == 0]
            gap = n - lower_bound(size, capacity)
            # a certified partition gives back its last, part-filled sequences; one with a gap its emptiest quarter
            back = np.zeros(n, bool)
            back[np.argsort(fill, kind="stable")[: 2 if gap <= 0 else max(2, n // 4)]] = True
            back &= fill < capacity
            return pa.RecordBatch.from_arrays([pa.array(pid), pa.array(size), pa.array(name[bins]), pa.array(offset), pa.array(back[bins])],
                                              ["pid", "length", "sequence_id", "offset", "back"])

        for batch in batches:
            held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
            if sum(x.shape[1] for x in held) >= 2 * PIECES:
                yield packed()
                held = []
        if held:
            yield packed()

    return rows


def pack(rows: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """pid, sequence_id and offset of pieces (pid, unique; length up to the capacity).

    A sequence's id is the pid of the piece at its offset 0.
    """
    full = rows.where(F.col("length") == capacity).select("pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool, done = rows.where(F.col("length") < capacity).select("pid", "length"), full
    count, before = pool.count(), None
    for _ in range(ROUNDS):
        parts = max(1, -(-count // PIECES))
        dealt = pool.repartition(parts, F.xxhash64("pid", F.lit(parts)))
        step = written(dealt.mapInArrow(_pack(capacity), "pid long, length long, sequence_id long, offset long, back boolean"), "packed")
        returned = step.where("back")
        state = returned.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if parts == 1 or not state[0] or (before is not None and state[0] >= before):
            return done.union(step.select("pid", "sequence_id", "offset"))
        done = done.union(step.where("not back").select("pid", "sequence_id", "offset"))
        pool, count, before = returned.select("pid", "length"), state[0], state[0]
    return done.union(step.where("back").select("pid", "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    ``tokenizer`` is a `tokenizers` file on every machine; ``ranks``, if given,
    the file of the same vocabulary for `tiktoken`, which then encodes plain words."""
    cut = written(pieces(docs, tokenizer, length, end_id, ranks).withColumn("pid", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut.select("pid", "length"), length)
    return cut.join(placed, "pid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
