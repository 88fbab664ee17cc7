"""Lexical retrieval packing: training sequences of documents that share words.

Method: a sharded BM25 inverted index.  Documents are tokenised once; their
token ids are the terms, and document frequencies and the mean length are
counted over all documents.  Documents are dealt to shards by their two weightiest
terms, so lexical neighbours mostly meet in one shard; ranges of (terms, row)
split a group of any size.  A shard is at most ``SHARD`` ids (or one
longer document), so a task holds one bounded index at a time, however many
shards its partition has.

In a shard the first unused document seeds a window.  The index scores all
unused documents against the seed's terms, and the best ones fill the window in
the order of their scores (ties: shard order).  The one that crosses the
window's end is cut there and its rest seeds the next window; a document longer
than a window fills whole ones and the rest seeds the last.  A window that is
open when a shard ends is filled from the partition's next one.  What is left at the
partition's end is cut into windows whose lengths are powers of two, which
need no padding, so no sequence is padded at all.

Results for odd input: null and blank texts are the end id alone.  Every row is
packed, repeated ones too; a null doc_id stays null.  Extra columns are ignored.
An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm import textblocks as tb
from barwise.llm.counts import summed
from barwise.session import written

LENGTH = 4096
END_ID = 2
#: The usual constants of BM25.
K1, B = 1.2, 0.75
#: Ids of one shard's index, and of one partition as far as there are at most ``PARTS``.
SHARD, PARTITION, PARTS = 1 << 21, 1 << 22, 20_000
#: Ranges dealt to a partition, and documents that a partition's borders are drawn from.
RANGES, SAMPLE = 4, 64
#: Words, and pre-tokens, whose ids a worker remembers before it starts afresh (about 80 MB each).
TABLE, PARTS_HELD = 2_000_000, 400_000
#: Words that a worker adds before it puts them into its long table, besides an eighth of that; bytes of text it cuts at a time.
NEWEST, TEXT_BLOCK = 20_000, 1 << 19
#: Fixed value: the word vocabulary's pre-token pattern.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words of Latin letters, digits and marks, which the tokenizer's normalizer only lower-cases.
PLAIN = regex.compile(r"[!-~\u00a1-\u024f]+")
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Words:
    """Token ids of texts, made word by word.

    The tokenizer lower-cases, drops white space and cuts at it, so a text's ids are those of its words
    in turn.  Words are looked up by the hashes of their lower-cased bytes in one sorted table, a block of
    texts at a time.  A new word of Latin letters, digits and marks is cut into the tokenizer's own
    pre-tokens, which recur far more than words; new ones are encoded as one text, in which each ends
    with an end-of-word token.  Other words, and texts that may hold a special token's string, are
    encoded as they are."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.parts = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.ends = np.zeros(len(vocabulary), bool)
        self.ends[[n for x, n in vocabulary.items() if x.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        #: (hash, first id, number of ids) of the words by hash: all but the newest, and these
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
        self.ids, self.held = np.zeros(1 << 16, self.dtype), 0

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.dtype).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn_parts(self, parts: list[str]) -> None:
        """Encode pre-tokens and remember their ids."""
        raw = self.encoded([" ".join(parts)])[0] if parts else b""
        stops = np.flatnonzero(self.ends[np.frombuffer(raw, self.dtype)]) + 1
        if len(stops) == len(parts):
            at = (stops * self.dtype.itemsize).tolist()
            self.parts.update((p, raw[x:y]) for p, x, y in zip(parts, [0, *at], at))
        else:                                                   # not a vocabulary of word ends
            self.parts.update(zip(parts, self.encoded(parts)))

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Put new words, by ascending hash, into the table."""
        if len(self.parts) > PARTS_HELD:
            self.parts.clear()
        cut = [PRE_TOKEN.findall(w.lower()) if PLAIN.fullmatch(w) else None for w in words]
        self.learn_parts(list(set(chain.from_iterable(filter(None, cut))).difference(self.parts)))
        rest = iter(self.encoded([w for w, c in zip(words, cut) if c is None]))
        got = [next(rest) if c is None else b"".join(map(self.parts.__getitem__, c)) for c in cut]
        size = np.fromiter(map(len, got), np.int64, len(got)) // self.dtype.itemsize
        first = self.held + np.cumsum(size) - size
        while self.held + int(size.sum()) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.held: self.held + int(size.sum())] = np.frombuffer(b"".join(got), self.dtype)
        self.held += int(size.sum())
        old, newest = self.tables
        newest = self.merged(newest, (hashes, first, size))
        if len(newest[0]) > NEWEST + len(old[0]) // 8:          # few copies of a long table
            old, newest = self.merged(old, newest), tuple(x[:0] for x in newest)
        self.tables = [old, newest]

    def merged(self, a: tuple, b: tuple) -> tuple:
        at = np.searchsorted(a[0], b[0])
        return tuple(np.insert(x, at, y) for x, y in zip(a, b))

    def found(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is known, its first id's place and its number of ids."""
        known, first, size = np.zeros(len(names), bool), np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for table in self.tables:
            left = np.flatnonzero(~known)
            if len(table[0]) and len(left):
                at = np.minimum(np.searchsorted(table[0], names[left]), len(table[0]) - 1)
                same = table[0][at] == names[left]
                known[left[same]], first[left[same]], size[left[same]] = True, table[1][at[same]], table[2][at[same]]
        return known, first, size

    def of(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of the texts that lie between ``offsets`` of UTF-8 ``data``."""
        if sum(len(t[0]) for t in self.tables) > TABLE:
            self.forget()
        whole = data.tobytes()
        if b"<|" in whole:
            texts = [whole[a:b] for a, b in zip(offsets, offsets[1:])]
            odd = [i for i, t in enumerate(texts) if b"<|" in t]
            plain = self.of(np.frombuffer(b"".join(b"" if i in set(odd) else t for i, t in enumerate(texts)), np.uint8),
                            np.cumsum([0, *(0 if b"<|" in t else len(t) for t in texts)]))
            for i, ids in zip(odd, self.encoded([texts[i].decode() for i in odd])):
                plain[i] = ids
            return plain
        first, last = tb.word_spans(data, offsets[:-1][offsets[:-1] < len(data)]) if len(data) else (np.zeros(0, np.int64),) * 2
        names, sample, where = np.unique(tb.span_hashes(data, first, last), return_index=True, return_inverse=True)
        known, begin, size = self.found(names)
        if not known.all():
            new = sample[~known]
            self.learn(names[~known], [whole[a:b].decode() for a, b in zip(first[new].tolist(), last[new].tolist())])
            _, begin, size = self.found(names)
        size = size[where]
        stop = np.cumsum(size)
        ids = self.ids[np.repeat(begin[where] - (stop - size), size) + np.arange(int(size.sum()))]
        raw, width = ids.tobytes(), self.dtype.itemsize
        edge = (np.concatenate([[0], stop])[np.searchsorted(first, offsets)] * width).tolist()
        return [raw[a:b] for a, b in zip(edge, edge[1:])]


@lru_cache(maxsize=1)
def _words(path: str) -> Words:
    return Words(path)


def tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (without the end id) of every row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            for a, b in tb.blocks(offsets, TEXT_BLOCK):
                ids = _words(tokenizer).of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, ids binary")


def terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a document, ascending, and how often each occurs."""
    ids = np.sort(ids, kind="stable")                           # a radix sort for two-byte ids
    at = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
    return ids[at].astype(np.int64), np.diff(np.r_[at, len(ids)])


class Corpus:
    """Term statistics of all documents: inverse document frequency and mean length."""

    def __init__(self, rows: DataFrame, dtype: np.dtype, vocabulary: int):
        def count(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
            df, size = np.zeros(vocabulary, np.int64), np.zeros(2, np.int64)
            for batch in batches:
                for x in batch.column(0):
                    ids = np.frombuffer(x.as_py(), dtype)
                    df[terms(ids)[0]] += 1
                    size += (1, len(ids))
            return {"df": df, "size": size}

        got = summed(rows.select("ids"), count)
        df = got.get("df", np.zeros(vocabulary, np.int64))
        self.documents, self.ids = map(int, got.get("size", np.zeros(2, np.int64)))
        self.idf = np.log1p((self.documents - df + 0.5) / (df + 0.5))
        self.mean = max(self.ids / max(self.documents, 1), 1.0)
        self.dtype = dtype

    def weights(self, term: np.ndarray, tf: np.ndarray, size: int) -> np.ndarray:
        """What each term of a document of ``size`` ids adds to its score."""
        return self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / self.mean))

    def key(self, ids: np.ndarray) -> int:
        """The document's two weightiest terms as one number; -1 without terms."""
        term, tf = terms(ids)
        if not len(term):
            return -1
        w = self.weights(term, tf, len(ids))
        first = int(np.argmax(w))
        w[first] = -1
        return (int(term[first]) << 31) | int(term[int(np.argmax(w))])


class Index:
    """Inverted index of one shard: postings of every term, with their weights."""

    def __init__(self, corpus: Corpus, docs: list[np.ndarray]):
        found = [terms(d) for d in docs]
        term = np.concatenate([t for t, _ in found])
        weight = np.concatenate([corpus.weights(t, tf, len(d)) for (t, tf), d in zip(found, docs)])
        doc = np.repeat(np.arange(len(docs)), [len(t) for t, _ in found])
        order = np.argsort(term.astype(corpus.dtype), kind="stable")
        self.doc, self.weight, self.size = doc[order], weight[order], len(docs)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(corpus.idf)))])

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 score of every document of the shard for distinct terms."""
        held = self.first[query + 1] - self.first[query]
        at = np.repeat(self.first[query] - (np.cumsum(held) - held), held) + np.arange(int(held.sum()))
        return np.bincount(self.doc[at], self.weight[at], self.size)

    def ranked(self, query: np.ndarray, unused: np.ndarray) -> Iterator[int]:
        """The unused documents by falling score, equal ones in order."""
        left = np.flatnonzero(unused)
        score, wanted = -self.scores(query)[left], 32
        while wanted < len(left):
            edge = np.partition(score, wanted - 1)[wanted - 1]
            near = np.flatnonzero(score <= edge)
            yield from left[near[np.argsort(score[near], kind="stable")]].tolist()
            left, score = left[score > edge], score[score > edge]
        yield from left[np.argsort(score, kind="stable")].tolist()


Doc = tuple[int | None, np.ndarray]


class Packer:
    """Fills windows from one shard after the other."""

    def __init__(self, corpus: Corpus, length: int, end_id: int, first_id: int):
        self.corpus, self.length, self.end = corpus, length, np.array([end_id], "<u4")
        self.next_id, self.open, self.room, self.query = first_id, [], length, np.zeros(0, np.int64)
        self.out: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for (doc_id, ids), a, b in pieces:
            self.out.append((doc_id, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), len(ids), self.next_id, offset))
            offset += b - a
        self.next_id += 1

    def add(self, doc: Doc, start: int) -> int:
        """Put a document's ids from ``start`` on into the open window; returns how far it got."""
        stop = min(len(doc[1]), start + self.room)
        self.open.append((doc, start, stop))
        self.room -= stop - start
        if not self.room:
            self.emit(self.open)
            self.open, self.room = [], self.length
        return stop

    def whole(self, doc: Doc) -> None:
        """Put in all of a document; if windows end in it, its rest is the next one's seed."""
        at = 0
        while at < len(doc[1]):
            if not self.open:
                self.query = terms(doc[1][:-1])[0]
            at = self.add(doc, at)

    def shard(self, docs: list[Doc]) -> None:
        index, unused, first = Index(self.corpus, [ids[:-1] for _, ids in docs]), np.ones(len(docs), bool), 0
        while True:
            if not self.open:                                   # a new window: the first unused document seeds it
                while first < len(docs) and not unused[first]:
                    first += 1
                if first == len(docs):
                    return
                unused[first] = False
                self.whole(docs[first])
                continue
            seed = self.next_id
            for i in index.ranked(self.query, unused):
                unused[i] = False
                self.whole(docs[i])
                if self.next_id != seed:
                    break
            else:
                return

    def close(self) -> None:
        """Cut what the open window holds into windows whose lengths are powers of two."""
        left = sum(b - a for _, a, b in self.open)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            part = []
            while size:
                doc, a, b = self.open.pop(0)
                part.append((doc, a, min(b, a + size)))
                if b - a > size:
                    self.open.insert(0, (doc, a + size, b))
                size -= part[-1][2] - a
            self.emit(part)
        self.open, self.room = [], self.length

    def rows(self) -> pa.RecordBatch:
        done, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], [f.split()[0] for f in PIECE.split(", ")])


def _pack(corpus: Corpus, length: int, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(corpus, length, end_id, TaskContext.get().partitionId() << 40)
        held, size = [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(np.frombuffer(raw.as_buffer(), corpus.dtype), np.array([end_id], corpus.dtype))
                if held and size + len(ids) > SHARD:
                    packer.shard(held)
                    held, size = [], 0
                    if packer.out:
                        yield packer.rows()
                held.append((doc_id, ids))
                size += len(ids)
        if held:
            packer.shard(held)
        packer.close()
        if packer.out:
            yield packer.rows()

    return rows


def _keyed(rows: DataFrame, corpus: Corpus, edges: list[tuple[int, int]]) -> DataFrame:
    """row, doc_id and ids with their key and the range of (key, row) between the edges."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [corpus.key(np.frombuffer(x.as_buffer(), corpus.dtype)) for x in batch.column(2)]
            at = [bisect_right(edges, x) for x in zip(found, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64()), pa.array(at, pa.int32())],
                                             ["row", "doc_id", "ids", "key", "range"])

    return rows.select("row", "doc_id", "ids").mapInArrow(keys, "row long, doc_id long, ids binary, key long, range int")


def _edges(rows: DataFrame, corpus: Corpus, parts: int) -> list[tuple[int, int]]:
    """Borders of ``RANGES`` ranges a partition that hold about as many documents each, from ``SAMPLE`` documents a
    partition; they only decide how evenly the documents are dealt."""
    rate = min(1.0, max(20_000, SAMPLE * parts) / max(corpus.documents, 1))
    some = _keyed(rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(rate * (1 << 20))), corpus, [])
    found = sorted((r["key"], r["row"]) for r in some.select("key", "row").collect())
    ranges = parts * RANGES
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if len(found) > ranges else []


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    ``tokenizer`` is a `tokenizers` file, on every machine, that drops white space and cuts at it."""
    words = Words(tokenizer)
    cut = written(tokens(docs, tokenizer).withColumn("row", F.monotonically_increasing_id()), "tokens")
    corpus = Corpus(cut, words.dtype, words.tokenizer.get_vocab_size())
    parts = min(max(1, -(-(corpus.ids + corpus.documents) // PARTITION)), PARTS)
    keyed = _keyed(cut, corpus, _edges(cut, corpus, parts))
    dealt = keyed.repartition(parts, "range").sortWithinPartitions("range", "key", "row")
    return dealt.select("doc_id", "ids").mapInArrow(_pack(corpus, length, end_id), PIECE)
