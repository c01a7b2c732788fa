"""Lexical retrieval packing.

Texts become token ids once. Document frequencies, the number of documents and their mean length
are counted over all of them. Documents are then put in an order of likeness, which is cut into
shards of bounded size, each with a BM25 inverted index over token ids. The first unused document
seeds a window; its best unused neighbours fill it in order of score, the last one cut so that the
window is exactly full. What is left of a cut document stays unused and goes to a later window.

A window is filled from the seed's shard: neighbours that the order puts elsewhere are not found.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.bpe import byte_characters
from loglake.llm.common import stored, text_or_empty
from loglake.llm.ragged import gather, release, segment_sums, slices, starts_of, texts_of

K1, B = 1.2, 0.75


class PairTable:
    """Merge rules by pairs of symbols, in hash tables: what finds its place taken goes to the next table."""

    BITS = 18

    def __init__(self, pairs: np.ndarray, merged: np.ndarray):
        self.pairs, self.merged = np.append(pairs, -1), np.append(merged, -1)
        self.none = len(pairs)
        self.tables, left = [], np.arange(len(pairs))
        while len(left):
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * 0x5851F42D4C957F2D * len(self.tables) & 0xFFFFFFFFFFFFFFFF)
            at, table = self._place(pairs[left], factor), np.full(1 << self.BITS, self.none, np.int32)
            table[at] = left
            self.tables.append((factor, table))
            left = left[table[at] != left]

    def _place(self, pairs: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (pairs.astype(np.uint64) * factor >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` for those that are never merged."""
        out = np.full(len(pairs), self.none, np.int32)
        left = np.arange(len(pairs))
        for factor, table in self.tables:
            wanted = pairs[left]
            found = table[self._place(wanted, factor)]
            same = self.pairs[found] == wanted
            out[left[same]] = found[same]
            # An empty place says that the pair is nowhere.
            left = left[~same & (found != self.none)]
        return out


class WordIds:
    """Token ids of words, with the recent words remembered.

    For a vocabulary that drops white space and never joins what white space parts, the ids of a text
    are those of its words in turn. Words of Latin letters are merged here, many at a time, by the
    vocabulary's rules; all others are left to the tokenizers library.
    """

    MARK = "0"  # a word of one token; words that hold it are encoded alone
    REMEMBERED = 100_000
    #: Letters that neither composing nor lower-casing changes, once they are lower case.
    PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        (self.mark,) = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids, rules = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = np.int64(1 + max(ids.values()))
        # Each token comes of one rule alone, so equal pairs of a word may be merged at once.
        self.mergeable = model.get("end_of_word_suffix") == self.END and len({a + b for a, b in rules}) == len(rules)
        self.table = PairTable(
            np.array([ids[a] * self.size + ids[b] for a, b in rules], np.int64), np.array([ids[a + b] for a, b in rules], np.int64))
        of_byte = byte_characters()
        self.inner, self.last = (np.zeros(256, np.int64) for _ in range(2))
        for character, byte in of_byte.items():
            self.inner[byte], self.last[byte] = ids[character], ids[character + self.END]
        self.known = pa.array([], pa.large_string())
        self.known_ids, self.known_lengths = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters in one array, and how many each has.

        In each round every word merges its pair of lowest rank, wherever it stands.
        """
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        symbols, ends = self.inner[raw], offsets[1:] - offsets[0] - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(offsets))
        done, owners = [], []
        while len(symbols):
            rank = np.full(len(symbols), self.table.none, np.int32)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.table.ranks(symbols[inside] * self.size + symbols[inside + 1])
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            active = lowest != self.table.none
            hits = np.flatnonzero(active & (rank == lowest))
            # Of overlapping hits (a run of one symbol) every second stays, from the left.
            if len(hits):
                turn = np.arange(len(hits))
                begin = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(hits) != 1]), turn, 0))
                hits = hits[(turn - begin) % 2 == 0]
            symbols[hits] = self.table.merged[rank[hits]]
            done.append(symbols[~active])
            owners.append(owner[~active])
            active[hits + 1] = False
            symbols, owner = symbols[active], owner[active]
        owners = np.concatenate([np.zeros(0, np.int32), *owners])
        flat = np.concatenate([np.zeros(0, np.int64), *done])[np.argsort(owners, kind="stable")]
        return flat.astype("<u4"), np.bincount(owners, minlength=len(words)).astype(np.int64)

    def by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any words in one array, and how many each has."""
        plain = [w for w in words if self.MARK not in w]
        out = {}
        for i in range(0, len(plain), 2000):
            group = plain[i:i + 2000]
            (whole,) = self.tokenizer.encode_batch_fast([f" {self.MARK} ".join(group)], add_special_tokens=False)
            ids = np.array(whole.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            at = 0
            for word, end in zip(group, ends):
                out[word] = ids[at:end]
                at = end + 1
        marked = [w for w in words if self.MARK in w]
        for word, whole in zip(marked, self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)):
            out[word] = np.array(whole.ids, "<u4")
        parts = [out[w] for w in words]
        return np.concatenate([np.zeros(0, "<u4"), *parts]), np.array([len(p) for p in parts], np.int64)

    def of(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: an array, and where in it each word's begin and how many they are.

        Words that recur, here or since lately, are remembered.
        """
        place = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(place < 0)
        new = words.take(pa.array(missing))
        plain = pc.match_substring_regex(new, self.PLAIN).to_numpy(zero_copy_only=False) & self.mergeable
        order = np.concatenate([missing[plain], missing[~plain]])
        merged, merged_lengths = self.merge(new.filter(pa.array(plain)))
        others, other_lengths = self.by_library(new.filter(pa.array(~plain)).to_pylist())
        flat = np.concatenate([self.known_ids, merged, others])
        lengths = np.concatenate([self.known_lengths, merged_lengths, other_lengths])
        place[order] = len(self.known) + np.arange(len(order))
        starts, own = starts_of(lengths)[place], lengths[place]
        # Remembered from now on: what was, and new words that recur; if too many, this slice's alone.
        whole = len(self.known) < self.REMEMBERED
        kept = np.flatnonzero((counts > 1) & (place >= len(self.known) if whole else True))
        ids, sizes = gather(flat, starts[kept], own[kept]), own[kept]
        if whole:
            self.known = pa.concat_arrays([self.known, words.take(pa.array(kept))])
            self.known_ids, self.known_lengths = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_lengths, sizes])
        else:
            self.known, self.known_ids, self.known_lengths = words.take(pa.array(kept)), ids, sizes
        return flat, starts, own

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end_id`` after each, in one array, and how many each has."""
        # A mark after a letter is always a word of its own, and case does not matter. (The library lowers a
        # slice of an array wrongly, so this is done on the new array.)
        parted = pc.replace_substring_regex(texts, r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([.,;:!?&#$%)]+)", r"\1 \2")
        split = pc.ascii_split_whitespace(pc.ascii_lower(parted))
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        flat, starts, lengths = self.of(coded.dictionary, np.bincount(code, minlength=len(coded.dictionary)))
        # One more word, of the end id alone, closes each text.
        starts, lengths = np.append(starts, len(flat)), np.append(lengths, 1)
        flat = np.append(flat, np.array([end_id], "<u4"))
        words = np.diff(split.offsets.to_numpy()).astype(np.int64)
        code = np.insert(code.astype(np.int64), np.cumsum(words), len(starts) - 1)
        each = lengths[code]
        ids = gather(flat, starts[code], each)
        return ids, segment_sums(each, words + 1)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """Loaded once in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


class Corpus(NamedTuple):
    """Counts over all documents: how many, their mean length, and how many hold each term."""

    n: int
    mean: float
    df: np.ndarray


def terms_of(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and frequency of each distinct term of each document, by document and term."""
    if not len(ids):
        return (np.zeros(0, np.int64),) * 3
    size = int(ids.max()) + 1
    key = np.sort(np.repeat(np.arange(len(counts), dtype=np.int64) * size, counts) + ids)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    doc, term = np.divmod(key[edge], size)
    return doc, term, np.diff(np.append(edge, len(key)))


def bm25(corpus: Corpus, counts: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    df = corpus.df[term]
    norm = K1 * (1 - B + B * counts / max(corpus.mean, 1))
    return np.log1p((corpus.n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm[doc])


class Index:
    """A shard's inverted index: per term its documents and their BM25 weights.

    Weights follow the counts of ``corpus``; without it the shard's documents are all there are.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, query_terms: int | None = None, corpus: Corpus | None = None):
        n, size = len(counts), int(ids.max()) + 1 if len(ids) else 1
        doc, term, tf = terms_of(ids, counts)
        held = np.bincount(term, minlength=size)
        weight = bm25(corpus or Corpus(n, counts.mean() if n else 0, held), counts, doc, term, tf)
        order = np.argsort(term.astype(np.uint16) if size <= 1 << 16 else term, kind="stable")
        self.docs, self.weights = doc[order], weight[order].astype(np.float32)
        self.starts = np.concatenate([[0], np.cumsum(held)])
        # The query of a document: its own terms that another document of the shard has.
        shared = held[term] > 1
        doc, term = doc[shared], term[shared]
        if query_terms is not None:
            weight = weight[shared].astype(np.float32)
            falling = (0xFFFFFFFF - weight.view(np.uint32)).astype(np.int64)
            order = np.argsort(doc << 32 | falling, kind="stable")
            keep = order[np.arange(len(doc)) - np.searchsorted(doc, doc) < query_terms]
            doc, term = doc[keep], term[keep]
        self.query_terms = term
        self.query_starts = np.searchsorted(doc, np.arange(n + 1))
        self.n = n

    def score(self, doc: int) -> np.ndarray:
        """BM25 of every document for the query of ``doc``."""
        terms = self.query_terms[self.query_starts[doc]:self.query_starts[doc + 1]]
        starts, held = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(starts - starts_of(held), held)
        at += np.arange(len(at))
        return np.bincount(self.docs[at], weights=self.weights[at], minlength=self.n)


def fill_windows(index: Index, counts: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``document, start, length, sequence, offset`` that hold every token exactly once.

    Every sequence but the last is exactly full.
    """
    pieces, sequence = [], 0
    start = np.zeros(len(counts), np.int64)
    for doc in np.flatnonzero(counts >= window).tolist():
        for at in range(0, int(counts[doc]) - window + 1, window):
            pieces.append((doc, at, window, sequence, 0))
            sequence += 1
        start[doc] = counts[doc] // window * window
    left = counts - start
    unused = left > 0
    seed, n = 0, len(counts)
    while True:
        while seed < n and not unused[seed]:
            seed += 1
        if seed == n:
            return pieces
        used = 0

        def put(doc: int) -> None:
            nonlocal used
            length = min(int(left[doc]), window - used)
            pieces.append((doc, int(start[doc]), length, sequence, used))
            used += length
            start[doc] += length
            left[doc] -= length
            unused[doc] = left[doc] > 0

        put(seed)
        if used < window:
            scores = np.where(unused, index.score(seed), -1)
            best = min(n, 16)
            near = np.argpartition(-scores, best - 1)[:best]
            near = near[np.lexsort((near, -scores[near]))].tolist()
            for doc in near:
                if used == window or scores[doc] < 0:
                    break
                put(doc)
            if used < window and n > best:
                for doc in np.lexsort((np.arange(n), -scores)).tolist():
                    if used == window or scores[doc] < 0:
                        break
                    if unused[doc]:
                        put(doc)
        sequence += 1


#: Sequences are numbered within a partition in the lower bits: 2^23 partitions of 2^40 sequences each.
SEQUENCE_BITS = 40

SCHEMA = ("start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def binaries(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive stretches of ``values`` as binary values."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def numbers(column: pa.Array | pa.ChunkedArray, counts: np.ndarray) -> np.ndarray:
    """The token ids of all rows in one array; two bytes each where that holds every id, else four."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * counts.sum() else "<u4")


def coded(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, bytes, doc_tokens, ids`` of all documents, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        dtype = "<u2" if max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for batch in slices(batches, "text"):
            texts = texts_of(batch.column("text"))
            ids, counts = words.texts(texts, end_id)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "bytes": pc.add(pc.binary_length(texts).cast(pa.int64()), 8),
                "doc_tokens": counts.astype(np.int64), "ids": binaries(ids.astype(dtype), counts)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select("doc_id", text_or_empty().alias("text"))
    return stored(docs.mapInArrow(run, f"doc_id {kind}, bytes bigint, doc_tokens bigint, ids binary"), "coded")


def counted(docs: DataFrame, n: int, tokens: int) -> Corpus:
    """The counts of all documents; no more than the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1, np.int64)
        for batch in slices(batches, "ids"):
            counts = batch.column("doc_tokens").to_numpy()
            _, term, _ = terms_of(numbers(batch.column("ids"), counts), counts)
            own = np.bincount(term, minlength=len(df))
            own[:len(df)] += df
            df = own
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": held, "df": df[held]})

    rows = docs.select("doc_tokens", "ids").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term = rows.column("term").to_numpy()
    df = np.zeros(int(term.max()) + 1, np.int64)
    df[term] = rows.column("df").to_numpy()
    return Corpus(n, tokens / n, df)


#: Numbers a document is told by in the order of likeness, and documents that shape the order.
DIMENSIONS, SHAPING = 64, 50_000


class Profiles:
    """Documents as few numbers: BM25 weights, scaled to length one, on fixed random directions."""

    def __init__(self, corpus: Corpus):
        self.corpus = corpus
        self.directions = np.random.default_rng(1).standard_normal((len(corpus.df), DIMENSIONS), np.float32)

    def of(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        doc, term, tf = terms_of(ids, counts)
        weight = bm25(self.corpus, counts, doc, term, tf).astype(np.float32)
        first = np.searchsorted(doc, np.arange(len(counts) + 1))
        out = np.empty((len(counts), DIMENSIONS), np.float32)
        for i in range(len(counts)):  # every document has its end id at least
            own = weight[first[i]:first[i + 1]]
            out[i] = own @ self.directions[term[first[i]:first[i + 1]]] / max(float(np.sqrt(own @ own)), 1e-9)
        return out


class Tree:
    """Halves the profiles again and again along the direction in which they differ most."""

    def __init__(self, profiles: np.ndarray, depth: int):
        self.depth = depth
        self.directions = np.zeros((2 << depth, DIMENSIONS), np.float32)
        self.middles = np.zeros(2 << depth, np.float32)
        self._halve(profiles, 1)

    def _halve(self, rows: np.ndarray, node: int) -> None:
        if not len(rows):
            return
        centred = rows - rows.mean(0)
        way = centred[np.argmax((centred * centred).sum(1))]
        for _ in range(6):
            way = centred.T @ (centred @ way)
            way = way / max(float(np.linalg.norm(way)), 1e-9)
        at = (rows * way).sum(1)
        self.directions[node], self.middles[node] = way, np.median(at)
        if node < 1 << self.depth:
            right = at >= self.middles[node]
            self._halve(rows[~right], 2 * node)
            self._halve(rows[right], 2 * node + 1)

    def leaves(self, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each profile and its place there."""
        node = np.ones(len(profiles), np.int64)
        for _ in range(self.depth):
            node = 2 * node + ((profiles * self.directions[node]).sum(1) >= self.middles[node])
        return node, (profiles * self.directions[node]).sum(1)


def by_likeness(docs: DataFrame, corpus: Corpus, shards: int) -> DataFrame:
    """``docs`` with ``leaf`` and ``place``: near each other in that order are documents alike in words.

    ``SHAPING`` random documents shape the order; every document has its place in it.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(corpus)
        for batch in slices(batches, "ids"):
            counts = batch.column("doc_tokens").to_numpy()
            found = profiles.of(numbers(batch.column("ids"), counts), counts)
            yield pa.RecordBatch.from_pydict({"profile": binaries(found.ravel(), np.full(len(counts), DIMENSIONS))})

    shaping = docs.select("doc_tokens", "ids").sample(min(1.0, SHAPING / max(corpus.n, 1)), seed=1).mapInArrow(sketch, "profile binary").toArrow()
    found = np.frombuffer(b"".join(shaping.column("profile").to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    tree = Tree(found, max(0, min((shards - 1).bit_length(), (len(found) // 8).bit_length() - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(corpus)
        for batch in slices(batches, "ids"):
            counts = batch.column("doc_tokens").to_numpy()
            leaf, place = tree.leaves(profiles.of(numbers(batch.column("ids"), counts), counts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf), pa.array(place.astype(np.float64))], [*batch.schema.names, "leaf", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "bytes", "doc_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, bytes bigint, doc_tokens bigint, ids binary, leaf bigint, place double")


def in_shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Consecutive rows of about ``limit`` by their ``bytes``."""
    held, size = [], 0
    for batch in batches:
        ends, begin = np.cumsum(batch.column("bytes").to_numpy()), 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + (not held), int(np.searchsorted(ends, before + limit - size, side="right")))
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1]) - before
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            begin = end
    if held:
        yield pa.Table.from_batches(held)


def pack(documents: DataFrame, path: str, window: int = 4096, end_id: int = 2, shard_bytes: int = 4 << 20,
         query_terms: int | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers. A document's tokens
    are those of its text and then ``end_id``; each lies in exactly one piece. Windows are exactly
    full, except for one at most in each shard of about ``shard_bytes`` of text. A document is
    queried by all its terms, or by the ``query_terms`` of highest weight if a number is given.

    A null text counts as empty and has the end id alone. Documents of equal id (null too) are told
    apart by their tokens; equal rows are packed each on its own. Ties of score go to the earlier
    document by id, then tokens. Other columns are ignored; an empty table gives no rows.
    """
    docs = coded(documents, path, end_id)
    n, tokens, size = docs.agg(F.count("*"), F.sum("doc_tokens"), F.sum("bytes")).first()
    corpus = counted(docs, n, tokens) if n else Corpus(0, 0, np.zeros(1, np.int64))
    shards = max(1, -(-(size or 0) // shard_bytes))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        for shard in in_shards(batches, shard_bytes):
            release()
            shard = shard.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
            counts = shard.column("doc_tokens").to_numpy()
            ids = numbers(shard.column("ids"), counts).astype("<u4")
            pieces = np.array(fill_windows(Index(ids, counts, query_terms, corpus), counts, window), np.int64).reshape(-1, 5)
            doc, start, length, sequence, offset = pieces.T
            out = pa.table({
                "doc_id": shard.column("doc_id").take(pa.array(doc)), "start": start, "length": length,
                "ids": binaries(gather(ids, starts_of(counts)[doc] + start, length), length), "doc_tokens": counts[doc],
                "sequence_id": first + sequence, "offset": offset})
            first += int(sequence.max(initial=-1)) + 1
            yield from out.combine_chunks().to_batches()

    order = ["leaf", "place", "doc_id", "doc_tokens"]
    ordered = by_likeness(docs, corpus, shards).repartitionByRange(-(-shards // 4), *order).sortWithinPartitions(*order, "ids")
    return ordered.select("doc_id", "bytes", "doc_tokens", "ids").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
