"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A text is cut where the pre-tokenizer always cuts, at a space before a character that is no white
space; each distinct piece of a batch is encoded once. The symbols of all its words stand in one
flat array. A round looks up the rank of every adjacent pair by binary search over the sorted pair
keys, merges the lowest-ranked pair of each word wherever it occurs, and sets finished words aside.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.ragged import gather, slices, starts_of, texts_of

#: White space, and the word pattern of byte-level BPE vocabularies.
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
         r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
NO_RANK = np.iinfo(np.int64).max


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tables of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        ids, merges = whole["model"]["vocab"], whole["model"]["merges"]
        self.added = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.added.values()])
        of_byte = byte_characters()
        self.byte_id = np.zeros(256, np.int64)
        for character, byte in of_byte.items():
            self.byte_id[byte] = ids[character]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        spelled = [b""] * self.size
        for token, i in ids.items():
            spelled[i] = bytes(of_byte[c] for c in token) if all(c in of_byte for c in token) else token.encode()
        for token, i in self.added.items():
            spelled[i] = token.encode()
        self.token_lengths = np.array([len(b) for b in spelled], np.int64)
        self.token_starts = starts_of(self.token_lengths)
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.words = regex.compile(WORDS)
        self.cuts = regex.compile(r"(?= [^" + SPACE + "])")
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and how many each word has."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owners = [], []
        while len(symbols):
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            starts = np.flatnonzero(first)
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(symbols), NO_RANK)
            rank[:-1] = np.where((self.keys[at] == key) & ~first[1:], self.ranks[at], NO_RANK)
            lowest = np.minimum.reduceat(rank, starts)
            spread = np.repeat(lowest, np.diff(np.append(starts, len(symbols))))
            active = spread != NO_RANK
            hits = np.flatnonzero(active & (rank == spread))
            # Of overlapping hits (a run of one symbol) every second stays, from the left.
            run = np.concatenate([[True], np.diff(hits) != 1]) if len(hits) else np.zeros(0, bool)
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0)) if len(hits) else hits
            hits = hits[(np.arange(len(hits)) - begin) % 2 == 0]
            symbols[hits] = self.merged[at[hits]]
            done_symbols.append(symbols[~active])
            done_owners.append(owner[~active])
            active[hits + 1] = False
            symbols, owner = symbols[active], owner[active]
        owners = np.concatenate(done_owners) if done_owners else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        flat = np.concatenate(done_symbols)[order] if done_symbols else np.zeros(0, np.int64)
        return flat, np.bincount(owners, minlength=len(words))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in one array, and how many each piece has."""
        words, index, word_at, word_count = [], {}, [], []
        for piece in pieces:
            found = (piece,) if piece in self.added else self.words.findall(piece)
            word_count.append(len(found))
            for word in found:
                if (i := index.get(word)) is None:
                    i = index[word] = len(words)
                    words.append(word)
                word_at.append(i)
        flat, counts = self.merge([b"" if w in self.added else w.encode() for w in words])
        if whole := [(i, self.added[w]) for i, w in enumerate(words) if w in self.added]:
            starts = starts_of(counts)
            flat = np.insert(flat, [starts[i] for i, _ in whole], [t for _, t in whole])
            counts[[i for i, _ in whole]] = 1
        at = np.array(word_at, np.int64)
        per_word = counts[at]
        ids = gather(flat, starts_of(counts)[at], per_word)
        ends = np.concatenate([[0], np.cumsum(per_word)])
        last = np.cumsum(np.array(word_count, np.int64))
        return ids, ends[last] - ends[last - np.array(word_count, np.int64)]

    def cut(self, text: str) -> list[str]:
        """Pieces of a text of which each is encoded on its own: added tokens, and cuts at spaces."""
        parts = self.split_added.split(text) if self.split_added else [text]
        out = []
        for part in parts:
            out += [part] if part in self.added else [p for p in self.cuts.split(part) if p]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in one array, and how many each text has."""
        split = pc.split_pattern(texts, " ")
        pieces = split.flatten()
        counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
        first = np.zeros(len(pieces), bool)
        begins = starts_of(counts)
        first[begins] = True
        coded = pieces.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary
        # A piece that is empty or starts with white space does not begin at a cut.
        odd = pc.invert(pc.match_substring_regex(distinct, r"^[^\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]"))
        odd_text = np.add.reduceat((odd.to_numpy(zero_copy_only=False)[code] & ~first).astype(np.int64), begins) > 0
        for token in self.added:
            odd_text |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        # Codes: the distinct pieces with their leading space, then without, then pieces of odd texts.
        known = distinct.to_pylist()
        code = np.where(first, code + len(known), code)
        extra: dict[str, int] = {}
        if odd_text.any():
            parts, sizes = [], counts.copy()
            bounds = np.append(begins, len(code))
            for i in np.flatnonzero(odd_text):
                own = [extra.setdefault(p, 2 * len(known) + len(extra)) for p in self.cut(texts[int(i)].as_py())]
                sizes[i] = len(own)
                parts.append((i, np.array(own, np.int64)))
            blocks, at = [], 0
            for i, own in parts:
                blocks += [code[bounds[at]:bounds[i]], own]
                at = i + 1
            code = np.concatenate([*blocks, code[bounds[at]:]])
            counts = sizes
        used = np.zeros(2 * len(known) + len(extra), bool)
        used[code] = True
        which = np.flatnonzero(used)
        extras = list(extra)
        names = [" " + known[c] if c < len(known) else known[c - len(known)] if c < 2 * len(known)
                 else extras[c - 2 * len(known)] for c in which.tolist()]
        place = np.cumsum(used) - 1
        flat, per_piece = self.encode_pieces(names)
        code = place[code]
        lengths = per_piece[code]
        ids = gather(flat, starts_of(per_piece)[code], lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(counts)
        return ids, ends[last] - ends[last - counts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids; bytes that are no UTF-8 become U+FFFD."""
        lengths = self.token_lengths[ids]
        spelled = gather(self.token_bytes, self.token_starts[ids], lengths).tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(counts)
        return [spelled[a:b].decode("utf-8", "replace") for a, b in zip(ends[last - counts], ends[last])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each Python worker."""
    return Vocabulary(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of each whole text by the vocabulary file at ``path``.

    The file must lie at ``path`` on every executor. A null text counts as empty and has no ids.
    Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in slices(batches, "text", 5 << 20):
            ids, counts = words.encode(texts_of(part.column("text")))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the text that each row's ids spell. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = words.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
