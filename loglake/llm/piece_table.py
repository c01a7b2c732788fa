"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the vocabulary reaches across the start of a white-space marker that follows another
character, so a text falls into chunks, a run of markers and the word behind it, whose ids do not
depend on their neighbours. Each distinct chunk of a slice of texts is segmented once, by the
library; the ids are joined back by the chunks' positions. Decoding joins the bytes of the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.llm.ragged import gather, segment_sums, slices, starts_of, texts_of

#: Fixed value: the character that stands for a space.
MARK = "▁"


class Pieces:
    """A model, the chunks that recurred lately, and the bytes of its pieces."""

    REMEMBERED = 100_000

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a piece reaches across a white-space marker")
        # The model must mark spaces one by one and put a marker before the text, nothing else.
        if self.model.encode("a") + self._after("a", " a") + self._after("a", "  a") != self.model.encode("a a  a"):
            raise ValueError("the model does not keep white space as it is")
        self.lone = np.array(self._after("a", " "), np.int32).tobytes()
        self.special = np.array([self.model.is_control(i) or self.model.is_unknown(i) for i in range(size)])
        spelled = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                   for i, p in enumerate(pieces)]
        self.piece_lengths = np.array([len(b) for b in spelled], np.int64)
        self.piece_starts = starts_of(self.piece_lengths)
        self.piece_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _after(self, head: str, tail: str) -> list[int]:
        return self.model.encode(head + tail)[len(self.model.encode(head)):]

    def segment(self, chunks: list[str], counts: np.ndarray) -> list[bytes]:
        """Ids of distinct chunks, each without its first marker; those that recur are remembered."""
        found, missing = [self.new.get(c) for c in chunks], []
        for i, ids in enumerate(found):
            if ids is None:
                ids = found[i] = self.old.get(chunks[i])
                if ids is None:
                    missing.append(i)
                else:
                    self.new[chunks[i]] = ids
        for begin in range(0, len(missing), 10_000):
            group = missing[begin:begin + 10_000]
            for i, ids in zip(group, self.model.encode([chunks[i] for i in group], num_threads=1)):
                # The model gives no marker to an empty text.
                found[i] = np.array(ids, np.int32).tobytes() if chunks[i] else self.lone
                if counts[i] > 1 and len(chunks[i]) < 100:
                    self.new[chunks[i]] = found[i]
        if len(self.new) > self.REMEMBERED:
            self.old, self.new = self.new, {}
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        split = pc.split_pattern(texts, " ")
        counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary
        # A marker stands before each word. Empty words lend theirs to the next word that is not.
        empty = (pc.binary_length(words).to_numpy(zero_copy_only=False) == 0)[code]
        last = np.zeros(len(code), bool)
        ends = np.cumsum(counts)
        last[ends - 1] = True
        chunk = ~empty | last
        at = np.flatnonzero(chunk)
        spaces = np.diff(np.concatenate([[-1], at])) - 1
        sizes = segment_sums(chunk.astype(np.int64), counts)
        # An empty text has no chunk at all.
        blank = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        if blank.any():
            some = np.repeat(~blank, sizes)
            at, spaces, sizes = at[some], spaces[some], np.where(blank, 0, sizes)
        key, place, held = np.unique(spaces * max(len(words), 1) + code[at], return_inverse=True, return_counts=True)
        more, which = np.divmod(key, max(len(words), 1))
        known = words.take(pa.array(which)).to_pylist()
        for i in np.flatnonzero(more).tolist():
            known[i] = " " * int(more[i]) + known[i]
        spelled = self.segment(known, held)
        flat = np.frombuffer(b"".join(spelled), np.int32)
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        each = lengths[place]
        return gather(flat, starts_of(lengths)[place], each), segment_sums(each, sizes)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids, as the library decodes them."""
        lengths = self.piece_lengths[ids]
        spelled = gather(self.piece_bytes, self.piece_starts[ids], lengths).tobytes()
        odd = segment_sums(self.special[ids].astype(np.int64), counts) > 0
        begins, sizes = starts_of(counts), segment_sums(lengths, counts)
        out = []
        for i, (at, size) in enumerate(zip(starts_of(sizes).tolist(), sizes.tolist())):
            text, end = None, at + size
            if not odd[i]:
                # The first marker is the model's own, not the text's.
                at += int(size > 0 and spelled[at] == 32 and not self.model.is_byte(int(ids[begins[i]])))
                try:
                    text = spelled[at:end].decode()
                except UnicodeDecodeError:
                    pass
            # Control and unknown ids, and bytes that are no UTF-8, are left to the library.
            out.append(self.model.decode(ids[begins[i]:begins[i] + counts[i]].tolist()) if text is None else text)
        return out


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """Loaded once in each Python worker."""
    return Pieces(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of each whole text by the model file at ``path``, without begin or end ids.

    The file must lie at ``path`` on every executor. A null text counts as empty and has no ids. A text
    is whole in one task, whatever its length. Repeated rows stay; other columns are ignored; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for part in slices(batches, "text"):
            ids, counts = pieces.encode(texts_of(part.column("text")))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(ids))], ["doc_id", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the text that each row's ids spell. Null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
