"""Merkle manifests, periodic runs and SentencePiece tables against plain versions of the same."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from messy import LONG, TEXTS, clash, documents, no_documents, odd_documents
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from loglake.llm import merkle, periodic, piece_table, queries

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# Manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[n] for n in merkle.FIELDS)))


def plain_tree(nodes):
    """Levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def plain_way(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 16 * 16
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        i //= 16
    return out


def plain_proofs(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row), row["doc_id"]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([leaf for _, _, leaf, _ in sorted(by_source[s], key=lambda r: r[:3])]) for s in order]
    over = plain_tree([t[-1][0] for t in trees]) if trees else []
    return sorted(
        ((doc_id, leaf, plain_way(trees[k], i) + plain_way(over, k), trees[k][-1][0], over[-1][0])
         for k, s in enumerate(order) for i, (_, _, leaf, doc_id) in enumerate(sorted(by_source[s], key=lambda r: r[:3]))), key=repr)


def proofs_of(docs, every=merkle.EVERY):
    found = merkle.prove(merkle.build(docs, every=every)).collect()
    return sorted(((r["doc_id"], r["leaf"], [tuple(s) for s in r["siblings"]], r["subroot"], r["root"]) for r in found), key=repr)


@pytest.mark.parametrize("every", [1, 2, 3])
def test_manifest_of_odd_documents(spark, every):
    docs = odd_documents(spark)
    assert proofs_of(docs, every) == plain_proofs(docs.select(*merkle.FIELDS).collect())


def test_manifest_without_documents(spark):
    assert proofs_of(no_documents(spark)) == []


def test_manifest_of_one_document(spark):
    docs = documents(spark, ["a"])
    ((_, leaf, siblings, subroot, root),) = proofs_of(docs)
    assert leaf == subroot == root and siblings == []


def test_manifest_of_many_levels_and_sources(spark):
    """A hot source of over 16 ** 3 rows with repeated rows, one of 256, one of 257, and 300 of one row."""
    own = F.when(F.col("id") < 4500, "hot").when(F.col("id") < 4756, "exact").when(F.col("id") < 5013, "over").otherwise(
        F.concat(F.lit("é"), F.col("id").cast("string")))
    docs = spark.range(5313).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 4000).alias("doc_id"), own.alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.when(F.col("id") < 300, "same").otherwise(F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(docs.filter("text = 'same'"))
    want = plain_proofs(docs.collect())
    assert proofs_of(docs) == want
    assert proofs_of(docs, 1) == want


def test_manifest_stores_every_second_level(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    built = merkle.build(docs)
    assert [b.select(F.explode("nodes")).count() for b in built.trees] == [1000, 4]


def test_tampering_is_found(spark):
    rows = {r["doc_id"]: r for r in queries.op11_merkle(spark, SF).collect()}
    for d in table(spark, "documents").collect():
        r = rows[d["doc_id"]]
        changed = zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in d["text"] or "")
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])


# Runs

def plain_runs(words, shortest=24, repeats=3):
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def words_of(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def repeating(rng):
    n, kinds = rng.choice([0, 1, 23, 24, 25, 80, 200, 400]), rng.choice([1, 2, 3, 10, 50])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 30 else 0):
        first = rng.randrange(n)
        period = rng.randint(1, max(1, (n - first) // rng.randint(2, 6)))
        for i in range(first, rng.randint(first, n)):
            words[i] = words[first + (i - first) % period]
    return words


@pytest.mark.parametrize("shortest,repeats", [(24, 3), (2, 3), (9, 4), (100, 3)])
def test_runs_of_random_words(shortest, repeats):
    rng = random.Random(shortest)
    for _ in range(60):
        texts = [repeating(rng) for _ in range(rng.randint(1, 6))]
        got = periodic.runs(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]), shortest, repeats)
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in plain_runs(t, shortest, repeats)]


def test_transform_and_back():
    rows = np.random.default_rng(0).integers(0, periodic.PRIME, (3, 64)).astype(np.uint64)
    assert (periodic.transform_back(periodic.transform(rows)) == rows).all()


def test_mismatches_are_sums_of_squared_differences():
    words = np.random.default_rng(1).integers(0, 9, 200).astype(np.uint64)
    squares = np.concatenate([[0], np.cumsum(words * words)]).astype(np.uint64)
    got = periodic.mismatches(words, squares, np.array([0, 16, 32]), 16, 16, 32)
    x = words.astype(np.int64)
    assert got.tolist() == [[int(((x[b:b + 16] - x[b + d:b + d + 16]) ** 2).sum()) for d in range(16, 32)] for b in (0, 16, 32)]


def test_runs_of_long_texts():
    """Runs within runs, one with a period of a third of the text, and one word repeated."""
    block = [*range(2000), *[7] * 400]
    words = block * 3 + [9] * 3000
    got = periodic.runs(np.array(words), np.array([len(words)]))
    assert (0, 0, 7200, 2400) in [tuple(r) for r in got.tolist()] and (0, 7200, 3000, 1) in [tuple(r) for r in got.tolist()]
    assert len(got) == 5


def test_runs_of_odd_documents(spark):
    rows = periodic.find_runs(odd_documents(spark)).collect()
    assert len(rows) == odd_documents(spark).count()
    texts = dict(enumerate(TEXTS))
    for r in rows:
        if r["doc_id"] is None or r["doc_id"] in (4, 5):
            continue
        words = words_of(texts[r["doc_id"]])
        if texts[r["doc_id"]] == LONG:
            assert [tuple(x) for x in r["runs"]] == [(0, len(words), 2)] and r["collapsed"] == "thonea wh"
            continue
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == plain_runs(words)
        assert r["collapsed"] == " ".join(words)
    assert periodic.find_runs(no_documents(spark)).collect() == []


def test_collapsed_keeps_first_periods(spark):
    text = "x " + "a b c " * 10 + "y\t" + "z " * 30 + "\x1cq"
    (row,) = periodic.find_runs(documents(spark, [text])).collect()
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3), (32, 30, 1)]
    assert row["collapsed"] == "x a b c y z \x1cq"


# Pieces

def library(texts):
    model = SentencePieceProcessor(model_file=PIECES)
    return [model.encode(t or "") for t in texts], model


def same_as_library(texts):
    pieces = piece_table.pieces_of(PIECES)
    ids, counts = pieces.encode(pa.array(texts, pa.large_string()))
    want, model = library(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert pieces.decode(ids.astype(np.int64), counts) == [model.decode(w) for w in want]


def test_pieces_of_white_space():
    same_as_library([" " * n for n in range(40)] + ["a" + " " * n for n in range(40)] + [" " * n + "b" for n in range(40)])
    same_as_library([""])
    same_as_library(["", " ", "", "▁", "▁ a▁▁", "\n \n", "\t"])


def test_pieces_of_random_texts():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "日本", "🙂", "▁", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "　", "\xa0", "1", "'", "ﬀ", "​", "x" * 50]
    for _ in range(100):
        same_as_library(["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(30)])
    same_as_library([chr(c) for c in range(0x3000)] + [chr(c) for c in range(0xF900, 0x10300)])


def test_pieces_of_any_ids():
    rng = random.Random(6)
    pieces, model = piece_table.pieces_of(PIECES), SentencePieceProcessor(model_file=PIECES)
    some = [0, 1, 2, 3, 13, 35, 200, 233, 240, 259, 260, 28705]
    rows = [[rng.choice([*some, rng.randrange(32000)]) for _ in range(rng.randint(0, 8))] for _ in range(3000)]
    got = pieces.decode(np.array(sum(rows, []), np.int64), np.array([len(r) for r in rows], np.int64))
    assert got == [model.decode(r) for r in rows]


def test_pieces_are_remembered_in_bounds(monkeypatch):
    monkeypatch.setattr(piece_table.Pieces, "REMEMBERED", 3)
    pieces = piece_table.Pieces(PIECES)
    texts = ["one one two two three three four four five five"] * 2
    for _ in range(3):
        ids, counts = pieces.encode(pa.array(texts, pa.large_string()))
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == library(texts)[0]
        assert len(pieces.new) <= 5


def test_pieces_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = piece_table.decode(piece_table.encode(docs, PIECES), PIECES).collect()
    texts = [r["text"] for r in docs.select("text").collect()]
    want, model = library(texts)
    assert sorted((r["ids"], r["text"]) for r in rows) == sorted((w, model.decode(w)) for w in want)
    assert sorted(r["doc_id"] or -1 for r in rows) == sorted(r["doc_id"] or -1 for r in docs.select("doc_id").collect())
    assert piece_table.encode(no_documents(spark), PIECES).collect() == []
    nothing = clash(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>").drop("x"))
    assert [r["text"] for r in piece_table.decode(nothing, PIECES).collect()] == ["", ""]


def test_pieces_of_given_documents(spark):
    docs = table(spark, "documents").collect()
    want, model = library([d["text"] for d in docs])
    rows = {r["doc_id"]: r for r in queries.op13_sentencepiece(spark, SF).collect()}
    for d, ids in zip(docs, want):
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(model.decode(ids))
