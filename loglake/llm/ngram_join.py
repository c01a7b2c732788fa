"""N-gram Jaccard join: documents whose sets of word shingles are alike, by prefix filtering.

Equal sets are one class. A class's shingles are ordered from the rarest; two classes can only be
alike if the first few shingles of each (the prefix) have one in common. Pairs that meet there pass a
length filter, a positional filter (what can still follow the common shingle) and a suffix filter
(how far the sets' sizes differ in fixed parts of the hash range), and are then verified once, on
the whole sets.

Shingles are held as 64-bit hashes and a class is named by a 64-bit hash of its set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.bloom import with_possible
from loglake.llm.common import stored, text_or_empty
from loglake.llm.components import components
from loglake.llm.ragged import slices, texts_of
from loglake.llm.shingles import mix, shingle_sets

#: The frequency sketch: so many counters, in so many rows of the table that sums them.
COUNTERS, PARTS = 1 << 20, 64
SHIFT = np.uint64(44)  # 64 bits less the 20 of a counter
OCTANTS = 16
LIMIT = 1 << 20
#: So many partners, about, meet one copy of a class's set.
PARTNERS = 100


def class_ids(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A name for each set, from its members' hashes."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
    ends = np.cumsum(counts)
    return mix(total[ends] - total[ends - counts] + counts.astype(np.uint64)).view(np.int64)


def describe(documents: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows: each document's ``doc_id, text_hash, n, cls``, and each task's share of the sketch, ``part, counts``.

    The sketch counts the shingles of all documents in a fixed number of counters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(COUNTERS, np.int64)
        schema = None
        for piece in slices(batches, "text", LIMIT):
            values, counts = shingle_sets(texts_of(piece.column("text")), words)
            sketch += np.bincount((values >> SHIFT).astype(np.int64), minlength=COUNTERS)
            n, ids = len(counts), piece.column("doc_id")
            schema = pa.schema([("doc_id", ids.type), ("text_hash", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("part", pa.int32()), ("counts", pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [ids, piece.column("text_hash"), pa.array(counts, pa.int32()), pa.array(class_ids(values, counts)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        if schema is not None:
            rows = sketch.astype("<u4").reshape(PARTS, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, schema.field("doc_id").type), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.int32()), pa.nulls(PARTS, pa.int64()),
                 pa.array(np.arange(PARTS), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], schema=schema)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, f"doc_id {kind}, text_hash bigint, n int, cls bigint, part int, counts binary")


def rarity(described: DataFrame) -> np.ndarray:
    """A level of frequency for each counter, one byte each: the sketch's size is fixed, so the driver holds it."""

    def total(part: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c, "<u4").astype(np.float64) for c in part.column("counts").to_pylist())
        level = np.minimum(np.round(4 * np.log2(1 + counts)), 255).astype(np.uint8)
        return pa.table({"part": part.column("part").slice(0, 1), "level": pa.array([level.tobytes()], pa.binary())})

    rows = described.filter(F.col("part").isNotNull()).select("part", "counts").groupBy("part").applyInArrow(
        total, "part int, level binary").collect()
    levels = np.zeros((PARTS, COUNTERS // PARTS), np.uint8)
    for row in rows:
        levels[row["part"]] = np.frombuffer(row["level"], np.uint8)
    return levels.ravel()


def prefixes(documents: DataFrame, words: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """``cls, doc_id, n, parts, grams`` of every class: one of its documents, its set's size in each part
    of the hash range, and its prefix from the rarest shingle on."""
    shared = documents.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for piece in slices(batches, "text", LIMIT):
            values, counts = shingle_sets(texts_of(piece.column("text")), words)
            some = np.flatnonzero(counts > 0)
            n = counts[some]
            owner = np.repeat(np.arange(len(n)), n)
            parts = np.bincount(owner * OCTANTS + (values >> np.uint64(60)).astype(np.int64), minlength=len(n) * OCTANTS)
            # From the rarest: by level, then by the value itself.
            order = np.argsort((owner << 8 | level[(values >> SHIFT).astype(np.int64)]), kind="stable")
            place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            length = n - -(-num * n // den) + 1
            grams = values[order][place < length[owner]].view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(class_ids(values, counts)[some]), piece.column("doc_id").take(pa.array(some)), pa.array(n, pa.int32()),
                pa.ListArray.from_arrays(np.arange(0, len(parts) + 1, OCTANTS, dtype=np.int32), pa.array(parts, pa.int32())),
                pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), pa.array(grams))],
                ["cls", "doc_id", "n", "parts", "grams"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        run, f"cls bigint, doc_id {kind}, n int, parts array<int>, grams array<bigint>").dropDuplicates(["cls"])


def sets_of(documents: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cls, salt, grams`` of the classes whose documents ``wanted`` (``doc_id, salts``) names, and perhaps of others.

    Each set comes ``salts`` times, numbered. Only texts that pass a filter of fixed size are moved
    to meet the ids.
    """
    ids = stored(wanted.groupBy("doc_id").agg(F.max("salts").alias("salts")), "wanted")
    likely = with_possible(documents, ids, "doc_id").filter(F.col("possible") | F.col("doc_id").isNull()).drop("possible")
    named = likely.join(ids.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id"))).select("text", "salts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", LIMIT):
            values, counts = shingle_sets(texts_of(piece.column("text")), words)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(class_ids(values, counts)), piece.column("salts"),
                pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))], ["cls", "salts", "grams"])

    return named.mapInArrow(run, "cls bigint, salts int, grams array<bigint>").select(
        "cls", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "grams").dropDuplicates(["cls", "salt"])


def can_meet(num: int, den: int, x: str, y: str) -> Column:
    """The length and positional filters for rows ``x`` and ``y`` that meet at a common prefix shingle."""
    n, m, p, q = (F.col(f"{r}.{c}").cast("long") for c in ("n", "pos") for r in (x, y))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & (
        (num + den) * (1 + F.least(n - p, m - q)) >= num * (n + m))


def verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The distinct ``pairs`` (classes ``a < b``) that are alike: suffix filter, then the whole sets once."""
    side = lambda r: classes.select(
        F.col("cls").alias(r), F.col("n").cast("long").alias(f"n_{r}"), F.col("parts").alias(f"parts_{r}"), F.col("doc_id").alias(f"id_{r}"))
    apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y).cast("long")), F.lit(0).cast("long"), lambda s, d: s + d)
    sizes = F.col("n_a") + F.col("n_b")
    # Alike sets differ in no more than sizes - 2 * common shingles.
    near = stored(
        pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        .filter((num + den) * (sizes - apart) >= 2 * num * sizes).select("a", "b", "n_a", "n_b", "id_a", "id_b"), "near")
    # A hub meets very many classes: its set comes in as many copies as keep each one's partners few.
    copies = near.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(
        F.ceil(F.count("*") / PARTNERS).cast("int").alias("salts"))
    salted = stored(
        near.join(copies.select(F.col("cls").alias("a"), F.col("salts").alias("salts_a")), "a")
        .join(copies.select(F.col("cls").alias("b"), F.col("salts").alias("salts_b")), "b")
        .withColumns({"salt_a": F.pmod(F.xxhash64("b"), "salts_a").cast("int"), "salt_b": F.pmod(F.xxhash64("a"), "salts_b").cast("int")}), "salted")
    ids = salted.select(F.col("id_a").alias("doc_id"), F.col("salts_a").alias("salts")).unionByName(
        salted.select(F.col("id_b").alias("doc_id"), F.col("salts_b").alias("salts")))
    # Dealt by class and copy once; both joins read that.
    sets = sets_of(documents, ids, words)
    common = F.size(F.array_intersect("grams_a", "grams_b")).cast("long")
    return (
        salted.join(sets.select(F.col("cls").alias("a"), F.col("salt").alias("salt_a"), F.col("grams").alias("grams_a")), ["a", "salt_a"])
        .join(sets.select(F.col("cls").alias("b"), F.col("salt").alias("salt_b"), F.col("grams").alias("grams_b")), ["b", "salt_b"])
        .withColumn("common", common)
        .filter((num + den) * F.col("common") >= num * sizes)
        .select("a", "b", "common", (sizes - F.col("common")).alias("either"))
    )


class Join:
    """The steps of one join, each stored in the shared folder."""

    def __init__(self, documents: DataFrame, words: int, num: int, den: int):
        self.documents = documents.select("doc_id", text_or_empty().alias("text"))
        self.words, self.num, self.den = words, num, den
        described = stored(describe(self.documents, words), "described")
        self.rows = described.filter(F.col("part").isNull()).select("doc_id", "text_hash", "n", "cls")
        self.classes = stored(prefixes(self.documents, words, num, den, rarity(described)), "classes")
        each = self.classes.select("cls", "n", F.posexplode("grams").alias("at", "gram")).select(
            "gram", "cls", "n", (F.col("at") + 1).alias("pos"))
        # The hub of a shingle is the class that has it earliest: the one with fewest rarer ones.
        rank = F.shiftleft(F.col("pos").cast("long"), 40).bitwiseOR(F.pmod(F.xxhash64("cls"), F.lit(1 << 40)))
        shared = stored(each.select("gram", rank.alias("rank")).groupBy("gram").agg(
            F.count("*").alias("many"), F.min("rank").alias("first")).filter("many > 1").drop("many"), "shared")
        # Most prefix shingles stand alone; a filter of fixed size keeps those from moving.
        likely = with_possible(each, shared, "gram").filter("possible").drop("possible")
        self.buckets = stored(likely.join(shared, "gram").select("gram", "cls", "n", "pos", (rank == F.col("first")).alias("hub")), "buckets")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        return verified(pairs, self.classes.drop("grams"), self.documents, self.words, self.num, self.den)

    def _pairs(self, x: DataFrame, y: DataFrame, condition: Column) -> DataFrame:
        """Distinct class pairs ``a < b`` of rows of ``x`` and ``y`` with the same shingle."""
        met = x.alias("x").join(y.alias("y"), (F.col("x.gram") == F.col("y.gram")) & condition & can_meet(self.num, self.den, "x", "y"))
        return met.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()

    def _within(self, rows: DataFrame, condition: Column) -> DataFrame:
        """Pairs among all rows of a shingle. Sizes are cut into bands of the allowed ratio, and a row
        meets its own band and the next, so a frequent shingle's rows meet few others."""
        band = F.floor(F.log(F.col("n")) / F.log(F.lit(self.den / self.num)) * (1 - 1e-9)).cast("int") if self.num < self.den else F.col("n")
        left = rows.withColumn("band", F.explode(F.array(band, band + 1)))
        right = rows.withColumn("band", band)
        return self._pairs(left, right, (F.col("x.band") == F.col("y.band")) & condition)

    def every_link(self) -> DataFrame:
        """``a, b, common, either``: all pairs of different classes that are alike."""
        return self._verified(self._within(self.buckets, F.col("x.cls") != F.col("y.cls")))

    def joined_classes(self) -> DataFrame:
        """``node, root``: classes that chains of links join.

        First each class meets the hubs of its shingles only. Then all rows of a shingle meet, without
        the pairs that are joined already: a group of thousands of near copies has none left.
        """
        hubs = self.buckets.filter("hub")
        links = stored(self._verified(self._pairs(self.buckets, hubs, F.col("x.cls") != F.col("y.cls"))).select("a", "b"), "links")
        joined = stored(components(links), "joined")
        rows = self.buckets.drop("hub").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
            "root", F.coalesce("root", "cls"))
        rows = stored(rows, "rows")
        open_ = rows.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("gram")
        more = self._verified(self._within(rows.join(open_, "gram", "left_semi"), F.col("x.root") != F.col("y.root"))).select("a", "b")
        return components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def ngram_components(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, class_id, group_id, component_id``.

    Words are what ``[^\\x20\\x09-\\x0D]+`` finds, A-Z lower-cased. A document with fewer words than a
    shingle has the whole sequence as its one shingle. Two documents are linked if
    ``den * common >= num * either``; ``component_id`` is the smallest ``doc_id`` that links reach, and
    ``group_id`` names the same group by one of its classes. ``text_hash`` tells rows of equal id apart.

    A null or empty text, or one of white space, has no shingles, null ``class_id`` and ``group_id``,
    links with nothing and is its own component. Repeated rows each give a row. A null ``doc_id``
    takes part but never names a component; one without any id is named null. Other columns are
    ignored; an empty table gives no rows.
    """
    join = Join(documents, words, num, den)
    joined = join.joined_classes().withColumnsRenamed({"node": "cls"})
    least = stored(join.rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least")).join(joined, "cls", "left").withColumn(
        "root", F.coalesce("root", "cls")), "least")
    named = stored(least.select("cls", "root").join(
        least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("cls", "root", "component_id"), "named")
    shown = ("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"))
    some = join.rows.filter("n > 0").join(named, "cls").select(
        *shown, F.col("cls").alias("class_id"), F.col("root").alias("group_id"), "component_id")
    nothing = F.lit(None).cast("long")
    none = join.rows.filter("n = 0").select(
        *shown, nothing.alias("class_id"), nothing.alias("group_id"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def superfluous(components: DataFrame) -> DataFrame:
    """``doc_id, text_hash`` of the rows to leave out so that one document of each group stays.

    The smallest id stays (null last), of equal ids the smallest hash. Documents without shingles stay.
    """
    grouped = components.filter(F.col("group_id").isNotNull())
    # A component is named by the id that stays, so only the rows of that id are compared.
    others = grouped.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    named = grouped.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("group_id", "doc_id", "text_hash").distinct()
    first = named.groupBy("group_id").agg(F.min("text_hash").alias("first"))
    repeated = named.join(first, "group_id").filter(F.col("text_hash") != F.col("first"))
    return others.select("doc_id", "text_hash").unionByName(repeated.select("doc_id", "text_hash")).distinct()
