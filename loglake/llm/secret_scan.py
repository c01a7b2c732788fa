"""Secret scans with corpus-wide ownership frequency.

Patterns propose candidates; the hash of each candidate is counted over the distinct repositories
and owners that hold it. A value that more than ``max_owners`` of both hold is a copied example;
others look live. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.llm.common import stored, text_or_empty

#: Kinds in the order in which equal starts are listed, and their patterns.
ASSIGN = (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "live")
#: How tokens of known services begin.
SERVICES = r"^(ghp_|gho_|ghs_|github_pat_|glpat-|xox[bp]-|sk_live_|rk_live_|AIza|npm_|pypi-)[A-Za-z0-9_-]{16,}"
#: A value in different texts of more owners than this is a widely copied example.
WIDELY = 10

SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"
#: Running values are found within blocks of this many and then over the blocks.
BLOCK = 64


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` reads it for each item of an array."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """The running sum or maximum (``joined``) of numbers from 0 up, as an array.

    A fold copies what it has gathered at each step, so a fold over all numbers would cost their
    square; blocks keep what is gathered short.
    """
    longs = "array<bigint>"

    def fold(items: Column, number: Callable[[Column], Column], first: Column) -> Column:
        return F.aggregate(items, first, lambda done, item: F.concat(done, F.array(
            joined(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0).cast("long")), number(item)))))

    def whole(numbers: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), ((F.size(numbers) - 1) / BLOCK).cast("int")), lambda b: fold(
            F.slice(numbers, b * BLOCK + 1, BLOCK), lambda n: n, F.array().cast(longs)))
        return _bound(blocks, lambda inner: F.flatten(F.zip_with(
            inner, F.slice(fold(inner, lambda block: F.element_at(block, -1), F.array(F.lit(0).cast("long"))), 1, F.size(inner)),
            lambda block, before: F.transform(block, lambda n: joined(before, n)))))

    return _bound(values, lambda numbers: F.when(F.size(numbers) > 0, whole(numbers)).otherwise(F.array().cast(longs)))


def _spans(text: Column, pattern: str, kind: int, value=lambda hit: hit, keep=None) -> Column:
    """Leftmost non-overlapping matches with code-point positions: ``start, kind, end, value``.

    The text between matches and the matches themselves alternate, so their running length is the
    position. Texts without a match skip that work.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(
        F.length(gap).cast("long").alias("gap"), F.length(hit).cast("long").alias("long"), value(hit).alias("value")))

    found = _bound(pairs, lambda all_: F.zip_with(
        all_, running(F.transform(all_, lambda p: p["gap"] + p["long"]), lambda x, y: x + y), lambda p, end: F.struct(
            (end - p["long"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["value"].alias("value"))))
    if keep is not None:
        found = F.filter(found, keep)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def looks_random(value: Column) -> Column:
    """Whether a token looks made by a machine: a known service's, or one with a part of mixed characters.

    Parts lie between ``/``, ``_`` and ``-``. One of 16 characters or more has both cases and two
    digits with a letter between, or one of 20 or more has four runs of digits, each before letters.
    Paths of words, slugs with a date and UUIDs have no such part.
    """
    return value.rlike(SERVICES) | F.exists(F.split(value, "[/_-]"), lambda part: (
        (F.length(part) >= 16) & part.rlike("[a-z]") & part.rlike("[A-Z]") & part.rlike("[0-9].*[A-Za-z].*[0-9]")
    ) | ((F.length(part) >= 20) & part.rlike("([0-9]+[A-Za-z]+){4}")))


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span.

    Both are sorted by start. A token falls if a base span before it ends after its start, or the
    span next to it begins before its end; tokens do not overlap, so one look ahead is enough.
    """

    def kept(both: Column) -> Column:
        ends = running(F.transform(both, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), F.greatest)
        return _bound(ends, lambda upto: F.filter(both, lambda s, i: (
            (s["kind"] == 3) & (F.get(upto, i) <= s["start"])
            & F.coalesce((F.get(both, i + 1)["kind"] == 3) | (F.get(both, i + 1)["start"] >= s["end"]), F.lit(True)))))

    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), _bound(F.sort_array(F.concat(base, tokens)), kept)).otherwise(tokens)


def candidates(documents: DataFrame, repo: str, owner: str) -> DataFrame:
    """``doc_id, text_hash, repo, owner, base, tokens``: spans of the fixed patterns and of random-looking tokens.

    The work grows with the text's length and matches, however long the text.
    """
    text = F.col("text")
    base = F.sort_array(F.concat(
        _spans(text, ASSIGN, 0, lambda hit: F.regexp_extract(hit, ASSIGN, 1), lambda s: F.length(s["value"]) >= 8),
        _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    tokens = _spans(text, TOKEN, 3, keep=lambda s: looks_random(s["value"]))
    hashed = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("value")))
    return (
        documents.select(
            "doc_id", text_or_empty().alias("text"),
            F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"),
            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), "repo", "owner",
                hashed(base).alias("base"), hashed(tokens).alias("tokens"))
        .withColumn("tokens", _apart(F.col("tokens"), F.col("base")))
    )


def ownership(found: DataFrame, max_owners: int = WIDELY) -> DataFrame:
    """``value, n_repos, n_owners, live``: in how many distinct repositories and owners each hash occurs.

    All rows of equal text count for one place, the first by owner and repository: a mirror makes no
    example of a credential. Copies are folded in each task before anything moves, so a value that
    stands in a third of all rows costs a row per task and text.
    """
    values = F.explode(F.array_distinct(F.transform(F.concat("base", "tokens"), lambda s: s["value"]))).alias("value")
    places = found.select("text_hash", "repo", "owner", values).groupBy("text_hash", "value").agg(
        F.min(F.struct("owner", "repo")).alias("place"))
    return (
        places.select("place.*", "value").distinct().groupBy("value")
        .agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))
        .withColumn("live", F.least("n_repos", "n_owners") <= max_owners)
    )


def scan_secrets(documents: DataFrame, repo: str = "source", owner: str = "source", max_owners: int = WIDELY) -> DataFrame:
    """One row per document: ``doc_id, text_hash, base, spans`` with ``spans`` holding a ``live`` flag.

    ``base`` are the fixed patterns' spans. ``spans`` are those and, as kind ``live``, random-looking
    tokens that no more than ``max_owners`` owners or repositories hold; tokens seen with more are
    copied examples and not added. Base spans stay whatever their ownership. Equal texts count for
    one owner. Long texts are read whole, with work in proportion to length and matches.

    Null or empty texts have no spans. Null repositories and owners count as one, named by the
    empty text. Repeated rows each give a row. Other columns are ignored; an empty table gives none.
    """
    found = stored(candidates(documents, repo, owner), "secrets")
    each = found.select("doc_id", "text_hash", F.explode(F.concat("base", "tokens")).alias("s")).select(
        "doc_id", "text_hash", "s.*").distinct()
    judged = (
        each.join(ownership(found, max_owners), "value")
        .filter((F.col("kind") < 3) | F.col("live"))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("spans"))
        .withColumnsRenamed({"doc_id": "judged_id", "text_hash": "judged_hash"})
    )
    return (
        found.select("doc_id", "text_hash", "base")
        .join(judged, F.col("doc_id").eqNullSafe(F.col("judged_id")) & (F.col("text_hash") == F.col("judged_hash")), "left")
        .select("doc_id", "text_hash", "base", F.coalesce(
            "spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")).alias("spans"))
    )


def named(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span replaced by ``mark``; overlapping spans make one mark.

    Pieces are cut from four bytes a code point, where a position costs nothing to find.
    """
    part = lambda wide, at, end: F.decode(F.concat(
        F.lit(b"\x00\x00\xfe\xff"), F.substring(wide, (4 * at + 1).cast("int"), (4 * (end - at)).cast("int"))), "UTF-32")

    def cut(wide: Column) -> Column:
        def marked(upto: Column) -> Column:
            before = lambda i: F.coalesce(F.get(upto, i - 1), F.lit(0).cast("long"))
            pieces = F.transform(spans, lambda s, i: F.when(
                s["start"] >= before(i), F.concat(part(wide, before(i), s["start"]), F.lit(mark))).otherwise(""))
            return F.concat(F.array_join(pieces, ""), part(wide, F.element_at(upto, -1), F.length(wide) / 4))

        return _bound(running(F.transform(spans, lambda s: s["end"]), F.greatest), marked)

    return F.when(F.size(spans) > 0, _bound(F.encode(text, "UTF-32"), cut)).otherwise(text)
