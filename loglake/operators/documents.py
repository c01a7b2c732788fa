"""Documents: typing, routing, content ids, mapping, upsert, display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.numbers import is_numeric_value, to_number
from loglake.functions.text import keyword_field, null_to_empty
from loglake.functions.times import index_name, index_suffix, utc_text
from loglake.schema import KEYWORD_LIMITS, NUMERIC_TYPE, UNTYPED

# Separator between the fields of an id; it does not occur in log text.
UNIT_SEPARATOR = "\u001f"
ID_FIELDS = (
    "timestamp", "loghost", "env", "procname", "procid", "module", "typelog", "keywname",
    "keywvalue", "logtext", "errstack", "errstackidx", "errlocation", "errseverity",
)
DOC_KEY = ("_index", "_type", "_id")

# The columns of the oldest sparse document and the layout of a printed hit.
SPARSE_FIELDS = {
    "timestamp": "@timestamp", "loghost": "loghost", "env": "envname", "procname": "procname",
    "procid": "procid", "module": "module", "keywname": "keywname", "keywvalue": "keywvalue",
    "logtext": "logtext",
}
HIT_INDENT, HIT_TEXT_INDENT, HIT_TEXT_WIDTH = 54, 63, 80


def doc_type(override: str = "default") -> Column:
    """``opslog`` for a numeric fpar record, else the lower-case type, ``untyped`` for none; or a forced type."""
    if override != "default":
        return F.lit(override)
    kind = F.coalesce(F.nullif(F.lower("typelog"), F.lit("")), F.lit(UNTYPED))
    numeric = (kind == "fpar") & is_numeric_value(F.col("keywvalue"))
    return F.when(numeric, NUMERIC_TYPE).otherwise(kind)


def doc_id() -> Column:
    """Content id: md5 over all record fields but the database id, with the time in UTC microseconds.

    Sources agree as far as their times do: an archive holds whole seconds, so a record with a
    fraction has another id there than from the database.
    """
    fields = [
        utc_text(F.unix_micros(F.col("timestamp").cast("timestamp"))) if name == "timestamp" else F.col(name)
        for name in ID_FIELDS
    ]
    return F.md5(F.concat_ws(UNIT_SEPARATOR, *[null_to_empty(f) for f in fields]))


def doc_index(
    index: str | Column, numeric_index: str | Column = NUMERIC_TYPE, suffix: Column | None = None, kind: Column | None = None
) -> Column:
    """Numeric parameter records go to their own index, all others to ``index``.

    ``kind`` is a column that holds ``doc_type()``, if there is one.
    """
    as_column = [F.lit(i) if isinstance(i, str) else i for i in (numeric_index, index)]
    base = F.when((doc_type() if kind is None else kind) == NUMERIC_TYPE, as_column[0]).otherwise(as_column[1])
    return base if suffix is None else index_name(base, suffix)


def to_docs(
    records: DataFrame,
    index: str = "logs",
    numeric_index: str = NUMERIC_TYPE,
    override_type: str = "default",
    frequency: str = "NONE",
    suffix: Column | None = None,
) -> DataFrame:
    """One document per record.

    ``keywvalue`` is the text; ``keywvalue_num`` its number for numeric parameter records. The
    index gets a time suffix by ``frequency``, or the given ``suffix`` (say from a file name).
    """
    # Three columns need the type, so it is a column of its own: written into each, its pattern is tried in each.
    kind = F.col("_kind")
    name = doc_index(index, numeric_index, suffix, kind)
    if suffix is None and frequency != "NONE":
        # A time's suffix is never empty; ``index_name`` would format the time twice to find out.
        name = F.concat(name, F.lit("-"), index_suffix(F.col("timestamp"), frequency))
    return records.withColumn("_kind", doc_type()).select(
        name.alias("_index"),
        (kind if override_type == "default" else doc_type(override_type)).alias("_type"),
        doc_id().alias("_id"),
        F.col("timestamp").alias("@timestamp"),
        "loghost",
        F.col("env").alias("envname"),
        "procname", "procid", "module", "keywname", "keywvalue",
        F.when(kind == NUMERIC_TYPE, to_number(F.col("keywvalue"))).alias("keywvalue_num"),
        "logtext", "errstack", "errstackidx", "errlocation", "errseverity",
    )


def apply_mapping(docs: DataFrame) -> DataFrame:
    """Storage types of the search index: 32-bit value, and exact-match copies by length."""

    def limit(lengths: dict[str, int]) -> Column:
        special = [(kind, n) for kind, n in lengths.items() if kind != "default"]
        bound = F.lit(lengths["default"])
        for kind, n in special:
            bound = F.when(F.col("_type") == kind, n).otherwise(bound)
        return bound

    exact = {}
    for name, lengths in KEYWORD_LIMITS.items():
        value = keyword_field(F.col(name), limit(lengths))
        if name == "keywvalue":
            value = F.when(F.col("_type") != NUMERIC_TYPE, value)
        exact[f"{name}_keyword"] = value
    return docs.withColumns({"keywvalue_num": F.col("keywvalue_num").cast("float"), **exact})


def sparse_doc_json(records: DataFrame) -> DataFrame:
    """JSON documents (column ``value``) without empty or null fields."""
    fields = []
    for source, target in SPARSE_FIELDS.items():
        if source == "timestamp":
            c = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif source == "procid":
            c = F.col(source)
        else:
            c = F.nullif(F.col(source), F.lit(""))
        fields.append(c.alias(target))
    return records.select(F.to_json(F.struct(*fields)).alias("value"))


def upsert_docs(
    docs: DataFrame, load_time: str = "load_time", key: Sequence[str] = DOC_KEY
) -> DataFrame:
    """One row per document key: that of the latest load.

    An aggregation rather than a ranking window, so any number of copies of one document is
    reduced to a row per task before the shuffle. Whole rows are combined by sorting, and the last
    part of the key, the id, goes first: documents differ in its first bytes, and hardly in their index.
    """
    rest = [c for c in docs.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.col(load_time)).alias("newest")
    return docs.groupBy(*reversed(key)).agg(newest).select(
        *[c if c in key else F.col("newest").getField(c).alias(c) for c in docs.columns]
    )


def format_hits(docs: DataFrame) -> DataFrame:
    """Printable text of each document, in a column ``value``."""

    def flat(name: str) -> Column:
        return F.translate(F.coalesce(F.col(name).cast("string"), F.lit("")), "\n", " ")

    text = flat("logtext")
    indent, text_indent = F.lit("\n" + " " * HIT_INDENT), F.lit("\n" + " " * HIT_TEXT_INDENT)
    return docs.select(
        F.concat(
            F.lit("/"), "_index", F.lit("/"), "_type", F.lit("/"), "_id",
            F.lit(" ("), F.date_format("@timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("):"),
            *[
                part
                for name in ("loghost", "envname", "procname", "procid", "module")
                for part in (F.lit(f"\t{name}: "), flat(name))
            ],
            indent, F.lit("\tkeywname: "), flat("keywname"),
            F.lit("\t keywvalue: "), flat("keywvalue"),
            indent, F.lit("\tlogtext: "), F.substring(text, 1, HIT_TEXT_WIDTH),
            text_indent, F.lit("\t "), F.substring(text, HIT_TEXT_WIDTH + 1, 2**31 - 1),
        ).alias("value")
    )
