"""Raw text logs: one record per line, five line types, parsed by column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.functions.text import loghost_from_path, split_spaces
from loglake.functions.times import date_from_path
from loglake.schema import OPS_CSV

# Fixed values of the line layout: endings of the marker token that tell the line types apart,
# and the token positions of the fields.
FPAR_END, FEVT_END, FLOG_END, ERR_MARK = ">", ">-", ">/", "ERR_"
DAEMON, MARKER = 4, 6
ENV, MODULE, PROCNAME, PROCID, ERRLOCATION = 7, 8, 9, 10, 11
LOG_TEXT, ERRSTACK, ERRSTACKIDX, ERRSEVERITY, ERR_TEXT = 12, 13, 14, 15, 17
BRACKETED = r"\[.*\]"
WHITESPACE_COLUMNS = 22
DEFAULT_YEAR = "1900"


def read_raw_logs(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """Lines (UTF-8) with the path of their file."""
    return (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .text(paths if isinstance(paths, str) else list(paths))
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )


def read_ws_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[int] | None = None,
) -> DataFrame:
    """Whitespace-delimited latin-1 lines as columns ``0``..``21`` and ``rest``, the words after those.

    Short rows end in nulls and an empty ``rest``. Chosen ``columns`` come without a ``rest``.
    """
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    cells = split_spaces(text)
    lines = read_raw_logs(spark, paths).where(F.trim("value") != "")
    chosen = range(WHITESPACE_COLUMNS) if columns is None else columns
    rest = [] if columns is not None else [
        F.slice(cells, WHITESPACE_COLUMNS + 1, F.greatest(F.size(cells) - WHITESPACE_COLUMNS, F.lit(0))).alias("rest")]
    return lines.select(*[F.get(cells, F.lit(i)).alias(str(i)) for i in chosen], *rest)


def env_from_cells(cells: DataFrame) -> Column:
    """Bracketed text in the last filled cell of a ``read_ws_table`` row; '' if there is none."""
    single = F.array(*[F.col(f"`{c}`") for c in cells.columns if c != "rest"])
    filled = F.array_compact(F.concat(single, F.col("rest")) if "rest" in cells.columns else single)
    last = F.try_element_at(filled, F.lit(-1))
    return F.coalesce(F.regexp_substr(last, F.lit(r"(?<=\[)[^\]]*(?=\])")), F.lit(""))


def raw_type(marker: Column, value: Column) -> Column:
    """Line type from the marker token, else from an error code in the text."""
    return (
        F.when(marker.endswith(FPAR_END), "FPAR")
        .when(marker.endswith(FEVT_END), "FEVT")
        .when(marker.endswith(FLOG_END), "FLOG")
        .when(value.contains(ERR_MARK), "ERR")
        .otherwise("LOG")
    )


def raw_types_only(lines: DataFrame) -> DataFrame:
    """Only the type of each line; lines without a marker token are left out."""
    # Generated rather than projected: the filter would otherwise split each line once more.
    marker = F.struct(F.get(split_spaces(F.col("value")), F.lit(MARKER)).alias("marker"))
    marked = lines.select("value", F.inline(F.array(marker)))
    return marked.where(F.col("marker").isNotNull()).select(
        raw_type(F.col("marker"), F.col("value")).alias("typelog")
    )


def _between(tokens: Column, start: int | Column, end: Column) -> Column:
    """Tokens from ``start`` to before ``end``, both 0-based."""
    start = F.lit(start) if isinstance(start, int) else start
    return F.slice(tokens, start + 1, F.greatest(end - start, F.lit(0)))


def _find(tokens: Column, mark: str, start: int | Column) -> Column:
    """0-based position of the first ``mark`` at or after ``start``; ``start - 1`` if there is none."""
    return F.array_position(_between(tokens, start, F.size(tokens)), mark).cast("int") - 1 + start


def parse_raw_logs(lines: DataFrame, year: int | None = None, kinds: Sequence[str] | None = None) -> DataFrame:
    """Lines (``value``, ``file_path``) to CSV-shaped records plus ``_malformed``.

    The year comes from ``year``, else from the date in the file's path. A line without the
    tokens its type needs keeps its text in ``_malformed`` and has no other field. With ``kinds``
    only lines of these types are taken; the others are left out before their fields are built.
    """
    path_year = date_from_path(F.col("file_path"), whole_word=False)["year"]
    if year is not None:
        year_text = F.lit(str(year))
    else:
        year_text = F.coalesce(F.nullif(path_year, F.lit("")), F.lit(DEFAULT_YEAR))
    tok, size, kind, good = F.col("tok"), F.col("size"), F.col("typelog"), F.col("good")

    def at(position: int) -> Column:
        return F.get(tok, F.lit(position))

    split = lines.select(
        "value",
        loghost_from_path(F.col("file_path")).alias("loghost"),
        year_text.alias("year"),
        split_spaces(F.col("value")).alias("tok"),
    )
    marks = split.withColumns({
        "size": F.size(tok),
        "typelog": raw_type(at(MARKER), F.col("value")),
        "eq": _find(tok, "=", ENV + 1),
    }).withColumns({
        "value_end": _find(tok, "/", F.col("eq") + 1),
        "event_end": _find(tok, "/", ENV),
        "tm": F.try_to_timestamp(
            F.concat_ws(" ", "year", at(0), at(1), F.substring(at(MARKER), 1, 8)),
            F.lit("yyyy MMM d HH:mm:ss"),
        ),
    })
    well_formed = (size > MARKER) & F.col("tm").isNotNull() & (
        F.when(kind == "FPAR", (F.col("eq") > ENV) & (F.col("value_end") > F.col("eq") + 1))
        .when(kind == "FEVT", F.col("event_end") >= ENV)
        .when(kind == "ERR", size > ERRSEVERITY)
        .when(kind == "LOG", size > PROCID)
        .otherwise(True)
    )
    # Fields come in two generated rows per line rather than in one projection: a filter above,
    # such as a number test on keyv, then reads the finished field instead of repeating its
    # expression, and each step stays small enough for the JVM to compile.
    kept = ("value", "loghost", "tok", "size", "typelog", "eq", "value_end", "event_end", "tm")
    checked = marks.select(F.inline(F.array(F.struct(*kept, well_formed.alias("good")))))

    if kinds is not None:
        checked = checked.where(kind.isin(*kinds))

    coded = kind.isin("ERR", "LOG")
    error = kind == "ERR"
    slash = F.array_position(tok, "/").cast("int")
    key_end = F.when(kind == "FPAR", F.col("eq")).when(kind == "FEVT", F.col("event_end")).otherwise(ENV)
    text_start = (
        F.when(kind.isin("FPAR", "FEVT"), slash).when(kind == "FLOG", ENV)
        .when(error, ERR_TEXT).otherwise(LOG_TEXT)
    )
    text_end = F.when(kind == "FLOG", size - 1).otherwise(size)
    pieces = checked.withColumns({
        "key": F.array_join(_between(tok, ENV, key_end), "."),
        "text": F.array_join(_between(tok, text_start, text_end), " "),
    })
    # A free-text line starts inside its marker token; only its last token loses the brackets.
    flog_head = F.regexp_replace(at(MARKER), ".*>/", "")
    flog_last = F.when(size > MARKER + 1, F.regexp_replace(F.get(tok, size - 1), BRACKETED, ""))
    texts = F.struct(
        F.coalesce(
            F.translate(F.regexp_substr("value", F.lit(BRACKETED)), "[]", ""),
            F.when(coded, at(ENV)).otherwise(F.col("loghost")),
        ).alias("env"),
        F.when((kind == "FEVT") & (F.col("key") != ""), F.concat(F.lit("."), "key"))
        .otherwise(F.col("key")).alias("keyw"),
        F.when(kind == "FPAR", F.translate(
            F.array_join(_between(tok, F.col("eq") + 1, F.col("value_end")), "."), "'", ""))
        .otherwise("").alias("keyv"),
        F.when(kind.isin("FPAR", "FEVT"), F.regexp_replace("text", BRACKETED, ""))
        .when(kind == "FLOG", F.concat_ws(" ", flog_head, F.nullif("text", F.lit("")), flog_last))
        .otherwise(F.col("text")).alias("logtext"),
    )
    codes = {
        "procname": F.when(coded, at(PROCNAME)).otherwise(F.translate(at(DAEMON), ":", "")),
        "procid": F.when(coded, at(PROCID).try_cast("bigint")).otherwise(0),
        "module": F.when(coded, at(MODULE)).otherwise(""),
        "errstack": F.when(error, at(ERRSTACK)).otherwise(""),
        "errstackidx": F.when(error, at(ERRSTACKIDX).try_cast("bigint")).otherwise(0),
        "errlocation": F.when(error, at(ERRLOCATION)).otherwise(""),
        "errseverity": F.when(error, at(ERRSEVERITY)).otherwise(""),
    }
    named = {"typelog": kind, "tm": F.col("tm"), "loghost": F.col("loghost"), **codes}
    return pieces.select("*", F.inline(F.array(F.when(good, texts)))).select(
        *[(F.when(good, named[f.name]) if f.name in named else F.col(f.name))
          .cast(f.dataType).alias(f.name) for f in OPS_CSV.fields],
        F.when(~good, F.col("value")).alias("_malformed"),
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    """The records that parsed, ready for ``normalise_csv``."""
    return parsed.where(F.col("_malformed").isNull()).drop("_malformed")
