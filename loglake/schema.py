"""Row shapes of the lake.

Every record source is brought to ``ALOG``; loads turn it into ``POINT`` and document rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


TEXT, LONG, DOUBLE, TIME = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

# One log record as the database holds it.
ALOG = _struct(
    ("id", LONG), ("timestamp", TIME), ("loghost", TEXT), ("env", TEXT), ("procname", TEXT),
    ("procid", LONG), ("module", TEXT), ("typelog", TEXT), ("keywname", TEXT),
    ("keywvalue", TEXT), ("logtext", TEXT), ("errstack", TEXT), ("errstackidx", LONG),
    ("errlocation", TEXT), ("errseverity", TEXT),
)

# One line of an operational CSV archive, which has no header and no id.
OPS_CSV = _struct(
    ("typelog", TEXT), ("tm", TIME), ("loghost", TEXT), ("env", TEXT), ("procname", TEXT),
    ("procid", LONG), ("module", TEXT), ("keyw", TEXT), ("keyv", TEXT), ("logtext", TEXT),
    ("errstack", TEXT), ("errstackidx", LONG), ("errlocation", TEXT), ("errseverity", TEXT),
)

CSV_TO_ALOG = {"tm": "timestamp", "keyw": "keywname", "keyv": "keywvalue"}

TAG_KEYS = ("proc", "env", "loghost", "logtext")

POINT = T.StructType([
    T.StructField("name", TEXT), T.StructField("timestamp", LONG), T.StructField("value", DOUBLE),
    T.StructField("tags", T.MapType(TEXT, TEXT)),
])

DOC = _struct(
    ("_index", TEXT), ("_type", TEXT), ("_id", TEXT), ("@timestamp", TIME), ("loghost", TEXT),
    ("envname", TEXT), ("procname", TEXT), ("procid", LONG), ("module", TEXT), ("keywname", TEXT),
    ("keywvalue", TEXT), ("keywvalue_num", DOUBLE), ("logtext", TEXT), ("errstack", TEXT),
    ("errstackidx", LONG), ("errlocation", TEXT), ("errseverity", TEXT),
)

PROGRESS = _struct(
    ("collector", TEXT), ("past", TIME), ("present", TIME), ("collector_piglet", TIME),
    ("written_at", TIME),
)

RUN_LOG = _struct(
    ("collector", TEXT), ("host", TEXT), ("level", TEXT), ("message", TEXT), ("past", TIME),
    ("present", TIME), ("rows_in", LONG), ("points_out", LONG), ("docs_out", LONG),
    ("ok", T.BooleanType()), ("timestamp", TEXT), ("rejected", LONG),
)

REJECT = _struct(
    ("reason", TEXT), ("record", TEXT), ("file_path", TEXT), ("load_time", TIME), ("copies", LONG),
)

# One delete of datapoints: it removes what it names of all that was loaded up to its time.
DELETE = _struct(
    ("names", T.ArrayType(TEXT)), ("start_ms", LONG), ("end_ms", LONG),
    ("tags", T.MapType(TEXT, T.ArrayType(TEXT))), ("deleted_at", TIME),
)

# What a load says of an archive file: claimed, loaded (and what was in it) or given back.
LEDGER = _struct(
    ("target", TEXT), ("file_path", TEXT), ("file_size", LONG), ("modified", TIME), ("digest", TEXT),
    ("state", TEXT), ("load_id", TEXT), ("written_at", TIME), ("rows_in", LONG), ("rejected", LONG),
)

# Document types, and the length up to which a text field keeps an exact-match
# copy. Fields not listed for a type fall back to "default".
NUMERIC_TYPE = "opslog"
UNTYPED = "untyped"
KEYWORD_LIMITS = {
    "envname": {"default": 20},
    "errlocation": {"default": 20},
    "errseverity": {"default": 20},
    "errstack": {"default": 20},
    "keywname": {"default": 100},
    "keywvalue": {"default": 100},
    "loghost": {"default": 20},
    "logtext": {"default": 256, "fevt": 20},
    "module": {"default": 20},
    "procname": {"default": 20},
}


def time_literal_type(df: DataFrame, column: str) -> T.DataType:
    """Type a literal needs so that comparing it leaves the column itself uncast.

    A cast on the column would keep the predicate out of the Parquet reader.
    """
    kind = df.schema[column].dataType
    return kind if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else TIME
