"""Small records shared by the tests."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime

from loglake.schema import ALOG

GOLDEN = [
    (90017, datetime(2021, 3, 14, 15, 9, 26), "node7", "hall2", "recorder", 0, "", "FPAR",
     "HALL_PRESSURE", "1.01325", "Hall gauge", "", 0, "", ""),
    (90018, datetime(2021, 3, 14, 15, 31, 40), "node8", "hall5", "recorder", 0, "", "FPAR",
     "HALL_PRESSURE", "0.98692", "Hall gauge", "", 0, "", ""),
]

RAW_LINES = """\
May  3 08:15:20 kiln recorder: 77 08:15:20> OVEN HEAT = 841.5 / Heat of the oven [K]. [hall2]
May  3 08:15:21 kiln recorder: 77 08:15:21>- DOOR OPEN / Door was opened [hall2]
May  3 08:15:22 kiln recorder: 77 08:15:22>/ Shift change noted [hall2]
May  3 08:15:23 kiln recorder: 77 08:15:23 hall2 burner gasCtl 902 valve.C:37 x q15 4 W ERR_FLOW Gas flow is low
May  3 08:15:24 kiln recorder: 77 08:15:24 hall2 burner gasCtl 902 x valve cycle done
"""


def record(**changes):
    """One FPAR record with some fields changed."""
    values = dict(zip(ALOG.names, GOLDEN[0]))
    values.update(changes)
    return tuple(values[name] for name in ALOG.names)


def alog(spark, rows):
    """Records as a DataFrame; times are taken as UTC whatever zone Python is in."""
    texts = [tuple(str(v) if isinstance(v, datetime) else v for v in row) for row in rows]
    kinds = ", ".join(
        f"{f.name} {'string' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in ALOG.fields
    )
    df = spark.createDataFrame(texts, kinds)
    return df.withColumn("timestamp", df["timestamp"].cast("timestamp"))


def plan_of(df):
    """The physical plan with its full scan details."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
