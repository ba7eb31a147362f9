"""Table schemas. Timestamps carry no zone; every operator takes the instant as ``as_of``."""

from pyspark.sql import types as T

_text = T.StringType()
_when = T.TimestampNTZType()


def _schema(*columns) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], nullable=len(c) == 2) for c in columns])


REQUIRED = False

CONTENT = _schema(
    ("entry_id", T.LongType()), ("topic", _text, REQUIRED), ("subject", _text), ("url", _text),
    ("body", _text, REQUIRED), ("source_type", _text), ("fetched_at", _when), ("expires_at", _when),
    ("tags", _text),
)
PROBLEMS = _schema(
    ("problem_id", T.LongType()), ("topic", _text, REQUIRED), ("subject", _text), ("difficulty", _text),
    ("source", _text), ("problem", _text, REQUIRED), ("solution", _text), ("url", _text),
    ("fetched_at", _when), ("expires_at", _when),
)
SESSIONS = _schema(
    ("session_id", T.LongType()), ("topic", _text, REQUIRED), ("subject", _text), ("started_at", _when),
    ("checkpoint", T.IntegerType()), ("notes", _text),
)
SYLLABUS = _schema(
    ("subject", _text), ("section", _text), ("topic", _text), ("weight_pct", T.IntegerType()),
    ("advanced", _text), ("tier", _text), ("notes", _text),
)
SECTION_TOTALS = _schema(
    ("subject", _text), ("section", _text), ("lo_pct", T.IntegerType()), ("hi_pct", T.IntegerType()),
)
STUDY_ORDER = _schema(
    ("phase", T.IntegerType()), ("subject", _text), ("pos", T.IntegerType()), ("label", _text),
)
SLIDES = _schema(("deck", _text), ("slide_no", T.IntegerType()), ("text", _text))

STORE_TABLES = {
    "content": (CONTENT, "entry_id"),
    "problems": (PROBLEMS, "problem_id"),
    "sessions": (SESSIONS, "session_id"),
}
