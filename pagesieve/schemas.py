"""Fixed column types of every table the jobs read or write."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_text, _long, _int, _double = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

TRAINING = _struct(
    title=_text, keywords=_text, description=_text, corpus=_text, label=_text, **{"class": _text}
)
INCOMING = _struct(id=_long, sname=_text, domain=_text, url=_text, snapshot=_text)
SNAPSHOT = _struct(file_path=_text, html=_text)
FEATURES = _struct(file_path=_text, title=_text, keywords=_text, description=_text, corpus=_text)
VOCABULARY = _struct(word=_text, id=_long)
VECTORS = _struct(word=_text, id=_long, vector=T.ArrayType(T.FloatType()))
SCORES = _struct(classes=_int, probabilities=T.ArrayType(_double))
MARKS = _struct(seq=_long, offset_value=_long, upto=_long)

_result = {name: _text for name in ("wzmc", "ym", "yjym", "url", "nwdz")}
RESULT = _struct(offset=_long, **_result, rksj=T.TimestampNTZType(), logits=_double)
CASCADE_RESULT = _struct(
    offset=_long, **_result, rksj=T.TimestampNTZType(), logits_main=_double, logits_sub=_double
)
