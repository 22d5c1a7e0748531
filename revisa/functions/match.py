"""SCL-08 match text: NFKC, no whitespace / separators / punctuation, lower case.

Spark has no NFKC built-in, so the normalisation step is an Arrow UDF; the rest is built-in
expressions.  Arrow's own ``utf8_normalize`` leaves composed characters decomposed under NFKC
(and NFC), so each distinct value of a batch goes through ``unicodedata``.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from revisa.functions.text import _c

DROP = r"[\t-\r\x1c-\x20\x85\p{Z}\p{P}]"


@arrow_udf(StringType())
def nfkc(s: pa.Array) -> pa.Array:
    values = s.dictionary_encode()
    plain = pa.array([unicodedata.normalize("NFKC", v) for v in values.dictionary.to_pylist()], pa.string())
    return plain.take(values.indices)


def match_text(c) -> Column:
    return F.lower(F.regexp_replace(nfkc(_c(c)), DROP, ""))
