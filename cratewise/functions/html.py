"""HTML entity decoding: the one function that needs Python.

No SQL function knows the full entity table. Only the character references of a
text are sent to Python, and each different one of a batch is decoded once; the
text stays in the JVM, where the decoded references take their places. So the
memory of a Python worker follows the references, not the texts around them.
"""

from __future__ import annotations

import html
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Ship the function itself, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What ``html.unescape`` may change: a number, or a run of letters and digits.
# Every name of the entity table is such a run of at most 32 characters, which
# a semicolon may follow; the longest name that begins the run is decoded.
REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][0-9A-Za-z]{0,31};?)"


@F.arrow_udf(ArrayType(StringType()))
def _decode(references: pa.Array) -> pa.Array:
    found = references.flatten().dictionary_encode()
    decoded = pa.array([html.unescape(r) for r in found.dictionary.to_pylist()], pa.string())
    size = references.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.r_[0, np.cumsum(size)], pa.int32())
    # Null for a text without any, which then need not be put together.
    return pa.ListArray.from_arrays(ends, decoded.take(found.indices), mask=pa.array(size == 0))


def unescape_html(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    decoded = _decode(F.when(F.contains(c, F.lit("&")), F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0))))
    # One part more than there are references: nothing follows the last part.
    joined = F.zip_with(F.split(c, REFERENCE, -1), decoded, lambda part, after: F.concat(part, F.coalesce(after, F.lit(""))))
    return F.when(decoded.isNull(), c).otherwise(F.array_join(joined, ""))
