"""What decoding of character references sends to Python."""

import html
import re

from pyspark.sql import functions as F

from cratewise.functions.html import REFERENCE, unescape_html


def test_only_references_reach_python(spark):
    rows = [(0, "x" * 50_000 + "&amp;&amp&lt&#65;&nope;" + "y" * 50_000), (1, "z" * 50_000 + "& &; &#; &#x;"), (2, None), (3, "&notit;"),
            (4, "&" + "a" * 40 + ";&AMP&#x1F600;&#0;&copy=1&CounterClockwiseContourIntegral;"), (5, "&"), (6, "")]
    df = spark.createDataFrame(rows, "id int, s string").coalesce(1)
    found = {r.id: r.d for r in df.select("id", unescape_html("s").alias("d")).collect()}
    assert found == {i: s if s is None else html.unescape(s) for i, s in rows}
    # What the function in Python is given: references, however long the texts are.
    plan = df.select(unescape_html("s"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ArrowEvalPython \[_decode\(", plan) and "regexp_extract_all" in plan
    sent = df.select(F.sum(F.length(F.array_join(F.regexp_extract_all("s", F.lit(REFERENCE), F.lit(0)), "")))).first()[0]
    assert sent < 200
