"""Line dedup by winnowing over line hashes.

Lines are symbols. A *window* is a shortest run of consecutive lines (blank ones
left out) with at least ``min_words`` words, from the line it begins at or back
from the line it ends at.

1. Lines get 128-bit hashes. The smallest hash of each window that begins at a line,
   and its place, is selected; the run of windows with one minimum has one position.
   Two texts that share ``min_words`` words of whole lines share such a window, and
   with it the position and its hash, for certain.
2. A position is extended by the windows that hold it, line by line to both sides.
   Equal extensions are one *kind*: kinds are counted and keep their first place
   (smallest doc_id, then line). All places of a kind but the first are later runs as a whole.
3. Kinds are joined on the position's hash. Only where different kinds share one are
   their first places compared, window by window, to find how far the match goes; a hash
   with one kind at one place goes no further.
4. The lines of later runs are deleted. A run longer than an extension holds further
   positions, whose extensions overlap.

Texts move once, to meet the numbers of their deleted lines. All counting is
combined before the shuffle, and copies meet as one kind, never pair by pair; joins on
a frequent hash are inner joins of written tables, which Spark splits when one key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.llm.stores import free_name, written

_WORD = r"[^\x20\x09-\x0D]+"


def _hashes(value: Column) -> Column:
    return F.struct(F.xxhash64(value).alias("x"), F.xxhash64(F.lit(0x5EED), value).alias("y"))


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: key of the text, line number, hashes, words, and words before."""
    lines = docs.filter(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line", "content")
    )
    lines = lines.select(
        "doc_id", "text_hash", "line", F.xxhash64("content").alias("x"), F.xxhash64(F.lit(0x5EED), "content").alias("y"),
        F.regexp_count("content", F.lit(_WORD)).cast("long").alias("words"),
    ).filter("words > 0")
    # Repeated rows of the table are one text here.
    one = lines.repartition("doc_id", "text_hash").groupBy("doc_id", "text_hash", "line").agg(
        F.first("x").alias("x"), F.first("y").alias("y"), F.first("words").alias("words")
    )
    order = Window.partitionBy("doc_id", "text_hash").orderBy("line")
    return one.withColumn("upto", F.sum("words").over(order)).withColumn("before", F.col("upto") - F.col("words"))


def positions(docs: DataFrame, min_words: int) -> DataFrame:
    """The selected positions of all texts: ``mark`` (hash of the line), first and last line of the
    extension, its content (``kx``, ``ky``) and the windows in it."""
    lines = _lines(docs)
    text = Window.partitionBy("doc_id", "text_hash")
    ahead = text.orderBy("before").rangeBetween(0, min_words - 1)
    behind = text.orderBy("upto").rangeBetween(1 - min_words, 0)

    def content(frame) -> Column:
        return _hashes(F.collect_list(F.struct("x", "y")).over(frame))

    lines = lines.withColumns({
        "to": F.max("line").over(ahead), "full": F.sum("words").over(ahead) >= min_words,
        # Of equal hashes the one furthest up.
        "least": F.min(F.struct("x", "y", "line")).over(ahead), "next": content(ahead),
    })
    lines = lines.withColumns({
        "start": F.first(F.struct("line", "to", "least")).over(behind), "filled": F.sum("words").over(behind) >= min_words, "last": content(behind),
    })

    def window(first, last, hashes, least) -> Column:
        return F.struct(F.col(first).alias("from"), F.col(last).alias("to"), F.col(f"{hashes}.x").alias("x"), F.col(f"{hashes}.y").alias("y"), F.col(least).alias("least"))

    # A window that also begins where it was looked for backwards is there once.
    both = F.array(
        F.when(F.col("full"), window("line", "to", "next", "least")),
        F.when(F.col("filled") & (F.col("start.to") < F.col("line")), window("start.line", "line", "last", "start.least")),
    )
    held = lines.select("doc_id", "text_hash", F.explode(F.array_compact(both)).alias("w"))
    held = held.groupBy("doc_id", "text_hash", F.col("w.least.line").alias("at"), F.col("w.least.x").alias("mark")).agg(
        F.sort_array(F.collect_list(F.struct("w.from", "w.to", "w.x", "w.y"))).alias("windows")
    )
    whole = _hashes(F.transform("windows", lambda w: F.struct(w["x"], w["y"])))
    return held.select(
        "doc_id", "text_hash", "mark", F.col("windows")[0]["from"].alias("from"), F.array_max(F.col("windows.to")).alias("to"),
        whole["x"].alias("kx"), whole["y"].alias("ky"), "windows",
    )


def repeated_lines(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``gone``: the numbers of lines in later repeated runs."""
    selected = written(positions(docs, min_words), "positions")
    place = F.struct("doc_id", "text_hash", "from")
    kinds = written(selected.groupBy("kx", "ky").agg(F.first("mark").alias("mark"), F.min(place).alias("first"), F.count("*").alias("n")), "kinds")
    # A hash with one place in all is not shared.
    marks = kinds.groupBy("mark").agg(F.sum("n").alias("places"), F.count("*").alias("kinds")).filter("places > 1")
    shared = kinds.join(marks, "mark").select("kx", "ky", "first", (F.col("kinds") > 1).alias("others"))
    met = selected.join(shared, ["kx", "ky"]).withColumn("leads", place.eqNullSafe(F.col("first"))).filter("not leads or others")
    met = written(met.select("doc_id", "text_hash", "from", "to", "leads", F.when(F.col("leads"), F.col("windows")).alias("windows")), "met")
    copies = met.filter("not leads").select("doc_id", "text_hash", "from", "to")
    # Windows that kinds share, at the kinds' first places.
    parts = met.filter("leads").select("doc_id", "text_hash", F.inline("windows"))
    firsts = parts.groupBy("x", "y").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    partly = parts.join(written(firsts, "firsts"), ["x", "y"]).filter(~place.eqNullSafe(F.col("first")))
    later = copies.unionByName(partly.select("doc_id", "text_hash", "from", "to"))
    gone = later.select("doc_id", "text_hash", F.explode(F.sequence("from", "to")).alias("line"))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("gone"))


def _cut(docs: DataFrame, min_words: int, lines: str, lines_gone: str) -> DataFrame:
    """``docs`` without later runs, and the two counts under the given names."""
    found = written(repeated_lines(docs, min_words), "gone")
    taken = docs.withColumns({lines: F.lit(None), lines_gone: F.lit(None)})
    own = {c: free_name(taken, f"cut_{c}") for c in ("id", "hash", "gone", "parts")}
    gone = found.select(F.col("doc_id").alias(own["id"]), F.col("text_hash").alias(own["hash"]), F.col("gone").alias(own["gone"]))
    text = F.split("text", "\n", -1)
    same = F.col("doc_id").eqNullSafe(F.col(own["id"])) & (F.xxhash64("text") == F.col(own["hash"]))
    out = docs.join(gone.hint("shuffle_hash"), same, "left")
    cut = F.col(own["gone"]).isNotNull()
    kept = F.array_except(F.sequence(F.lit(0), F.size(text) - 1), own["gone"])
    parts = F.transform(kept, lambda i: F.get(F.col(own["parts"]), i))
    out = out.withColumn(own["parts"], F.when(cut, text))
    out = out.withColumn(lines, F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("long"))
    out = out.withColumn(lines_gone, F.when(cut, F.size(own["gone"])).otherwise(0).cast("long"))
    out = out.withColumn("text", F.when(cut, F.array_join(parts, "\n")).otherwise(F.col("text")))
    return out.drop(*own.values())


def drop_repeated_lines(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``, and two more
    columns, ``lines`` (lines of the text before) and ``lines_gone``.

    A run is one or more consecutive lines with ``min_words`` words in all that
    occurs earlier: in a document with a smaller id, or further up in the same
    one. Lines are compared exactly; lines without a word are looked through and
    stay, unless they lie inside a deleted window. Shorter repeated runs stay.
    Null texts stay null with 0 lines; an empty text has one line. Repeated rows
    are one text and get the same result. Null doc_ids come first in the order.
    All other columns are kept as they are; a column named ``lines`` or ``lines_gone`` is replaced.
    """
    own = docs.drop("lines", "lines_gone")
    return _cut(own, min_words, "lines", "lines_gone").select(*own.columns, "lines", "lines_gone")


def without_repeated_lines(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """``docs`` after ``drop_repeated_lines``, with its own columns, whatever their names:
    ``n_chars``, if there is one, follows the text, and texts of which no word is left are
    dropped. Null and empty texts lose no line and stay."""
    lines, gone = free_name(docs, "lines"), free_name(docs, "lines_gone")
    out = _cut(docs, min_words, lines, gone).filter((F.col(gone) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, changed).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
