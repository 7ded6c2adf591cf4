"""Personal data: fixed forms, and identifiers found by bootstrapped contexts.

1. *Seeds.* Emails, IP addresses, card and phone numbers are matched by pattern
   in whole texts; only the matches, with the lengths of the gaps between them
   and the words to their left, leave the scan. Places are running sums.
2. *Patterns.* The word before an instance is its lexical pattern. Every token
   with a digit that is not part of a seed is a candidate instance.
3. *Graph.* Patterns and instances form a graph. In each round a pattern's
   confidence for a kind is the share of that kind among its seeds and accepted
   candidates, and a candidate's score is one minus the product of its good
   patterns' doubts, times their share of the judged patterns it has; accepted
   candidates count with their scores for their patterns in the next round. What
   is not labelled yet speaks neither for nor against a pattern. Rounds end when
   no candidate is new.
4. Candidates with a high score are reported as ``near_<kind>`` spans.

Everything is built-in DataFrame functions; a frequent pattern is aggregated on
the map side and joined from written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.functions.once import with_once
from cratewise.llm.stores import free_name, written

# The forms of the contract. Possessive quantifiers and the look-behinds change no match: they
# keep a long run of such characters from being tried again from each of its characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
KINDS = ("email", "ip", "card", "phone")


def _found(kind: str, pattern: str, when: Column) -> Column:
    """Matches with the length of the gap before each and its last word, whatever its length and the blanks behind it."""
    text = F.col("text")
    gaps = F.split(text, pattern, -1)

    def last_word(gap: Column) -> Column:
        return F.substring_index(F.rtrim(F.translate(gap, "\t\n\v\f\r", " " * 5)), " ", -1)

    part = F.transform(
        F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")),
        lambda x: F.struct(F.length(x["gap"]).cast("long").alias("gap"), last_word(x["gap"]).alias("left"), x["match"].alias("match")),
    )
    none = F.array().cast("array<struct<gap: bigint, left: string, match: string>>")
    return F.struct(F.lit(kind).alias("kind"), F.coalesce(F.when(when, part), none).alias("items"))


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0))) % 10 == 0
    part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    return (
        F.when(kind == "ip", match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", F.length(digits).between(14, 19) & luhn)
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(F.lit(True))
    )


def matches(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash`` and all matches by kind."""
    text = F.col("text")
    digit, dotted = text.rlike("[0-9]"), text.rlike(r"[0-9]\.[0-9]")
    kinds = F.array(
        _found("email", EMAIL, F.contains(text, F.lit("@"))), _found("ip", IP, dotted), _found("card", CARD, digit),
        _found("phone", PHONE, F.contains(text, F.lit("+"))), _found("token", TOKEN, digit),
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.filter(kinds, lambda k: F.size(k["items"]) > 0).alias("found"))


def placed(found: DataFrame) -> DataFrame:
    """The matches with their places: ``kind, start, end, match, left``. Repeated rows are one text."""
    items = found.filter("size(found) > 0").select("doc_id", "text_hash", F.inline("found"))
    items = items.select("doc_id", "text_hash", "kind", F.posexplode("items").alias("nth", "item")).select(
        "doc_id", "text_hash", "kind", "nth", "item.*"
    )
    items = items.groupBy("doc_id", "text_hash", "kind", "nth").agg(*[F.first(c).alias(c) for c in ("gap", "left", "match")])
    size = F.coalesce(F.length("match"), F.lit(0))
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("nth")
    items = items.withColumn("end", F.sum(F.col("gap") + size).over(so_far).cast("long")).withColumn("start", F.col("end") - size)
    items = items.filter(F.col("match").isNotNull() & _valid(F.col("kind"), F.col("match")))
    return items.select("doc_id", "text_hash", "kind", "start", "end", "match", "left")


def instances(spans: DataFrame) -> DataFrame:
    """Seeds, and tokens that overlap no seed, with the word before each (``pattern``, lower case, or null)."""
    seed = F.col("kind") != "token"
    text = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end", "kind")
    past, rest = text.rowsBetween(Window.unboundedPreceding, -1), text.rowsBetween(1, Window.unboundedFollowing)
    marked = spans.withColumn("reached", F.max(F.when(seed, F.col("end"))).over(past)).withColumn("next", F.min(F.when(seed, F.col("start"))).over(rest))
    free = F.coalesce(F.col("reached") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True))
    word = F.lower("left")
    return marked.filter(seed | free).select(
        "doc_id", "text_hash", "kind", "start", "end", "match", F.when(word.rlike(r"\p{L}") & ~word.rlike("[0-9]"), word).alias("pattern")
    )


def discover(found: DataFrame, support: int = 3, sure: float = 0.7, accept: float = 0.8) -> DataFrame:
    """(match, near): candidates that patterns of one kind vouch for.

    A pattern is judged if seeds and accepted candidates, which count with their
    scores, sum to ``support``; it is good for a kind if that kind alone does and
    its confidence is ``sure`` or more. An accepted candidate stays, so the rounds
    end: at the latest when all candidates are accepted.
    """
    edges = written(
        found.filter("pattern is not null").groupBy("pattern", "match", "kind").agg(F.count("*").alias("n")), "edges"
    )
    tokens = edges.filter("kind = 'token'").select("pattern", "match")
    seeds = edges.filter("kind <> 'token'").select("pattern", F.col("kind").alias("of"), F.lit(1.0).alias("score"))
    scored, accepted = seeds, None
    while True:
        of = [F.coalesce(F.sum(F.when(F.col("of") == k, F.col("score"))), F.lit(0.0)) for k in KINDS]
        best = F.greatest(*[F.struct(w.alias("weight"), F.lit(k).alias("of")) for w, k in zip(of, KINDS)])
        patterns = scored.groupBy("pattern").agg(F.sum("score").alias("total"), best.alias("best"))
        trust = F.col("best.weight") / (F.col("total") + 1)
        good = (F.col("best.weight") >= support) & (trust >= sure)
        judged = written(patterns.filter(F.col("total") >= support).select("pattern", F.when(good, F.col("best.of")).alias("of"), trust.alias("sure")), "judged")
        doubt = F.log(1 - F.least("sure", F.lit(0.999)))
        parts = [
            (F.count(F.when(F.col("of") == k, 1)) / F.count("*") * (1 - F.exp(F.coalesce(F.sum(F.when(F.col("of") == k, doubt)), F.lit(0.0)))), k)
            for k in KINDS
        ]
        # Of equal scores the later kind.
        best = F.greatest(*[F.struct(x.alias("score"), F.lit(n).alias("order"), F.lit(k).alias("of")) for n, (x, k) in enumerate(parts)])
        scores = tokens.join(judged, "pattern").groupBy("match").agg(best.alias("best")).filter(F.col("best.score") >= accept).select("match", "best.of", "best.score")
        fresh = written(scores if accepted is None else scores.join(accepted.select("match"), "match", "left_anti"), "accepted")
        done, accepted = fresh.isEmpty(), fresh if accepted is None else accepted.unionByName(fresh)
        if done:
            return accepted.select("match", F.concat(F.lit("near_"), F.col("of")).alias("near"))
        scored = seeds.unionByName(tokens.join(accepted, "match").select("pattern", "of", "score"))


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data spans of each whole text.

    Returns one row per row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone``, ``base_sha256`` (digest of the four forms' spans) and
    ``spans`` (all spans as kind:start:end by start, then kind; ``near_...`` kinds
    are the discovered ones). Places are code points, the end is exclusive. A null
    or empty text has no spans. Repeated rows get equal results; an empty table
    gives no rows; other columns are ignored. Seeds stay whatever the graph says.
    """
    found = written(matches(docs), "matches")
    every = written(instances(placed(found)), "instances")
    near = written(discover(every), "near")
    tokens = every.filter("kind = 'token'").join(near, "match").withColumn("kind", F.col("near")).drop("near")
    spans = every.filter("kind <> 'token'").unionByName(tokens)
    order = F.array(*[F.lit(k) for k in (*KINDS, *[f"near_{k}" for k in KINDS])])
    spans = spans.withColumn("order", F.array_position(order, F.col("kind")))
    listed = spans.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "order", "end", "kind"))).alias("all"),
        *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).cast("long").alias(f"n_{k}") for k in KINDS],
    )
    listed = written(listed, "listed")

    def named(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = named(F.filter("all", lambda s: s["order"] <= len(KINDS)))
    left, right = found.select("doc_id", "text_hash").alias("d"), listed.alias("l")
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.text_hash") == F.col("l.text_hash"))
    return left.join(right, same, "left").select(
        "d.doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(base, F.lit("")), 256).alias("base_sha256"), F.coalesce(named(F.col("all")), F.lit("")).alias("spans"),
    )


def redacted(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (one row per doc_id) with the characters of each span of ``spans`` (a result of
    ``personal_data``) replaced by the kind in brackets; overlapping spans keep the first."""
    own = {c: free_name(docs, f"redact_{c}") for c in ("id", "spans", "done")}
    parts = spans.select(F.col("doc_id").alias(own["id"]), F.split("spans", ",").alias(own["spans"])).filter(F.size(F.filter(own["spans"], lambda s: s != "")) > 0)
    joined = docs.join(parts, docs["doc_id"].eqNullSafe(F.col(own["id"])), "left")
    folded = F.expr(f"""aggregate({own["spans"]}, named_struct('at', 0, 'out', ''), (acc, s) ->
        if(cast(split(s, ':')[1] as int) < acc.at, acc,
           named_struct('at', cast(split(s, ':')[2] as int), 'out', concat(acc.out, substring(text, acc.at + 1, cast(split(s, ':')[1] as int) - acc.at),
                        '[', split(s, ':')[0], ']'))))""")
    done = own["done"]
    joined = with_once(joined, **{done: F.when(F.col(own["spans"]).isNotNull(), folded)})
    text = F.when(F.col(done).isNull(), F.col("text")).otherwise(F.concat(F.col(f"{done}.out"), F.expr(f"substring(text, {done}.at + 1)")))
    return joined.withColumn("text", text).select(*docs.columns)
