"""Colliding words, groups of near copies, and helper names that tables may have too."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cratewise.llm import decontam, ngram_join, pretokens
from cratewise.llm.line_dedup import drop_repeated_lines, positions, without_repeated_lines
from cratewise.llm.ngram_join import jaccard_components, keep_one_of_each
from cratewise.llm.packing import pack
from cratewise.llm.pii import instances, matches, personal_data, placed, redacted
from cratewise.llm.secrets import find_secrets
from cratewise.llm.stores import components
from cratewise.llm.token_counts import count_tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def colliding():
    """Pairs whose difference any polynomial modulo 2**64 maps to zero."""
    texts = []
    for letters in ("ab", "th", "er", "ox", "in"):
        for n in (1024, 2048):
            texts += [thue_morse(n, letters) + " tail", thue_morse(n, letters[::-1]) + " tail"]
    return list(enumerate([*texts, thue_morse(8192, "ab") + " tail", thue_morse(8192, "ba") + " tail"]))


def library(text):
    return Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def test_words_that_a_polynomial_cannot_tell_apart(spark):
    rows = colliding()
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    ids = {i: library(t) for i, t in rows}
    assert {r.doc_id: r.n_tokens for r in count_tokens(df, VOCABULARY).collect()} == {i: len(x) for i, x in ids.items()}
    pieces = {}
    for r in pack(df, VOCABULARY).collect():
        pieces.setdefault(r.doc_id, {})[r.piece] = r
    for i, own in ids.items():
        own = [*own, 1]
        for n, r in pieces[i].items():
            part = np.array(own[r.start : r.start + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.length == min(4096, len(own) - 4096 * n)
    found = jaccard_components(df).collect()
    assert all(r.component_id == r.doc_id for r in found)


def test_words_with_the_same_hash_are_compared_by_characters(spark, monkeypatch):
    table = pretokens.WordTable(Tokenizer.from_file(VOCABULARY).to_str(), lambda words: words)
    monkeypatch.setattr(pretokens, "word_hashes", lambda code, start, end: (end - start).astype(np.uint64))
    texts = ["one two six ten three", "ten two one seven eight", "", "two", "three eight seven"]
    assert [[table.values[i] for i in own] for own in table.rows(texts)] == [t.split() for t in texts]


def near_copies(n, seed=4):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(1, 2)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def plain_components(rows):
    names = {}
    sets = [{names.setdefault(tuple(t.split()[i : i + 5]), len(names)) for i in range(len(t.split()) - 4)} for _, t in rows]
    there = np.zeros((len(sets), len(names)), dtype=np.float32)
    for i, own in enumerate(sets):
        there[i, list(own)] = 1
    common, size = there @ there.T, there.sum(axis=1)
    linked = 100 * common >= 80 * (size[:, None] + size[None] - common)
    least = np.arange(len(sets))
    while True:
        new = np.where(linked, least[None], len(sets)).min(axis=1)
        if (new == least).all():
            return {i: int(c) for (i, _), c in zip(rows, least)}
        least = new


def test_a_large_group_of_near_copies_gives_few_rows(spark, monkeypatch):
    made = []
    for name in ("_large_links", "_pivot_pairs", "_small_links"):
        def counted(*args, own=getattr(ngram_join, name)):
            out = own(*args)
            made.append(out.count())
            return out

        monkeypatch.setattr(ngram_join, name, counted)
    monkeypatch.setattr(ngram_join, "BLOCK", 500)
    n = 2500
    rows = near_copies(n)
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    want = plain_components(rows)
    assert {r.doc_id: r.component_id for r in found} == want and len(set(want.values())) < n / 10
    # All pairs would be over three million.
    assert sum(made) < 20 * n


def members(texts):
    grams = [np.unique(np.array([hash(tuple(t.split()[i : i + 5])) & (2**63 - 1) for i in range(len(t.split()) - 4)], dtype=np.uint64)) for t in texts]
    out = []
    for i, g in enumerate(grams):
        bits = np.bincount(((g >> np.uint64(20)) & np.uint64(2047)).astype(np.int64), minlength=2048) & 1
        out.append({"cid": bytes([i // 256, i % 256]), "component": bytes([i // 256, i % 256]), "n": len(g), "shared": len(g),
                    "bitmap": np.packbits(bits.astype(bool)).tobytes(), "segments": [g[g < 2**62].tobytes(), g[g >= 2**62].tobytes()]})
    return out, grams


def test_a_block_returns_fewer_links_than_members():
    import pandas as pd

    side, grams = members([t for _, t in near_copies(300)] + [t for _, t in near_copies(100, seed=9)])
    frame = pd.DataFrame({"one": [side], "two": [side], "same": [True]})
    links = pd.concat(list(ngram_join._united(80)(iter([frame]))))
    assert len(links) < len(side)
    root = list(range(len(side)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(links["a"], links["b"]):
        i, j = a[0] * 256 + a[1], b[0] * 256 + b[1]
        common = len(np.intersect1d(grams[i], grams[j]))
        assert 100 * common >= 80 * (len(grams[i]) + len(grams[j]) - common)
        root[find(i)] = find(j)
    for i in range(0, len(side), 7):
        for j in range(i):
            common = len(np.intersect1d(grams[i], grams[j]))
            if 100 * common >= 80 * (len(grams[i]) + len(grams[j]) - common):
                assert find(i) == find(j)


CLASHES = ["_id", "_hash", "_lines", "_gone", "_spans", "_done", "cut_id", "cut_hash", "cut_gone", "cut_parts", "lines", "lines_gone", "keep_id", "text_digest", "redact_id", "Redact_spans", "redact_done"]


@pytest.fixture(scope="module")
def clashing(spark):
    run = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 2
    texts = [(1, f"{run}\nfirst line"), (2, f"{run}\nother line"), (3, "mail a@b.example now"), (4, None), (5, ""), (6, "x " * 60_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return df.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASHES})


def kept(df):
    return {r.doc_id: [r[c] for c in CLASHES] for r in df.collect()}


def test_columns_with_the_names_of_helpers_are_kept(spark, clashing):
    whole = kept(clashing)
    cut = without_repeated_lines(clashing)
    assert cut.columns == clashing.columns and kept(cut) == whole
    assert {r.doc_id: r.text for r in cut.collect()}[2] == "other line"
    counted = {r.doc_id: (r.lines, r.lines_gone) for r in drop_repeated_lines(clashing).collect()}
    assert counted == {1: (2, 0), 2: (2, 1), 3: (1, 0), 4: (0, 0), 5: (1, 0), 6: (1, 0)}
    one = keep_one_of_each(clashing)
    assert one.columns == clashing.columns and kept(one) == whole
    plain = redacted(clashing, personal_data(clashing))
    assert plain.columns == clashing.columns and kept(plain) == whole
    assert {r.doc_id: r.text for r in plain.collect()}[3] == "mail [email] now"


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(5, i) for i in range(6, 60)], [(9, 1), (1, 9), (9, 2), (2, 7), (30, 20)], [],
])
def test_components_equal_a_plain_union(spark, links):
    want = {x: x for pair in links for x in pair}
    for _ in want:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    found = [tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(found) == len(want) and dict(found) == want


def _plain_cut(texts, least):
    """Lines left of each text when runs of ``least`` words that occur earlier go, all runs against all."""
    split = {i: t.split("\n") for i, t in texts}
    seen, gone = {}, {i: set() for i in split}
    for i in sorted(split):
        worded = [j for j, line in enumerate(split[i]) if line.split()]
        size = [len(split[i][j].split()) for j in worded]
        for a in range(len(worded)):
            for b in range(a, len(worded)):
                if sum(size[a : b + 1]) < least:
                    continue
                run = tuple(split[i][j] for j in worded[a : b + 1])
                # Only shortest runs, from one side or the other, cover blank lines within.
                shortest = sum(size[a:b]) < least or sum(size[a + 1 : b + 1]) < least
                if run in seen and shortest:
                    gone[i].update(range(worded[a], worded[b] + 1))
                seen.setdefault(run, i)
    return {i: "\n".join(x for j, x in enumerate(lines) if j not in gone[i]) for i, lines in split.items()}


@pytest.mark.parametrize("seed", range(3))
def test_winnowed_runs_equal_all_runs_against_all(spark, seed):
    dice = random.Random(seed)
    lines = ["", " ", "a", "b c", "d e f", "g h i j", "k l m n o p q", "r"]
    texts = [(i, "\n".join(dice.choices(lines, k=dice.randrange(0, 14)))) for i in range(150)]
    found = drop_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string"), 6)
    assert {r.doc_id: r.text for r in found.collect()} == _plain_cut(texts, 6)


def test_one_position_stands_for_the_windows_of_a_minimum(spark):
    lines = [f"line {i} of a long text" for i in range(400)]
    texts = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[100:300]))], "doc_id long, text string")
    # Five lines of six words to a window: positions are far fewer than windows.
    assert positions(texts, 30).count() < 0.5 * 600
    assert {r.doc_id: r.lines_gone for r in drop_repeated_lines(texts, 30).collect()} == {1: 0, 2: 200}


# Written for this test; no text of the table holds them.
IDENTIFIERS = """customer_account_overview get_user_by_identifier com/photos/2024/summer-holiday BUILD_RELEASE_CONFIGURATION xylophone-quartet
Donaudampfschifffahrt customerAccountOverview MaxConnectionsPerHost read_only_replica docs/getting-started/install-guide HTTP_RESPONSE_TIMEOUT
shopping-cart-total invoice_number_2023 Wirtschaftswissenschaften responsabilidad internationalisation parseRequestHeaders user-profile-settings
is_valid_address ORDER_STATUS_PENDING backup-2024-03-01 temperature_sensor_12 ListOfOpenItems desarrollo-sostenible chambre_de_commerce
www/static/images/header-logo employee-of-the-month createTemporaryFolder TOTAL_AMOUNT_DUE weather_forecast_daily monthlyNewsletter
geschwindigkeitsbegrenzung anticonstitutionnellement last-modified-since remote_server_name LocalDateFormatter color=dark-green
notes/meeting/october first_name+last_name table_of_contents SearchResultPage""".split()


def test_ordinary_identifiers_are_told_from_random_strings(spark):
    dice = random.Random(5)
    alphabets = ("0123456789abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    keys = ["".join(dice.choices(alphabets[i % 3], k=dice.randrange(12, 32))) for i in range(len(IDENTIFIERS))]
    planted = [(10_000_000 + i, f"we saw {x} there") for i, x in enumerate(IDENTIFIERS + keys)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))).filter("doc_id >= 10000000")
    hit = [r.doc_id - 10_000_000 for r in found.filter("contains(spans, 'random:')").collect()]
    right = sum(i >= len(IDENTIFIERS) for i in hit)
    assert right >= 0.9 * len(keys)
    assert right >= 0.9 * len(hit)


@pytest.mark.parametrize("limits", [(12, 10**6), (10**6, 40)])
def test_benchmark_in_shares_of_words_and_bytes(spark, monkeypatch, limits):
    dice = random.Random(3)
    texts = [",".join(dice.choices("abc", k=dice.randrange(0, 60))) for _ in range(60)] + [None, ""]
    items = [",".join(dice.choices("abc", k=n)) for n in (0, 1, 4, 5, 6, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (None, "a,b")], "item_id long, text string").repartition(3)
    whole = decontam.contamination(docs, benchmark, 5).collect()
    # Brute force.
    named = {}
    for i, t in enumerate(items):
        words = [w for w in t.split(",") if w]
        m = min(5, len(words))
        for s in range(len(words) - m + 1) if m else ():
            named.setdefault(tuple(words[s : s + m]), set()).add(i)
    for row in whole:
        words = [w for w in (texts[row.doc_id] or "").split(",") if w]
        found = [(s, m, named[tuple(words[s : s + m])]) for m in range(1, 6) for s in range(len(words) - m + 1) if tuple(words[s : s + m]) in named]
        assert row.n_hit == len({s + k for s, m, _ in found for k in range(m)})
        assert row.items_sha256 == decontam.items_digest(set().union(*(x for *_, x in found)))
    clean = {r.doc_id for r in decontam.decontaminate(docs, benchmark, 5).collect()}
    assert clean == {r.doc_id for r in whole if not r.contaminated}
    monkeypatch.setattr(decontam, "WORDS_PER_SEARCH", limits[0])
    monkeypatch.setattr(decontam, "BYTES_PER_SEARCH", limits[1])
    assert decontam._searches(benchmark, 5)[0] > 1
    assert sorted(decontam.contamination(docs, benchmark, 5).collect()) == sorted(whole)
    assert {r.doc_id for r in decontam.decontaminate(docs, benchmark, 5).collect()} == clean


@pytest.mark.parametrize("most, widest", [(12, 10**6), (10**6, 40), (1, 1), (40, 10**6)])
def test_pieces_hold_every_window(most, widest):
    words = [b"w%d" % i for i in range(40)]
    pieces = [*decontam._pieces(words, 5, most, widest)]
    found = [tuple(text.split()[s : s + 5]) for n, text in pieces for s in range(n - 4)]
    assert sorted(found) == sorted(tuple(words[i : i + 5]) for i in range(36))
    assert all(n == 5 or (n <= most and len(text) <= widest) for n, text in pieces)


def test_context_is_the_whole_word_before(spark):
    long = "reach" * 30
    docs = spark.createDataFrame([(1, f"{long}{' ' * 90}\n\t a@b.co and +49 30 1234567"), (2, "x1"), (3, None)], "doc_id long, text string")
    found = {r.match: r.pattern for r in instances(placed(matches(docs))).collect()}
    assert found == {"a@b.co": long, "+49 30 1234567": "and", "x1": None}
