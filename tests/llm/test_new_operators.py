"""Centroids, conversation repair and archives against brute force."""

import hashlib
import itertools
import random
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cratewise.llm import archives, turns
from cratewise.llm.archives import archived_pages, read_records, record_places, with_payloads, write_packages
from cratewise.llm.centroids import lookup_clusters, table_distances
from cratewise.llm.turns import cheapest, converge, damaged, repair, repaired_conversations, trace
from cratewise.llm.zip_reader import DamagedPackage, members

BAD = float("nan"), float("inf"), float("-inf"), None


# Centroids


def plain_clusters(rows, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    mid = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(mid))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        mid = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if groups[c] else m for c, m in enumerate(mid)]
    found = [(i, *near(v)) for i, v in kept]
    per = Counter()
    for _, s, c in found:
        per[c] += s
    name = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in mid]
    return Counter((i, c, s, per[c], sum(per.values()), name[c]) for i, s, c in found)


def vectors(n, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=64).astype(np.float32) / 8]) for i in range(n)]
    odd = [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), *[(904 + j, [0.25] * 63 + [b]) for j, b in enumerate(BAD)]]
    return rows + odd + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (910, [0.0] * 64), (911, [0.0] * 64), (912, [3000.0] * 64)]


@pytest.mark.parametrize("n", [150, 20])
def test_clusters_equal_brute_force(spark, n):
    rows = vectors(n)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, vector string").repartition(5)
    found = lookup_clusters(df)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, found.collect())) == plain_clusters(rows)


def test_clusters_of_an_empty_table_and_of_huge_components(spark):
    assert lookup_clusters(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []
    rows = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)]
    found = lookup_clusters(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), k=1).collect()
    assert sorted(r.vec_id for r in found) == [1, 2, 3] and {r.inertia for r in found} == {2**61}


def test_table_distances_of_wide_and_narrow_columns():
    rng = np.random.default_rng(1)
    wide = np.c_[rng.integers(-9, 9, (50, 3)), rng.integers(-(1 << 27), 1 << 27, (50, 2))]
    mid = wide[:7]
    assert (table_distances(wide, mid) == ((wide[:, None] - mid[None]) ** 2).sum(axis=2)).all()


# Conversation repair


def plain_cheapest(symbols):
    """Dijkstra's order without prices: least (cost, letters) of every state, row by row."""
    def inserted(best):
        for _ in range(2):
            for s in (0, 1, 2, 3):
                if s in best:
                    to, way = (3 if s == 2 else 2), (best[s][0] + 5, best[s][1] + "I")
                    best[to] = min(best.get(to, way), way)
        return best

    best = {0: (0, "")}
    for c in symbols:
        step = {}
        for s, (cost, letters) in inserted(best).items():
            ways = [(s, 2, "D")]
            if c != "d":
                more, low = 5 * c.isupper(), c.lower()
                ways.append((3 if s == 2 else 2, 1 + more, "R"))
                ways += [(1, more, "K")] * (low == "s" and s == 0) + [(2, more, "K")] * (low == "u" and s != 2) + [(3, more, "K")] * (low == "a" and s == 2)
            for to, price, letter in ways:
                way = (cost + price, letters + letter)
                step[to] = min(step.get(to, way), way)
        best = step
    best = inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


def test_auction_finds_the_cheapest_least_edits():
    for n in range(5):
        for symbols in map("".join, itertools.product("dsuaoSUA", repeat=n)):
            assert cheapest(symbols) == plain_cheapest(symbols), symbols
    rng = random.Random(1)
    for _ in range(300):
        symbols = "".join(rng.choices("dsuaoSUAO", [2, 1, 6, 6, 1, 1, 2, 2, 1], k=rng.randint(5, 60)))
        assert cheapest(symbols) == plain_cheapest(symbols), symbols


def test_prices_are_dual_feasible_and_tight_on_the_path():
    symbols = "suuaUAdoaausuad"
    price = converge(symbols, turns.CLOSING)
    for i, c in enumerate(symbols):
        for s in turns.STATES:
            costs = [cost + price[i + rows][to] for _, cost, rows, to in turns.arcs(c)[s]]
            assert price[i][s] == min(costs)
    assert trace(symbols, price, turns.NONE)[0]


LEGAL = {"su", "ua", "au"}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain_repair(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[1:])
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen, symbols = Counter(), set(), ""
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults[fault] += 1
            c = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "d" if fault in ("blank", "duplicate") else c.upper() if fault else c
        cost, audit = plain_cheapest(symbols)
        lines, at = [], 0
        order = ["user", "assistant"] * len(audit)
        if audit.replace("I", "").replace("D", "")[:1] == "K" and (len(audit) - audit.count("D")) % 2:
            order = ["system", *order]
        for letter in audit:
            if letter != "D":
                role = order[len(lines)]
                if letter == "K":
                    assert own[at][1][:1] == role[0]
                    role = own[at][1]
                lines.append(f"{role}:" + ("" if letter == "I" else own[at][2]))
            at += letter != "I"
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(own, own[1:]))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(n=60, seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "up"])
            rows.append((conv, turn + rng.choice([0, 0, 3]), role, rng.choice(["Hello.", "What?", "cut off", "ünï 𝒳!\t", " \n", "", "Yes.\x0b"]) + rng.choice(["", "", f" {turn}."])))
    rows += [(None, 1, "user", "no id."), (None, None, None, None), (70, None, "user", "a."), (70, None, "user", "a."), (71, None, "assistant", "b"), (72, -5, "user", "x " * 20000)]
    return rows + [(80, t, "user" if t % 2 else "assistant", f"line {t % 37}" + "." * (t % 3)) for t in range(700)] + [(81, 3, "user", "same.")] * 300


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


@pytest.mark.parametrize("block", [(1024, 1 << 20), (16, 1 << 20), (1024, 60)])
def test_repair_equals_brute_force_in_blocks_of_any_size(spark, monkeypatch, block):
    rows = conversations()
    monkeypatch.setattr(turns, "BLOCK_ROWS", block[0])
    monkeypatch.setattr(turns, "BLOCK_CHARS", block[1])
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, cost int").repartition(4)
    found = repaired_conversations(df)
    assert found.columns == COLUMNS
    want = {conv: EMPTY for conv in {r[0] for r in rows}} | plain_repair(plain_damage(rows))
    got = found.collect()
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want


def test_damage(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert Counter(map(tuple, damaged(df).collect())) == Counter(plain_damage(rows))


def test_repair_of_an_empty_table_and_of_string_ids(spark):
    assert repaired_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
    rows = [("b", 1, "user", "Hi."), ("b", 2, "assistant", "Ho."), ("a", 1, "assistant", "Ho.")]
    found = repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    assert {r.conv_id: (r.cost, r.audit) for r in found} == {"b": (0, "KK"), "a": (2, "D")}


# Archives


PAGE = "<p>" + "long enough to be shared " * 8 + "</p>"


@pytest.fixture(autouse=True)
def few_copies(monkeypatch):
    monkeypatch.setattr(archives, "COPIES", 3)


def pages():
    rows = [(i, f"http://x.example/{i}?q=ü é", f"<p>page {i % 9}</p>" * (1 + i % 9 * 3)) for i in range(60)]
    return rows + [(70, None, None), (71, "", ""), (None, "u", PAGE), (None, "u", PAGE), (72, "u\nv", PAGE), (72, "u", PAGE), (60, "u", PAGE), *[(59, v, PAGE) for v in "uuuuuuuvv"], (73, "u", "x" * 300_000), (5, "again", "y" * 99), (6, "z", "y" * 99)]


def plain_archive(rows):
    groups = defaultdict(list)
    out = Counter()
    for page, _, html in rows:
        groups[html or ""].append(page)
    for html, ids in groups.items():
        data = html.encode()
        first = min(ids, key=lambda i: (i is None, i or 0))
        for n, page in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            again = len(data) >= 100 and n > 0
            out[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    return out


def test_archive_round_trip(spark):
    df = spark.createDataFrame([(*r, "x") for r in pages()], "page_id long, url string, html string, digest string").repartition(3)
    found = archived_pages(df)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, found.collect())) == plain_archive(pages())
    assert archived_pages(df.limit(0)).collect() == []


def test_packages_roll_and_hold_every_payload(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(2)
    manifest = write_packages(df, f"file:{tmp_path}/packages", package_bytes=3000)
    paths = [r.path.removeprefix("file:") for r in manifest.collect()]
    assert len(paths) > 2 and manifest.agg(F.sum("records")).first()[0] == len(pages())
    for path in paths:  # an independent reader agrees on names, sizes and bytes
        with zipfile.ZipFile(path) as plain, open(path, "rb") as file:
            data = file.read()
            own = members(lambda a, n: data[a : a + n], len(data))
            assert plain.testzip() is None and [m.name for m in own] == plain.namelist()
            for m in own:
                at = m.place(lambda a, n: data[a : a + n])
                assert data[at : at + m.size] == plain.read(m.name)
    records = read_records(manifest, payloads=True)
    back = with_payloads(records).select("page", F.decode("payload", "UTF-8")).collect()
    assert Counter(map(tuple, back)) == Counter((None if p is None else str(p), h or "") for p, _, h in pages())
    assert record_places(manifest).count() == len(pages())


def package(path, comment=b"", large=False, method=zipfile.ZIP_STORED):
    with zipfile.ZipFile(path, "w", method) as out:
        for name in ("a.txt", "bü.txt"):
            info = zipfile.ZipInfo(name)
            info.compress_type = method
            with out.open(info, "w", force_zip64=large) as member:
                member.write(name.encode() * 5)
        out.comment = comment
    return path.read_bytes()


def ranges(data):
    return lambda start, length: data[start : start + length]


@pytest.mark.parametrize("comment", [b"", b"note PK\x05\x06 and more than twenty-two further bytes"])
@pytest.mark.parametrize("large", [False, True])
def test_directory_of_plain_and_large_packages(tmp_path, comment, large):
    data = package(tmp_path / "p.zip", comment, large)
    found = members(ranges(data), len(data))
    assert [m.name for m in found] == ["a.txt", "bü.txt"]
    for m in found:
        at = m.place(ranges(data))
        assert data[at : at + m.size] == m.name.encode() * 5


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    data = package(tmp_path / "p.zip", large=True)
    assert b"PK\x06\x06" in data
    found = members(ranges(data), len(data))
    assert [(m.name, m.size) for m in found] == [("a.txt", 25), ("bü.txt", 35)]
    assert all(data[m.place(ranges(data)) :].startswith(m.name.encode() * 5) for m in found)


def test_damaged_packages(tmp_path):
    data = package(tmp_path / "p.zip")
    for broken in (b"", b"PK", data[:-1], data[:40], data.replace(b"PK\x01\x02", b"PK\x01\x03")):
        with pytest.raises(DamagedPackage):
            members(ranges(broken), len(broken))
    packed = package(tmp_path / "q.zip", method=zipfile.ZIP_DEFLATED)
    with pytest.raises(DamagedPackage):
        members(ranges(packed), len(packed))[0].place(ranges(packed))


def test_changed_record_is_found():
    data = archives.record("1", "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None, "", "1970-01-01T00:00:00Z")
    assert archives.parsed(data)[2] == b"payload"
    for broken in (data.replace(b"payload\r", b"pAyload\r"), data[:-6], b"x" + data):
        with pytest.raises(DamagedPackage):
            archives.parsed(broken)
