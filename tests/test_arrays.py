"""JSON lists read by ranges: any cut gives the same rows, damage is a reject."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from cratewise.sources.arrays import ESCAPED, OUTSIDE, STRING, read_arrays, scan

ELEMENT = StructType([StructField("t", StringType()), StructField("n", ArrayType(IntegerType()))])
ROWS = [
    {"t": 'quote " and \\ back\\\\slash \\" [ ] { } , end', "n": [1, 2]}, {"t": "", "n": []}, {"t": "ünï 𝒳 \n\t", "n": [3]},
    {"t": "\\", "n": [4]}, {"t": "}{][\",", "n": None}, {"t": None, "n": [5, 6]}, {"t": "x" * 300, "n": [7]}, {"t": "\\\\\\", "n": [8]},
]


def test_any_cut_gives_the_same_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text(" [" + ",\n ".join(json.dumps(r, ensure_ascii=i % 2 == 0) for i, r in enumerate(ROWS)) + "]\n")
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps(ROWS))
    want = [(n, i, r["t"], r["n"]) for i, (n, r) in enumerate([("a.json", r) for r in ROWS] + [("c.json", r) for r in ROWS])]
    for size in (1, 7, 64, 1 << 20):
        rows, rejects = read_arrays(spark, str(tmp_path), ELEMENT, size)
        found = sorted((r.path.rsplit("/", 1)[1], r.id, r.element.t, r.element.n) for r in rows.collect())
        assert found == want and rejects.count() == 0, size


@pytest.mark.parametrize("state", [OUTSIDE, STRING, ESCAPED])
def test_scan_in_two_parts_is_a_scan(state):
    text = json.dumps(ROWS)
    begin = {OUTSIDE: 0, STRING: text.index("quote") + 1, ESCAPED: text.index("\\") + 1}[state]
    data = np.frombuffer(text[begin:].encode() + b' "\\\\\\', dtype=np.uint8)
    depth, end = scan(data, state)
    for cut in range(len(data) + 1):
        one, middle = scan(data[:cut], state)
        two, last = scan(data[cut:], middle)
        base = one[-1] if len(one) else 0
        assert last == end and (np.r_[one, two + base] == depth).all()


DAMAGED = {
    "blank": " ", "cut": '[{"t": "a"}, {"t"', "open": '[{"t": "a"}', "string": '["a"]', "number": "[1]", "object": '{"t": "a"}',
    "comma": '[{"t": "a"},]', "two commas": '[{"t": "a"},,{"t": "b"}]', "none": '[{"t": "a"} {"t": "b"}]', "two lists": "[][]", "tail": "[] x",
    "field": '[{"t": "a", "n": [1}]', "inner": '[{"t": a}]', "closed": "]", "brace": '[{"t": "a"}}', "null": "null",
}


@pytest.mark.parametrize("size", [3, 1 << 20])
def test_damaged_files_are_rejects(spark, tmp_path, size):
    for name, text in DAMAGED.items():
        (tmp_path / f"{name.replace(' ', '-')}.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"t": "a", "n": [1]}]')
    rows, rejects = read_arrays(spark, str(tmp_path), ELEMENT, size)
    assert [(r.id, r.element.t) for r in rows.collect()] == [(0, "a")]
    assert sorted(r.path.rsplit("/", 1)[1] for r in rejects.collect()) == sorted(f"{n.replace(' ', '-')}.json" for n in DAMAGED)


def test_several_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"t": f"row {i}", "n": [i]} for i in range(500)]))
    rows, _ = read_arrays(spark, str(tmp_path), ELEMENT, 1000)
    found = rows.select("id", "element.n").collect()
    assert sorted((r.id, r.n[0]) for r in found) == [(i, i) for i in range(500)]
    ranges = spark.read.format("binaryFile").load(str(tmp_path)).select(F.ceil(F.col("length") / 1000)).first()[0]
    assert ranges > 10
