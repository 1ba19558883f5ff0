import json
import random

import pytest

from verdigris.sources import json_arrays
from verdigris.sources import requests as files
from verdigris.sources.storage import stored

ITEM = "struct<q: string, deep: string, n: int>"


@pytest.fixture
def small_ranges(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def read(spark, path):
    return [row.value and tuple(row.value) for row in json_arrays.array_items(spark, str(path), ITEM).collect()]


def records(seed, count=60):
    pick = random.Random(seed)
    marks = ['"', "\\", "{", "}", "[", "]", ",", "\\\"", "é", "😀", "\n", "\t", "x" * 90, "]]}}", '"}', "\\\\", " "]
    def text():
        return "".join(pick.choice(marks) for _ in range(pick.randint(0, 6)))
    return [pick.choice([None, {"q": text(), "deep": {"a": [{"b": text()}], "c": {}}, "n": n}, {}, {"q": text()}]) for n in range(count)]


def wanted(items):
    return [
        item if item is None else (item.get("q"), "deep" in item, item.get("n")) for item in items
    ]


@pytest.mark.parametrize("indent", [None, 2, "\t"])
@pytest.mark.parametrize("ascii_", [True, False])
def test_every_item_of_every_range(spark, tmp_path, small_ranges, indent, ascii_):
    """Escapes, quotes and brackets inside strings fall on borders; ranges are 64 bytes."""
    items = [records(seed) for seed in range(3)]
    for n, each in enumerate(items):
        (tmp_path / f"{n}.json").write_text(json.dumps(each, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    frame = json_arrays.array_items(spark, str(tmp_path), ITEM)
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 50
    found = [row.value and (row.value.q, row.value.deep is not None, row.value.n) for row in frame.collect()]
    assert sorted(found, key=repr) == sorted((each for group in items for each in wanted(group)), key=repr)


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []), (" \n", []), ("[]", []), (" [ \n ] \n", []), ("[null]", [None]), ("[null, null]", [None, None]),
        ('[{"q": "a"}]', [("a", None, None)]), ('\n[\n{"q": "}"}\n,\nnull, {}]\n', [("}", None, None), None, (None, None, None)]),
        ('[{"q": "a"}, null]', [("a", None, None), None]), ('﻿[{"q": "a"}]', [("a", None, None)]),
        ('[{"q": "' + "\\\\" * 100 + '"}]', [("\\" * 100, None, None)]),
    ],
)
def test_small_files(spark, tmp_path, small_ranges, text, want):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    assert sorted(read(spark, tmp_path), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize(
    "text",
    [
        '[{"q": "a"}] x', '[{"q": "a"}]]', '[{"q": "a"}] [{"q": "b"}]', '[{"q": "a"}] {"q": "b"}', '[{"q": "a"}] }', '[{"q": "a"} {"q": "b"}]',
        '[{"q": "a"},]', '[,{"q": "a"}]', '[{"q": "a"},,{"q": "b"}]', '[{"q": "a"}', '[{"q": "a"}, {"q": "b', '[{"q": "a"}, ', "[", '{"q": "a"}',
        '{"q": "a"}]', "3", '["text"]', '[{"q": "a"}, 3]', '[{"q": a}]', "]", "[]]", "[] []", "[,]", '[{"q": "a"]}', '[{"q": "a"}]}', "x[]",
    ],
)
def test_what_is_no_single_array_fails(spark, tmp_path, small_ranges, text):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    with pytest.raises(Exception):
        read(spark, tmp_path)


def test_requests_in_ranges_equal_those_of_lines(spark, tmp_path, small_ranges):
    kinds = [
        {"question": "q", "context": None}, {"query": "s"}, {"messages": [{"role": "user", "content": '}"{'}]}, {"other": 1}, {"question": 3},
    ]
    items = [kinds[n % len(kinds)] for n in range(57)]
    for name, text in (("lines", "\n".join(map(json.dumps, items))), ("array", json.dumps(items, indent=1))):
        (tmp_path / name).write_text(text)
    frames = [files.read_requests(spark, str(tmp_path / layout), layout) for layout in ("lines", "array")]
    lines, array = (sorted(map(str, frame.collect())) for frame in frames)
    assert len(array) == 57 and array == lines and frames[0].schema == frames[1].schema


def test_text_is_read_twice_and_cut_once(spark, tmp_path, monkeypatch):
    """Once for the state in which each range is entered, once to cut it; what follows reads the records."""
    (tmp_path / "a.json").write_text(json.dumps([{"q": "a"}, None, {"q": "}"}]))
    written = []
    monkeypatch.setattr(json_arrays, "stored", lambda frame, name: written.append(frame) or stored(frame, name), raising=False)
    found = json_arrays.array_items(spark, str(tmp_path / "a.json"), ITEM)
    plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in (*written, found)]
    assert [plan.count("FileScan text") for plan in plans] == [2, 0]
    assert sorted(row.value.q if row.value else "none" for row in found.collect()) == ["a", "none", "}"]
