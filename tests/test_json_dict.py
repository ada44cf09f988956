import json
import random

import pytest
from pyspark.sql import types as T

from answerloom.sources.json_dict import read_dict, write_dict

ANY = T.MapType(T.StringType(), T.StringType())


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def odd_entries(seed, n):
    """Texts full of the signs that cut entries, quotes, escapes and long characters."""
    rng = random.Random(seed)
    word = lambda most: "".join(rng.choice('{}[],:"\\ \n\tab1é😀') for _ in range(rng.randrange(most)))
    return {f"{i}{word(6)}": {"text": word(rng.choice([3, 40, 300])), "more": word(5)} for i in range(n)}


@pytest.mark.parametrize("size", [90, 700, 10**8])
@pytest.mark.parametrize("layout", [{"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_one_file_read_by_many_tasks(spark, tmp_path, small_ranges, size, layout):
    want = odd_entries(size, 20)
    path = tmp_path / "one.json"
    path.write_text(json.dumps(want, **layout), encoding="utf-8")
    small_ranges(size)
    got = read_dict(spark, str(path), ANY).orderBy("pos").collect()
    assert [(r["pos"], r["key"], r["value"]) for r in got] == [(i, k, v) for i, (k, v) in enumerate(want.items())]
    if size == 90:
        assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 10


def test_files_without_entries_and_values_of_other_kinds(spark, tmp_path, small_ranges):
    (tmp_path / "a.json").write_text(" {} \n")
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text('{"x": [1, {"a": ","}], "y": "}{", "z": null, "x": 7}\n')
    for size in (24, 10**8):
        small_ranges(size)
        rows = read_dict(spark, str(tmp_path), T.StringType()).orderBy("pos").collect()
        assert [(r["pos"], r["key"], r["value"]) for r in rows] == [
            (0, "x", '[1,{"a":","}]'), (1, "y", "}{"), (2, "z", None), (3, "x", "7")]


def test_written_files_are_json(spark, tmp_path):
    want = odd_entries(3, 50)
    rows = spark.createDataFrame([(k, v) for k, v in want.items()] + [(None, None)], T.StructType(
        [T.StructField("k", T.StringType()), T.StructField("v", ANY)])).repartition(3)
    write_dict(rows, "k", "v", str(tmp_path / "out"))
    files = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert {k: v for f in files for k, v in f.items()} == want and len(files) >= 1
    got = read_dict(spark, str(tmp_path / "out"), ANY).collect()
    assert {r["key"]: r["value"] for r in got} == want
