"""Multi-line CSV read in blocks, against Spark's own reader of whole files."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from varve.session import ship
from varve.sources import quoted
from varve.sources.files import read_csv
from varve.sources.quoted import Blocks, Dialect, block_lines, block_maps, read_records

SCHEMA = "a string, b string, c int, _corrupt_record string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def plain(rows):
    """Rows whose broken text, if any, has plain line ends: Spark keeps carriage returns in that text alone."""
    return Counter((*r[:3], r[3] and r[3].replace("\r\n", "\n")) for r in rows)


def random_csv(seed):
    """Rows with line breaks, quotes, separators and escapes in and out of quotes, and its escape."""
    rng = random.Random(seed)
    escape = rng.choice('"\\')

    def value():
        inner = "".join(rng.choice(["a", ",", "\n", '"', "\\", " ", "é", "x\r\n", "\n\n"]) for _ in range(rng.randint(0, 12)))
        kind = rng.random()
        if kind < 0.75:
            plain = inner.replace("\\", "\\\\") if escape == "\\" else inner
            return '"' + plain.replace('"', escape + '"') + '"'
        if kind < 0.85:
            return "".join(rng.choice('ab\\ é"') for _ in range(5)).lstrip('"\\')
        return '"ab"cd' if kind < 0.9 else "plain"

    rows = [f"{value()},{value()}" + (f",{rng.randint(0, 99)}" if rng.random() < 0.9 else "") for _ in range(rng.randint(0, 200))]
    line = rng.choice(["\n", "\r\n"])
    return line.join(["a,b,c", *rows, ""]), escape


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_a_whole_file(spark, tmp_path, seed):
    text, escape = random_csv(seed)
    path = f"{tmp_path}/f.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(text)
    whole = spark.read.options(header=True, escape=escape, multiLine=True).schema(SCHEMA).csv(path).collect()
    for size in (150, 2000):
        found = read_csv(spark, path, SCHEMA, escape, multiline=True, block_bytes=size).drop("_raw_file_source").collect()
        assert plain(found) == plain(whole)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [(n, f'text {n} with "quotes",\nbreaks\n\nand more ' + "x" * (n % 300) + "end") for n in range(2000)]
    spark.createDataFrame(rows, "id int, text string").coalesce(1).write.options(header=True, escape='"').csv(f"{tmp_path}/one")
    df = read_csv(spark, f"{tmp_path}/one", "id int, text string", '"', multiline=True, block_bytes=16 << 10)
    assert sorted(tuple(r) for r in df.select("id", "text").collect()) == rows
    lines = block_lines(spark, [f"{tmp_path}/one"], 16 << 10)
    assert lines.rdd.getNumPartitions() > 20
    maps = block_maps(lines, Dialect(escape='"'))
    states = next(iter(Blocks.combine(maps.toPandas()).known.values()))[1]
    assert states.any() and not states.all()


def test_blocks_do_not_follow_the_cores(spark, tmp_path):
    """The same blocks in both passes, whatever the session says of its cores and splits meanwhile."""
    (tmp_path / "f.csv").write_text("a,b\n" + '1,"x\ny"\n' * 5000)
    first = {tuple(r) for r in block_lines(spark, [f"{tmp_path}/f.csv"], 8192).select("path", "block").distinct().collect()}
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        again = {tuple(r) for r in block_lines(spark, [f"{tmp_path}/f.csv"], 8192).select("path", "block").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and len(first) == 5


def test_a_record_over_many_blocks(spark, tmp_path):
    text = "\n".join(f"line {n}" for n in range(4000))
    (tmp_path / "f.csv").write_text(f'a,b\n1,"{text}"\n2,"short"\n')
    df = read_csv(spark, f"{tmp_path}/f.csv", quote_escape='"', multiline=True, block_bytes=1000)
    assert sorted((r["a"], r["b"]) for r in df.collect()) == [("1", text), ("2", "short")]


def test_an_unclosed_quote_is_one_record_or_fails(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,x\n2,"open\n' + "3,y\n" * 2000)
    path = f"{tmp_path}/f.csv"
    records = read_records(spark, path, Dialect(escape='"'), 1000).orderBy("record").collect()
    assert [r["record"][:8] for r in records] == ["1,x", '2,"open\n', "a,b"] and [r["first"] for r in records] == [False, False, True]
    with pytest.raises(ValueError, match="not closed within 3000 bytes"):
        read_records(spark, path, Dialect(escape='"'), 1000, record_bytes=3000)


def test_headers_and_marks(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿a,b\n\n1,\"x\r\ny\"\n".encode())
    assert [(r["a"], r["b"]) for r in read_csv(spark, f"{tmp_path}/bom.csv", multiline=True).collect()] == [("1", "x\r\ny")]
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="the header of"):
        read_csv(spark, str(folder), multiline=True).collect()


def test_broken_records_keep_their_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\ny"\nno,z\n3\n4,p,q\n')
    rows = read_csv(spark, f"{tmp_path}/f.csv", "a int, b string", '"', multiline=True).collect()
    assert Counter((r["a"], r["b"], r["_corrupt_record"]) for r in rows) == Counter(
        [(1, "x\ny", None), (None, "z", "no,z"), (3, None, "3"), (4, "p", "4,p,q")]
    )


def test_a_file_that_changed_between_the_passes_fails(spark, tmp_path):
    path = f"{tmp_path}/f.csv"
    (tmp_path / "f.csv").write_text("a,b\n" + '1,"x\ny"\n' * 2000)
    blocks = Blocks.combine(block_maps(block_lines(spark, [path], 4096), Dialect()).toPandas())
    other = block_lines(spark, [path], 3000)
    with pytest.raises(Exception, match="has it changed"):
        quoted.pieces(other, blocks, Dialect()).collect()


def write_mixed(folder):
    """Files of one block and of several, of which one has records that cross blocks; rows by file."""
    folder.mkdir()
    texts = {
        "small": 'a,b\n1,"x\ny"\n2,z\n',
        "open": 'a,b\n3,"never\nclosed\n',
        "empty": "",
        "header": "a,b\n",
        "plain": "a,b\n" + "".join(f"{n},p\n" for n in range(1000, 1500)),
        "long": "a,b\n" + "".join(f'{n},"q\n{n}\nr"\n' for n in range(2000, 2500)),
        "tail": "a,b\n" + "".join(f"{n},s\n" for n in range(3000, 3500)) + '4,"open\ntail\n',
    }
    for name, text in texts.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return texts


def test_files_of_one_block_beside_longer_ones(spark, tmp_path):
    """All files at once equal each by itself as one block, also those whose last quote stays open."""
    texts = write_mixed(tmp_path / "all")
    paths = [f"{tmp_path}/all/{name}.csv" for name in texts]
    columns = ["path", "first", "record"]
    want = Counter(tuple(r) for p in paths for r in read_records(spark, p, Dialect(escape='"'), 1 << 20).select(columns).collect())
    assert sum(want.values()) == 1 + 2 + 2 + 1 + 501 + 501 + 502
    for size in (1000, 3000):
        got = read_records(spark, paths, Dialect(escape='"'), size)
        assert Counter(tuple(r) for r in got.select(columns).collect()) == want


def test_only_longer_files_are_read_for_their_maps(spark, tmp_path, monkeypatch):
    """The first pass, and the one for records that cross blocks, open no file of one block."""
    texts = write_mixed(tmp_path / "all")
    mapped, cut = [], []
    maps, pieces = quoted.block_maps, quoted.pieces
    monkeypatch.setattr(quoted, "block_maps", lambda lines, *a: mapped.append(lines) or maps(lines, *a))
    monkeypatch.setattr(quoted, "pieces", lambda lines, *a: cut.append(lines) or pieces(lines, *a))

    def names(lines):
        return {r["path"].rsplit("/", 1)[1][:-4] for r in lines.select("path").distinct().collect()}

    def run(which, size):
        mapped.clear(), cut.clear()
        read_records(spark, [f"{tmp_path}/all/{n}.csv" for n in which], Dialect(escape='"'), size)
        return [names(x) for x in mapped], [names(x) for x in cut]

    some = {n for n in texts if texts[n]}
    assert run(texts, 3000) == ([{"plain", "long", "tail"}], [some, {"plain", "long", "tail"}])
    assert run(texts, 1 << 20) == ([set()], [some])
    # No value is open where a block of these starts, so no record crosses blocks.
    assert run(["small", "plain", "tail"], 3000) == ([{"plain", "tail"}], [{"small", "plain", "tail"}])
    assert "file_size" in mapped[0]._jdf.queryExecution().executedPlan().toString()


def test_blocks_stay_where_a_most_number_of_splits_is_set(spark, tmp_path):
    write_mixed(tmp_path / "all")
    spark.conf.set("spark.sql.files.maxPartitionNum", "2")
    try:
        blocks = block_lines(spark, [f"{tmp_path}/all"], 1000).select("path", "block").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionNum")
    assert blocks > 10
