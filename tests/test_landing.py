"""Landing in one pass, entry points and the data source: all give the rows of the archives."""

import io
import random
import zipfile
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bizregistry.sources import (
    expand_archives,
    index_members,
    land_archives,
    landed_files,
    list_archives,
    list_members,
    read_archived_delimited,
    read_delimited,
    read_landed,
    register_zip_lines,
    remove_stale,
)
from bizregistry.sources.entries import _block_finder
from bizregistry.sources.schemas import schema_of

PAIR = schema_of("k string, v int")


def body(rng, n, end="\n", head="k;v"):
    return end.join([head, "", *(f"{rng.randrange(10**9)}é;{i}" for i in range(n))]).encode("latin-1")


@pytest.fixture
def source(tmp_path):
    rng = random.Random(6)
    folder = tmp_path / "archives"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.TEXT", body(rng, 30_000, "\r\n") + b"\r\n")
        z.writestr("sub/two.TEXT", body(rng, 20_000, "\r"))
        z.writestr("none.TEXT", b"")
        z.writestr("other.CSV", b"k;v\nx;1\n")
    with zipfile.ZipFile(folder / "c.zip", "w") as z:
        z.writestr("one.TEXT", b"\n \nk;v\nplain;7")
    return str(folder)


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


def unpacked(source, target):
    for path in Path(source).glob("*.zip"):
        with zipfile.ZipFile(path) as z:
            for info in z.infolist():
                if info.filename.endswith(".TEXT"):
                    name = f"{path.stem}-{info.filename.replace('/', '-')}"
                    (target / name).write_bytes(z.read(info))
    return f"{target}/*.TEXT"


@pytest.mark.parametrize("chunk_bytes", [50_000, 1 << 30])
def test_landed_files_give_the_rows_of_the_archives(spark, source, tmp_path, chunk_bytes):
    """Each member is inflated once, and its files together hold all of it."""
    target = str(tmp_path / "landed")
    listed = list_archives(spark, source)
    done = land_archives(listed, target, member="*.TEXT", chunk_bytes=chunk_bytes).collect()
    sizes = {(r.archive, r.member): r.size for r in list_members(listed).collect()}
    for key in {(r.archive, r.member) for r in done}:
        assert sum(r.bytes for r in done if (r.archive, r.member) == key) == sizes[key]
    assert len(done) == 4 if chunk_bytes > 10**6 else len(done) > 10
    plain = tmp_path / "plain"
    plain.mkdir()
    want = pairs(read_delimited(spark, unpacked(source, plain), PAIR, escape='"'))
    assert len(want) == 50_001
    assert pairs(read_landed(spark, target, PAIR, member="*.TEXT", escape='"')) == want
    # The files' names fit the members' pattern, so any reader of folders finds them.
    assert pairs(read_delimited(spark, f"{target}/*.TEXT", PAIR, escape='"')) == want
    inside = read_archived_delimited(listed, PAIR, member="*.TEXT", escape='"')
    assert pairs(inside) == want
    lines = sum(r.lines for r in done if r.member == "one.TEXT" and r.archive.endswith("b.zip"))
    assert lines == 30_002


def test_landing_without_headers(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    land_archives(list_archives(spark, source), target, member="*.TEXT", header=False, chunk_bytes=9000)
    got = read_landed(spark, target, PAIR, header=False, provenance="path")
    assert got.filter("k = 'k'").count() == 3 and got.count() == 50_004
    assert got.select("path").distinct().count() > 50
    empty = read_landed(spark, target, PAIR, member="nothing", provenance="path")
    assert empty.columns == ["k", "v", "path"] and empty.isEmpty()


def test_a_second_landing_reads_only_what_is_new(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    listed = list_archives(spark, source)
    first = land_archives(listed, target, chunk_bytes=50_000).count()
    assert land_archives(listed, target, chunk_bytes=50_000).count() == 0
    before = pairs(landed_files(spark, target))
    assert len(before) == first
    with zipfile.ZipFile(f"{source}/c.zip", "w") as z:
        z.writestr("one.TEXT", b"k;v\nchanged;8\n")
    with zipfile.ZipFile(f"{source}/new.zip", "w") as z:
        z.writestr("x.TEXT", b"k;v\nnew;9\n")
    done = land_archives(listed, target).collect()
    assert sorted(r.archive.rsplit("/", 1)[1] for r in done) == ["c.zip", "new.zip"]
    got = [tuple(r) for r in read_landed(spark, target, PAIR, member="*.TEXT").collect()]
    assert ("changed", 8) in got and ("new", 9) in got and ("plain", 7) not in got
    def stale():
        return read_delimited(spark, f"{target}/*.TEXT", PAIR).filter("k = 'plain'").count()

    assert stale() == 1
    assert (remove_stale(spark, target), remove_stale(spark, target)) == (1, 0)
    assert stale() == 0 and len(got) == 50_002


def broken(source):
    """A byte in the middle of a member changed: the archive is whole, its CRC is not."""
    path = Path(source) / "z bad.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("good.TEXT", b"k;v\ngood;1\n")
        z.writestr("bad.TEXT", b"k;v\nright;2\n")
    path.write_bytes(path.read_bytes().replace(b"right", b"wrong", 1))
    (Path(source) / "no.zip").write_bytes(b"no archive")


def test_broken_members_are_named_and_tried_again(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    broken(source)
    listed = list_archives(spark, source)
    with pytest.raises(Exception, match=r"not a whole ZIP archive: .*no\.zip"):
        land_archives(listed, target)
    whole = listed.filter("archive NOT LIKE '%no.zip'")
    with pytest.raises(Exception, match=r"broken member .*z bad\.zip/bad\.TEXT: Bad CRC-32"):
        land_archives(whole, target)
    # What a failed run has moved into place does not count, and is not repeated by the next.
    assert landed_files(spark, target).isEmpty()
    done = land_archives(listed, target, on_bad="skip").filter("error IS NOT NULL").collect()
    assert sorted((r.member or "", r.path) for r in done) == [("", None), ("bad.TEXT", None)]
    got = read_landed(spark, target, PAIR, member="*.TEXT")
    assert got.count() == 50_002 and got.filter("k = 'good'").count() == 1
    again = land_archives(listed, target, on_bad="skip").collect()
    assert len(again) == 2 and all(r.error for r in again)
    with pytest.raises(ValueError):
        land_archives(listed, target, on_bad="ignore")


def test_a_lost_task_leaves_the_same_files(spark, source, tmp_path):
    """Files of another attempt are replaced, and pending ones are no input."""
    target = tmp_path / "landed"
    listed = list_archives(spark, source)
    land_archives(listed, str(target), chunk_bytes=50_000)
    names = sorted(p.name for p in target.glob("*.TEXT"))
    content = {p.name: p.read_bytes() for p in target.glob("*.TEXT")}
    for manifest in target.glob("_manifest/*"):
        manifest.unlink()
    (target / names[0]).write_bytes(b"half")
    (target / "_pending-x-0").write_bytes(b"k;v\nlost;1\n")
    land_archives(listed, str(target), chunk_bytes=50_000)
    assert {p.name: p.read_bytes() for p in target.glob("*.TEXT")} == content
    assert read_landed(spark, str(target), PAIR).filter("k = 'lost'").isEmpty()


def streams():
    rng = random.Random(3)
    text = b"".join(
        b"%d;name %d;%s\r\n" % (i, rng.randrange(10**6), b"ab" * rng.randrange(20)) for i in range(9000)
    )
    digits = b"".join(b"%08x;\r" % rng.getrandbits(32) for _ in range(20_000))
    for data in (text, digits, b"\n" * 300_000):
        for level in (1, 6, 9):
            for strategy in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_FIXED, zlib.Z_HUFFMAN_ONLY):
                packer = zlib.compressobj(level, zlib.DEFLATED, -15, 5, strategy)
                yield data, packer.compress(data) + packer.flush()


def test_blocks_of_deflate_streams():
    """Found one by one, each with the text before it, and together the whole text."""
    several = 0
    for data, stream in streams():
        out, blocks, stored = b"", 0, False
        for _, window, text in _block_finder()(io.BytesIO(b"head" + stream + b"tail"), 4, 4 + len(stream)):
            stored = text is None
            if not stored:
                assert window == out[-32768:]
                out, blocks = out + text, blocks + 1
        assert stored or out == data
        several += blocks > 3
    assert several > 12
    cut = io.BytesIO(stream[: len(stream) // 2])
    with pytest.raises(ValueError):
        list(_block_finder()(cut, 0, len(stream) // 2))


@pytest.mark.parametrize("slice_bytes", [999, 20_011])
def test_slices_from_entry_points(spark, source, slice_bytes):
    listed = list_archives(spark, source)
    entries = index_members(listed, every=15_000).cache()
    assert entries.count() > 10
    assert entries.filter(F.length("window") > 32768).isEmpty()
    plain, entered = (
        expand_archives(listed, member="*.TEXT", slice_bytes=slice_bytes, partitions=4, entries=e)
        for e in (None, entries)
    )
    want = sorted(map(tuple, plain.collect()), key=str)
    assert sorted(map(tuple, entered.collect()), key=str) == want and len(want) == 50_008


def test_neighbours_from_entry_points(spark, source, monkeypatch):
    """Slices that share tasks, and points that are found once, give the same lines."""
    monkeypatch.setattr("bizregistry.sources.archives.MANY_TASKS", 40)
    listed = list_archives(spark, source)
    plain = expand_archives(listed, member="*.TEXT", slice_bytes=5000, partitions=4)
    points = index_members(listed, member="*.TEXT", every=15_000)
    entered = expand_archives(listed, member="*.TEXT", slice_bytes=999, entries=points)
    assert entered.rdd.getNumPartitions() == 40
    plan = entered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow index(") == 1
    want = sorted(map(tuple, plain.collect()), key=str)
    assert sorted(map(tuple, entered.collect()), key=str) == want and len(want) == 50_008


def test_entry_points_bound_what_is_inflated(spark, tmp_path):
    """Sixteen slices of a member inflate twice its size at most."""
    rng = random.Random(9)
    text = body(rng, 300_000)
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.TEXT", text)
    listed = list_archives(spark, str(tmp_path))
    entries = [r.entry for r in index_members(listed, every=len(text) // 32).collect()]
    inflated = 0
    for nth in range(16):
        start, stop = nth * len(text) // 16, (nth + 1) * len(text) // 16
        inflated += stop - max([0, *(e for e in entries if e < max(1, start))])
    assert inflated <= 2 * len(text)
    lines = expand_archives(
        listed, slice_bytes=-(-len(text) // 16), entries=index_members(listed, every=len(text) // 32)
    )
    assert lines.agg(F.count("*"), F.countDistinct("line_no")).first() == (300_002, 300_002)


def test_entry_points_of_another_content_are_left_aside(spark, tmp_path):
    rng = random.Random(1)
    listed = list_archives(spark, str(tmp_path))
    for nth in range(2):
        with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("x.TEXT", body(rng, 20_000))
        if not nth:
            index_members(listed, every=9000).write.parquet(str(tmp_path / "entries"))
    entries = spark.read.parquet(str(tmp_path / "entries"))
    lines = expand_archives(listed, slice_bytes=50_000, entries=entries)
    assert not entries.isEmpty() and lines.count() == 20_002


def test_broken_members_have_no_entry_points(spark, source):
    path = Path(source) / "bad.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.TEXT", body(random.Random(2), 9000))
    data = path.read_bytes()
    # The CRC in the table of contents.
    at = data.rindex(b"PK\x01\x02") + 16
    path.write_bytes(data[:at] + bytes(4) + data[at + 4 :])
    listed = list_archives(spark, source).filter("archive LIKE '%bad.zip'")
    with pytest.raises(Exception, match=r"broken member .*bad\.zip/x\.TEXT: size or CRC differ"):
        index_members(listed, every=1000).collect()


def test_data_source(spark, source):
    """The rows of ``expand_archives``, in slices, with the columns that are asked for only."""
    register_zip_lines(spark)
    read = spark.read.format("zip_lines").option("member", "*.TEXT").option("sliceBytes", "70001")
    want = expand_archives(list_archives(spark, source), member="*.TEXT")
    lines = read.load(source)
    assert pairs(lines) == pairs(want) and lines.rdd.getNumPartitions() > 5
    pruned = read.schema("line string, first_record boolean").load(source)
    scan = [p for p in pruned._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan" in p]
    assert len(scan) == 1 and "line" in scan[0] and "archive" not in scan[0] and "member" not in scan[0]
    assert pairs(pruned) == pairs(want.select("line", "first_record"))
    assert read.load(f"{source}/c.zip").count() == 4
    (Path(source) / "no.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match=r"not a whole ZIP archive: .*no\.zip"):
        read.load(source).count()
    assert read.option("onBad", "skip").load(source).count() == 50_008
    with pytest.raises(Exception, match="no column other"):
        read.schema("other string").load(source).collect()
    with pytest.raises(Exception, match="no option slices"):
        spark.read.format("zip_lines").option("slices", "2").load(source).collect()


def test_data_source_without_archives(spark, tmp_path):
    register_zip_lines(spark)
    assert spark.read.format("zip_lines").load(str(tmp_path)).collect() == []


def test_columns_that_are_not_asked_for_are_not_made(spark, source):
    lines = expand_archives(list_archives(spark, source), member="c.*", columns=["line"])
    assert lines.columns == ["line"]
    several = expand_archives(list_archives(spark, source), member="*.TEXT", columns=["line", "member"])
    assert several.columns == ["line", "member"]
    assert several.filter("member = 'sub/two.TEXT'").count() == 20_002
