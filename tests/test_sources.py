import html
import io
import tempfile
import zipfile
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bizregistry.sources import (
    FAMILIES,
    expand_archives,
    extract_links,
    list_archives,
    list_members,
    read_archived_delimited,
    read_delimited,
    register_zip_lines,
    skipped_archives,
    with_provenance,
)
from bizregistry.sources.archives import _slice_reader
from bizregistry.sources.schemas import schema_of

NUMBERED = schema_of("id int, text string, after string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def land(path, text, encoding="iso-8859-1"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_families_are_complete():
    widths = {name: len(f.schema) for name, f in FAMILIES.items()}
    assert widths == {
        "simples": 7,
        "cnae": 2,
        "municipio": 2,
        "natureza_juridica": 2,
        "pais": 2,
        "qualificacao_socio": 2,
        "socio": 12,
        "empresa": 7,
        "estabelecimento": 30,
    }
    assert all(field.nullable for f in FAMILIES.values() for field in f.schema)


def test_wide_schemas_keep_text():
    for name, columns in {
        "socio": ["cpf_representante"],
        "empresa": ["ente_federativo"],
        "estabelecimento": ["cod_cnae_secundario", "numero"],
        "pais": [],
    }.items():
        family = FAMILIES[name]
        changed = [w.name for f, w in zip(family.schema, family.wide) if f != w]
        assert changed == columns
        assert all(family.wide[c].dataType.simpleString() == "string" for c in changed)


def test_latin1_and_delimiter(spark, tmp_path):
    path = land(tmp_path / "a.TXT", 'id;text;after\n1;"Ç; ã";x\n')
    assert rows(read_delimited(spark, path, NUMBERED)) == [(1, "Ç; ã", "x")]


def test_header_is_dropped_per_file(spark, tmp_path):
    for name in "abc":
        land(tmp_path / f"{name}.TXT", f"1;{name};x\n2;{name};y\n")
    pattern = str(tmp_path / "*.TXT")
    assert read_delimited(spark, pattern, NUMBERED).count() == 3
    assert read_delimited(spark, pattern, NUMBERED, header=False).count() == 6


def test_glob_and_path_list(spark, tmp_path):
    one = land(tmp_path / "K1.CNAECSV", "h;h;h\n1;a;x\n")
    two = land(tmp_path / "K2.CNAECSV", "h;h;h\n2;b;y\n")
    land(tmp_path / "K3.OTHER", "h;h;h\n3;c;z\n")
    assert read_delimited(spark, str(tmp_path / "*.CNAECSV"), NUMBERED).count() == 2
    assert read_delimited(spark, [one, two], NUMBERED).count() == 2


def test_escaped_quotes(spark, tmp_path):
    path = land(tmp_path / "a.TXT", '1;"SALA ""B"" 2";n\n2;"BARRA \\";n\n')
    df = read_delimited(spark, path, NUMBERED, header=False, escape='"')
    assert rows(df) == [(1, 'SALA "B" 2', "n"), (2, "BARRA \\", "n")]


@pytest.mark.parametrize("bad", ["S/N", "4712100,4713002", "***123456**", "99999999999", ""])
def test_malformed_int_is_null(spark, tmp_path, bad):
    path = land(tmp_path / "a.TXT", f"{bad};kept;too\n03;short\n")
    df = read_delimited(spark, path, NUMBERED, header=False)
    assert rows(df) == [(None, "kept", "too"), (3, "short", None)]


def test_provenance(spark, tmp_path):
    land(tmp_path / "a b.TXT", "1;a;x\n")
    land(tmp_path / "c.TXT", "2;b;y\n")
    df = read_delimited(spark, str(tmp_path / "*.TXT"), NUMBERED, header=False)
    named = with_provenance(df)
    assert {n.rsplit("/", 1)[1] for (n,) in rows(named.select("filename"))} == {
        "a%20b.TXT",
        "c.TXT",
    }
    # The same but for how a local path is spelt.
    builtin = F.replace(F.input_file_name(), F.lit("file:///"), F.lit("file:/"))
    both = named.select("filename", builtin.alias("builtin")).collect()
    assert all(r.filename == r.builtin for r in both)


# Links

PAGE = """<html><!-- <a href="no1.zip"> --><script>x = '<a href="no2.zip">'</script>
<style>a { content: "<a href='no3.zip'>" }</style>
<a href="one.zip">1</a> <A class=x HREF='two.zip'>2</A> <a href=three.zip>3</a>
<a title="a > b" href="four.zip">4</a> <a
  href = "five.zip" rel=nofollow>5</a> <abbr href="no4.zip">x</abbr>
<a data-href="no5.zip">x</a> <a title="href='no6.zip'">x</a> <a name=top>x</a>
<a href="six.zip" href="no7.zip">6</a> <a href="q?a=1&amp;b=.zip">7</a> <a href="">8</a>
<img alt="<a href='no8.zip'>"> <p title=it's>x <a href=it's.zip rel="x">12</a>
<a href="page.html">9</a> <a href="gzip">10</a> <a href="zip">11</a>"""


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attributes):
        hrefs = [value for name, value in attributes if name == "href"]
        if tag == "a" and hrefs:
            self.found.append(hrefs[0])


def parsed_links(html):
    parser = _Links()
    parser.feed(html)
    return parser.found


def test_links_of_a_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "plain")], "page_id int, html string")
    got = [r.link for r in extract_links(df, "").collect()]
    assert got == parsed_links(PAGE)
    archives = [r.link for r in extract_links(df).collect()]
    # "gzip" has a character before "zip", and "zip" alone has none.
    assert archives == [
        "one.zip",
        "two.zip",
        "three.zip",
        "four.zip",
        "five.zip",
        "six.zip",
        "q?a=1&b=.zip",
        "it's.zip",
        "gzip",
    ]


def test_links_of_open_comment_and_long_page(spark):
    long_page = "<p>" + "x" * 3_000_000 + '<a href="end.zip">e</a><!-- <a href="no.zip">'
    many = "<a " + "".join(f'k{i}="v" ' for i in range(20000)) + 'href="late.zip">'
    df = spark.createDataFrame([(1, long_page), (2, many)], "page_id int, html string")
    assert sorted(r.link for r in extract_links(df).collect()) == ["end.zip", "late.zip"]


def test_links_of_test_pages(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    try:
        pages = pq.read_table(path).to_pylist()
    except FileNotFoundError:
        pytest.skip("no test tables")
    got = extract_links(spark.read.parquet(path), "").groupBy("page_id").agg(
        F.collect_list("link").alias("links")
    )
    found = {r.page_id: r.links for r in got.collect()}
    for page in pages:
        assert found.get(page["page_id"], []) == parsed_links(page["html"])


# Archives

BODY = b'k;v\r\n\r\nA\x85B;1\r\n \t\n"x;\xc7";2\n\nS/N;z\nlast;3'
RECORDS = [("A\x85B", 1), ("x;Ç", 2), ("S/N", None), ("last", 3)]
KEYED = schema_of("k string, v int")


@pytest.fixture
def archives(tmp_path):
    (tmp_path / "deep").mkdir()
    with zipfile.ZipFile(tmp_path / "a b%20.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("F.K$Z.TEXT", BODY)
        z.writestr("empty.TEXT", b"")
        z.writestr("folder/", b"")
        z.writestr("folder/G.TEXT", b"k;v\nfolder;7\n")
        z.writestr("other.OTHER", b"k;v\nno;0\n")
    with zipfile.ZipFile(tmp_path / "deep" / "c.zip", "w") as z:
        z.writestr("F.K$Z.TEXT", b"k;v\nsame name;8\n")
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    (tmp_path / "empty.zip").write_bytes(b"")
    (tmp_path / "large bad.zip").write_bytes(b"x" * 100_000)
    (tmp_path / "_hidden.zip").write_bytes(b"x")
    (tmp_path / ".hidden.zip").write_bytes(b"x")
    (tmp_path / "upper.ZIP").write_bytes(b"not listed")
    return str(tmp_path)


def short(path):
    return path.rsplit("/", 1)[1]


def test_list_archives(spark, archives):
    """Suffix and depth count; hidden files and those of no bytes are listed as well."""
    listed = list_archives(spark, archives)
    assert sorted((short(p), n > 0) for p, n in rows(listed)) == [
        (".hidden.zip", True),
        ("_hidden.zip", True),
        ("a b%20.zip", True),
        ("bad.zip", True),
        ("c.zip", True),
        ("empty.zip", False),
        ("large bad.zip", True),
    ]
    nested = list_archives(spark, archives + "/d*")
    assert [short(p) for p, _ in rows(nested)] == ["c.zip"]
    with pytest.raises(FileNotFoundError):
        list_archives(spark, archives + "/none")
    plan = listed.select("archive")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_list_members_and_skipped(spark, archives):
    listed = list_archives(spark, archives)
    members = list_members(listed, partitions=3).filter("member IS NOT NULL")
    assert sorted((short(r.archive), r.member, r.size) for r in members.collect()) == [
        ("a b%20.zip", "F.K$Z.TEXT", len(BODY)),
        ("a b%20.zip", "empty.TEXT", 0),
        ("a b%20.zip", "folder/G.TEXT", 13),
        ("a b%20.zip", "other.OTHER", 9),
        ("c.zip", "F.K$Z.TEXT", 16),
    ]
    skipped = [short(p) for (p,) in rows(skipped_archives(listed))]
    hidden = [".hidden.zip", "_hidden.zip"]
    assert sorted(skipped) == [*hidden, "bad.zip", "empty.zip", "large bad.zip"]


@pytest.mark.parametrize("slice_bytes", [1, 2, 3, 5, 1 << 30])
def test_expand_archives(spark, archives, slice_bytes):
    """Slices neither lose nor repeat a line, wherever they are cut."""
    lines = expand_archives(
        list_archives(spark, archives),
        member="F*.TEXT",
        on_bad="skip",
        partitions=4,
        slice_bytes=slice_bytes,
    )
    got = sorted(
        (short(r.archive), r.line_no, r.first_record, r.line) for r in lines.collect()
    )
    assert got == [
        ("a b%20.zip", 0, True, "k;v"),
        ("a b%20.zip", 1, None, ""),
        ("a b%20.zip", 2, False, "A\x85B;1"),
        ("a b%20.zip", 3, None, " \t"),
        ("a b%20.zip", 4, False, '"x;Ç";2'),
        ("a b%20.zip", 5, None, ""),
        ("a b%20.zip", 6, False, "S/N;z"),
        ("a b%20.zip", 7, False, "last;3"),
        ("c.zip", 0, True, "k;v"),
        ("c.zip", 1, False, "same name;8"),
    ]


def test_slices_of_many_blocks(spark, tmp_path):
    """A member of several read blocks, in slices that end inside blocks and lines."""
    text = "".join(f"{i};{'x' * (i % 700)}\n" for i in range(60000)).encode()
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("big.TEXT", text)
        z.writestr("one line.TEXT", b"y" * 9_000_000)
    lines = expand_archives(
        list_archives(spark, str(tmp_path)), partitions=8, slice_bytes=1_000_003
    )
    big = lines.filter("member = 'big.TEXT'")
    right = F.concat_ws(
        ";", "line_no", F.repeat(F.lit("x"), (F.col("line_no") % 700).cast("int"))
    )
    assert big.count() == 60000
    assert big.select("line_no").distinct().count() == 60000
    assert big.filter(F.col("line") != right).isEmpty()
    assert big.filter("first_record").count() == 1
    (one,) = lines.filter("member = 'one line.TEXT'").selectExpr("length(line)").collect()
    assert one[0] == 9_000_000


def test_utf8_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "u.zip", "w") as z:
        z.writestr("u.TEXT", "k;v\nžluť;1\n".encode())
    df = read_archived_delimited(
        list_archives(spark, str(tmp_path)), KEYED, encoding="utf-8", slice_bytes=1
    )
    assert rows(df) == [("žluť", 1)]


def test_same_member_name_twice(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("x.TEXT", b"first\n")
        with pytest.warns(UserWarning):
            z.writestr("x.TEXT", b"second\n")
    (tmp_path / "x.zip").write_bytes(data.getvalue())
    lines = expand_archives(list_archives(spark, str(tmp_path)))
    assert sorted(r.line for r in lines.collect()) == ["first", "second"]


@pytest.mark.parametrize("header", [True, False])
def test_archived_equals_unpacked(spark, archives, tmp_path, header):
    """Reading inside the archive gives what the plain reader gives after unpacking."""
    unpacked = tmp_path / "unpacked"
    unpacked.mkdir()
    (unpacked / "F.TEXT").write_bytes(BODY)
    (unpacked / "G.TEXT").write_bytes(b"k;v\nfolder;7\n")
    (unpacked / "H.TEXT").write_bytes(b"k;v\nsame name;8\n")
    plain = read_delimited(spark, str(unpacked / "*.TEXT"), KEYED, header=header)
    inside = read_archived_delimited(
        list_archives(spark, archives),
        KEYED,
        member="*.TEXT",
        header=header,
        slice_bytes=4,
        on_bad="skip",
    )
    assert sorted(map(str, rows(inside))) == sorted(map(str, rows(plain)))
    if header:
        assert set(RECORDS) < set(rows(inside))


@pytest.mark.parametrize("slice_bytes", [1, 2, 3, 5, 1 << 28])
def test_line_ends(spark, tmp_path, slice_bytes):
    """All three line ends, mixed and doubled, also where a slice is cut inside one."""
    bodies = {
        "CR.TEXT": b"k;v\ra;1\r\rb;2\r",
        "CRLF.TEXT": b"k;v\r\na;1\r\n\r\nb;2",
        "LF.TEXT": b"\nk;v\na;1\n\nb;2\n",
        "MIX.TEXT": b"k;v\ra;1\n\rb;2\r\nc;3\r\r\nd;4\n\n\re;5",
    }
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for name, body in bodies.items():
            z.writestr(name, body)
            (tmp_path / name).write_bytes(body)
    plain = read_delimited(spark, str(tmp_path / "*.TEXT"), KEYED)
    inside = read_archived_delimited(
        list_archives(spark, str(tmp_path)), KEYED, slice_bytes=slice_bytes, partitions=4
    )
    assert sorted(rows(inside)) == sorted(rows(plain))
    assert inside.count() == 11


@pytest.mark.parametrize("end", ["\r", "\n", "\r\n"])
def test_line_ends_between_blocks(end):
    """Blocks of any size leave the lines whole."""
    text = end.join(["head", "", "a", "bb" * 9, "", ""]).encode()
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("x", text)
    with tempfile.NamedTemporaryFile(suffix=".zip") as file:
        file.write(archive.getvalue())
        file.flush()
        wanted = None
        for block_bytes in range(1, len(text) + 2):
            read = _slice_reader("latin-1", 100, block_bytes)
            got = []
            for start in range(0, len(text), 4):
                names = ["archive", "position", "member", "start", "stop"]
                row = [[file.name], [0], ["x"], [start], [start + 4]]
                for batch in read(iter([pa.RecordBatch.from_arrays([*map(pa.array, row)], names)])):
                    got += [tuple(r.values())[2:] for r in batch.to_pylist()]
            wanted = wanted or got
            assert got == wanted
        assert [line for *_, line in wanted] == ["head", "", "a", "bb" * 9, ""]
        assert [n for n, *_ in wanted] == [0, 1, 2, 3, 4]
        assert [mark for _, mark, _ in wanted] == [True, None, False, False, None]


def test_long_lines_raise(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.TEXT", b"y" * 9_000_000)
    lines = expand_archives(list_archives(spark, str(tmp_path)), max_line_bytes=1_000_000)
    with pytest.raises(Exception, match=r"more than 1000000 bytes in .*x\.zip/x\.TEXT"):
        lines.collect()


def test_tasks_grow_with_the_bytes_inside(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for i in range(10):
            z.writestr(f"{i}.TEXT", b"ab\n" * 1000)
    listed = list_archives(spark, str(tmp_path))
    few, many = (expand_archives(listed, slice_bytes=n) for n in (1 << 28, 100))
    assert few.rdd.getNumPartitions() < 100
    assert many.rdd.getNumPartitions() == 300


def test_small_slices_share_tasks(spark, tmp_path):
    """Beyond a thousand slices there is no task for each; the lines stay whole."""
    text = "".join(f"{i};{i % 7}\n" for i in range(1000)).encode()
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.TEXT", text)
    lines = expand_archives(list_archives(spark, str(tmp_path)), slice_bytes=2)
    assert len(text) > 4000 and lines.rdd.getNumPartitions() == 1000
    got = lines.select("line_no", "line", "first_record").collect()
    assert sorted(map(tuple, got)) == [(i, f"{i};{i % 7}", i == 0) for i in range(1000)]
    reader = register_zip_lines(spark).read.format("zip_lines").option("sliceBytes", "2")
    read = reader.load(str(tmp_path))
    assert read.rdd.getNumPartitions() <= 1001 and read.count() == 1000


def test_archived_provenance(spark, archives):
    df = read_archived_delimited(
        list_archives(spark, archives),
        KEYED,
        member="*.TEXT",
        provenance="filename",
        on_bad="skip",
    )
    names = {n.split("a b%20.zip/")[-1] for (n,) in rows(df.select("filename").distinct())}
    assert {"F.K$Z.TEXT", "folder/G.TEXT"} < names


@pytest.mark.parametrize("cut", [0, 40])
def test_bad_archives_raise(spark, tmp_path, cut):
    """No archive at all, or one cut off in transfer: an error that names it."""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.TEXT", b"k;v\nx;1\n" * 50)
    whole = data.getvalue()
    (tmp_path / "cut.zip").write_bytes(whole[:-cut] if cut else b"not an archive")
    (tmp_path / "whole.zip").write_bytes(whole)
    listed = list_archives(spark, str(tmp_path))
    with pytest.raises(Exception, match=r"not a whole ZIP archive: .*cut\.zip"):
        expand_archives(listed).collect()
    assert expand_archives(listed, on_bad="skip").count() == 100
    with pytest.raises(ValueError):
        expand_archives(listed, on_bad="ignore")


def test_open_tags_take_linear_time(spark):
    """A megabyte of tags that are never closed; quadratic matching would take half an hour."""
    html = "<a href=first.zip>" + "<a x " * 200_000
    pages = spark.createDataFrame([(1, html), (2, "<p x " * 200_000)], "page_id int, html string")
    assert [r.link for r in extract_links(pages).collect()] == ["first.zip"]


def test_links_decode_references(spark):
    """Every reference, as the page parser of the standard library decodes it; each once."""
    values = [
        "x&#46;zip?a=1&#038;b=2", "caf&eacute;.zip", "&#xE9;&#X2f;&#x1F600;", "&amp;lt;", "&amp;#46;",
        "a&b", "?a=1&copy=2&reg", "&copy x", "&nosuch;", "&#;", "&#x;", "&#0;", "&#128;&#150;&#129;",
        "&#xD800;", "&#1114112;", "&#99999999999999999999;", "&&amp;&", "&#65&#66;", "&NotEqualTilde;",
    ]
    pages = spark.createDataFrame([(f'<a href="{v}">',) for v in values], "html string")
    got = [r.link for r in extract_links(pages, "").collect()]
    assert got == [html.unescape(v).replace("©=2", "&copy=2") for v in values]
