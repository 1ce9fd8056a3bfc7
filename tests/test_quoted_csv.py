"""CSV files with line breaks inside quotes."""

from pyspark.sql import DataFrameReader

from stalewatch.sources.files import BINARY, OPEN_QUOTE, csv_dialects, inspect_csv, read_file


def test_quoted_files_are_streamed_for_their_shape(spark, tmp_path, monkeypatch):
    texts = {
        "a b.csv": 'id,"two\nlines",c\n1,"x,\ny",3\n2,"say ""hi"",\nyou",4,"more, and",\n',
        "b.csv": 'k;"v\nw"\n1;"a;\nb"\n2;b;;\n',
        "c.csv": 'name\n"only\none"\nlast\n',
        "d.csv": "plain,words\n1,2\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "e.csv").write_bytes('é,"b\nb"\n1,2,3\n'.encode("latin-1"))
    formats, plain = [], DataFrameReader.format
    monkeypatch.setattr(DataFrameReader, "format", lambda self, source: formats.append(source) or plain(self, source))
    found = csv_dialects(spark, [f"file://{tmp_path}/{n}" for n in (*texts, "e.csv")])
    shapes = {p.rsplit("/", 1)[1]: (len(d.names), d.delimiter, d.encoding, d.spans_lines) for p, d in found.items()}
    assert shapes == {
        "a b.csv": (5, ",", "UTF-8", True), "b.csv": (4, ";", "UTF-8", True), "c.csv": (1, ",", "UTF-8", True),
        "d.csv": (2, ",", "UTF-8", False), "e.csv": (3, ",", "ISO-8859-1", True),
    }
    assert "binaryFile" not in formats
    rows = sorted(map(tuple, read_file(spark, f"file://{tmp_path}/a b.csv").collect()))
    assert rows == [("1", "x,\ny", "3", None, None), ("2", 'say "hi",\nyou', "4", "more, and", None)]


def test_stray_quotes_and_long_records_lose_no_field(spark, tmp_path):
    texts = {
        "stray.csv": 'a,b\n5" x,3,4" y\n6\' z,"7, 8"\n',
        "break.csv": 'a;b\n5" x;"two\nlines";more\n"say ""hi""; you";2\n',
        "tail.csv": "a,b\n1,2,,\n3\n",
        "pipes.csv": 'a|"b|c"|\n1|2|3|4|"x|y"\n',
        "head.csv": 'a" b,c\n1,2,3\n',
        "many.csv": "k\n" + ",".join(map(str, range(300))) + "\n",
    }
    expected = {
        "stray.csv": (["a", "b", "unnamed_2"], [('5" x', "3", '4" y'), ("6' z", "7, 8", None)]),
        "break.csv": (["a", "b", "unnamed_2"], [('5" x', "two\nlines", "more"), ('say "hi"; you', "2", None)]),
        "tail.csv": (["a", "b", "unnamed_2", "unnamed_3"], [("1", "2", None, None), ("3", None, None, None)]),
        "pipes.csv": (["a", "b_c", "unnamed_2", "unnamed_3", "unnamed_4"], [("1", "2", "3", "4", "x|y")]),
        "head.csv": (["a_b", "c", "unnamed_2"], [("1", "2", "3")]),
        "many.csv": (["k", *(f"unnamed_{i}" for i in range(1, 300))], [tuple(map(str, range(300)))]),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    dialects = csv_dialects(spark, [str(tmp_path / n) for n in texts])
    for name, (columns, rows) in expected.items():
        assert list(dialects[str(tmp_path / name)].names) == columns
        assert sorted(map(tuple, read_file(spark, str(tmp_path / name)).collect()), key=repr) == sorted(rows, key=repr)


def test_verdict_of_every_file(spark, tmp_path):
    texts = {
        "good.csv": "a,b\n1,2\n\n3,4\n", "header.csv": "a,b\n", "open.csv": 'a,b\n1,"2\n3,4\n', "bytes.csv": "a,b\n1,\x002\n",
        "quoted.csv": 'a,b\n1,"x\ny"\n2,3\n', "tail.csv": 'a\n1\n2\n"3\n', "one.csv": 'a\n"1\n2"\n3\n',
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    found = inspect_csv(spark, [str(tmp_path / n) for n in texts])
    verdicts = {p.rsplit("/", 1)[1]: (i.rows, i.fault) for p, i in found.items()}
    assert verdicts == {
        "good.csv": (2, None), "header.csv": (0, None), "open.csv": (1, OPEN_QUOTE), "bytes.csv": (1, BINARY), "quoted.csv": (2, None),
        "tail.csv": (3, OPEN_QUOTE), "one.csv": (2, None),
    }
