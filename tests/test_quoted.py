"""Quoted line breaks in files that are read in splits."""

import csv
import io
import random

import pytest

from tagloom.sources import quoted, readers


@pytest.fixture
def small_splits(spark):
    """Byte ranges so short that records cross several of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("97", "0", "1")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def made(rng: random.Random, sep: str, comments: bool) -> tuple[str, list[list[str]]]:
    """A file with odd fields, and its records."""
    pieces = ["a", "bc", sep, '"', "\n", "#", " ", "ä", "\r\n", ""]
    lines, records = [], []
    for _ in range(rng.randrange(1, 40)):
        if comments and rng.random() < 0.2:
            lines.append('#an odd " comment\n')
        fields = ["".join(rng.choices(pieces, k=rng.randrange(1, 12))) + "x" for _ in range(2)]
        if rng.random() < 0.1:
            fields[1] += "\n" * 300
        out = io.StringIO()
        csv.writer(out, delimiter=sep, lineterminator="\n", quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])).writerow(fields)
        text = out.getvalue()
        if text.startswith("#"):
            text, fields[0] = "x" + text, "x" + fields[0]
        lines.append(text)
        records.append(fields)
    return "".join(lines), records


@pytest.mark.parametrize("seed", range(6))
def test_records_across_byte_ranges(spark, small_splits, tmp_path, seed):
    rng = random.Random(seed)
    want = []
    for name in "ab":
        text, records = made(rng, "\t", True)
        (tmp_path / name).write_text(text, newline="")
        want += records
    notes = readers.scan_notes(spark, str(tmp_path))
    lines = quoted._lines(spark, str(tmp_path))
    assert lines.select("file", "start").distinct().count() > 2
    assert sorted([r["guid"], r["card"]] for r in notes.collect()) == sorted(want)


def test_one_large_export_takes_many_tasks(spark, small_splits, tmp_path):
    """The plan reads the only file in many partitions and shuffles no whole record."""
    (tmp_path / "one.tsv").write_text("".join(f'{i}\t"card ""{i}""\nnext, line"\n' for i in range(500)))
    path = str(tmp_path / "one.tsv")
    records = quoted.read_records(spark, path, "\t", "line")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # pieces are written apart
    assert quoted._lines(spark, path).rdd.getNumPartitions() > 50
    got = {r["guid"]: r["card"] for r in readers.scan_notes(spark, path).collect()}
    assert got == {str(i): f'card "{i}"\nnext, line' for i in range(500)}


def test_inline_comments_and_quoted_breaks(spark, small_splits, tmp_path):
    text = '#c "\ng1\tcard one\ng3\thas # in"side\ng#2\tcard two\ng4\t"a # b\n#c ""d""\n" # gone "\ng5\tsay "hi # x"\n'
    (tmp_path / "export.tsv").write_text(text * 9)
    got = readers.scan_notes(spark, str(tmp_path / "export.tsv"), inline_comments=True).distinct().collect()
    assert sorted(map(tuple, got)) == [
        ("g1", "card one"), ("g3", "has "), ("g4", 'a # b\n#c "d"\n'), ("g5", 'say "hi '),
    ]


def test_headers_in_every_file(spark, small_splits, tmp_path):
    head = "guid,card,tag,cosine_sim,gpt_reply,score,objective\n"
    for name in "ab":
        rows = "".join(f'{name}{i},"c\n""{i}""",t,0.5,"Score:\n80",80,"o, {i}"\n' for i in range(20))
        (tmp_path / f"{name}.csv").write_text(head + rows)
    got = readers.scan_ratings(spark, str(tmp_path), format="csv")
    assert sorted(got.select("guid", "card", "gpt_reply", "score", "objective").collect()) == sorted(
        (f"{n}{i}", f'c\n"{i}"', "Score:\n80", 80, f"o, {i}") for n in "ab" for i in range(20)
    )


def test_unclosed_quotes_lose_nothing_before(spark, small_splits, tmp_path):
    (tmp_path / "x.tsv").write_text("g1\tone\ng2\ttwo\n" * 20 + 'g3\t"never closed\n' + "more\n" * 50)
    got = [r["guid"] for r in readers.scan_notes(spark, str(tmp_path / "x.tsv")).collect()]
    assert sorted(set(got)) == ["g1", "g2", "g3"] and len(got) == 41


def test_line_scan():
    tab = quoted.Dialect("\t", "line")
    assert tab.scan('a\t"b', False) == (True, 'a\t"b')
    assert tab.scan('a\tb"c', False)[0] is False
    assert tab.scan('b""c', True)[0] is True
    assert tab.scan('b"""\t"', True)[0] is True
    assert tab.scan('b"""\t""', True)[0] is False
    assert tab.scan('#a\t"b', False) == (False, "")
