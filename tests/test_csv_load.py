"""CSV load: rows cut over byte ranges equal Spark's own unsplit reader, and no broken row is lost."""

import random

import pytest
from pyspark.sql import functions as F

from tradewind.sources import csv_load
from tradewind.sources.csv_load import INSIDE, OUTSIDE, CsvLoad, csv_rows, ends, load_csv
from tradewind.sources.raw import RAW_SCHEMAS, read_csv_folder

SCHEMA = "a string, n int, b string"


@pytest.fixture
def ranges(spark):
    """Sets how many bytes a task reads, down to a few."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        for name, value in zip(names, (size, 0)):
            spark.conf.set(name, str(value))

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def whole(spark, path, schema=SCHEMA):
    """Spark's reader over unsplit files."""
    options = {"header": True, "escape": '"', "multiLine": True, "enforceSchema": False}
    return sorted(map(tuple, spark.read.schema(schema).options(**options).csv(str(path)).collect()), key=repr)


def loaded(spark, path, schema=SCHEMA):
    return sorted(map(tuple, load_csv(spark, str(path), "t", schema, multiline=True).rows.collect()), key=repr)


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("", OUTSIDE, INSIDE),
        ("a,b", OUTSIDE, INSIDE),
        ('a,"b', INSIDE, OUTSIDE),
        ('a,"b"', OUTSIDE, OUTSIDE),
        ('a"b', OUTSIDE, OUTSIDE),
        ('"a""', INSIDE, OUTSIDE),
        ('"a"",b', INSIDE, OUTSIDE),
        ('"a","b",c', OUTSIDE, OUTSIDE),
        ('"a" x,"b', INSIDE, INSIDE),
        ('x",5,"y', INSIDE, INSIDE),
        ('"', INSIDE, OUTSIDE),
        ('""', OUTSIDE, INSIDE),
        ('"""', INSIDE, OUTSIDE),
    ],
)
def test_what_a_line_does_to_both_states(line, outside, inside):
    assert ends(line) == (outside, inside)


TEXTS = ["plain", "", 'say ""hi""', "two\nlines", "\n\nblank\n\n", "comma, and\r\nbreak", '""', 'end""\n""begin', "é 日本\n😀", '"",""\n', " spaced "]


def csv_text(n, seed, newline="\n"):
    draw = random.Random(seed)
    rows = ["a,n,b"]
    for i in range(n):
        first = draw.choice(["", "x", f'"{draw.choice(TEXTS)}"', 'it"s', "a b"])
        rows.append(f'{first},{draw.choice([i, i, ""])},"{draw.choice(TEXTS)}{"z" * draw.choice([0, 0, 40])}"')
    return newline.join(rows) + newline


@pytest.mark.parametrize("size", [37, 61, 400])
def test_ranges_of_any_size_give_the_rows_of_the_unsplit_reader(spark, tmp_path, ranges, size):
    ranges(size)
    path = tmp_path / "t.csv"
    path.write_bytes(csv_text(24, size).encode())
    expected = whole(spark, path)
    assert len(expected) == 24 and loaded(spark, path) == expected
    assert spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 1


def test_folders_windows_line_ends_and_a_last_row_without_one(spark, tmp_path, ranges):
    ranges(200)
    folder = tmp_path / "t.csv"
    folder.mkdir()
    for i, text in enumerate([csv_text(10, 1), csv_text(12, 2, "\r\n"), "a,n,b\n", "a,n,b\nx,1,y", 'a,n,b\n"q\nr",2,"s\nt"']):
        (folder / f"part-{i}.csv").write_bytes(text.encode())
    # Spark's reader turns line ends within texts into its own where rows end in two characters; here they stay.
    expected = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in whole(spark, folder)]
    found = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r) for r in loaded(spark, folder)]
    assert sorted(found, key=repr) == sorted(expected, key=repr) and len(found) == 24


def test_a_row_longer_than_many_ranges(spark, tmp_path, ranges):
    ranges(300)
    path = tmp_path / "t.csv"
    text = "\n".join(f'line {i} ""quoted"", with commas' for i in range(120))
    path.write_text(f'a,n,b\nfirst,1,"{text}"\nlast,2,x\n"{text}",3,"y\nz"\n')
    found = loaded(spark, path)
    assert found == whole(spark, path) and len(found) == 3 and max(len(r[2]) for r in found) > 2000


def test_more_ranges_than_are_broadcast(spark, tmp_path, ranges, monkeypatch):
    monkeypatch.setattr(csv_load, "BROADCAST_RANGES", 3)
    ranges(100)
    path = tmp_path / "t.csv"
    path.write_text(csv_text(20, 9))
    assert loaded(spark, path) == whole(spark, path)


def test_the_rows_as_they_stand(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,n,b\n"x\ny",1,z\n\n  \np,2,q\n')
    rows = {(r["kind"], r["row"]) for r in csv_rows(spark, str(path)).collect()}
    assert rows == {(csv_load.HEADER, "a,n,b"), (csv_load.WHOLE, '"x\ny",1,z'), (csv_load.WHOLE, "p,2,q")}


@pytest.mark.parametrize("multiline", [False, True])
def test_files_without_headers(spark, tmp_path, multiline):
    path = tmp_path / "t.csv"
    path.write_text("x,1,y\nz,2,w\n")
    assert sorted(load_csv(spark, str(path), "t", SCHEMA, multiline, header=False).rows.collect()) == [("x", 1, "y"), ("z", 2, "w")]


BROKEN = ["short,1", "long,2,x,y", "type,abc,x", 'type,"1\n2",x']


@pytest.mark.parametrize("multiline", [False, True])
def test_broken_rows_are_kept_apart_with_a_reason(spark, tmp_path, multiline):
    path = tmp_path / "t.csv"
    broken = BROKEN if multiline else BROKEN[:3]
    path.write_text("\n".join(["a,n,b", "good,1,x", *broken, ",,", 'good,3,""', ""]))
    table = load_csv(spark, str(path), "t", SCHEMA, multiline)
    assert sorted(map(tuple, table.rows.collect()), key=repr) == sorted([("good", 1, "x"), (None, None, None), ("good", 3, None)], key=repr)
    reasons = {r["record"]: r["reason"] for r in table.rejects.collect()}
    expected = {"short,1": "not 3 fields", "long,2,x,y": "not 3 fields", "type,abc,x": "n: no int: abc", 'type,"1\n2",x': "n: no int: 1\n2"}
    assert reasons == {k: expected[k] for k in broken}
    assert table.counts.collect() == [("t", 3, len(broken))]
    # No narrow read passes over them or takes them in.
    assert table.rows.count() == 3 and table.rows.select("n").count() == 3 and table.rejects.select("record").count() == len(broken)
    assert table.rows.agg(F.sum("n")).first()[0] == 4


@pytest.mark.parametrize("row", ["o1,1,boleto,1", "o1,xx,boleto,1,5.0", "o1,1,boleto,1,5.0,9"])
@pytest.mark.parametrize("read", [lambda df: df.count(), lambda df: df.select("order_id", "payment_value").collect(), lambda df: df.agg(F.sum("payment_value")).collect()])
def test_a_broken_value_in_an_unread_column_stops_the_plain_load(spark, tmp_path, row, read):
    head = "order_id,payment_sequential,payment_type,payment_installments,payment_value"
    (tmp_path / "payments.csv").write_text(f"{head}\no0,1,boleto,1,4.0\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read(read_csv_folder(spark, str(tmp_path))["payments"])


def test_a_wrong_header_stops_the_load(spark, tmp_path):
    for name, head in (("one", "a,n,c"), ("two", "a,n"), ("three", "a,n,b,c")):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"{head}\nx,1,y\n")
        with pytest.raises(ValueError, match="header"):
            load_csv(spark, str(path), "t", SCHEMA, multiline=True)
        with pytest.raises(Exception, match="(?i)header"):
            load_csv(spark, str(path), "t", SCHEMA)
    (tmp_path / "bom.csv").write_text("﻿A,N,B\nx,1,y\n")
    assert loaded(spark, tmp_path / "bom.csv") == [("x", 1, "y")]


def test_empty_files_and_other_separators(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,n,b\n")
    assert loaded(spark, tmp_path / "none.csv") == loaded(spark, tmp_path / "head.csv") == []
    with pytest.raises(ValueError, match="sep"):
        load_csv(spark, str(tmp_path / "head.csv"), "t", SCHEMA, sep=";")


def test_a_folder_of_tables_and_its_report(spark, tmp_path):
    schemas = {t: RAW_SCHEMAS[t] for t in ("reviews", "sellers")}
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,a,SP\ns2,1\n")
    head = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"
    (tmp_path / "reviews.csv").write_text(f'{head}\nr1,o1,5,,"fine\nreally",2018-01-01 00:00:00,2018-01-02 10:00:00\nr2,o1,good,,,,\n')
    load = CsvLoad(spark, str(tmp_path), schemas)
    assert load.tables["sellers"].collect() == [("s1", "01234", "a", "SP")]
    assert load.tables["reviews"].select("review_score", "review_comment_message").collect() == [(5, "fine\nreally")]
    assert {tuple(r) for r in load.counts.collect()} == {("reviews", 1, 1), ("sellers", 1, 1)}
    assert {(r["status"], r["check"], r["violations"]) for r in load.report().collect()} == {("FAIL", "rejected_reviews", 1), ("FAIL", "rejected_sellers", 1)}
    assert {r["reason"] for r in load.rejects.collect()} == {"not 4 fields", "review_score: no int: good"}
