from collections import Counter

import pytest
from helpers import rows

from sheaf.functions.numbers import to_double
from sheaf.functions.text import field, split_fields, token_count
from sheaf.operators.words import zip_histogram
from sheaf.sources import lines as src
from sheaf.sources import sinks

TOWNS = [
    ("Alder", "TX", "Travis", 812, ""),
    ("Birch", "TX", "Hays", 95, "78610 78640"),
    ("Cedar", "NM", "Taos", 40, "87571"),
    ("Elm", "NM", "Luna", 7, "88030 88031 88032 88033"),
    ("Fir", "UT", "Kane", 63, "84741"),
]
TOWN_FILE = ["\t".join(map(str, [*town, i * 10])) for i, town in enumerate(TOWNS)]
DAMAGED = {"one field only": "field count", "Gum\tUT\tKane\t5": "field count"}
ZIP_HISTOGRAM = sorted(Counter(len(town[4].split()) for town in TOWNS).items())


def write(path, texts, end="\n"):
    path.write_bytes((end.join(texts) + end).encode())
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_town_file(spark, tmp_path, end):
    records = src.read_records(spark, write(tmp_path / "towns", [*TOWN_FILE, *DAMAGED], end))
    assert rows(zip_histogram(records.good)) == ZIP_HISTOGRAM
    assert dict(rows(records.rejects)) == DAMAGED


def test_damaged_rows_stay_out_of_narrow_queries(spark, tmp_path):
    good = {"H\tUT\tKane\t 31 \tq\t1": 31, "H\tUT\tKane\t-88888888888\tq\t2": -88888888888, '"H\tUT\tKane\t2\tq\t3': 2, "H\tUT\tKane\t \tq\t4": None}
    bad = {
        "H\tUT\tKane\t+31\tq q q\t5": "not an integer: population",
        "H\tUT\tKane\tmany\tq q q\t6": "not an integer: population",
        "H\tUT\tKane\t1\tq q q\t7\tx": "field count",
        "": "field count",
        "H\tUT\tKane\t9223372036854775808\tq q q\t8": "out of range: population",
        "H\tUT\tKane\t1\tq q q\t-99999999999999999999": "out of range: id",
    }
    records = src.read_records(spark, write(tmp_path / "towns", [*TOWN_FILE, *good, *bad]))
    expected = Counter(dict(ZIP_HISTOGRAM)) + Counter({1: len(good)})
    assert rows(zip_histogram(records.good)) == sorted(expected.items())
    assert dict(rows(records.rejects)) == bad
    found = [row.population for row in records.good.where("name IN ('H', '\"H')").collect()]
    assert sorted(found, key=str) == sorted(good.values(), key=str)
    assert records.good.count() + records.rejects.count() == len(TOWN_FILE) + len(good) + len(bad)


def test_required_integers(lines):
    records = src.parse_records(lines(["1\tx", "\tx", " \tx"]), ["n", "s"], ["n"], required=["n"])
    assert rows(records.good) == [(1, "x")] and rows(records.rejects) == [("\tx", "missing: n"), (" \tx", "missing: n")]


def test_several_files_are_one_input(spark, tmp_path):
    a, b = write(tmp_path / "a.txt", ["1 2", "3"]), write(tmp_path / "b.txt", ["4"])
    assert rows(src.read_lines(spark, a, b)) == [("1 2",), ("3",), ("4",)]
    assert src.read_lines(spark, str(tmp_path / "*.txt")).count() == 3


def test_declared_schemas(spark, tmp_path):
    path = write(tmp_path / "towns", ["8\tBirch\tTX\tHays\t95\t78610 78640"])
    ddl = "id int, name string, state string, county string, population bigint, zips string"
    assert rows(src.read_delimited(spark, path, ddl)) == [(8, "Birch", "TX", "Hays", 95, "78610 78640")]
    for name, content in {
        "customers": ["customer_id,country", "k7,Peru", ",Chad"],
        "orders": ["invoice_no,customer_id", "n3,k7"],
        "items": ["invoice_no,quantity,unit_price", "n3,4,2.5"],
    }.items():
        (tmp_path / "shop" / name).mkdir(parents=True)
        write(tmp_path / "shop" / name / "part.csv", content)
    customers, orders, items = src.read_tables(spark, str(tmp_path / "shop"))
    assert rows(customers) == [(None, "Chad"), ("k7", "Peru")]
    assert rows(orders) == [("n3", "k7")] and rows(items) == [("n3", 4, 2.5)]


def test_edges(spark, tmp_path):
    path = write(tmp_path / "graph", ["8 4", "lonely", "4 6 further fields", "8 4"])
    assert rows(src.read_edges(spark, path)) == [("4", "6"), ("8", "4"), ("8", "4")]
    assert rows(src.parse_edges(src.read_lines(spark, path)).rejects) == [("lonely", "field count")]


def test_header_fields_and_prices(lines):
    goods = [("k1", "oak", "4.75"), ("k2", "ash", "0.5"), ("k3", "yew", "n/a")]
    table = lines(["code\twood\teuros", *["\t".join(x) for x in goods]])
    body = src.drop_header(table, "code").select(split_fields("value").alias("f"))
    assert rows(body.select(to_double(field("f", 2)).alias("price"))) == [(0.5,), (4.75,), (None,)]
    assert rows(body.select("f")) == [(list(x),) for x in goods]
    assert rows(src.flatten(body, field("f", 0), field("f", 1))) == sorted((v,) for x in goods for v in x[:2])
    assert src.preview(table, 2).count() == 2 and src.preview(table).count() == 4
    assert rows(src.preview(table, 2, ["value"])) == [("code\twood\teuros",), ("k1\toak\t4.75",)]


def test_csv_sink_replaces(spark, frame, tmp_path):
    path = str(tmp_path / "out")
    for value in (1, 2):
        sinks.write_csv(frame([("a", value)], "k string, n int"), path)
    assert rows(spark.read.text(path)) == [("a,2",)]


def test_text_sinks(spark, frame, tmp_path):
    df = frame([("a", 1, 2), (None, 3, 4)], "k string, x int, y int")
    sinks.write_tuples(df, str(tmp_path / "flat"))
    sinks.write_tuples(df, str(tmp_path / "nested"), nested=["x", "y"])
    assert rows(spark.read.text(str(tmp_path / "flat"))) == [("(a,1,2)",), ("(null,3,4)",)]
    assert rows(spark.read.text(str(tmp_path / "nested"))) == [("(a,(1,2))",), ("(null,(3,4))",)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_tuples(df, str(tmp_path / "flat"))
    sinks.write_scalar(frame([(2,)], "n bigint"), str(tmp_path / "one"))
    assert rows(spark.read.text(str(tmp_path / "one"))) == [("2",)]
    assert len(list((tmp_path / "one").glob("part-*"))) == 1


def test_key_value_sink(spark, frame, tmp_path):
    df = frame([("a", "b", 6, 2), (None, 'q"t', 0, 1)], "k1 string, k2 string, total bigint, n bigint")
    path = str(tmp_path / "kv")
    for _ in range(2):
        sinks.write_key_values(df, ["k1", "k2"], ["total", "n"], path)
    assert rows(spark.read.text(path)) == [('["a", "b"]\t[6, 2]',), ('[null, "q\\"t"]\t[0, 1]',)]
    histogram = frame(ZIP_HISTOGRAM, "num_zips int, num_cities bigint")
    lines = rows(sinks.key_value_lines(histogram, ["num_zips"], ["num_cities"]))
    assert lines == [(f"{zips}\t{n}",) for zips, n in ZIP_HISTOGRAM]


def test_typed_cities_with_missing_zips(frame):
    towns = frame([("Oak", None), ("Pine", " "), ("Rowan", "1 22 333")], "name string, zips string")
    assert rows(towns.select("name", token_count("zips"))) == [("Oak", 0), ("Pine", 0), ("Rowan", 3)]
