import json

import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sheaf.operators import quality
from sheaf.plans import files
from sheaf.session import shared_folder
from sheaf.sources import lines as src
from sheaf.sources import sinks, typed

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "id INT, price DOUBLE, note STRING"


def put(path, text):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_bytes(text.encode())
    return str(path)


def test_typed_rows_and_rejects(spark, tmp_path):
    good = ['1,2.5,plain', ' 2 ,,"a, b"', '3,1e3,"say ""x"""', '4,-0.5,', '5,7,"quoted, ""twice"", ok"', '6,.5,été', '7,NaN,x']
    bad = {
        "8,1.5": "field count",
        "9,1.5,x,y": "field count",
        "x1,1.5,n": "not a int: id",
        "99999999999,1.5,n": "not a int: id",
        "10,cheap,n": "not a double: price",
        ",1.5,n": "missing: id",
    }
    path = put(tmp_path / "t" / "a.csv", "\n".join([*good, *bad]) + "\n")
    found = typed.read_typed(spark, path, schema=SCHEMA, required=["id"])
    assert dict(rows(found.rejects)) == bad
    notes = {1: "plain", 2: "a, b", 3: 'say "x"', 4: None, 5: 'quoted, "twice", ok', 6: "été", 7: "x"}
    assert dict(rows(found.good.select("id", "note"))) == notes
    assert [r.price for r in found.good.orderBy("id").limit(5).collect()] == [2.5, None, 1000.0, -0.5, 7.0]
    # narrow queries see the same rows
    assert found.good.select("note").count() == found.good.count() == len(good)
    assert sorted(r.reason for r in found.rejects.select("reason").collect()) == sorted(bad.values())


def test_line_breaks_in_fields(spark, tmp_path):
    path = put(tmp_path / "t" / "a.csv", '1,2,"two\nlines"\n2,3,"three\n\n, ""lines"""\n3,x,"bad\none"\n')
    found = typed.read_typed(spark, path, schema=SCHEMA, multiline=True)
    assert rows(found.good) == [(1, 2.0, "two\nlines"), (2, 3.0, 'three\n\n, "lines"')]
    assert rows(found.rejects) == [("3,x,bad\none", "not a double: price")]


def test_headers_of_several_files_and_other_separators(spark, tmp_path):
    one = put(tmp_path / "one" / "a.tsv", "id\tprice\tnote\n1\t2\tx\n")
    two = put(tmp_path / "two" / "b.tsv", "id\tprice\tnote\n2\t3\t\n\n3\n")
    found = typed.read_typed(spark, one, two, schema=SCHEMA, sep="\t", header=True)
    assert rows(found.good) == [(1, 2.0, "x"), (2, 3.0, None)]
    assert rows(found.rejects) == [("3", "field count")]
    assert rows(typed.read_typed(spark, one, schema="id INT NOT NULL, price INT, note STRING", sep="\t", header=True).good) == [(1, 2, "x")]


def test_empty_file(spark, tmp_path):
    found = typed.read_typed(spark, put(tmp_path / "t" / "a.csv", ""), schema=SCHEMA)
    assert rows(found.good) == rows(found.rejects) == []


def test_lines_know_their_files(spark, tmp_path):
    names = [put(tmp_path / f"d{i}" / f"f{i}.txt", "a\n" * (i + 1)) for i in range(4)]
    found = src.read_lines_with_files(spark, *names[:3])
    assert rows(found.groupBy("file").count()) == [(f"f{i}.txt", i + 1) for i in range(3)]


@pytest.mark.parametrize("block", ["200", "134217728"])
@pytest.mark.parametrize("strict", [True, False])
def test_numbers_of_faulty_lines_in_files_cut_into_blocks(spark, tmp_path, block, strict):
    expected = []
    for name in ("mapper0_out.txt", "mapper1_out.txt"):
        content = []
        for number in range(1, 201):
            text = ["", json.dumps("k") + "\t1", "no tab", "1\tNaN", "é\t1"][(number * number + len(expected)) % 5]
            content.append(text)
            if text == "no tab" or text == "é\t1" or (strict and text == "1\tNaN"):
                expected.append((name, number, text))
        put(tmp_path / "t" / name, "\n".join(content))
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        frame = quality.check_files(spark, str(tmp_path / "t"), strict=strict)
        found = [row[:3] for row in rows(frame)]
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted(expected, key=lambda r: tuple(map(str, r)))
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]  # the files are read once


def test_check_of_clean_and_of_no_files(spark, tmp_path):
    put(tmp_path / "t" / "mapper0_out.txt", '1\t2\n\n"x"\tnull\n')
    put(tmp_path / "t" / "other.txt", "bad\n")
    assert rows(quality.check_files(spark, str(tmp_path / "t"))) == []
    assert rows(quality.check_files(spark, str(tmp_path / "t"), names="none")) == []


def test_sinks_replace_or_refuse(spark, tmp_path):
    df = spark.range(3).selectExpr("id AS k", "id * 2 AS v")
    for write in (sinks.write_csv, lambda d, p: sinks.write_key_values(d, ["k"], ["v"], p)):
        path = str(tmp_path / str(id(write)))
        write(spark.range(50).selectExpr("id AS k", "id AS v"), path)
        write(df, path)
        assert spark.read.text(path).count() == 3
    for write in (sinks.write_tuples, lambda d, p: sinks.write_scalar(d.agg(F.sum("v")), p)):
        path = str(tmp_path / f"once{id(write)}")
        write(df, path)
        before = rows(spark.read.text(path))
        with pytest.raises(AnalysisException):
            write(df.limit(1), path)
        assert rows(spark.read.text(path)) == before


def test_writes_of_tasks_that_fail_once_leave_each_row_once(spark, tmp_path):
    """A task that fails after writing half its rows is run again; what it wrote first must not stay."""
    marks = tmp_path / "marks"
    marks.mkdir()

    def flaky(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        for batch in batches:
            yield batch
        if context.attemptNumber() == 0 and context.partitionId() % 2:
            raise RuntimeError("lost")

    local = spark.sparkContext.master
    frame = spark.range(0, 4000, 1, 4).mapInPandas(flaky, "id long")
    try:
        sinks.write_csv(frame, str(tmp_path / "out"))
    except Exception:  # noqa: BLE001 - local[n] allows a task one attempt only
        assert "," not in local
        assert not list((tmp_path / "out").glob("part-*")) or not (tmp_path / "out" / "_SUCCESS").exists()
        return
    assert rows(src.read_delimited(spark, str(tmp_path / "out"), "id BIGINT", sep=",").selectExpr("count(*)", "sum(id)")) == [
        (4000, 4000 * 3999 // 2)
    ]


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == shared_folder(spark)

    class Cluster:
        conf = type("", (), {"get": staticmethod(lambda name, other=None: other)})
        sparkContext = type("", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        shared_folder(Cluster)


def test_each_run_writes_a_folder_of_its_own(spark):
    a, b = (files.edges_of_files(spark, FOLDER) for _ in range(2))
    assert a.inputFiles() and not set(a.inputFiles()) & set(b.inputFiles())
    assert rows(a) == rows(b)
