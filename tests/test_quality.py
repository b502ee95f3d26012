import json
import random

import pytest
from helpers import rows

from sheaf.operators import quality

GOOD = ['"a"\t[1, 2]', "5.4\tnull", '["a", 3]\t"hello"', "   ", "", '1\t {"k": 69} ']
BAD = {
    "no tab here": "no tab",
    "1\t2\t3": "more than one tab",
    "'hello'\t1": "key is not JSON",
    "hello\t'x'": "key is not JSON",
    "1\t5 6": "value is not JSON",
    "1\t": "value is not JSON",
    "1\t[1, 2] x": "value is not JSON",
}
LENIENT = ["1\tNaN", "1\tInfinity", '{"a": 1, "a": 2}\t1']


def test_violations(lines):
    assert dict(rows(quality.key_value_violations(lines(GOOD + list(BAD))))) == BAD


def test_lenient_check_accepts_what_python_accepts(lines):
    data = lines(GOOD + list(BAD) + LENIENT + ["NaN\t'x'"])
    assert quality.key_value_violations(data).count() == len(BAD) + len(LENIENT) + 1
    expected = {**BAD, "NaN\t'x'": "value is not JSON"}
    assert dict(rows(quality.key_value_violations(data, strict=False))) == expected


def test_other_columns_are_kept(frame):
    df = frame([(1, "x"), (2, "1\t2")], "id int, text string")
    assert rows(quality.key_value_violations(df, "text")) == [(1, "x", "no tab")]


@pytest.mark.parametrize("block", ["512", "134217728"])
def test_files_with_line_numbers(spark, tmp_path, block):
    random.seed(1)
    expected = []
    for name in ("mapper0_out.txt", "reducer1_in.txt", "reducer1_out.txt", "mapper0_in.txt", "notes.txt"):
        content = []
        for number in range(1, 301):
            line = random.choice([json.dumps("k") + "\t" + "x" * 0 + str(number), "", *BAD])
            content.append(line)
            if line in BAD and name not in ("mapper0_in.txt", "notes.txt"):
                expected.append((name, number, line, BAD[line]))
        (tmp_path / name).write_text("\n".join(content) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = rows(quality.check_files(spark, str(tmp_path)))
        first = rows(quality.check_files(spark, str(tmp_path), first_only=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda row: tuple(str(v) for v in row)
    assert found == sorted(expected, key=key)
    firsts = [min(row for row in expected if row[0] == name) for name in {row[0] for row in expected}]
    assert first == sorted(firsts, key=key)
