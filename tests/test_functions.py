import hashlib
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.functions import bucket, jsoncheck, numbers, text

QUIET = dict(deadline=None, max_examples=8, suppress_health_check=list(HealthCheck))
TEXTS = ["", " ", None, "16801", " 1 2 ", "1\t2", "\n a\x0bb\fc\r", "a  b", "x" * 50, "é ü"]


def values(frame, data, kind, column):
    rows = [(i, v) for i, v in enumerate(data)]
    out = frame(rows, f"i int, x {kind}").select("i", column.alias("y")).collect()
    return [row.y for row in sorted(out, key=lambda row: row.i)]


def test_tokens_and_counts_follow_python_split(frame):
    found = values(frame, TEXTS, "string", text.tokens("x"))
    assert [f for f, t in zip(found, TEXTS) if t is not None] == [t.split() for t in TEXTS if t is not None]
    assert values(frame, TEXTS, "string", text.token_count("x")) == [len((t or "").split()) for t in TEXTS]


@settings(**QUIET)
@given(st.lists(st.text(alphabet=" \t\n\x0b\f\rab1é.", max_size=30), min_size=1, max_size=20))
def test_token_count_on_any_text(frame, texts):
    assert values(frame, texts, "string", text.token_count("x")) == [len(t.split()) for t in texts]


def test_zip_counter_by_name_is_inlined(spark, frame):
    text.register_zip_counter(spark)
    df = frame([(i, t) for i, t in enumerate(TEXTS)], "i int, zips string")
    counted = df.selectExpr("i", "zipCounter(zips) <= 1 AS small", "zipCounter(zips) AS n")
    assert [r.n for r in sorted(counted.collect())] == [len((t or "").split()) for t in TEXTS]
    assert "UDF" not in counted._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sep", ["\t", " ", ",", "|", ".", "\\", "^", "ab", "||"])
def test_split_fields_keeps_trailing_empties(frame, sep):
    data = [sep.join(parts) for parts in (["a", "b", ""], ["", "", ""], ["x"], [""], ["1", "2"])]
    assert values(frame, data, "string", text.split_fields("x", sep)) == [d.split(sep) for d in data]


def test_fields_out_of_range_are_null(frame):
    assert values(frame, ["a\tb"], "string", text.field(text.split_fields("x"), 5)) == [None]


def test_int_or_blank_rule(frame):
    good = ["", " ", "5", " 12 ", "-7", "99999999999", "007"]
    bad = ["abc", "+5", "--5", "1.0", "1 2", "٣", "-"]
    assert values(frame, good + bad, "string", numbers.is_int_or_blank("x")) == [True] * len(good) + [False] * len(bad)
    assert values(frame, ["", " 12 ", "abc", "99999999999"], "string", numbers.to_long("x")) == [None, 12, None, 99999999999]
    assert values(frame, ["3.01", " 9.99", "x"], "string", numbers.to_double("x")) == [3.01, 9.99, None]


def test_log_limits(frame):
    found = values(frame, [1.0, math.e, 0.0, -1.0, None], "double", numbers.log_or_limit("x"))
    assert found[:3] == [0.0, 1.0, float("-inf")] and math.isnan(found[3]) and found[4] is None


def test_stable_bucket_known_answers(frame):
    salt = "abc1234"
    assert values(frame, ["hi", "worlds", "5"], "string", bucket.stable_bucket(salt, "x", 4)) == [1, 1, 2]
    assert values(frame, [5], "int", bucket.stable_bucket(salt, "x", 4, bucket.INTEGER_KEY)) == [3]
    listed = bucket.list_key(F.lit("a"), "x", quoted=(True, False))
    assert values(frame, [7], "int", bucket.stable_bucket(salt, listed, 4, bucket.LIST_KEY)) == [2]


@settings(**QUIET)
@given(
    st.lists(st.text(max_size=12).filter(lambda t: "\x00" not in t and t.isprintable()), min_size=1, max_size=10),
    st.sampled_from([1, 2, 7, 1000, 2**31 - 1]),
)
def test_stable_bucket_equals_big_integer_arithmetic(frame, keys, buckets):
    expected = [int(hashlib.sha1(f"s|<class 'str'>|{k}".encode()).hexdigest(), 16) % buckets for k in keys]
    assert values(frame, keys, "string", bucket.stable_bucket("s", "x", buckets)) == expected


def test_list_key_text_follows_python(frame):
    data = ["a", "it's", 'say "hi"', "both ' and \"", "tab\there", "back\\slash"]
    found = values(frame, data, "string", bucket.list_key("x", F.lit(7), quoted=(True, False)))
    assert found == [str([d, 7]) for d in data]


def test_bucket_count_is_checked():
    with pytest.raises(ValueError):
        bucket.hash_modulo("x", 2**31)


STRICT_JSON = ["5.4", '"hello"', '["a", 3]', '["nested", "list", [1, 2]]', "null", " 1 ", '{"k": 69}', "-0", "1e5", "true"]
NOT_JSON = ["'hello'", "hello", "", " ", "5 6", "[1, 2] x", "1, 2", "[1],[2", "[1,]", "{", '{"a":1}{"a":1}', "01", '"a', "1]"]
LENIENT_JSON = ["NaN", "Infinity", '{"a": 1, "a": 2}', "[NaN]"]


def test_strict_json(frame):
    data = STRICT_JSON + NOT_JSON + LENIENT_JSON + [None]
    expected = [True] * len(STRICT_JSON) + [False] * (len(NOT_JSON) + len(LENIENT_JSON) + 1)
    assert values(frame, data, "string", jsoncheck.is_json("x")) == expected


def test_python_json(frame):
    data = STRICT_JSON + LENIENT_JSON + NOT_JSON

    def accepted(t):
        try:
            json.loads(t)
        except ValueError:
            return False
        return True

    assert values(frame, data, "string", jsoncheck.is_python_json("x")) == [accepted(t) for t in data]
