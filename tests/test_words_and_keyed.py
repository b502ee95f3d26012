import random
from collections import Counter, defaultdict

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheaf.functions.text import token_count
from sheaf.operators import keyed, words
from sheaf.sources.lines import parse_records

QUIET = dict(deadline=None, max_examples=6, suppress_health_check=list(HealthCheck))


def made_up_lines(seed, n=40):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["oak", "ash", "elm", "fir", "yew"]) for _ in range(rng.randint(0, 6))) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_word_count(lines, partitions):
    texts = made_up_lines(1) + ["\t oak  oak\t\tpine "]
    assert dict(rows(words.word_count(lines(texts, partitions)))) == dict(Counter(w for t in texts for w in t.split()))


@settings(**QUIET)
@given(st.lists(st.text(alphabet="ab \t\n\r", max_size=20), min_size=1, max_size=20))
def test_word_count_and_weights_on_any_lines(lines, texts):
    counts, weights = Counter(), Counter()
    for text in texts:
        tokens = text.split()
        counts.update(tokens)
        for token in tokens:
            weights[token] += len(tokens) if len(tokens) > 1 else 0
    df = lines(texts)
    assert dict(rows(words.word_count(df))) == dict(counts)
    assert dict(rows(words.line_weights(df))) == dict(weights)


def test_line_weights_keep_words_of_short_lines(lines):
    texts = made_up_lines(2) + ["alone", "yew"]
    expected = Counter()
    for text in texts:
        found = text.split()
        for word in found:
            expected[word] += len(found) if len(found) > 1 else 0
    assert dict(rows(words.line_weights(lines(texts)))) == dict(expected) and expected["alone"] == 0


def test_lines_of_texts(frame):
    df = frame([("a b\nc",), (None,), ("",)], "text string")
    assert rows(words.lines_of(df, "text")) == [("",), ("a b",), ("c",)]


def test_product_sums(lines):
    rng = random.Random(4)
    data = [(rng.randint(0, 9), rng.choice("pq"), rng.choice("xyz"), rng.randint(-3, 9)) for _ in range(60)]
    records = parse_records(lines(["\t".join(map(str, row)) for row in data] + [""]), ["f0", "f1", "f2", "f3"], ["f0", "f3"])
    expected = defaultdict(lambda: [0, 0])
    for a, key1, key2, b in data:
        expected[key2, key1][0] += a * b
        expected[key2, key1][1] += 1
    assert rows(keyed.product_sums_by(records.good, ["f2", "f1"], "f0", "f3")) == sorted((*k, *v) for k, v in expected.items())
    assert rows(records.rejects) == [("", "field count")]


def test_product_sums_beyond_bigint(frame):
    df = frame([("a", 4_000_000_000, 4_000_000_000)] * 3, "k string, x bigint, y bigint")
    assert rows(keyed.product_sums_by(df, ["k"], "x", "y")) == [("a", 3 * 16 * 10**18, 3)]
    doubles = frame([("a", 0.5, 3)], "k string, x double, y int")
    assert rows(keyed.product_sums_by(doubles, ["k"], "x", "y")) == [("a", 1.5, 1)]


TOWN_DDL = "id int, name string, state string, county string, population bigint, zips string"


def made_up_towns(seed, n=50):
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < 0.1 else value
    return [
        (
            i,
            f"town {i}",
            maybe(rng.choice(["TX", "NM", "UT"])),
            maybe(rng.choice(["Taos", "Kane", "Luna"])),
            maybe(rng.randint(0, 5000)),
            maybe(" ".join(["84741"] * rng.randint(0, 3))),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("max_small", [2, 4])
def test_small_county_report(frame, max_small):
    towns = made_up_towns(3)
    counties = defaultdict(lambda: [0, 0, 0])
    for _, _, state, county, population, zips in towns:
        if state is not None and county is not None and population is not None:
            found = counties[state, county]
            found[0] += 1
            found[1] += population
            found[2] += len((zips or "").split()) <= 1
    expected = defaultdict(lambda: [0, 0, 0])
    for (state, _), (n, population, small) in counties.items():
        for k, value in enumerate((n, population, small <= max_small)):
            expected[state][k] += value
    report = keyed.small_county_report(frame(towns, TOWN_DDL), max_small=max_small)
    assert rows(report) == sorted((k, *v) for k, v in expected.items())
    assert report.columns == ["state", "num_cities", "total_population", "num_counties_le_2_small"]


def test_city_profiles(frame):
    towns = [(i, n, s or "UT", c, p or 0, z) for i, n, s, c, p, z in made_up_towns(5)]
    groups = defaultdict(list)
    for town in towns:
        groups[town[2]].append((town[4], len((town[5] or "").split())))
    profiles = sorted((s, sum(p for p, _ in g) / len(g), max(z for _, z in g)) for s, g in groups.items())
    assert rows(keyed.state_profile(frame(towns, TOWN_DDL))) == profiles
    assert rows(keyed.city_measures(frame(towns, TOWN_DDL))) == sorted(
        (s, len(g), sum(p for p, _ in g), max(z for _, z in g)) for s, g in groups.items()
    )


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_customer_totals(lines, partitions):
    rng = random.Random(6)
    sales = [(f"n{rng.randint(0, 9)}", rng.randint(-2, 9), rng.choice(["k1", " k1 ", "k2", "", "k3"])) for _ in range(50)]
    text = lambda invoice, quantity, customer: f"{invoice}\tthing\t{quantity}\tday\t{customer}"
    bad = {
        text("n1", "x", "k1"): "not an integer: quantity",
        text("n77", "1.5", "k9"): "not an integer: quantity",
        text("n1", "", "k1"): "missing: quantity",
        text("n1", "9" * 19, "k1"): "out of range: quantity",
        "n1\tthing\t4\tday": "field count",
    }
    header = "InvoiceNo\tthing\tquantity\tday\tcustomer"
    frame = lines([text(*sale) for sale in sales] + [header, *bad, header], partitions)
    expected = defaultdict(lambda: [0, set()])
    for invoice, quantity, customer in sales:
        expected[customer.strip()][0] += quantity
        expected[customer.strip()][1].add(invoice)
    assert rows(keyed.customer_totals(frame)) == sorted((c, total, len(found)) for c, (total, found) in expected.items())
    records = keyed.sales_records(frame)
    assert dict(rows(records.rejects)) == bad and records.good.count() == len(sales)


@settings(**QUIET)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xy"), st.integers(-9, 9)), min_size=1, max_size=30))
def test_grouped_measures_on_any_rows(frame, data):
    df = frame(data, "k string, j string, v int")
    groups = defaultdict(list)
    for k, j, v in data:
        groups[k].append((j, v))
    one = {k: [v for _, v in g] for k, g in groups.items()}
    assert rows(keyed.sum_by(df, ["k"], "v")) == sorted((k, sum(v)) for k, v in one.items())
    assert rows(keyed.sum_and_count_by(df, ["k"], "v")) == sorted((k, sum(v), len(v)) for k, v in one.items())
    assert rows(keyed.ratio_by(df, ["k"], "v")) == sorted((k, sum(v) / len(v)) for k, v in one.items())
    assert rows(keyed.mean_and_max_by(df, ["k"], "v", "v")) == sorted((k, sum(v) / len(v), max(v)) for k, v in one.items())
    assert rows(keyed.pair_sums_by(df, ["k"], "v", token_count("j"))) == sorted((k, sum(v), len(v)) for k, v in one.items())
    assert rows(keyed.two_step_totals(df, ["k"], ["j"], "v", "t", "n")) == sorted(
        (k, sum(v for _, v in g), len({j for j, _ in g})) for k, g in groups.items()
    )
    assert rows(keyed.distinct_rows(df, "k", "j")) == sorted({(k, j) for k, j, _ in data})
    assert rows(keyed.distinct_rows(df)) == sorted(set(data), key=lambda r: tuple(map(str, r)))
    assert rows(keyed.row_count(df)) == [(len(data),)]
    assert rows(words.histogram(df, df.v, "v", "n")) == sorted(
        Counter(v for _, _, v in data).items(), key=lambda r: tuple(map(str, r))
    )
