import random
import re

import pytest

from sheaf.llm import decontam

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def terms(text):
    return WORDS.findall(lowered(text))


def brute(texts, items, size=10):
    """``(words, covered places, ids)`` of each text, every window compared with every test string."""
    out = []
    for text in texts:
        words, covered, ids = terms(text), set(), set()
        for item, item_text in items:
            own = terms(item_text)
            for at in range(max(len(own) - size, 0) + 1) if own else ():
                string = own[at : at + size]
                for k in range(len(words) - len(string) + 1):
                    if words[k : k + len(string)] == string:
                        covered.update(range(k, k + len(string)))
                        ids |= {str(item)} - {"None"}
        out.append((len(words), covered, sorted(ids)))
    return out


def inputs(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "c", "d", "über", "x1", "日本"] if seed % 2 else [f"w{i}" for i in range(300)]
    gap = lambda: rng.choice([" ", "  ", "\n", ", ", " - ", ".\t"])
    say = lambda n: "".join(rng.choice(vocab) + gap() for _ in range(n))
    items = [(i % 40, say(rng.choice([1, 2, 3, 9, 10, 11, 30]))) for i in range(45)]
    items += [(50, None), (51, " ;. "), (52, ""), (None, say(12)), (3, items[3][1]), (60, items[3][1])]
    texts = [None, "", " ?! "]
    for _ in range(60):
        parts = [say(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            words = terms(rng.choice(items)[1])
            parts += [" ".join(words[: rng.randint(0, len(words))]).upper(), say(rng.randint(0, 20))]
        texts.append("; ".join(parts))
    return [*texts, *texts[-5:]], items


def collected(found):
    return {
        r.doc_id: (r.n_words, {k for s, e in zip(r.hit_starts, r.hit_ends) for k in range(s, e)}, r["items"])
        for r in found.collect()
    }


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("set_bytes", [10**6, 60])
def test_covered_words_are_those_of_a_comparison_of_all_windows(spark, docs, seed, set_bytes):
    texts, items = inputs(seed)
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontam.covered_words(docs(list(enumerate(texts))), benchmark, set_bytes=set_bytes)
    assert collected(found) == dict(enumerate(brute(texts, items)))
    spans = [list(zip(r.hit_starts, r.hit_ends)) for r in found.collect()]
    assert all(a[1] < b[0] for own in spans for a, b in zip(own, own[1:]))


def test_hits_at_the_ends_of_neighbouring_texts_stay_apart(spark, docs):
    benchmark = spark.createDataFrame([("q", "one two")], "item_id string, text string")
    found = collected(decontam.covered_words(docs([(i, "one two") for i in range(5)], partitions=1), benchmark))
    assert set(map(str, found.values())) == {str((2, {0, 1}, ["q"]))}


@pytest.mark.parametrize("stretch", [1, 2, 7])
def test_stretches_lose_no_place(monkeypatch, stretch):
    texts, items = inputs(1)
    monkeypatch.setattr(decontam, "STRETCH", stretch)
    monkeypatch.setattr(decontam, "PAIRS", 3)
    searcher = decontam.Searcher([(str(i), t) for i, t in items if t])
    found = decontam.searched([decontam.plain_text(t) for t in texts], lambda: [searcher])
    assert [(n, sum(e - s for s, e in zip(starts, ends))) for n, starts, ends, _ in found] == [
        (n, len(covered)) for n, covered, _ in brute(texts, items)
    ]


def test_most_places_of_strange_text_are_passed_over():
    rng = random.Random(5)
    tables = decontam.Tables(10, [b" ".join(b"q%d" % rng.randrange(10**6) for _ in range(10)) for _ in range(50)])
    text = decontam.Searched([b" ".join(b"t%d" % rng.randrange(10**6) for _ in range(20_000))])
    looked_at = []
    slot = tables._slot
    tables._slot = lambda blocks: looked_at.append(len(blocks)) or slot(blocks)
    tables.places(text.hashes, text.edges[:-1], text.edges[1:])
    assert sum(looked_at) < 20_000 / 5


def test_long_texts_and_words(spark, docs):
    passage = " ".join(f"p{i}" for i in range(12))
    texts = ["z" * 3_000_000 + " " + passage, ("filler text " * 300_000) + passage, "z" * 200_000]
    benchmark = spark.createDataFrame([(1, passage), (2, "z" * 200_000)], "item_id int, text string")
    found = collected(decontam.covered_words(docs(list(enumerate(texts))), benchmark))
    assert [(n, len(c), i) for n, c, i in (found[k] for k in range(3))] == [
        (13, 12, ["1"]), (600_012, 12, ["1"]), (1, 1, ["2"]),
    ]


def test_a_passage_that_most_documents_hold(spark, docs):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"start{i} {passage} end{i}" if i % 3 else f"other {i}") for i in range(3000)]
    benchmark = spark.createDataFrame([(i, passage) for i in range(30)], "item_id int, text string")
    found = collected(decontam.covered_words(docs(rows), benchmark))
    assert all(len(found[i][1]) == (20 if i % 3 else 0) and len(found[i][2]) == (30 if i % 3 else 0) for i, _ in rows)


def test_odd_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    clashing = docs([(None, "x a b c", "n", 5, "i"), (2, None, "n", 5, "i")], ", n_words string, _found int, items string")
    found = decontam.covered_words(clashing, items)
    assert found.columns == ["doc_id", "text", "_found", "n_words", "hit_starts", "hit_ends", "items"]
    assert {(r.doc_id, r.n_words, tuple(r.hit_starts), r._found) for r in found.collect()} == {(None, 4, (1,), 5), (2, 0, (), 5)}
    assert decontam.covered_words(docs([(1, "a b c")]).limit(0), items).collect() == []
    (row,) = decontam.covered_words(docs([(1, "a b c")]), items.limit(0)).collect()
    assert (row.n_words, row.hit_starts, row["items"]) == (3, [], [])


def test_no_row_is_shuffled(spark, docs):
    rows = spark.range(10).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    plan = decontam.covered_words(rows, docs([(1, "a")]).withColumnRenamed("doc_id", "item_id"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
