import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sheaf.llm import resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    source_counts = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    target_counts = Counter(bucket(f) for text in target for f in features(text)[1])
    s, t = sum(source_counts.values()), sum(target_counts.values())
    gain = lambda b: math.floor(1000 * math.log((target_counts[b] + 1) * (s + 10_000) / ((source_counts[b] + 1) * (t + 10_000))))
    out = []
    for i, text in rows:
        words, own = features(text)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(words), len(own), weight, score))
    eligible = sorted((-r[4], r[0]) for r in out if r[1] >= 20 and r[4] is not None)
    ranks = {key: k for k, key in reversed(list(enumerate(eligible[: 25 * len(eligible) // 100], 1)))}
    return [(*r, ranks.get((-r[4], r[0])) if r[1] >= 20 and r[4] is not None else None) for r in out]


def inputs(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["Über", "X", "日本", "y" * 40]
    say = lambda k, v: "".join(rng.choice(v) + rng.choice([" ", " ", "\n", ", ", "\n\n"]) for _ in range(k))
    texts = [say(rng.choice([0, 1, 5, 19, 20, 21, 60, 200]), vocab) for _ in range(n)]
    texts += [texts[3] + "\n" + texts[8], None, "", " .\n; ", "w1 " * 50, "\n".join(["w1 w2 w3"] * 30)]
    return list(enumerate(texts)), [say(30, vocab[:40]) for _ in range(20)] + [None, ""]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_draw_against_every_feature_counted(spark, docs, seed):
    rows, target = inputs(seed)
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(resampling.resample(docs(rows), frame)) == sorted(brute(rows, target), key=str)


def test_cuts_of_long_lines_change_nothing(spark, docs, monkeypatch):
    rows, target = inputs(7, 40)
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    whole = [resampling._weighed([resampling.segments_of(t) for _, t in rows], np.arange(10_000), 10_000)]
    monkeypatch.setattr(resampling, "SEGMENT_BYTES", 20)
    assert max(len(s) for s in resampling.segments_of(rows[7][1] + "w1 " * 90)) <= 20 + 41
    cut = resampling._weighed([resampling.segments_of(t) for _, t in rows], np.arange(10_000), 10_000)
    assert whole[0].equals(cut)
    assert frame.count() == len(target)


def test_counts_of_a_long_line_and_a_long_word(spark, docs):
    rows = [(1, "alpha beta " * 40_000), (2, "z" * 300_000 + " alpha"), (3, "alpha beta")]
    counts = dict(map(tuple, resampling.bucket_counts(docs(rows)).collect()))
    expected = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    assert counts == dict(expected)


def test_equal_lines_meet_as_one_row(spark, docs):
    rows = [(i, "the same line\nof all rows") for i in range(500)]
    sent = {(r.across, bytes(r.segment)): r.n for r in resampling._segment_counts(docs(rows)).collect()}
    assert sent == {(False, b"the same line"): 500, (False, b"of all rows"): 500, (True, b"line of"): 500}


def test_ranks_count_on_over_ties_and_repeated_rows(spark):
    rows = [(i // 2, 30, 5, 1, 100 - i // 20) for i in range(200)] + [(None, 30, 5, 1, None), (500, 3, 5, 1, 999)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(5)
    out = resampling.ranked(scored.selectExpr("*", "0L AS _text"), 25, 20)
    drawn = sorted((r["rank"], -r.score, r.doc_id) for r in out.collect() if r["rank"])
    assert [d[0] for d in drawn] == list(range(1, 51))
    assert [d[1:] for d in drawn] == sorted(d[1:] for d in drawn) and out.count() == len(rows)


def test_odd_tables(spark, docs):
    empty = spark.createDataFrame([], "text string")
    clash = docs([(1, "a b " * 20, "x", 1), (None, "c d " * 20, "x", 1), (2, None, "x", 1)], ", weight string, _text int")
    out = {r.doc_id: r for r in resampling.resample(clash, empty).collect()}
    assert out[None].score is None and out[None]["rank"] is None and out[None].n_features == 79
    assert out[2].n_features == out[2].weight == 0 and out[2].score is not None
    assert resampling.resample(clash.limit(0), clash).collect() == []
    one = docs([(i, "x y " * 15) for i in [5, 5, 5, 5]])
    assert sorted(str(r["rank"]) for r in resampling.resample(one, empty).collect()) == ["1", "None", "None", "None"]


def test_draw_prefers_texts_like_the_target(spark, docs):
    rng = random.Random(3)
    likes, others = [f"t{i}" for i in range(50)], [f"o{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choices(likes if i % 4 == 0 else others, k=80))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(rng.choices(likes, k=100)),) for _ in range(20)], "text string")
    drawn = [r.doc_id for r in resampling.resample(docs(rows), target).where("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and sum(i % 4 == 0 for i in drawn) >= 60  # 25 without weights
