import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from tokenizers import Tokenizer, models

from sheaf.llm import packing, tokencount

ODD = [
    "don't it's I'LL we've <|startoftext|> <|endoftext|>x a<|endoftext|> 12 3a4 ''s ... 'tis '",
    "café CAFÉ ΣαΣ 你好  x y \x85 \x1c ​ İstanbul ×÷ ﬁ don''t é Ünïcödé ŸŒ ſ",
    "<0x0A> ▁▁ </s> <unk> ▁a a▁ 🙂🙂 ퟿",
    "a" * 3000,
    "",
    None,
    " \n\t ",
]


def test_token_counts_match_the_tokenizer(docs, tokenizer):
    pieces = tokencount.read_pieces(tokenizer("piece_bpe_32k.model"))
    texts = plain.corpus(4, 30) + ODD
    whole = Tokenizer(models.Unigram([(p, s) for p, s in pieces], unk_id=0, byte_fallback=True))
    frame = docs([(i, t, "x", 1) for i, t in enumerate(texts)], ", score string, n_tokens int")
    counted = tokencount.count_tokens(frame, pieces)
    assert counted.columns == ["doc_id", "text", "n_words", "n_tokens", "score"]
    for row in counted.collect():
        words = [w.decode() for w in plain.words(texts[row.doc_id])]
        expected = sum(len(e.ids) for e in whole.encode_batch(["▁" + w for w in words], add_special_tokens=False))
        assert (row.n_words, row.n_tokens) == (len(words), expected), texts[row.doc_id]


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknown_characters(seed):
    """Few scores, so that many segmentations tie; with and without byte fallback."""
    rng = random.Random(seed)
    pieces = [("<unk>", 0.0)] + [(p, float(-rng.randint(1, 3))) for p in sorted({"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4))) for _ in range(25)})]
    bytes_too = [*pieces, *[(f"<0x{b:02X}>", 0.0) for b in range(256)]]
    for vocabulary, fallback in ((pieces, False), (bytes_too, True)):
        whole = Tokenizer(models.Unigram([(p, s) for p, s in vocabulary], unk_id=0, byte_fallback=fallback))
        counter = tokencount.UnigramCounter(vocabulary)
        for _ in range(300):
            word = "".join(rng.choice("abcdé▁") for _ in range(rng.randint(1, 14)))
            assert counter.best(word)[0] == len(whole.encode(word, add_special_tokens=False).ids), word


def test_no_documents(docs, tokenizer):
    assert tokencount.count_tokens(docs([]), [("▁a", -1.0)]).count() == 0
    assert packing.pack_documents(docs([]), tokenizer("word_bpe_49k.json")).count() == 0


def test_pieces_are_the_tokens_of_whole_texts(docs, tokenizer, monkeypatch):
    path = tokenizer("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = plain.corpus(6, 40) + ODD + [" ".join(plain.vocabulary(rng, 6000)), "Été, là!" * 50]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, "no id", 1)]
    packed = packing.pack_documents(docs(rows, ", start int"), path).collect()
    pieces = defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append(r)
    for doc_id, text in [*enumerate(texts), (None, "no id")]:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        times = 2 if doc_id == 3 else 1
        expected = Counter((at, min(2048, len(ids) - at), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)) for at in range(0, len(ids), 2048))
        found = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id])
        assert found == Counter({k: times * n for k, n in expected.items()}), text
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_memories_change_nothing(tokenizer, monkeypatch):
    definition = open(tokenizer("word_bpe_49k.json")).read()
    texts = [t or "" for t in plain.corpus(8, 60) + ODD] * 3
    expected = list(packing.TextIds(definition)(texts))
    monkeypatch.setattr(packing, "MEMO", 50)
    ids_of = packing.TextIds(definition)
    assert [x for text in texts for x in ids_of([text])] == expected


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.randint(1, 256), lambda: 100, lambda: rng.choice([1, 255, 256, 128, 85]), lambda: int(rng.expovariate(0.02)) % 256 + 1][seed % 4]
    histogram = Counter(draw() for _ in range(rng.choice([1, 50, 5000])))
    used = Counter()
    for lengths, times in packing.plan_sequences(histogram, window=256, grain=4):
        assert sum(lengths) <= 256 and times > 0
        for k in lengths:
            used[k] += times
    assert used == histogram


def test_little_padding():
    rng = random.Random(1)
    histogram = Counter(min(2047, max(2, int(rng.lognormvariate(6, 1)) % 2048)) for _ in range(50_000))
    plan = packing.plan_sequences(histogram)
    sequences = sum(times for _, times in plan)
    assert sum(k * n for k, n in histogram.items()) / sequences / 2048 > 0.99


def test_combinations_fill_the_window():
    found = packing.combinations(12, depth=4)
    brute = {tuple(sorted((a, b, c, d), reverse=True)) for a in range(13) for b in range(13) for c in range(13) for d in range(13) if a + b + c + d == 12}
    assert {tuple(sorted(row, reverse=True)) for row in found.tolist()} == brute and len(found) == len(brute)


def test_ranks_are_dense_per_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 20)
    rows = [(i, 0, 7 if i % 3 else i % 5, 1) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint").repartition(4)
    by_length = defaultdict(list)
    for r in packing.ranked(frame, "length", ["doc_id", "start", "ids_crc32"], 300).collect():
        by_length[r.length].append(r._rank)
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in by_length.values())


def test_a_long_word_needs_the_memory_of_its_last_ends():
    """A word of 2 million characters; keeping every end took some 195 bytes a character."""
    counter = tokencount.UnigramCounter([("a", -1.0), ("ab", -1.5), ("aba", -1.6)])
    word = "ab" * 1_000_000
    tracemalloc.start()
    pieces, _ = counter.best(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pieces == counter.best("ab" * 1000)[0] * 1000 and peak < 6 * len(word)  # 4 of them a copy of the word
