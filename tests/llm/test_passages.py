import random

import numpy as np
import pandas as pd
import plain
import pytest

from sheaf.llm import repeats, substring, suffix

OPERATORS = [substring.substring_dedup, suffix.suffix_dedup]


def check(found, rows):
    expected = plain.kept_words(rows)
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.n_removed, r.kept_text) == expected[r.doc_id]
        w = plain.words(dict(rows)[r.doc_id])
        left = [x for i, x in enumerate(w) if not any(s.start <= i < s.end for s in r.spans)]
        assert b" ".join(left).decode() == r.kept_text


@pytest.mark.parametrize("operator", OPERATORS)
@pytest.mark.parametrize("seed", range(2))
def test_against_every_window(docs, operator, seed):
    rows = list(enumerate(plain.corpus(seed, 80)))
    random.Random(seed).shuffle(rows)
    check(operator(docs([(i, t, 1, "x") for i, t in rows], ", n_words int, g string")).collect(), rows)


@pytest.mark.parametrize("operator", OPERATORS)
def test_passages_at_the_limit_and_crowded_groups(docs, operator, monkeypatch):
    """Small groups, segments and runs, so that every branch that bounds them is taken; many copies of one text."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", 3000)
    monkeypatch.setattr(substring, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(substring, "GATHER", 300)
    monkeypatch.setattr(suffix, "RUN_ROWS", 4)
    rng = random.Random(9)
    vocab = plain.vocabulary(rng)
    say = lambda k: [rng.choice(vocab) for _ in range(k)]
    fifty, crowd = say(50), say(90)
    rows = []
    for i in range(12):
        rows.append(" ".join(say(20) + fifty[: 49 + i % 3] + say(15)))
    for i in range(40):
        changed = list(crowd)
        if i % 4:
            changed[rng.randrange(90)] = f"x{i}"
        rows.append(" ".join(changed))
    rows += [" ".join(["same"] * 200), " ".join(["same"] * 130), " ".join(crowd + crowd)]
    # one word many times, in several places of a text and of its copies
    for word in ("same", "w", "x7", "other"):
        long = [word] * 90 + say(9) + [word] * 70 + say(60) + [word] * 90 + say(7)
        rows += [" ".join([word] * 60 + say(5)), " ".join(long), " ".join(long), " ".join(say(3) + long)]
    rows = list(enumerate(rows))
    check(operator(docs(rows, partitions=5)).collect(), rows)


@pytest.mark.parametrize("operator", OPERATORS)
def test_missing_and_repeated_ids(docs, operator):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text), (5, text), (5, text + " more"), (None, text), (None, "short"), (7, None)]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in operator(docs(rows)).collect())
    # rows of one id do not remove each other's words, rows without id are last
    assert found == [(False, 5, 80, 0), (False, 5, 80, 0), (False, 5, 81, 0), (False, 7, 0, 0), (True, 0, 1, 0), (True, 0, 80, 80)]


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty_tables(docs, operator):
    assert operator(docs([])).count() == 0
    assert [tuple(r)[:4] for r in operator(docs([(1, None), (2, "")])).sort("doc_id").collect()] == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_estimates_are_never_too_low(monkeypatch):
    """A sketch far too small for its windows still names all that occur twice."""
    monkeypatch.setattr(substring, "WIDTH_BITS", 8)
    rng = np.random.default_rng(1)
    parts = [np.sort(rng.choice(2**32, 400, replace=False).astype(np.uint32)) for _ in range(4)]
    parts[2][:50] = parts[1][:50]
    parts = [np.sort(p) for p in parts]
    sketches = pd.DataFrame({"block": 0, "g": range(4), "cells": [substring.squeezed(np.diff(p, prepend=np.uint32(0))) for p in parts]})
    out = substring.merged(sketches)
    named = {r.g: dict(zip(np.cumsum(substring.unsqueezed(r.cells), dtype=np.uint32), substring.unsqueezed(r.estimates))) for r in out.itertuples()}
    flat, counts = np.unique(np.concatenate(parts), return_counts=True)
    for value, n in zip(flat, counts):
        if n >= 2:
            assert all(named[g][value] >= n for g, p in enumerate(parts) if value in p)


def test_counts_of_a_group_are_added_and_do_not_wrap():
    """Windows that occur several times in a group are listed once, with their count."""
    listed = np.array([3, 70_000, 2**31], dtype=np.uint32)
    cells = substring.squeezed(np.diff(listed, prepend=np.uint32(0)))
    often = substring.squeezed(np.array([1, 2, substring._FULL]))
    sketches = pd.DataFrame({"block": 5, "g": [0, 1, 2], "cells": cells, "times": [None, often, often]})
    out = substring.merged(sketches)
    assert out[["g", "block"]].values.tolist() == [[0, 5], [1, 5], [2, 5]]
    for r in out.itertuples():
        assert np.cumsum(substring.unsqueezed(r.cells), dtype=np.uint32).tolist() == listed.tolist()
        assert substring.unsqueezed(r.estimates).tolist() == [3, 5, substring._FULL]


def test_sketch_rows_grow_with_groups_and_blocks_not_with_tasks(docs, monkeypatch):
    """One row for a group and a block, however the documents are dealt; a common passage is in it once."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", 30_000)
    monkeypatch.setattr(substring, "BLOCK_BYTES", 40_000)
    made = []

    def kept(*args, real=substring.partition_sketches):
        made.append(real(*args))
        return made[-1]

    monkeypatch.setattr(substring, "partition_sketches", kept)
    rng = random.Random(3)
    common = " ".join(f"c{i}" for i in range(60))
    rows = [(i, " ".join([common, *(f"w{rng.randrange(10**6)}" for _ in range(120))])) for i in range(120)]
    n_bytes = sum(len(text) for _, text in rows)
    groups, blocks = -(-n_bytes // 30_000), -(-n_bytes // 40_000)
    found = []
    for dealt in (2, 9):
        substring.substring_dedup(docs(rows, partitions=dealt))
        sketches = made[-1].toPandas()
        assert len(sketches) <= groups * blocks
        for cells in sketches["cells"]:
            assert (substring.unsqueezed(cells)[1:] > 0).all()
        found.append(sorted(zip(sketches["block"], sketches["g"], sketches["cells"])))
    assert found[0] == found[1]
    # all windows are counted
    listed = sum(len(substring.unsqueezed(cells)) for cells in sketches["cells"])
    repeated = sum(int((substring.unsqueezed(n) - 1).sum()) for n in sketches["times"].dropna())
    assert listed + repeated == 120 * (180 - 49)


def test_equal_words_have_equal_window_hashes():
    rng = random.Random(1)
    hashes_of = lambda text: next(repeats.word_hashes([text]))
    words = [rng.choice("abc") for _ in range(300_000)]
    windows = repeats.window_hashes(hashes_of(" ".join(words).encode()), 7)
    names = [tuple(words[i : i + 7]) for i in range(len(words) - 6)]
    keys = [tuple(x) for x in windows.tolist()]
    assert len(set(names)) == len(set(keys)) == len(set(zip(names, keys)))


def test_long_texts_are_hashed_in_parts(monkeypatch):
    hashes = next(repeats.word_hashes([" ".join(str(i % 977) for i in range(5000)).encode()]))
    whole = repeats.window_hashes(hashes, 50)
    monkeypatch.setattr(repeats, "_CHUNK", 64)
    assert np.array_equal(repeats.window_hashes(hashes, 50), whole)


def test_every_window_has_a_minimiser_of_its_own():
    rng = random.Random(4)
    grams_of = lambda h: repeats.window_hashes(h[:, :1], suffix.GRAM)[:, 0]
    for _ in range(20):
        hashes = next(repeats.word_hashes([" ".join(rng.choice("abcdef") for _ in range(rng.randint(50, 300))).encode()]))
        found = suffix.minimiser_of(grams_of(hashes), len(hashes) - 49, 50)
        assert len(found) == len(hashes) - 49
        for s, p in enumerate(found):
            # inside the window with the words that are compared, and the same for the window alone
            assert s <= p <= s + 50 - suffix.SHARED
            assert suffix.minimiser_of(grams_of(hashes[s : s + 50]), 1, 50)[0] == p - s
    with pytest.raises(ValueError):
        suffix.suffix_dedup(None, size=10)


@pytest.mark.parametrize("operator", OPERATORS)
@pytest.mark.parametrize("seed", range(3))
def test_overlapping_passages(docs, operator, seed):
    """Stretches of a few common texts, so that windows are shared by changing sets of documents."""
    rng = random.Random(seed)
    vocab = plain.vocabulary(rng)
    sources = [[rng.choice(vocab) for _ in range(400)] for _ in range(3)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 3)):
            source = rng.choice(sources)
            at = rng.randrange(300)
            words += source[at : at + rng.randint(40, 120)]
        rows.append((i, " ".join(words)))
    check(operator(docs(rows)).collect(), rows)


def test_word_hashes_depend_on_the_word_alone():
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab é\t\n 你") for _ in range(rng.randint(0, 400))).encode() for _ in range(200)]
    texts += [None, b"", b" ", b"x" * 200_000 + b" y " + b"x" * 200_000, b"z " * 100_000]
    seen, count = {}, 0
    for text, hashes in zip(texts, repeats.word_hashes(texts)):
        words = (text or b"").split()
        assert len(words) == len(hashes)
        for word, h in zip(words, hashes.tolist()):
            assert seen.setdefault(word, h) == h
    assert len({tuple(h) for h in seen.values()}) == len(seen)
    assert len({h[0] for h in seen.values()}) == len({h[1] for h in seen.values()}) == len(seen)
