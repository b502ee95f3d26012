import random
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import alignment


@pytest.fixture(scope="module")
def pair(tokenizer):
    a, b = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return a, b, alignment.piece_count(b)


@pytest.fixture(scope="module")
def encoders(pair):
    import sentencepiece
    import tiktoken  # noqa: F401
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(pair[0])
    bpe.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=pair[1])
    table = {}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = 0
    for byte in range(256):
        if byte in printable:
            table[chr(byte)] = byte
        else:
            table[chr(256 + other)] = byte
            other += 1

    def a(text):
        ids = bpe.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(table[c] for c in bpe.id_to_token(i))) for i in ids]

    def b(text):
        out = []
        for i in pieces.encode(text):
            piece = pieces.id_to_piece(i)
            as_byte = len(piece) == 6 and piece.startswith("<0x")
            out.append((i, bytes([int(piece[3:5], 16)]) if as_byte else piece.replace("▁", " ").encode()))
        return out

    return a, b


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(texts, encoders):
    """Every token pair of a text compared by its bytes."""
    rows, linked = [], []
    for text in texts:
        a, b = (encode(text) for encode in encoders) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(d for _, d in a) != whole or b"".join(d for _, d in b) != whole:
            a = b = []
        x, y = spans(a), spans(b)
        links = [(i, j) for i, s, e in x for j, t, f in y if s < f and t < e]
        common = sorted({e for *_, e in x} & {e for *_, e in y})
        groups, low = [], 0
        for high in common:
            side = [",".join(str(i) for i, s, e in z if low <= s and e <= high) for z in (x, y)]
            groups.append("|".join(side))
            low = high
        rows.append((len(a), len(b), len(groups), len(links), ";".join(groups)))
        linked.append(links)
    count = Counter(pair for links in linked for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (*row, sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)) for row, links in zip(rows, linked)
    ]


def inputs(seed=0):
    rng = random.Random(seed)
    vocab = ["the", "Straße", "naïve", "don't", "x=3;", "日本語", "emoji😀!", "<|endoftext|>", "</s>", "12345", "  ", "\n", "\t", "été"]
    texts = ["".join(rng.choice(vocab) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(40)]
    return [*texts, None, "", " ", "\n", "a▁b", "\x00 zero", *texts[:4], "plain words only", " leading", "trailing "]


def result(docs, pair, rows, extra=""):
    aligned = alignment.align(docs(rows, extra), pair[0], pair[1])
    return alignment.weigh_links(aligned, pair[2])


@pytest.mark.parametrize("block_bytes", [2_000_000, 300])
def test_groups_links_and_counts_against_all_token_pairs(docs, pair, encoders, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    texts = inputs()
    found = result(docs, pair, list(enumerate(texts)))
    rows = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in found.collect()}
    assert rows == dict(enumerate(brute(texts, encoders)))
    assert any(r[0] for r in rows.values()) and rows[texts.index("a▁b")] == (0, 0, 0, 0, "", 0, 0)


def test_links_are_in_order_and_name_their_ids(docs, pair, encoders):
    (row,) = alignment.align(docs([(1, "naïve words")]), pair[0], pair[1]).collect()
    links = [divmod(n, pair[2]) for n in struct.unpack(f"<{row.n_links}I", row.links)]
    x, y = (spans(encode("naïve words")) for encode in encoders)
    assert links == [(i, j) for i, s, e in x for j, t, f in y if s < f and t < e]


@pytest.mark.parametrize("seed", range(3))
def test_long_texts_in_parts_have_the_tokens_of_the_whole(pair, encoders, monkeypatch, seed):
    texts = [t * 6 for t in inputs(seed) if t and "▁" not in t and "\x00" not in t]
    monkeypatch.setattr(alignment, "LONG", 40)
    a = alignment.ByteTokens(open(pair[0]).read())
    b = alignment.PieceTokens(open(pair[1], "rb").read())
    assert sum(len(list(alignment.parts_of(t))) > 1 for t in texts) > 10
    assert a.ids(texts) == [[i for i, _ in encoders[0](t)] for t in texts]
    assert b.ids(texts) == [[i for i, _ in encoders[1](t)] for t in texts]


def test_both_ways_to_encode_give_the_same_ids(pair):
    texts = [t for seed in range(3) for t in inputs(seed) if t] + ["it's I'LL we'd  x\u00a0 \u00a0y\u2028 z\n\n q", "1²٣ _a_"]
    a = alignment.ByteTokens(open(pair[0]).read())
    by_ranks = a.ids(texts)
    assert a.ranks is not None
    a.ranks = None
    assert a.ids(texts) == by_ranks


def test_packed_pairs_come_back_in_order():
    for code in ("<u4", "<u8"):
        links = np.array([7, 2**31, 7, 0, 3], dtype=code)
        assert alignment.pairs_of(alignment.packed_pairs(links.tobytes(), 5)).tolist() == [0, 3, 7, 7, 2**31]
    assert len(alignment.pairs_of(alignment.packed_pairs(b"", 0))) == len(alignment.pairs_of(None)) == 0


def test_remembered_parts_change_nothing(pair, encoders, monkeypatch):
    texts = [t for seed in range(3) for t in inputs(seed)]
    expected = [row[:5] for row in brute(texts, encoders)]
    a = alignment.ByteTokens(open(pair[0]).read())
    b = alignment.PieceTokens(open(pair[1], "rb").read())
    for memo in (400_000, 20, 0):
        monkeypatch.setattr(alignment, "MEMO", memo)
        aligner = alignment.Aligner(a, b)
        found = [row for at in range(0, len(texts), 7) for row in aligner(texts[at : at + 7])]
        assert [row[:5] for row in found] == expected


def test_no_piece_crosses_a_cut(pair):
    b = alignment.PieceTokens(open(pair[1], "rb").read())
    a = alignment.ByteTokens(open(pair[0]).read())
    crossing = lambda piece: alignment._CUT.search(piece.decode("utf-8", "replace"))
    assert not any(crossing(p) for p in b.bytes) and not any(crossing(p) for p in a.bytes)


def test_very_long_texts(docs, pair):
    text = "some words of a text " * 60_000
    found = {r.doc_id: r for r in result(docs, pair, [(1, text), (2, "x" * 50_000), (3, "some words")]).collect()}
    assert found[1].n_links >= found[1].n_groups > 250_000 and found[1].count_sum >= found[1].n_links
    assert found[2].n_a > 0 and found[3].n_best == found[3].n_links


def test_pairs_common_to_all_rows_are_counted_per_block(docs, pair):
    rows = [(i, "the very same text") for i in range(300)]
    found = result(docs, pair, rows).collect()
    assert {(r.count_sum, r.n_best) for r in found} == {(300 * found[0].n_links, found[0].n_links)} and len(found) == 300


def test_odd_tables(docs, pair):
    rows = [(None, "some text", "k", 7), (4, None, "k", 7), (4, None, "k", 7)]
    found = result(docs, pair, rows, ", n_best string, _block int")
    assert found.columns == ["doc_id", "text", "_block", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert sorted((str(r.doc_id), r._block, r.n_a > 0, r.count_sum > 0) for r in found.collect()) == [
        ("4", 7, False, False), ("4", 7, False, False), ("None", 7, True, True),
    ]
    assert result(docs, pair, [(1, None)]).collect()[0].groups == ""
    none = alignment.align(docs([(1, "x")]).limit(0), pair[0], pair[1])
    assert alignment.weigh_links(none, pair[2]).collect() == []
