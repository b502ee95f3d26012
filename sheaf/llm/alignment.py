"""Alignment of the tokens that two tokenizers give for the same bytes.

The cumulative ends of each tokenizer's tokens become a dictionary from end to index. The ends that both dictionaries
have, sorted, slice both id lists into groups; inside a group every pair of tokens whose bytes overlap is a link. How
many documents have a pair of ids linked is counted over the whole corpus, and each document gets sums over its links.

Texts are tokenized once. Documents stay in the blocks of their tasks: a block sends one row per distinct pair, so what
a pair common to all documents costs grows with the blocks, and gets back the counts of its own pairs.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate, islice
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sheaf.llm.common import hand_back, settle, spare_name

# Longer texts, in characters, are tokenized in parts of about half of it.
LONG = 200_000
# Characters of text that are aligned and handed on together.
TOGETHER = 1_000_000
# Bytes of packed links in a block, unless one document has more.
BLOCK_BYTES = 2_000_000
# Where both tokenizers cut: before a single space between two characters that are none.
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_BLANK = re.compile(r"[\s▁]").match
_NO_CUT = re.compile(r" [\s▁]|[\s▁] ")
# Parts that a task remembers; when there are more, it forgets the older half, which changes no result.
MEMO = 400_000


def _byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies are written in: printable Latin ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def parts_of(text: str) -> Iterator[str]:
    """A long text cut at places where no token crosses; each part but the first starts with a space."""
    at = 0
    while len(text) - at > LONG:
        cut = _CUT.search(text, at + LONG // 2)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def words_of(text: str) -> list[str]:
    """A text that is not empty cut at all such places, without the spaces there."""
    if text[0] in " \n" or text[-1] == " " or _NO_CUT.search(text):
        return _CUT.split(text)
    return text.split(" ")


def link_type(a_size: int, b_size: int) -> np.dtype:
    """Unsigned little-endian numbers that hold a pair of ids."""
    return np.dtype("<u4" if a_size * b_size <= 2**32 else "<u8")


class ByteTokens:
    """Byte-level BPE of a ``tokenizers`` file; strings of special tokens are plain text.

    Files of the plain form, with merges in the order of their ids and text cut by ``PATTERN``, are encoded by the same
    ranks in ``tiktoken``, which takes a third of the time. The tests hold both against each other.
    """

    # Fixed value: how byte-level BPE of this family cuts text.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given the cores to tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        known = _byte_characters()
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(known[c] for c in token) if all(c in known for c in token) else token.encode()
        self.ranks = self._ranks(json.loads(definition))

    def _ranks(self, definition: dict):
        """The encoding by ranks, None if the file has another form."""
        import tiktoken

        model, cut = definition["model"], definition.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not model.get("dropout") and not definition.get("normalizer")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        order = [model["vocab"].get(a + b, -1) for a, b in merges] if plain else []
        if not plain or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
            return None
        if order != sorted(order) or order[:1] != [256] or len(set(order)) != len(order):
            return None
        ranks = {self.bytes[i]: i for i in (*range(256), *order)}
        return tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of each text with a space in front."""
        parts, counts = [], []
        for text in texts:
            own = list(parts_of(" " + text))
            parts += own
            counts.append(len(own))
        if self.ranks:
            found = map(self.ranks.encode_ordinary, parts)
        else:
            found = (e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False))
        return [next(found) if n == 1 else [i for _ in range(n) for i in next(found)] for n in counts]


class PieceTokens:
    """BPE pieces of a sentencepiece model that puts a space in front of a text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        as_byte = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
        self.bytes = [
            bytes.fromhex(m[1]) if (m := as_byte(piece)) else piece.replace("▁", " ").encode() for piece in pieces
        ]

    def ids(self, texts: Sequence[str]) -> list[list[int]]:
        parts, counts = [], []
        for text in texts:
            own = list(parts_of(text))
            parts += [own[0], *(part[1:] for part in own[1:])]  # the model puts the space back
            counts.append(len(own))
        found = iter(self.model.encode(parts, num_threads=1))
        return [next(found) if n == 1 else [i for _ in range(n) for i in next(found)] for n in counts]


def piece_count(piece_model: str) -> int:
    """Size of the vocabulary of a model file."""
    return PieceTokens(Path(piece_model).read_bytes()).size


class Aligner:
    """Groups and links of texts for two tokenizers, each with ``ids``, ``bytes`` of its tokens and ``size``.

    A text is cut wherever no token crosses, mostly between words; groups and links of such parts are remembered, and
    those of a text are put together from its parts.
    """

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.a_lengths, self.b_lengths = [len(t) for t in a.bytes], [len(t) for t in b.bytes]
        self.code = link_type(a.size, b.size)
        # part to numbers of tokens and groups, groups and links; None where its bytes are not given back
        self.memo: dict[str, tuple[int, int, int, str, bytes] | None] = {}

    def __call__(self, texts: Sequence[str | None]) -> list[tuple[int, int, int, int, str, bytes]]:
        """``(n_a, n_b, n_groups, n_links, groups, links)`` of each text."""
        parts = [words_of(text) if text else [] for text in texts]
        if len(self.memo) > MEMO:  # the older half goes
            self.memo = dict(islice(self.memo.items(), len(self.memo) - MEMO // 2, None))
        self.learn(list({part for own in parts for part in own}.difference(self.memo)))
        return [self.joined(text, own) if own else _NONE for text, own in zip(texts, parts)]

    def joined(self, text: str, parts: list[str]) -> tuple[int, int, int, int, str, bytes]:
        known = list(map(self.memo.__getitem__, parts))
        if None in known:
            found = self.aligned([text])
            known = [found[0]] if found else []
        if not known:
            return _NONE
        n_a, n_b, n_groups, groups, links = zip(*known)
        links = b"".join(links)
        return sum(n_a), sum(n_b), sum(n_groups), len(links) // self.code.itemsize, ";".join(groups), links

    def learn(self, parts: list[str]) -> None:
        """Align parts, many in one text; one by one where that does not give back its bytes or has no cut."""
        some, size = [], 0
        for part in parts:
            if _BLANK(part[0]) or _BLANK(part[-1]):
                self.memo[part] = (self.aligned([part]) or [None])[0]
                continue
            some.append(part)
            size += len(part) + 1
            if size > 20_000:
                self._learn_together(some)
                some, size = [], 0
        if some:
            self._learn_together(some)

    def _learn_together(self, parts: list[str]) -> None:
        found = self.aligned(parts) or [(self.aligned([part]) or [None])[0] for part in parts]
        self.memo.update(zip(parts, found, strict=True))

    def aligned(self, parts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """``(n_a, n_b, n_groups, groups, links)`` of each part of a text, nothing if its bytes are not given back."""
        text = " ".join(parts)
        (a,), (b,) = self.a.ids([text]), self.b.ids([text])
        whole = b" " + text.encode("utf-8", "replace")
        if b"".join(map(self.b.bytes.__getitem__, b)) != whole or b"".join(map(self.a.bytes.__getitem__, a)) != whole:
            return []
        a_ends, b_ends = list(accumulate(map(self.a_lengths.__getitem__, a))), list(accumulate(map(self.b_lengths.__getitem__, b)))
        a_at, b_at = dict(zip(a_ends, range(1, len(a) + 1))), dict(zip(b_ends, range(1, len(b) + 1)))
        part_ends = iter(accumulate(len(part.encode("utf-8", "replace")) + 1 for part in parts))
        size, code = self.b.size, "I" if self.code.itemsize == 4 else "Q"
        found, groups, links = [], [], []
        i = j = first_a = first_b = 0
        part_end = next(part_ends)
        for end in sorted(a_at.keys() & b_at.keys()):
            x, y = a_at[end], b_at[end]
            if x == i + 1 and y == j + 1:
                groups.append(f"{a[i]}|{b[j]}")
                links.append(a[i] * size + b[j])
            else:
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                while i < x and j < y:  # tokens that overlap, the one that ends first is left behind
                    links.append(a[i] * size + b[j])
                    p, q = a_ends[i], b_ends[j]
                    i += p <= q
                    j += q <= p
            i, j = x, y
            if end == part_end:
                found.append((i - first_a, j - first_b, len(groups), ";".join(groups), array(code, links).tobytes()))
                groups, links, first_a, first_b, part_end = [], [], i, j, next(part_ends, -1)
        return found


_NONE = (0, 0, 0, 0, "", b"")
_ADDED = ("n_a", "n_b", "n_groups", "n_links", "groups", "links")


def align(docs: DataFrame, byte_tokenizer: str, piece_model: str) -> DataFrame:
    """``docs`` with ``n_a, n_b, n_groups, n_links, groups, links``; columns of these names are replaced, others passed on.

    ``docs`` has ``text``. Tokens ``a`` are those of the byte-level BPE for the text with a space in front, tokens ``b``
    those of the piece model, which adds the space. ``groups`` lists the ids between ends that both have, as in
    ``a1,a2|b1;a3|b2,b3``. ``links`` are the pairs of tokens whose bytes overlap, in their order: numbers ``a * size + b``
    of :func:`link_type`, with the size of the piece vocabulary.

    NULL and empty texts, and those that either tokenizer does not give back byte by byte, have no tokens: zeros, no
    groups and no links. Long texts are tokenized in parts cut where no token crosses. Rows alike get alike results. The
    vocabularies are read by the driver and sent with the tasks; their size does not depend on the documents.
    """
    context = docs.sparkSession.sparkContext
    definition, model = context.broadcast(Path(byte_tokenizer).read_text()), context.broadcast(Path(piece_model).read_bytes())

    def aligned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(ByteTokens(definition.value), PieceTokens(model.value))
        for texts in batches:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text or "")
                if size > TOGETHER:
                    yield pd.DataFrame(aligner(held), columns=_ADDED)
                    held, size = [], 0
            yield pd.DataFrame(aligner(held), columns=_ADDED)
            del texts, held
            hand_back()
        del aligner
        hand_back()

    made = F.pandas_udf(
        aligned, "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary"
    )
    name = spare_name(docs, "_aligned")
    kept = [c for c in docs.columns if c.lower() not in _ADDED]
    return docs.withColumn(name, made("text")).select(*kept, f"{name}.*")


def _in_blocks(links: str, block: str):
    """Number the rows of a task by blocks, in a column ``block``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, current, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            numbers, all_packed = np.empty(batch.num_rows, dtype=np.int64), []
            place = batch.schema.get_field_index(links)
            for at, (own, n) in enumerate(zip(batch.column(place).to_pylist(), batch.column("n_links").to_pylist())):
                packed = packed_pairs(own or b"", n)
                if size and size + len(packed) > BLOCK_BYTES:
                    current, size = current + 1, 0
                size += len(packed) + 64
                numbers[at] = current
                all_packed.append(packed)
            batch = batch.set_column(place, batch.schema.field(place), pa.array(all_packed, pa.binary()))
            yield batch.append_column(block, pa.array((task << 32) + numbers))
            hand_back()

    return number


def packed_pairs(links: bytes, n: int) -> bytes:
    """The pairs of a row in order, as compressed differences, a plane for each of their bytes."""
    if not links:
        return b""
    code = np.dtype("<u4" if len(links) == 4 * n else "<u8")
    steps = np.diff(np.sort(np.frombuffer(links, dtype=code)), prepend=code.type(0))
    return bytes([code.itemsize]) + zlib.compress(steps.view(np.uint8).reshape(-1, code.itemsize).T.tobytes(), 1)


def pairs_of(packed: bytes | None) -> np.ndarray:
    if not packed:
        return np.zeros(0, dtype=np.int64)
    planes = np.frombuffer(zlib.decompress(packed[1:]), dtype=np.uint8).reshape(packed[0], -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{packed[0]}").ravel().astype(np.int64))


def _pair_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``block, pair, n``: in how many rows of a block a pair is linked; the rows of a block come one after the other."""
    block, held = None, []

    def counted() -> pd.DataFrame:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"block": block, "pair": pairs.astype(np.int64), "n": n})

    for batch in batches:
        for own, links in zip(batch["block"].tolist(), batch["links"]):
            if own != block and held:
                yield counted()
                held = []
            block = own
            if links:
                held.append(np.unique(pairs_of(links)))
        hand_back()
    if held:
        yield counted()


def weigh_links(aligned: DataFrame, piece_size: int) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` instead of ``links``, of any rows that :func:`align` made.

    A pair's count is the number of rows that have it linked. ``n_best`` is how many links of a row have the highest
    count of their ``a`` id, ties included; ``count_sum`` sums the counts over the links. Repeated rows each count. Rows
    without links have 0 of both, an empty table gives no rows. Other columns are passed on; columns ``n_best`` and
    ``count_sum`` are replaced.
    """
    rows = aligned.select(*[c for c in aligned.columns if c.lower() not in ("n_best", "count_sum")])
    links = next(c for c in rows.columns if c.lower() == "links")
    block = spare_name(rows, "_block")
    # written once: a block is what one task had, so it must not be put together again
    with_block = StructType([*rows.schema.fields, StructField(block, LongType())])
    rows = settle(rows.mapInArrow(_in_blocks(links, block), with_block))
    own_pairs = rows.select(F.col(block).alias("block"), F.col(links).alias("links"))
    sent = settle(own_pairs.mapInPandas(_pair_counts, "block bigint, pair bigint, n bigint"))
    counts = sent.groupBy("pair").agg(F.sum("n").alias("count"))
    a_id = F.expr(f"pair DIV {int(piece_size)}")
    best = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("best"))
    is_best = (F.col("count") == F.col("best")).alias("is_best")
    known = counts.withColumn("a", a_id).join(best, "a").select("pair", "count", is_best)
    back = sent.select("block", "pair").join(known, "pair")

    def summed(own: pa.Table, counts: pa.Table) -> pa.Table:
        pairs, n, is_best = (counts.column(c).to_numpy() for c in ("pair", "count", "is_best"))
        order = np.argsort(pairs)
        pairs, n, is_best = pairs[order], n[order], is_best[order]
        n_best, sums = [], []
        for packed in own.column(links).to_pylist():
            at = np.searchsorted(pairs, pairs_of(packed))
            n_best.append(int(is_best[at].sum()))
            sums.append(int(n[at].sum()))
        hand_back()
        out = own.drop_columns([links, block])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    fields = [f for f in rows.schema.fields if f.name not in (links, block)]
    schema = StructType([*fields, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    return rows.groupBy(block).cogroup(back.groupBy("block")).applyInArrow(summed, schema)
