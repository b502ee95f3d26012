"""Words of documents that passages of benchmark items cover, found by Wu-Manber search for all passages at once.

A test string is a window of ``size`` consecutive words of an item, or a shorter item whole. The alphabet is words, told
apart by 64-bit hashes until the end. For the test strings of one length there is a shift table over hashed blocks of
two words: how far the place of search may move on without passing an occurrence. Where it may not move, the blocks that
end and start the window select a bucket of test strings, and those are compared word by word with the text.

Many stretches of text are searched side by side, so a step of all of them is a handful of array operations.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, spare_name
from sheaf.llm.repeats import _words_of, mixed

SIZE = 10
# Bytes of item text in one set of tables, which is what is broadcast at a time. More items make more sets.
SET_BYTES = 2_000_000
# Sets of tables that a task keeps; with more it builds each set again for every batch of documents.
KEPT_SETS = 8
# Places that a stretch of text is searched at; bytes of text that are searched together.
STRETCH = 256
TOGETHER = 4_000_000
# Pairs of a place and a test string that are looked up at a time.
PAIRS = 1_000_000

# Bytes of words: digits, letters in lower case, and all of characters beyond ASCII; others are blanks here.
_LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def plain_text(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case and a blank for each byte that is in no word."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER)


def test_strings(items: Sequence[tuple[str | None, str | None]], size: int = SIZE) -> dict[bytes, set[int]]:
    """Test strings, words joined by one space, with the numbers of the items that have them."""
    found: dict[bytes, set[int]] = {}
    for number, (_, text) in enumerate(items):
        words = plain_text(text).split()
        if words:
            for at in range(max(len(words) - size, 0) + 1):
                found.setdefault(b" ".join(words[at : at + size]), set()).add(number)
    return found


class Tables:
    """Shift table and buckets for test strings of ``length`` words each."""

    def __init__(self, length: int, strings: Sequence[bytes]):
        self.length, self.strings = length, strings
        self.block = min(2, length)
        _, hashes = _words_of(b" ".join(strings), 1)
        blocks = self._blocks(hashes[:, 0].reshape(len(strings), length))
        places = blocks.shape[1]
        self.bits = np.uint64(64 - min(max(12, int(8 * blocks.size).bit_length()), 22))
        self.shift = np.full(1 << (64 - int(self.bits)), places, dtype=np.int32)
        for place in range(places):  # the last place of a block counts, so it comes last
            self.shift[self._slot(blocks[:, place])] = places - 1 - place
        ends = mixed(blocks[:, -1] * _FACTOR + blocks[:, 0])
        self.order = np.argsort(ends, kind="stable")
        self.ends = ends[self.order]

    def _blocks(self, hashes: np.ndarray) -> np.ndarray:
        return hashes if self.block == 1 else mixed(hashes[..., :-1] * _FACTOR + hashes[..., 1:])

    def _block_at(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Blocks that end at the given words."""
        return hashes[at] if self.block == 1 else mixed(hashes[at - 1] * _FACTOR + hashes[at])

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return mixed(blocks * _FACTOR) >> self.bits

    def places(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words where a window ends whose last block ends a test string; texts are ``begins`` to ``ends``, end excluded."""
        first = begins + self.length - 1
        counts = np.maximum(ends - first, 0)
        stretches = -(-counts // STRETCH)
        number = np.arange(int(stretches.sum())) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = np.repeat(first, stretches) + number * STRETCH
        stop = np.minimum(at + STRETCH, np.repeat(ends, stretches))
        found = []
        while len(at):
            step = self.shift[self._slot(self._block_at(hashes, at))]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def matches(self, text: "Searched", begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``last words, numbers of test strings`` of all occurrences in the texts."""
        at = self.places(text.hashes, begins, ends)
        last = self._block_at(text.hashes, at)
        start = self._block_at(text.hashes, at - self.length + self.block)
        keys = mixed(last * _FACTOR + start)
        low = np.searchsorted(self.ends, keys, "left")
        sizes = np.searchsorted(self.ends, keys, "right") - low
        at, low, sizes = at[sizes > 0], low[sizes > 0], sizes[sizes > 0]
        cut = np.searchsorted(np.cumsum(sizes), np.arange(PAIRS, int(sizes.sum()) + PAIRS, PAIRS))
        begin = 0
        for end in np.unique(np.minimum(cut + 1, len(at))).tolist():
            n = sizes[begin:end]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            string = self.order[np.repeat(low[begin:end], n) + inside]
            words = [text.words(w - self.length + 1, w) for w in at[begin:end].tolist()]
            place = np.repeat(np.arange(end - begin), n)
            same = [words[p] == self.strings[s] for p, s in zip(place.tolist(), string.tolist())]
            same = np.array(same, dtype=bool)
            yield at[begin:end][place[same]], string[same]
            begin = end


class Searched:
    """Some texts, one after the other, with the places and hashes of their words."""

    def __init__(self, texts: Sequence[bytes]):
        self.whole = b" ".join(texts)
        self.starts, hashes = _words_of(self.whole, 1)
        self.hashes = hashes[:, 0]
        offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])
        self.edges = np.searchsorted(self.starts, offsets)

    def words(self, first: int, last: int) -> bytes:
        end = self.whole.find(b" ", self.starts[last])
        return b" ".join(self.whole[self.starts[first] : end if end >= 0 else None].split())


class Searcher:
    """All test strings of a set of items."""

    def __init__(self, items: Sequence[tuple[str | None, str | None]], size: int = SIZE):
        self.ids = [item for item, _ in items]
        by_length: dict[int, list[bytes]] = {}
        found = test_strings(items, size)
        for string in found:
            by_length.setdefault(string.count(b" ") + 1, []).append(string)
        self.tables = [Tables(length, strings) for length, strings in by_length.items()]
        self.items_of = [[found[string] for string in tables.strings] for tables in self.tables]

    def search(self, text: Searched, cover: np.ndarray, items: dict[int, set[str]]) -> None:
        """Add to ``cover`` where occurrences start and end, and to ``items`` the ids of a text's items."""
        begins, ends = text.edges[:-1], text.edges[1:]
        for tables, items_of in zip(self.tables, self.items_of):
            for last, string in tables.matches(text, begins, ends):
                np.add.at(cover, last - tables.length + 1, 1)
                np.add.at(cover, last + 1, -1)
                doc = np.searchsorted(ends, last, "right")
                pairs = np.unique(doc * len(tables.strings) + string)
                for d, s in zip((pairs // len(tables.strings)).tolist(), (pairs % len(tables.strings)).tolist()):
                    own = items.setdefault(d, set())
                    own.update(self.ids[i] for i in items_of[s] if self.ids[i] is not None)


def searched(texts: Sequence[bytes], searchers) -> list[tuple[int, list[int], list[int], list[str]]]:
    """``words, starts, ends, items`` of each text; ``searchers()`` gives all of them, one after the other."""
    text = Searched(texts)
    cover = np.zeros(len(text.starts) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for searcher in searchers():
        searcher.search(text, cover, items)
    hit = np.cumsum(cover)[:-1] > 0
    # an occurrence lies in one text, but those of neighbouring texts may touch
    before = np.append(False, hit[:-1])
    after = np.append(hit[1:], False)
    inner = text.edges[(text.edges > 0) & (text.edges < len(hit))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    spans = np.searchsorted(starts, text.edges)
    out = []
    for number in range(len(texts)):
        begin, stop = int(text.edges[number]), int(text.edges[number + 1])
        own = slice(spans[number], spans[number + 1])
        out.append((stop - begin, (starts[own] - begin).tolist(), (ends[own] - begin).tolist(), sorted(items.get(number, ()))))
    return out


def item_sets(benchmark: DataFrame, set_bytes: int = SET_BYTES) -> Iterator[list[tuple[str | None, str | None]]]:
    """The distinct items ``(item_id, text)`` in their order, in sets of at most ``set_bytes`` unless one has more.

    Items pass through the driver a partition at a time, and a set is given away before the next one is gathered.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    held, held_bytes = [], 0
    for item in items.orderBy("item_id", "text").toLocalIterator():
        own = len(item["text"].encode("utf-8", "replace"))
        if held and held_bytes + own > set_bytes:
            yield held
            held, held_bytes = [], 0
        held.append(tuple(item))
        held_bytes += own
    if held:
        yield held


def covered_words(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_starts``, ``hit_ends`` and ``items``; columns of these names are replaced.

    ``docs`` has ``text``, ``benchmark`` has ``item_id`` and ``text``; other columns of ``docs`` are passed on. Words are
    runs of digits, letters and characters beyond ASCII, A-Z in lower case. ``hit_starts`` and ``hit_ends`` are the
    stretches of covered words, counted from 0, end excluded; ``items`` the ids as text, in order, of the items with an
    occurring test string. NULL and texts without a word have no words and no hits; so has an item. Items repeated or
    with equal texts each count by their id; those without an id cover words but are not listed. An empty benchmark
    covers nothing. Texts of any length are searched whole, rows alike get alike results, no row is shuffled.

    Items are sent with the tasks in sets of bounded size. A task searches each batch of documents for one set after the
    other, so its memory does not grow with the benchmark, and its time does by the number of sets.
    """
    context = docs.sparkSession.sparkContext
    sets = [context.broadcast(items) for items in item_sets(benchmark, set_bytes)]

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept = [Searcher(items.value, size) for items in sets] if len(sets) <= KEPT_SETS else None

        def searchers() -> Iterator[Searcher]:
            if kept is not None:
                yield from kept
                return
            for items in sets:
                yield Searcher(items.value, size)
                vars(items).pop("_value", None)  # the next use reads it from disk again

        for texts in batches:
            rows, held, held_bytes = [], [], 0
            for text in texts:
                held.append(plain_text(text))
                held_bytes += len(held[-1])
                if held_bytes > TOGETHER:
                    rows += searched(held, searchers)
                    held, held_bytes = [], 0
            if held:
                rows += searched(held, searchers)
            yield pd.DataFrame(rows, columns=["n_words", "hit_starts", "hit_ends", "items"])
            del rows, held
            hand_back()

    found = F.pandas_udf(search, "n_words bigint, hit_starts array<bigint>, hit_ends array<bigint>, items array<string>")
    name = spare_name(docs, "_found")
    kept_columns = [c for c in docs.columns if c.lower() not in ("n_words", "hit_starts", "hit_ends", "items")]
    return docs.withColumn(name, found("text")).select(*kept_columns, f"{name}.*")


def hit_words(starts: Column | str = "hit_starts", ends: Column | str = "hit_ends") -> Column:
    """Number of words in the stretches."""
    return F.aggregate(F.zip_with(ends, starts, lambda e, s: e - s), F.lit(0).cast("bigint"), lambda a, x: a + x)
