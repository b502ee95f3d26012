"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton lists all vocabulary pieces inside a word; dynamic programming carries the best score and
its number of pieces for each end, and no segmentation is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import hand_back, spare_name

# The mark in front of a word, and how far below the lowest score an unknown character lies.
WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Words remembered by a task; the memory is emptied when full, which changes no result.
MEMO_WORDS = 400_000


def read_pieces(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(model_path).read_bytes())
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Number of pieces and score of the best segmentation of a word, with the tie rules of unigram tokenizers.

    Candidates for an end are tried by ascending start and replace the best one only if strictly better, so the
    longest last piece wins a tie. A character that no piece of its own length covers may stand alone at the lowest
    score less ten; it counts as its UTF-8 bytes where the vocabulary has all of them (byte fallback), else a run of
    such characters counts as one unknown piece. Memory follows the longest piece, not the word.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max((len(piece) for piece, _ in pieces), default=1) or 1
        known = {piece for piece, _ in pieces}
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = all(f"<0x{b:02X}>" in known for b in range(256))
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, word: str) -> tuple[int, float]:
        """``(pieces, score)`` of one word, its mark included."""
        size = self.longest + 1
        # places behind the longest piece are never asked for again, so the last ``size`` ends are all that is kept
        score, count, tail_unknown = [0.0] * size, [0] * size, [False] * size
        matches = self.automaton.iter(word) if len(self.automaton) else iter(())
        match_end, match = next(matches, (-1, None))
        now = 0
        for end in range(1, len(word) + 1):
            best, start, unknown, single = None, 0, False, False
            while match_end == end - 1:  # longest first
                length, piece_score = match
                single = single or length == 1
                candidate = score[(end - length) % size] + piece_score
                if best is None or candidate > best:
                    best, start = candidate, (end - length) % size
                match_end, match = next(matches, (-1, None))
            if not single:
                candidate = score[(end - 1) % size] + self.unknown
                if best is None or candidate > best:
                    best, start, unknown = candidate, (end - 1) % size, True
            if not unknown:
                pieces = count[start] + 1
            elif self.byte_fallback:
                pieces = count[start] + len(word[end - 1].encode("utf-8", "replace"))
            else:
                pieces = count[start] + (0 if tail_unknown[start] else 1)
            now = end % size
            score[now], count[now], tail_unknown[now] = best, pieces, unknown
        return count[now], score[now]

    def __call__(self, text: str) -> tuple[int, int, float]:
        """``(words, pieces, score)`` of a text: its words, each with the mark in front, one by one."""
        memo, n_words, n_pieces, total = self.memo, 0, 0, 0.0
        for word in text.encode("utf-8", "replace").split():
            found = memo.get(word)
            if found is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                found = memo[word] = self.best(WORD_MARK + word.decode())
            n_words += 1
            n_pieces += found[0]
            total += found[1]
        return n_words, n_pieces, total


def count_tokens(docs: DataFrame, pieces: Sequence[tuple[str, float]], text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` and ``score`` of the whole text; columns of these names are replaced.

    NULL and texts without a word have 0 of each; repeated rows are counted row by row. Texts of any length are read word
    by word, and words of any length with the last few ends in memory. The vocabulary is sent
    with the tasks; its size does not depend on the documents.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(list(pieces))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = UnigramCounter(vocabulary.value)
        for texts in batches:
            yield pd.DataFrame([counter(text or "") for text in texts], columns=["n_words", "n_tokens", "score"])
            hand_back()
        del counter
        hand_back()

    counted = F.pandas_udf(count, "n_words bigint, n_tokens bigint, score double")
    name = spare_name(docs, "_counts")
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_tokens", "score")]
    return docs.withColumn(name, counted(text_column)).select(*kept, f"{name}.*")
