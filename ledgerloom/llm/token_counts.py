"""How many tokens a unigram tokenizer gives a text, without making the tokens.

An Aho-Corasick automaton over the vocabulary finds every piece in a word; a Viterbi pass keeps, for each end, the best
score and the number of pieces on that path, and no path. Ties go as in the tokenizer: of pieces that end at one place,
the one that begins first is met first, and only a better score takes its place. A character without a piece of its own
may be taken as unknown, at the lowest score less ``UNKNOWN_PENALTY``; with byte fallback it counts as its UTF-8 bytes,
without it neighbouring unknowns count as one.

White space becomes the word mark, and no piece goes beyond a word, so that a text's count is the sum over its words,
each distinct one counted once and remembered up to a bound.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerloom.llm.common import map_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that one Python worker remembers, and the longest of them in characters.
CACHED_WORDS, CACHED_CHARS = 300_000, 64


def pieces_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounts:
    held: dict[tuple[str, bool], UnigramCounts] = {}

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        known = {piece for piece, _ in pieces}
        self.fallback = byte_fallback and all(f"<0x{b:02X}>" in known for b in range(256))
        # a character in no piece cuts a word in two that have nothing to do with each other
        self.line_cuts = self.fallback and not any("\n" in piece for piece, _ in pieces)
        self.words: dict[str, int] = {}

    @classmethod
    def of(cls, path: str, byte_fallback: bool = True) -> UnigramCounts:
        """One for each file and worker, so that later tasks find the words of earlier ones."""
        if (path, byte_fallback) not in cls.held:
            cls.held[path, byte_fallback] = cls(pieces_of(path), byte_fallback)
        return cls.held[path, byte_fallback]

    def best(self, segment: str) -> int:
        """Pieces on the best path through ``segment``."""
        n = len(segment)
        score, count, last_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        reached = 0  # ends up to here are settled

        def settle(upto: int) -> None:
            # ends without a piece of one character may also be reached by an unknown one
            nonlocal reached
            for end in range(reached + 1, upto + 1):
                begin = end - 1
                if not single[end]:
                    s = score[begin] + self.unknown
                    if count[end] == 0 or s > score[end]:
                        score[end], last_unknown[end] = s, True
                        if self.fallback:
                            count[end] = count[begin] + len(segment[begin].encode("utf-8", "surrogatepass"))
                        else:
                            count[end] = count[begin] + (not last_unknown[begin])
            reached = max(reached, upto)

        single = [False] * (n + 1)
        for at, (length, own) in self.automaton.iter(segment):
            end = at + 1
            if end > reached + 1:
                settle(end - 1)
            begin = end - length
            s = score[begin] + own
            if count[end] == 0 or s > score[end]:
                score[end], count[end], last_unknown[end] = s, count[begin] + 1, False
            if length == 1:
                single[end] = True
        settle(n)
        return count[n]

    def segment(self, segment: str) -> int:
        found = self.words.get(segment)
        if found is None:
            found = self.best(segment)
            if len(segment) <= CACHED_CHARS:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                self.words[segment] = found
        return found

    def word(self, word: str) -> int:
        """Pieces of a word, its mark before it."""
        if self.line_cuts and "\n" in word:
            head, *rest = word.split("\n")
            return self.segment(MARK + head) + len(rest) + sum(self.segment(x) for x in rest if x)
        return self.segment(MARK + word)

    def counts(self, texts: list[str]) -> np.ndarray:
        spaced = pc.replace_substring(pa.array(texts, pa.large_string()), MARK, " ")
        lists = pc.split_pattern(spaced, " ")
        found = lists.flatten().dictionary_encode()
        each = np.array([self.word(w) for w in found.dictionary.to_pylist()], dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(each[found.indices.to_numpy(zero_copy_only=False)])])
        bounds = lists.offsets.to_numpy()
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        # a text that begins with a space has its own mark there; an empty one has no piece
        extra = pc.starts_with(spaced, " ").to_numpy(zero_copy_only=False) | (pc.binary_length(spaced).to_numpy() == 0)
        return total - extra * self.segment(MARK)


def with_token_count(docs: DataFrame, vocabulary: str, text_col: str = "text", out: str = "n_tokens",
                     byte_fallback: bool = True) -> DataFrame:
    """``docs`` with the number of tokens of each text; a null or empty text has none.

    Every row is counted by its text alone, so repeated rows agree. Other columns are
    passed on; one named ``out`` is replaced.
    """
    return map_texts(docs, text_col, {out: "long"}, lambda texts: [UnigramCounts.of(vocabulary, byte_fallback).counts(texts)], 1 << 22)
