"""Token ids of whole texts by a tokenizer that never merges across white space, word by word with a bounded cache.

The words of a batch are told apart in Arrow, each distinct one is encoded once, and the texts' ids are gathered from
those of their words. A word in plain letters, with or without marks behind it, goes straight to the tokenizer's model;
any other goes through the whole tokenizer. So the ids are those that the tokenizer gives for the text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a task remembers, and runs of letters; beyond either it starts anew with them.
CACHED_WORDS = 500_000
CACHED_PARTS = 500_000
#: Precomposed Latin letters, which normalisation leaves as they are, and marks that no pattern treats alike.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: itself where it is printable, else from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


def packed(ids: list[int]) -> bytes:
    """Little-endian ids of two bytes; many short lists, for which numpy is slow."""
    found = array("H", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class WordTokens:
    held: dict[str, WordTokens] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of two bytes are taken")
        self.model = self.whole.model
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordTokens:
        """One for each file and Python worker."""
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def forget(self) -> None:
        """Give the words' memory back; a worker that waits for its next task needs none."""
        self.words.clear()
        self.parts.clear()

    def part(self, text: str) -> bytes:
        """Ids of a run of letters, or of marks, that the tokenizer takes as one."""
        written = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        found = self.parts[text] = packed([t.id for t in self.model.tokenize(written)])
        return found

    def learn(self, words: list[str]) -> None:
        odd, known, parts, matched = [], self.words, self.parts, PLAIN.fullmatch
        if len(parts) > CACHED_PARTS:
            parts.clear()
        for word in words:
            if m := matched(word):
                letters, marks = m.groups()
                letters = letters.lower()
                ids = parts.get(letters)
                if ids is None:
                    ids = self.part(letters)
                if marks:
                    more = parts.get(marks)
                    ids += self.part(marks) if more is None else more
                known[word] = ids
            elif word:
                odd.append(word)
            else:
                known[word] = b""
        for word, found in zip(odd, self.whole.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            known[word] = packed(found.ids)

    def encode(self, texts: list[str], end_id: int | None = None) -> list[bytes]:
        """Little-endian two-byte ids of each text, with ``end_id`` behind them."""
        end = b"" if end_id is None else np.array([end_id], "<u2").tobytes()
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        found = lists.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.words.get, distinct))
        missing = [w for w, known in zip(distinct, ids, strict=True) if known is None]
        if len(self.words) + len(missing) > CACHED_WORDS:
            self.words.clear()
        self.learn(missing)
        ids = [self.words[w] if known is None else known for w, known in zip(distinct, ids, strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        flat, starts = np.frombuffer(b"".join(ids), "<u2"), np.cumsum(sizes) - sizes
        at = found.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        ends = np.cumsum(n)
        # place k of the gathered ids comes from its word's start, plus how far into the word it is
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - n), n)
        gathered = flat[source]
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy()]
        return [gathered[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
