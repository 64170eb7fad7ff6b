"""Ids of whole texts by a sentencepiece BPE model, and texts of ids, in vectorised merge rounds.

The texts of a batch are one array of bytes. It is cut wherever two neighbouring bytes occur side by side in no piece,
for no merge can reach over such a place; words are what is left, and each distinct one is encoded once and remembered
up to a bound. All new words are merged together, as one flat array of symbols:

* the smallest rank among the pairs of each word is a segmented minimum;
* all pairs of that rank are merged at once, leftmost first where they overlap. A merge whose new neighbours would rank
  as well or better comes before all pairs right of it, so those wait for the next round: this is the order in which
  the library merges, one pair at a time;
* the array is compacted, and words without a pair leave it.

A character that is no piece becomes the pieces of its UTF-8 bytes. Decoding gathers the bytes of the pieces; bytes that
aren't UTF-8 become U+FFFD each. A model whose texts are changed by more than the word mark, or that isn't BPE with byte
pieces, is refused when it is loaded: its probes would differ from the library's own.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_texts, named, plain

MARK = "▁"
#: Words that a task remembers, and the bytes of the longest of them; beyond that it starts anew.
CACHED_WORDS, CACHED_BYTES = 100_000, 64
#: Texts of one pass hold about so many bytes; a longer text is a pass of its own.
PASS_BYTES = 1 << 20
NO_PAIR = np.iinfo(np.int32).max
PROBES = [
    "", " ", "Hello  world\n\tagain", "   three spaces, a tab\t and ﬁ ① 　x", "naïve café 日本語 \U0001f600 \U00013000",
    "x" * 40 + " " * 40 + "aaaa bbbb", f"a{MARK}b <s> </s> <unk> <0x41>", "0123456789 3.14159 1,000,000 e-mail@example.org",
]


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("ledgerloom.one_by_one", _one_by_one)


class PairTable:
    """Merged piece and rank of a pair of symbols, by open addressing in arrays of four slots a pair."""

    def __init__(self, keys: np.ndarray, piece: np.ndarray, rank: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.piece, self.rank = np.zeros(1 << bits, np.int32), np.full(1 << bits, NO_PAIR, np.int32)
        left, slot = np.arange(len(keys)), self.slot(keys)
        while len(left):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] == -1]
            at = slot[first]
            self.keys[at], self.piece[at], self.rank[at] = keys[left[first]], piece[left[first]], rank[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of each key; the rank is ``NO_PAIR`` where there is none."""
        slot = self.slot(keys)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            open_ = open_[(held != keys[open_]) & (held != -1)]
        return self.piece[slot], self.rank[slot]


class PieceMerges:
    held: dict[str, PieceMerges] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.end = model.eos_id()
        plain_ = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        if any(model.is_unused(i) for i in range(n)) or not all(f"<0x{b:02X}>" in names for b in range(256)):
            raise ValueError("a model with all byte pieces and without unused ones is needed")
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbols = {names[i]: i for i in plain_}
        for i in plain_:
            for c in names[i]:
                symbols.setdefault(c, n + len(symbols))
        self.symbols = n + len(symbols) + 1  # the last one is any character that no piece has
        self.of_char = np.full(0x110000, self.symbols - 1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        order = np.unique([-model.get_score(i) for i in plain_], return_inverse=True)[1]
        pairs = [
            (symbols[names[i][:k]] * self.symbols + symbols[names[i][k:]], i, r)
            for i, r in zip(plain_, order, strict=True) for k in range(1, len(names[i]))
            if names[i][:k] in symbols and names[i][k:] in symbols
        ]
        self.pairs = PairTable(*(np.array(x, t) for x, t in zip(zip(*pairs, strict=True), (np.int64, np.int32, np.int32), strict=True)))
        # bytes that stand side by side in a piece, the mark written as a space; no character is cut
        beside = np.zeros(1 << 16, bool)
        for i in plain_:
            b = np.frombuffer(names[i].replace(MARK, " ").encode(), np.uint8).astype(np.int64)
            beside[b[:-1] << 8 | b[1:]] = True
        beside |= (np.arange(1 << 16) & 0xC0) == 0x80
        self.cut = ~beside
        # what ids decode to: bytes, and where they begin
        surface = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.marked = np.zeros(n, bool)
        self.marked[[i for i in plain_ if names[i].startswith(MARK)]] = True
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.words: dict[bytes, bytes] = {}
        for probe in PROBES:
            ids, bounds = self.encode([probe], end=False)
            expected = model.encode(probe)
            if ids.tolist() != expected or self.decode(ids, bounds) != [model.decode(expected)]:
                raise ValueError(f"{path} isn't a BPE model that this encoder can follow: {probe!r}")

    @classmethod
    def of(cls, path: str) -> PieceMerges:
        """One for each file and Python worker."""
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge the symbols of each word to the end: word, symbol and first place of what is left, by word.

        ``word`` numbers the words in ascending order, one number a symbol.
        """
        at = np.arange(len(symbols))
        piece, rank = self.beside(symbols, word, at[:-1])
        piece, rank = np.append(piece, 0), np.append(rank, NO_PAIR)
        done = []
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(word)))
            open_ = least < NO_PAIR
            if not open_.all():
                done.append((word[~open_], symbols[~open_], at[~open_]))
                symbols, word, at, piece, rank, least = (x[open_] for x in (symbols, word, at, piece, rank, least))
                if not len(symbols):
                    break
            # of neighbouring pairs of that rank, every second one from the left
            found = np.flatnonzero(rank == least)
            head = np.diff(found, prepend=-2) != 1
            chain = np.maximum.accumulate(np.where(head, np.arange(len(found)), 0))
            found = found[(np.arange(len(found)) - chain) % 2 == 0]
            found = self.in_order(found, symbols, word, piece, least)
            symbols[found] = piece[found]
            keep = np.ones(len(symbols), bool)
            keep[found + 1] = False
            moved = np.cumsum(keep)[found] - 1
            symbols, word, at, piece, rank = (x[keep] for x in (symbols, word, at, piece, rank))
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            inner = changed[changed < len(symbols) - 1]
            rank[changed] = NO_PAIR
            piece[inner], rank[inner] = self.beside(symbols, word, inner)
        if not done:
            return word, symbols, at
        word, symbols, at = (np.concatenate(x) for x in zip(*done, strict=True))
        by_word = np.argsort(word, kind="stable")
        return word[by_word], symbols[by_word], at[by_word]

    def beside(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of the pairs that begin at ``at``; none where a word ends."""
        piece, rank = self.pairs.find(symbols[at].astype(np.int64) * self.symbols + symbols[at + 1])
        return piece, np.where(word[at] == word[at + 1], rank, NO_PAIR)

    def in_order(self, found: np.ndarray, symbols: np.ndarray, word: np.ndarray, piece: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Of the pairs to merge, those that no better pair made by one of them must go before."""
        several = np.zeros(len(found), bool)
        same = word[found[1:]] == word[found[:-1]]
        several[:-1] |= same
        several[1:] |= same
        of = found[several]
        if not len(of):
            return found
        made = piece[of].astype(np.int64)
        left, right = np.maximum(of - 1, 0), np.minimum(of + 2, len(word) - 1)
        before = symbols[left].astype(np.int64)
        touching = np.flatnonzero(np.diff(of, prepend=-9) == 2)
        before[touching] = made[touching - 1]
        rank_left = np.where((left < of) & (word[left] == word[of]), self.pairs.find(before * self.symbols + made)[1], NO_PAIR)
        rank_right = np.where((right == of + 2) & (word[right] == word[of]), self.pairs.find(made * self.symbols + symbols[right])[1], NO_PAIR)
        stops = np.minimum(rank_left, rank_right) <= least[of]
        # stops before each one within its word
        total = np.cumsum(stops) - stops
        begin = np.flatnonzero(np.diff(word[of], prepend=-1))
        waits = total > np.repeat(total[begin], np.diff(begin, append=len(of)))
        kept = np.ones(len(found), bool)
        kept[np.flatnonzero(several)[waits]] = False
        return found[kept]

    def learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, as bytes of ``kind``; a space stands for the mark."""
        texts = [w.decode().replace(" ", MARK) for w in words]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        number = np.repeat(np.arange(len(words)), [len(t) for t in texts])
        word, symbols, at = self.merged(self.of_char[points], number)
        # characters without a piece become bytes
        bare = symbols >= self.size
        sizes, ids = np.ones(len(symbols), np.int64), symbols
        if bare.any():
            c = points[at[bare]].astype(np.int64)
            n = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            sizes[bare] = n
            ids = np.repeat(symbols, sizes)
            starts = (np.cumsum(sizes) - sizes)[bare]
            lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n]
            for k in range(4):
                has = n > k
                byte = (c[has] >> 6 * (n[has] - 1 - k)) & (0x3F if k else 0xFF)
                byte = byte | (lead[has] if k == 0 else 0x80)
                ids[starts[has] + k] = self.byte_ids[byte]
        ends = np.cumsum(np.bincount(word, weights=sizes, minlength=len(words)).astype(np.int64)) * self.kind.itemsize
        flat = ids.astype(self.kind).tobytes()
        return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]

    def words_of(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of all texts, each text with a mark before it, and where the words of each begin and end."""
        raw = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = self.cut[data[:-1].astype(np.int64) << 8 | data[1:]]
        begins[bounds] = True
        offsets = np.flatnonzero(begins)
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return words.dictionary_encode(), np.searchsorted(offsets, bounds)

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the bounds of each text's own."""
        found, bounds = self.words_of(texts)
        distinct = found.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.words]
        known = {w: self.words[w] for w in distinct if w in self.words}
        if new:
            known |= zip(new, self.learn(new), strict=True)
            short = [w for w in new if len(w) <= CACHED_BYTES]
            if len(self.words) + len(short) > CACHED_WORDS:
                self.words.clear()
            self.words.update((w, known[w]) for w in short[:CACHED_WORDS])
        ids = [known[w] for w in distinct]
        sizes = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        if end:  # an end id is a word of its own, behind those of each text
            ids.append(np.array([self.end], self.kind).tobytes())
            sizes = np.append(sizes, 1)
        flat, starts = np.frombuffer(b"".join(ids), self.kind), np.cumsum(sizes) - sizes
        word = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if end:
            word = np.insert(word, bounds[1:], len(sizes) - 1)
            bounds = bounds + np.arange(len(bounds))
        n = sizes[word]
        ends = np.cumsum(n)
        # place k of the gathered ids comes from its word's start, plus how far into the word it is
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[word] - (ends - n), n)
        return flat[source].astype(np.int32), np.concatenate([[0], ends])[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each stretch of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is none of the model's")
        n = self.surface_size[ids]
        ends = np.cumsum(n)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.surface_at[ids] - (ends - n), n)
        data = self.surface[source].tobytes()
        total = np.concatenate([[0], ends])
        begin, end = total[bounds[:-1]], total[bounds[1:]]
        # the mark that encoding has put before a text: that of the first piece with a text of its own
        shown = np.flatnonzero(n > 0)
        first = np.searchsorted(shown, bounds[:-1])
        own = first < len(shown)
        own[own] &= shown[first[own]] < bounds[1:][own]
        begin = begin.copy()
        begin[own] += self.marked[ids[shown[first[own]]]]
        # bytes on either side of an invisible id make no character together
        unseen = np.flatnonzero(n == 0)
        first_unseen = np.searchsorted(unseen, bounds)
        texts = []
        for k, (a, b) in enumerate(zip(begin, end, strict=True)):
            cuts = total[unseen[first_unseen[k]:first_unseen[k + 1]]]
            edges = [a, *cuts[(cuts > a) & (cuts < b)], b]
            texts.append("".join(data[x:y].decode(errors="ledgerloom.one_by_one") for x, y in zip(edges[:-1], edges[1:], strict=True)))
        return texts


def encode(docs: DataFrame, model: str, text_col: str = "text", out: str = "ids", end: bool = True,
           decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text, and the model's end id behind them if ``end``.

    ``decoded`` names a column for what these ids decode to, made in the same pass.
    A null text counts as empty: it has the end id alone. Other columns are passed on, one named ``out`` is replaced;
    rows are independent of each other, so repeated ones agree, and an empty table stays empty. A word without any
    place to cut (a text of millions of letters, say) is merged as one, round by round.
    """

    def ids(texts: list[str]) -> list:
        own = PieceMerges.of(model)
        flat, bounds = own.encode(texts, end)
        made = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))]
        return made if decoded is None else [*made, own.decode(flat, bounds)]

    return map_texts(docs, text_col, {out: "array<int>"} | ({} if decoded is None else {decoded: "string"}), ids, PASS_BYTES)


def decode(docs: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that each array of ids stands for; null ids and null arrays stand for nothing.

    Ids that encoding made give the text again, its word marks as spaces. Control ids are invisible. Other columns are
    passed on, one named ``out`` is replaced.
    """
    names = [c for c in docs.columns if c != out] if ids_col != out else docs.columns
    held = plain(docs.select(*map(named, names)))
    column, out_names = held.columns[names.index(ids_col)], [*held.columns, "n0"]
    schema = held.withColumn("n0", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.fill_null(batch.column(column), pa.scalar([], batch.column(column).type))
            flat = lists.flatten()
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            if flat.null_count:
                here = np.concatenate([[0], np.cumsum(flat.is_valid().to_numpy(zero_copy_only=False))])
                flat, bounds = flat.drop_null(), here[bounds]
            texts = PieceMerges.of(model).decode(flat.to_numpy(zero_copy_only=False).astype(np.int64), bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out_names)

    made = held.mapInArrow(run, schema).toDF(*names, "n0")
    return (made.drop(named(out)) if ids_col == out else made).withColumnRenamed("n0", out)
