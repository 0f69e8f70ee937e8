"""BPE encoding and decoding in batched numpy merge rounds.

The vocabulary file is read once on the driver and its tables, whose size
the file fixes, are broadcast. A task encodes each distinct word of a batch
once: the symbols of all new words lie in one flat array, each round finds
every word's lowest-rank pair by binary search over the sorted pair keys
and merges all its occurrences, and words without a mergeable pair leave
the array.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, frugal, ship

NO_RANK = np.iinfo(np.int64).max
KNOWN_WORDS = 200_000    # distinct chunks a task remembers between batches
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes for themselves, the others in
    order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    chars = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


def _ranges(category: str) -> str:
    """Regex class body of all code points of a general category, by the
    Unicode version of this Python."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == category
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def word_pattern() -> str:
    """The vocabulary's split pattern with the classes L, N and \\s spelled
    out, so that tasks need the standard library only."""
    letters, numbers = _ranges("L"), _ranges("N")
    # Unicode White_Space
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+"


OTHER, LETTER, NUMBER = 0, 1, 2
# The endings that the split pattern takes with their apostrophe
SHORT, LONG = "stmd", ("re", "ve", "ll")


def letter_classes() -> np.ndarray:
    """Class of every code point in the split pattern's terms."""
    return np.frombuffer(bytes({"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
                               for c in range(sys.maxunicode + 1)), np.uint8)


def word_ends(text: str, cuts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Ends of the words of the split pattern in a text without white space,
    each of whose stretches up to the next of ``cuts`` is split on its own.

    A word is a run of letters, a number, a run of other characters, or an
    apostrophe that begins such a run with one of its endings.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes[codes]
    last = np.ones(len(codes), bool)
    last[:-1] = (kind[1:] != kind[:-1]) | (kind[:-1] == NUMBER)
    last[cuts - 1] = True
    mark = np.flatnonzero(codes == ord("'"))
    # one that ends a stretch has no ending, one inside a run is part of it
    mark = mark[(mark + 1 < len(codes)) & ((mark == 0) | last[mark - 1])]
    mark = mark[kind[np.minimum(mark + 1, len(codes) - 1)] == LETTER]
    if len(mark):
        inside = np.zeros(len(codes) + 1, bool)
        inside[cuts[cuts < len(codes)]] = True      # the first of a stretch
        mark = mark[~inside[mark + 1]]
        one = codes[mark + 1]
        short = np.isin(one, [ord(c) for c in SHORT])
        two = np.where((mark + 2 < len(codes)) & ~inside[np.minimum(mark + 2, len(codes))],
                       codes[np.minimum(mark + 2, len(codes) - 1)], 0)
        long_ = np.zeros(len(mark), bool)
        for a, b in LONG:
            long_ |= (one == ord(a)) & (two == ord(b))
        last[mark[short | long_]] = False
        last[mark[short] + 1] = True
        last[mark[long_] + 2] = True
    return np.flatnonzero(last) + 1


class Vocabulary:
    """Tables of a byte-level BPE file with a word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.pattern, self.classes = word_pattern(), letter_classes()
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        pairs = [(a, b) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]
                 for a, b in [m if isinstance(m, list) else m.split(" ")]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)     # by rank
        # ranks of two bytes side by side, the second inside a word or its last
        self.byte_ranks = np.stack([self.rank(np.repeat(self.inner, 256), np.tile(second, 256))
                                    for second in (self.inner, self.last)])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        names = [""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            names[i] = token
        self.names = [n.encode() for n in names]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)


def merge_rounds(vocab: Vocabulary, text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and the number of each word's.
    ``text`` is the words' UTF-8 without gaps, ``ends`` are their ends in
    characters."""
    if not len(ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.frombuffer(text, np.uint8)
    if ends[-1] != len(flat):
        first_bytes = np.flatnonzero((flat & 0xC0) != 0x80)
        ends = np.append(first_bytes, len(flat))[ends]
    sizes = np.diff(ends, prepend=0)
    ends = ends - 1
    symbol = vocab.inner[flat]
    symbol[ends] = vocab.last[flat[ends]]
    word = np.repeat(np.arange(len(ends)), sizes)
    rank = np.full(len(symbol), NO_RANK)
    inside = np.ones(len(symbol), bool)
    inside[ends] = False
    within = np.flatnonzero(inside)
    final = np.zeros(len(symbol), np.int64)
    final[ends] = 1
    rank[within] = vocab.byte_ranks[final[within + 1], flat[within].astype(np.int64) << 8 | flat[within + 1]]
    done_word, done_symbol = [], []
    while len(symbol):
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        counts = np.diff(starts, append=len(word))
        least = np.repeat(np.minimum.reduceat(rank, starts), counts)
        open_ = least != NO_RANK
        if not open_.all():
            done_word.append(word[~open_])
            done_symbol.append(symbol[~open_])
            word, symbol, rank, least = word[open_], symbol[open_], rank[open_], least[open_]
            if not len(symbol):
                break
        at = np.flatnonzero(rank == least)
        # of overlapping equal pairs (aaa) every other one, from the left
        first = np.r_[True, np.diff(at) != 1]
        run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        symbol[at] = vocab.merged[rank[at]]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        word, symbol, rank = word[keep], symbol[keep], rank[keep]
        rank[at] = NO_RANK
        touched = np.zeros(len(symbol), bool)
        touched[at] = True
        touched[:-1] |= touched[1:]     # each merged symbol and its left neighbour
        left = np.flatnonzero(touched[:-1])
        left = left[word[left] == word[left + 1]]
        rank[left] = vocab.rank(symbol[left], symbol[left + 1])
    word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
    order = np.argsort(word, kind="stable")
    return symbol[order], np.bincount(word, minlength=len(ends))


class Numbering(dict):
    """Chunks in the order they were first seen."""

    def __missing__(self, chunk: str) -> int:
        i = self[chunk] = len(self)
        return i


class Encoder:
    """Encodes texts by their chunks between white space. White space always
    ends a word, so a chunk has the same tokens wherever it stands, and runs
    of white space need no replacing."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.pattern = vocab, re.compile(vocab.pattern)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(vocab.special, key=len, reverse=True)))
                                   + ")") if vocab.special else None
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbering()
        self.flat, self.start, self.size = (np.empty(0, np.int64) for _ in range(3))

    def _chunks(self, text: str) -> list[str]:
        """Special tokens are cut out first; the rest is brought to NFC and
        lower-cased by character."""
        out: list[str] = []
        pieces = self.specials.split(text) if self.specials else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(piece)
            elif piece:
                # final sigma is a rule on words, not on characters
                piece = unicodedata.normalize("NFC", piece).replace("\u03a3", "\u03c3").lower()
                # split() also parts at these, which are no white space here
                out += self.pattern.findall(piece) if SEPARATORS.search(piece) else piece.split()
        return out

    def _learn(self) -> None:
        """Encode the chunks seen since the last call."""
        new = list(islice(self.numbers, len(self.start), None))
        if not new:
            return
        special = [k for k, chunk in enumerate(new) if chunk in self.vocab.special]
        plain = ["" if k in set(special) else chunk for k, chunk in enumerate(new)] if special else new
        # every character of a chunk lies in one of its words
        chunk_ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))
        joined = "".join(plain)
        ends = word_ends(joined, chunk_ends[chunk_ends > 0], self.vocab.classes) if joined else np.empty(0, np.int64)
        owner = np.searchsorted(chunk_ends, ends, "left")
        flat, sizes = merge_rounds(self.vocab, joined.encode(), ends)
        size = np.bincount(owner, sizes, len(new)).astype(np.int64)
        if special:
            at = (np.cumsum(size) - size)[special]
            flat = np.insert(flat, at, [self.vocab.special[new[k]] for k in special])
            size[special] = 1
        start = len(self.flat) + np.cumsum(size) - size
        self.flat, self.start, self.size = (np.concatenate(x) for x in (
            (self.flat, flat), (self.start, start), (self.size, size)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (unsigned 32-bit, little-endian) of each text."""
        if len(self.numbers) > KNOWN_WORDS:
            self._forget()
        found = []
        for text in texts:
            chunks = self._chunks(text)
            found.append(np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks)))
        self._learn()
        out = []
        for chunks in found:
            sizes = self.size[chunks]
            before = np.cumsum(sizes) - sizes
            at = np.repeat(self.start[chunks] - before, sizes) + np.arange(int(sizes.sum()))
            out.append(self.flat[at].astype("<u4"))
        return out


def decode(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    """The tokens' strings joined by spaces (the file names no decoder)."""
    return b" ".join(map(vocab.names.__getitem__, ids.tolist()))


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str | None = None) -> DataFrame:
    """``docs`` without the text and with its token ids.

    ``ids_col`` holds unsigned 32-bit little-endian ids as bytes, as many as
    the whole text gives; ``decoded_col``, if named, the text decoded from
    them again. A null text counts as empty and gives no ids. Strings of
    special tokens in a text become their ids. Other columns pass through.
    An input column that is already named like an output one is replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    made = [ids_col, *([decoded_col] if decoded_col else [])]
    passed = [c for c in docs.columns if c not in (text_col, *made)]
    table = ship(spark, Vocabulary(path))

    def scan(batches):
        vocab = table()
        encoder = Encoder(vocab)
        for batch in batches:
            ids = encoder.encode([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()])
            columns = [pa.array([i.tobytes() for i in ids], pa.binary())]
            if decoded_col:
                columns.append(pa.array([decode(vocab, i) for i in ids], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*passed, *made])

    source = docs.select(*[F.col(f"`{c}`") for c in passed],
                         F.col(text_col).cast("string").alias("__text"))
    schema = source.select(*[f"`{c}`" for c in passed]).schema.add(ids_col, "binary")
    if decoded_col:
        schema = schema.add(decoded_col, "string")
    return source.mapInArrow(frugal(scan), schema)


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``df`` with ``decoded_col``, the text of the ids of ``ids_col`` (null
    ids: empty); an input column of that name is replaced."""
    spark = df.sparkSession
    bound_batches(spark)
    passed = [c for c in df.columns if c != decoded_col]
    table = ship(spark, Vocabulary(path))
    at = passed.index(ids_col)

    def scan(batches):
        vocab = table()
        for batch in batches:
            texts = [decode(vocab, np.frombuffer(x or b"", "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                                             [*passed, decoded_col])

    source = df.select(*[f"`{c}`" for c in passed])
    return source.mapInArrow(frugal(scan), source.select("*").schema.add(decoded_col, "string"))
