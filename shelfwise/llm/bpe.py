"""Byte-level BPE in batched numpy merge rounds, and its inverse.

The distinct words of a batch lie in one flat array of symbols. Each round looks up all neighbouring pairs by binary
search over the sorted pair keys of the vocabulary, takes the lowest rank of every word, and merges it everywhere in that
word; words without a known pair leave the array. What is already encoded is remembered, in tables of bounded size.

Defined results: a null text counts as empty and has no tokens. The text of a special token becomes that token, as in
the tokenizers library. Whole texts are encoded; memory is bounded by a portion of about two million characters or the
longest text.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .texts import appended

# How this kind of vocabulary cuts text into words before merging, with white space as Unicode defines it.
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
PIECES = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
REMEMBERED = 8_000_000  # characters of pieces, and of words, remembered with their ids; each counts as 50 more
SHIFT = 32


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable Latin-1, else the next free from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(free)) for byte in range(256)]


class Vocabulary:
    """The tables of a vocabulary file of the tokenizers library with byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        letters = byte_letters()
        self.of_byte = np.array([ids[letter] for letter in letters], np.int64)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in content["model"]["merges"]]
        keys = np.array([(ids[left] << SHIFT) | ids[right] for left, right in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([ids[left + right] for left, right in pairs], np.int64)[order]
        back = {letter: byte for byte, letter in enumerate(letters)}
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.bytes_of = {number: bytes(back[letter] for letter in token) for token, number in ids.items()}
        self.bytes_of |= {number: token.encode() for token, number in self.special.items()}
        self.words = regex.compile(WORDS)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.known = {token: np.int32(number).tobytes() for token, number in self.special.items()}
        self.of_word: dict[str, bytes] = {}
        self.known_size = self.of_word_size = 0

    def pieces(self, text: str) -> list[str]:
        """The text in pieces whose encoding does not depend on their neighbours: special tokens, runs of white space,
        and everything else up to the next white space with a space before it, if any."""
        if self.cut is None or not any(token in text for token in self.special):
            return PIECES.findall(text)
        found = []
        for part in self.cut.split(text):
            found.extend([part] if part in self.special else PIECES.findall(part))
        return found

    def learn(self, pieces: list[str]) -> None:
        """Remembers the ids of each piece, as bytes of int32; its words are encoded where they are new."""
        if self.known_size > REMEMBERED:
            self.known.clear()
            self.known |= {token: np.int32(number).tobytes() for token, number in self.special.items()}
            self.known_size = 0
        if self.of_word_size > REMEMBERED:
            self.of_word.clear()
            self.of_word_size = 0
        of_word = self.of_word
        words = [self.words.findall(piece) for piece in pieces]
        new = [word for word in set(itertools.chain.from_iterable(words)) if word not in of_word]
        if new:
            self.of_word_size += sum(map(len, new)) + 50 * len(new)
            raw = [word.encode() for word in new]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            symbols, ends = self.merge(self.of_byte[np.frombuffer(b"".join(raw), np.uint8)], sizes)
            data, start = symbols.astype(np.int32).tobytes(), 0
            for word, end in zip(new, (4 * ends).tolist()):
                of_word[word] = data[start:end]
                start = end
        self.known_size += sum(map(len, pieces)) + 50 * len(pieces)
        for piece, parts in zip(pieces, words):
            self.known[piece] = of_word[parts[0]] if len(parts) == 1 else b"".join([of_word[part] for part in parts])

    def found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the sorted keys; the number of keys for those that are none."""
        key = (left << SHIFT) | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, place, len(self.keys))

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged symbols of all words, and where each word ends."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        none = len(self.keys)
        ranks = np.append(self.ranks, none)

        def pairs_at(at: np.ndarray) -> np.ndarray:
            """The pairs beginning at these places, none across words."""
            after = np.minimum(at + 1, len(symbols) - 1)
            return np.where((after > at) & (owner[at] == owner[after]), self.found(symbols[at], symbols[after]), none)

        place = pairs_at(np.arange(len(symbols)))
        done_symbols, done_owner = [], []
        while len(symbols):
            rank = ranks[place]
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner))))
            gone = lowest == none
            if gone.any():
                done_symbols.append(symbols[gone])
                done_owner.append(owner[gone])
            at = np.flatnonzero((rank == lowest) & ~gone)
            if len(at):
                # Of a run such as a a a, the first, third, ... pairs merge.
                first = np.append(True, np.diff(at) != 1)
                run_start = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
                at = at[(at - run_start) % 2 == 0]
                symbols[at] = self.merged[place[at]]
                gone[at + 1] = True
            kept = np.flatnonzero(~gone)
            symbols, owner, place = symbols[kept], owner[kept], place[kept]
            if len(at):
                at = np.searchsorted(kept, at)
                place[at] = pairs_at(at)
                at = at[at > 0] - 1
                place[at] = pairs_at(at)
        if not done_owner:
            return symbols, np.zeros(len(sizes), np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_symbols)[order], np.cumsum(np.bincount(owner, minlength=len(sizes)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [self.pieces(text) for text in texts]
        found = [[*map(self.known.get, part)] for part in pieces]
        open_ = {piece for part, ids in zip(pieces, found) if None in ids for piece, one in zip(part, ids) if one is None}
        if open_:
            self.learn([*open_])
            for part, ids in zip(pieces, found):
                if None in ids:
                    ids[:] = [self.known[piece] if one is None else one for piece, one in zip(part, ids)]
        return [np.frombuffer(b"".join(ids), np.int32) for ids in found]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the tokens; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def bpe(docs: DataFrame, path: str, text: str = "text", into: str = "bpe") -> DataFrame:
    """``docs`` with a struct ``into`` of the token ids and the text decoded from them.

    ``path`` names a vocabulary file that every executor has, as a tokenizer library would need it too.
    """

    def run(piece: pa.RecordBatch) -> pa.Array:
        words = vocabulary(path)
        ids = words.encode([one.as_py() or "" for one in piece.column(piece.schema.get_field_index(text))])
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
        decoded = pa.array([words.decode(one) for one in ids], pa.string())
        return pa.StructArray.from_arrays([lists, decoded], names=["ids", "decoded"])

    return appended(docs, into, "struct<ids:array<int>,decoded:string>", run, text)
