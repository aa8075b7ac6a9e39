"""Encoding of a corpus with a public byte-level BPE vocabulary, by a lazily determinised finite-state transducer.

The merges of a vocabulary fix, for every prefix of a piece of text, the one token that its encoding ends with: the suffix
token that can follow the last token of what stands before it. A state of the transducer holds what the future may need: the
longest suffix of the input that begins a token, the last tokens of the positions within it, and their pending tokens. Tokens on
which all pending paths agree are emitted, so that the lookahead is bounded by the longest token. States and transitions are
built when an input first needs them and are kept up to ``MAX_STATES``; then the machine starts afresh, with the same output.

Decoding streams: ids give bytes, and an incremental UTF-8 state machine gives characters, U+FFFD for each maximal bad part.

NULL and empty texts have no ids: an empty list.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

DEFAULT = "byte_bpe_50k"
#: The usual pre-tokenisation of this kind of vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_STATES, MAX_WORDS, MAX_PAIRS = 400_000, 400_000, 2_000_000


def vocabulary(path: str) -> dict[bytes, int]:
    """token -> id of a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def vocabulary_path(name: str = DEFAULT, path: str | None = None) -> str:
    """The file of a public vocabulary: the given one, or that of the installed tokenizer files."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of = {v: k for k, v in ranks.items()}
        self.starts = {t[:k] for t in ranks for k in range(1, len(t) + 1)}
        self.follow: dict[tuple[int, int], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.words: dict[str, tuple[int, ...]] = {}
        self._state((b"", (-1,), ((),)))

    def _state(self, key: tuple) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return n

    def merged(self, piece: bytes) -> list[bytes]:
        """The plain merge procedure, for deciding which tokens can stand next to each other."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            best = min((self.ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _whole(self, token: bytes) -> bool:
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = self.merged(token) == [token]
        return ok

    def _follows(self, a: int, b: int) -> bool:
        ok = self.follow.get((a, b))
        if ok is None:
            x, y = self.of[a], self.of[b]
            ok = self.follow[a, b] = self.merged(x + y) == [x, y]
        return ok

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition of a state on a byte. lasts and chains belong to the positions of the window, oldest first; -1 stands
        for the beginning, where nothing comes before."""
        window, lasts, chains = self.states[state]
        text = window + bytes((byte,))
        for size in range(len(text), 0, -1):
            token = text[len(text) - size :]
            rank = self.ranks.get(token)
            if rank is None:
                continue
            before = lasts[len(lasts) - size]
            if (before == -1 and self._whole(token)) or (before != -1 and self._follows(before, rank)):
                break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        lasts, chains = lasts + (rank,), chains + (chains[len(chains) - size] + (rank,),)
        keep = len(text)
        while keep and text[len(text) - keep :] not in self.starts:
            keep -= 1
        lasts, chains = lasts[len(lasts) - keep - 1 :], chains[len(chains) - keep - 1 :]
        agreed = 0
        shortest = min(map(len, chains))
        while agreed < shortest and all(c[agreed] == chains[0][agreed] for c in chains):
            agreed += 1
        out = chains[0][:agreed]
        move = self.moves[state][byte] = (self._state((text[len(text) - keep :], lasts, tuple(c[agreed:] for c in chains))), out)
        return move

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece of the pre-tokenisation."""
        if len(self.states) > MAX_STATES:
            self._fresh()
        if len(self.follow) > MAX_PAIRS:
            self.follow.clear()
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in data:
            move = moves[state].get(byte) or self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        out += self.states[state][2][-1]
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        words = self.words
        for word in _pattern().findall(text):
            ids = words.get(word)
            if ids is None:
                ids = tuple(self.piece(word.encode("utf-8", "replace")))
                if len(word) <= 64:
                    if len(words) > MAX_WORDS:
                        words.clear()
                    words[word] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        machine = Utf8()
        return "".join([*(machine.feed(self.of[i]) for i in ids), machine.end()])


@cache
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


class Utf8:
    """An incremental UTF-8 decoder: feed it bytes, it returns the characters that are complete."""

    def __init__(self) -> None:
        self.need, self.value, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.low, self.high = 0x80, 0xBF
                    self.value = self.value << 6 | b & 0x3F
                    self.need -= 1
                    if not self.need:
                        out.append(chr(self.value))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.value = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.value = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.need, self.value = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        open_part, self.need, self.low, self.high = bool(self.need), 0, 0x80, 0xBF
        return "�" if open_part else ""


_machines: dict[int, Transducer] = {}


def machine_of(shared) -> Transducer:
    """One machine for each worker process and vocabulary, kept between batches and tasks."""
    if shared.id not in _machines:
        _machines.clear()
        _machines[shared.id] = Transducer(shared.value)
    return _machines[shared.id]


class _Shared:
    """A broadcast vocabulary with an id that survives pickling."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        self.broadcast = spark.sparkContext.broadcast(ranks)
        self.id = hash((len(ranks), min(ranks), max(ranks, key=lambda t: ranks[t])))

    @property
    def value(self) -> dict[bytes, int]:
        return self.broadcast.value


def encoded(documents: DataFrame, id_column: str = "doc_id", text: str = "text", name: str = DEFAULT, path: str | None = None) -> DataFrame:
    """(id, ids): the token ids of every document, in one pass without a shuffle. The vocabulary is read on the driver and
    broadcast; it has a fixed size."""
    shared = _Shared(documents.sparkSession, vocabulary(vocabulary_path(name, path)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = machine_of(shared)
        for pdf in batches:
            yield pd.DataFrame({id_column: pdf[id_column], "ids": [machine.encode(x) for x in pdf[text]]})

    return spread(documents.select(id_column, text)).mapInPandas(run, f"{id_column} {dict(documents.dtypes)[id_column]}, ids array<int>")


def counted(documents: DataFrame, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("source",), name: str = DEFAULT, path: str | None = None) -> DataFrame:
    """(id, kept columns, n_tokens)."""
    shared = _Shared(documents.sparkSession, vocabulary(vocabulary_path(name, path)))

    @F.pandas_udf("bigint")
    def size(texts: pd.Series) -> pd.Series:
        machine = machine_of(shared)
        return texts.map(lambda x: len(machine.encode(x)))

    return spread(documents.select(id_column, *keep, text)).select(id_column, *keep, size(F.coalesce(F.col(text), F.lit(""))).alias("n_tokens"))
