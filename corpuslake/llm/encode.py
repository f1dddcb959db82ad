"""Encoding of texts with a public byte-level tokenizer, and its reverse.

The ids are those of the tokenizers library. A text is cut where the
tokenizer's own first step always cuts (before a word with its leading space),
and each distinct piece is encoded by the library once in a worker; pieces are
remembered, texts are not. Offsets come from the tokens' byte lengths through
the byte-to-character table of the text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

#: Pieces remembered by one worker; beyond it the memory is emptied. Only speed
#: depends on it. Longer pieces than PIECE are never remembered.
REMEMBER, PIECE = 400_000, 48

# A cut between pieces is a cut of the byte-level pattern: a space belongs to
# the word after it, and a run of white space leaves its last one behind.
_PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space to Python but not to the tokenizer's pattern.
_ODD = re.compile("[\x1c-\x1f]")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files lie on this machine."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


class Encoder(dict):
    """piece -> ids, filled by the tokenizers library on first use."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        table = {c: b for b, c in byte_characters().items()}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(table[c] for c in token)
        self.token_length = np.array([len(b) for b in self.token_bytes], np.int64)

    def __missing__(self, piece: str) -> list[int]:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        if len(piece) <= PIECE:
            if len(self) >= REMEMBER:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if _ODD.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return list(chain.from_iterable(map(self.__getitem__, _PIECES.findall(text))))

    def count(self, text: str | None) -> int:
        return len(self.ids(text))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end (in characters) of each token; a token that holds
        only a part of a character's bytes covers that whole character."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.token_length[np.asarray(ids, np.int64)])
        if len(ends) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts = np.concatenate(([0], ends[:-1]))
        return character[starts], character[ends - 1] + 1

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Bytes are joined before they become characters, so
        characters split over tokens come back; bytes that form no character
        (ids cut within one) become U+FFFD. Ids outside the vocabulary raise."""
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace")


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file of this machine."""
    with open(path, encoding="utf-8") as f:
        return Encoder(f.read())


@lru_cache(2)
def _shipped(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _ship(df: DataFrame, path: str | None):
    """The vocabulary file (a few MB) as read by the driver, sent to all
    workers once; they need no file of their own."""
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _lists(values: list[list[int]]) -> pa.Array:
    flat = np.fromiter(chain.from_iterable(values), np.int32)
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _encode(batches, text: str, vocabulary, ids: str | None, count: str | None, starts: str | None, ends: str | None):
    enc = _shipped(vocabulary.value)
    for b in batches:
        at = b.schema.get_field_index(text)
        texts = b.column(at).to_pylist()
        got = [enc.ids(t) for t in texts]
        rest = b.drop_columns([text])
        if ids:
            rest = rest.append_column(ids, _lists(got))
        if count:
            rest = rest.append_column(count, pa.array([len(g) for g in got], pa.int32()))
        if starts:
            pairs = [enc.offsets(t or "", g) for t, g in zip(texts, got)]
            rest = rest.append_column(starts, _lists([a.tolist() for a, _ in pairs]))
            rest = rest.append_column(ends, _lists([z.tolist() for _, z in pairs]))
        yield rest


def _without(df: DataFrame, column: str, *new: T.StructField) -> T.StructType:
    clash = {f.name for f in new} & {c for c in df.columns if c != column}
    if clash:
        raise ValueError(f"columns exist: {sorted(clash)}")
    return T.StructType([*(f for f in df.schema.fields if f.name != column), *new])


def encode(df: DataFrame, text: str, ids: str = "ids", path: str | None = None, starts: str | None = None, ends: str | None = None) -> DataFrame:
    """df with ids in place of text: the token ids, without special tokens.

    Null and empty texts have the empty list. The strings of special tokens
    are ordinary text. With starts and ends, also each token's first character
    and the one after its last. Other columns pass through; a new column whose
    name exists raises. Repeated rows stay. No shuffle.
    """
    ints = T.ArrayType(T.IntegerType())
    new = [T.StructField(ids, ints), *(T.StructField(c, ints) for c in (starts, ends) if c)]
    run = partial(_encode, text=text, vocabulary=_ship(df, path), ids=ids, count=None, starts=starts, ends=ends)
    return df.mapInArrow(run, _without(df, text, *new))


def token_counts(df: DataFrame, text: str, count: str = "n_tokens", path: str | None = None) -> DataFrame:
    """df with the number of tokens in place of text; 0 for null and empty."""
    run = partial(_encode, text=text, vocabulary=_ship(df, path), ids=None, count=count, starts=None, ends=None)
    return df.mapInArrow(run, _without(df, text, T.StructField(count, T.IntegerType())))


def _decode(batches, ids: str, vocabulary, text: str):
    enc = _shipped(vocabulary.value)
    for b in batches:
        lists = b.column(b.schema.get_field_index(ids)).to_pylist()
        yield b.drop_columns([ids]).append_column(text, pa.array([None if x is None else enc.decode(x) for x in lists], pa.string()))


def decode(df: DataFrame, ids: str = "ids", text: str = "text", path: str | None = None) -> DataFrame:
    """df with the text of ids in their place; null ids give null, no ids the
    empty text."""
    run = partial(_decode, ids=ids, vocabulary=_ship(df, path), text=text)
    return df.mapInArrow(run, _without(df, ids, T.StructField(text, T.StringType())))
