"""Encoding a corpus with a public byte-level tokenizer by forced-boundary splitting.

A pair of bytes that occurs inside no token of the vocabulary can never end up inside one token, so
the text may be cut between any two such bytes and the fragments encoded apart; the joined ids are
those of the whole text.  The tokenizer also splits text by a pattern before its merges, and a cut
must leave that split as it is.  It does where the cut lies between two characters, the one before it
is no white space (whose split depends on what follows) and the one after it is no apostrophe (which
may begin a contraction).  The fragments are mostly words with the space before them; each distinct
one is encoded once in a while and remembered.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary files are; a parameter of every operator below.
TOKENIZERS = os.environ.get("QUARRYWEAVE_TOKENIZERS", "/opt/tokenizers")

#: The pattern that splits text before the merges of the rank files (fixed value of the tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct fragments a worker remembers before it starts afresh, and the longest one it remembers.
REMEMBERED, REMEMBERED_LENGTH = 200_000, 64

#: Bytes that end a character of white space, so that no cut may follow them: ASCII blanks, and the
#: last bytes of U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F and U+3000.
_BLANK_ENDS = sorted({9, 10, 11, 12, 13, 28, 29, 30, 31, 32, *(chr(c).encode()[-1] for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))})


def read_ranks(folder: str, name: str = "byte_bpe_50k") -> bytes:
    """The rank file of a tokenizer, under a megabyte, read on the driver."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return f.read()


class Encoder:
    """Encodes by forced-boundary splitting; one for each worker process."""

    def __init__(self, rank_file: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines()) if token}
        self.whole = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        inside = np.zeros((256, 256), dtype=bool)
        for token in ranks:
            if len(token) > 1:
                pairs = np.frombuffer(token, dtype=np.uint8)
                inside[pairs[:-1], pairs[1:]] = True
        cut = ~inside
        cut[_BLANK_ENDS, :] = False
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False  # the second byte goes on with a character
        self.cut = cut.ravel()
        self.known: dict[bytes, list[int]] = {}

    def cuts(self, data: bytes) -> list[int]:
        """Places in ``data`` where a fragment begins, but the first."""
        codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint16)
        return (np.flatnonzero(self.cut[(codes[:-1] << 8) | codes[1:]]) + 1).tolist()

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; the empty list for null and empty texts."""
        if not text:
            return []
        data = text.encode("utf-8", "replace")
        ids: list[int] = []
        at, known = 0, self.known
        for end in [*self.cuts(data), len(data)]:
            fragment = data[at:end]
            found = known.get(fragment)
            if found is None:
                found = self.whole(fragment.decode())
                if len(fragment) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[fragment] = found
            ids += found
            at = end
        return ids


_ENCODERS: dict[int, Encoder] = {}


def encoder(rank_file: bytes) -> Encoder:
    """The encoder of this process for a rank file."""
    key = hash(rank_file)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(rank_file)
    return _ENCODERS[key]


def _ranks(spark: SparkSession, folder: str | None, name: str):
    return spark.sparkContext.broadcast(read_ranks(folder or TOKENIZERS, name))  # the file's fixed size


def encode_corpus(texts: DataFrame, row: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``(row, ids)`` for every row, without special tokens; null and empty texts have the empty list.

    Strings that look like special tokens are ordinary text.  Rows are taken as they come; other
    columns are ignored; an empty table gives an empty one.
    """
    ranks = _ranks(texts.sparkSession, folder, tokenizer)
    id_type = dict(texts.select(F.col(row)).dtypes)[row]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(ranks.value)
        for batch in batches:
            yield pd.DataFrame({row: batch.iloc[:, 0], "ids": [own.encode(x) for x in batch.iloc[:, 1]]})

    return texts.select(F.col(row), F.col(text)).mapInPandas(encode, f"`{row}` {id_type}, ids array<int>")


def token_counts(texts: DataFrame, row: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``(row, n_tokens)`` for every row; 0 for null and empty texts."""
    ranks = _ranks(texts.sparkSession, folder, tokenizer)
    id_type = dict(texts.select(F.col(row)).dtypes)[row]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(ranks.value)
        for batch in batches:
            yield pd.DataFrame({row: batch.iloc[:, 0], "n_tokens": [len(own.encode(x)) for x in batch.iloc[:, 1]]})

    return texts.select(F.col(row), F.col(text)).mapInPandas(count, f"`{row}` {id_type}, n_tokens int")
