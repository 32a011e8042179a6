"""Byte-level BPE with the tiktoken library and a local rank file.

A text is cut where no match of the pattern can span, between a word character and a single space that a
word character follows, so that long texts reach the regular expression in pieces. A long run of white space can't be cut: it is
one match, but for its last character where other text follows. Such runs are found first, and given to the library's
merges as single pieces, as the regular expression's stack doesn't hold them. The ids are the same as
for the whole text. Decoding joins the raw bytes of the ids.
The pattern must end in `\\s+(?!\\S)|\\s+` and begin no other alternative with more than one space; this holds for the public patterns of
byte-level vocabularies, and others are refused.
Null and empty texts have no ids. Repeated rows give repeated results.
"""
from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_chunks, id_text, map_arrow

#: A cut may go before the space: every match that could reach it ends there, and the space starts the next.
SAFE = re.compile(r"(?<=\w) (?=\w)")
#: White space as the pattern's \\s has it, in runs that are too long for the regular expression.
LONG_RUN = 10_000
RUNS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG_RUN)
_LOADED: dict = {}


def encoding(ranks_path: str, pattern: str):
    """The tiktoken encoding of a rank file, kept in each Python worker."""
    if (ranks_path, pattern) not in _LOADED:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[ranks_path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[ranks_path, pattern]


def pieces(text: str, piece_chars: int) -> Iterator[str]:
    """Parts of about piece_chars characters that are cut at safe boundaries only."""
    at = 0
    while len(text) - at > piece_chars and (m := SAFE.search(text, at + piece_chars)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def ids_of(enc, text: str, piece_chars: int) -> list[bytes]:
    """The ids of a text, in parts."""
    out, at = [], 0

    def plain(part: str) -> None:
        out.extend(enc.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in pieces(part, piece_chars))

    for m in RUNS.finditer(text) if len(text) >= LONG_RUN else ():
        end = m.end() - (m.end() < len(text))  # the last one goes with what follows
        plain(text[at : m.start()])
        out.append(np.array(enc._core_bpe.encode_single_piece(text[m.start() : end].encode()), "<u4").tobytes())
        at = end
    plain(text[at:] if at else text)
    return out


def _checked(pattern: str) -> None:
    if not pattern.endswith(r"|\s+(?!\S)|\s+"):
        raise ValueError("texts are cut by the white space rules of patterns that end in \\\\s+(?!\\\\S)|\\\\s+")


def _encoded(batch: pa.RecordBatch, enc, piece_chars: int) -> Iterator[dict]:
    for at, texts in byte_chunks(batch.column(1)):
        ids = [b"".join(ids_of(enc, t.decode("utf-8", "replace"), piece_chars)) for t in texts]
        yield {"doc_id": batch.column(0).slice(at, len(texts)), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = 1 << 16) -> DataFrame:
    """doc_id, n_tokens, ids: the ids as little-endian unsigned 32-bit integers."""
    _checked(pattern)

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        yield from _encoded(batch, encoding(ranks_path, pattern), piece_chars)

    return map_arrow(id_text(docs, id_col, text_col), f, "doc_id long, n_tokens long, ids binary")


def decoded(enc, ids: bytes, at_once: int = 1 << 20) -> bytes:
    """The bytes of ids, of which at_once at a time become Python numbers."""
    x = np.frombuffer(ids, "<u4")
    return b"".join(enc.decode_bytes(x[i : i + at_once].tolist()) for i in range(0, len(x), at_once))


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds to encode's result decoded: the raw bytes that the ids stand for."""

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        enc = encoding(ranks_path, pattern)
        for at, ids in byte_chunks(batch.column(2)):
            yield {"doc_id": batch.column(0).slice(at, len(ids)), "n_tokens": batch.column(1).slice(at, len(ids)), "ids": ids, "decoded": [decoded(enc, x) for x in ids]}

    return map_arrow(tokens.select("doc_id", "n_tokens", "ids"), f, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", piece_chars: int = 1 << 16) -> DataFrame:
    """decode() of encode() in one pass: a task has one Python worker with one copy of the ranks, and the ids don't go back and forth."""
    _checked(pattern)

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        enc = encoding(ranks_path, pattern)
        for part in _encoded(batch, enc, piece_chars):
            yield part | {"decoded": [decoded(enc, x) for x in part["ids"]]}

    return map_arrow(id_text(docs, id_col, text_col), f, "doc_id long, n_tokens long, ids binary, decoded binary")
