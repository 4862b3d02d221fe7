"""Text units: sentences, tokens, chunks, evidence signals."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SENTENCE = r"[^.!?;。！？；]*[.!?;。！？；]|[^.!?;。！？；]+$"


def sentence_units(text: Column) -> Column:
    """Trimmed pieces that end with a closing mark or the text, blanks left out."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_SENTENCE), 0)
    return F.filter(F.transform(pieces, lambda x: F.trim(x)), lambda x: x != "")


def search_tokens(text: Column) -> Column:
    """ASCII words, single ideographs and pairs of neighbouring ideographs, in lower case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    words = F.regexp_extract_all(low, F.lit(r"[a-z0-9]+"), 0)
    runs = F.regexp_extract_all(low, F.lit(r"[\x{4E00}-\x{9FFF}]+"), 0)
    singles = F.flatten(F.transform(runs, lambda r: F.split(r, "")))
    pairs = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) > 1, F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))))
    return F.concat(words, F.filter(singles, lambda x: x != ""), pairs)


def evidence_confidence(kind: Column, text: Column, section: Column) -> Column:
    """How much a block can support: none for furniture, little for short text, more with numbers and units, methods, tables, a section."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    measured = plain.rlike(r"[0-9]+(\.[0-9]+)? ?(°C|%|MPa|GPa|kPa|mm|nm|kJ|HV|wt|mol|min|rpm|Hz|kHz)")
    method = F.lower(plain).rlike(r"spectroscopy|diffraction|microscopy|analysis|calorimetry|testing|rheometry")
    score = F.lit(0.65) + F.when(measured, 0.15).otherwise(0.0) + F.when(method, 0.1).otherwise(0.0) + F.when(kind == "table", 0.05).otherwise(0.0) + F.when(F.trim(F.coalesce(section, F.lit(""))) != "", 0.05).otherwise(0.0)
    capped = F.least(score, F.lit(0.95))
    return F.round(F.when(kind.isin("header", "footer", "page_number"), 0.0).when(F.length(plain) < 16, 0.2).otherwise(capped), 2)


def chunk_text(text: str, target: int, most: int, overlap: int) -> list[str]:
    """Sentence units packed to about ``target`` characters; each chunk after the first begins with the end of the last one."""
    units = []
    for piece in re.findall(_SENTENCE, text, flags=re.S):
        piece = piece.strip()
        while len(piece) > target:
            units.append(piece[:target])
            piece = piece[target:]
        if piece:
            units.append(piece)
    chunks: list[str] = []
    body = ""
    for unit in units:
        joined = f"{body} {unit}" if body else unit
        if body and len(joined) > target:
            chunks.append(body)
            tail = body[-overlap:] if overlap else ""
            body = f"{tail} {unit}" if tail and len(tail) + 1 + len(unit) <= most else unit
        else:
            body = joined
    if body:
        chunks.append(body)
    return chunks


def chunk_documents(texts: DataFrame, row: str, text: str, target: int = 2400, most: int = 4000, overlap: int = 200) -> DataFrame:
    """``(row, chunk_no, n_chars, chunk)`` of every text; null and blank texts have none."""
    rows = texts.select(row, text).filter(F.trim(F.col(text)) != "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r, k, len(c), c) for r, t in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True) for k, c in enumerate(chunk_text(t, target, most, overlap))]
            yield pd.DataFrame(out, columns=[row, "chunk_no", "n_chars", "chunk"])

    return rows.mapInPandas(cut, f"`{row}` {dict(rows.dtypes)[row]}, chunk_no int, n_chars int, chunk string")
