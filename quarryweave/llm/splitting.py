"""Splitting oversized texts at natural boundaries by agglomerative merging.

A text is first cut into atomic segments (sentences; a sentence over the limit into words, a word
over the limit into characters).  The boundary between two segments has a strength: heading,
paragraph, line, sentence, word, character.  A heap holds all adjacent pairs; the pair with the
weakest boundary (then the smallest result, then the earlier place) is merged first, as long as both
together and the overlap fit the limit.  Each piece but the first then begins with the end of the
piece before it.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARACTER, WORD, SENTENCE, LINE, PARAGRAPH, HEADING = range(6)

_HEADING = re.compile(r"\n(?=[ \t]{0,3}#{1,6}[ \t])")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n\s*")
_SENTENCE = re.compile(r"""[.!?;…]["'”’)\]]*\s+|[。！？；…]["'”’）」』]*\s*""")
_GAP = re.compile(r"\s+")


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def _cuts(text: str) -> dict[int, int]:
    """Places (in characters) where a segment may begin, and the strength of the boundary there."""
    cuts: dict[int, int] = {}
    for strength, pattern in ((SENTENCE, _SENTENCE), (LINE, re.compile(r"\n+")), (PARAGRAPH, _PARAGRAPH), (HEADING, _HEADING)):
        for m in pattern.finditer(text):
            if 0 < m.end() < len(text):
                cuts[m.end()] = max(cuts.get(m.end(), -1), strength)
    return cuts


def _atoms(text: str, most: int) -> list[tuple[int, int, int]]:
    """(begin, end, strength of the boundary before it) of segments of at most ``most`` bytes."""
    cuts = _cuts(text)
    places = [0, *sorted(cuts), len(text)]
    out = []
    for begin, end in zip(places, places[1:], strict=False):
        strength = cuts.get(begin, CHARACTER)
        if _size(text[begin:end]) <= most:
            out.append((begin, end, strength))
            continue
        inner = [begin, *(m.end() for m in _GAP.finditer(text, begin, end) if begin < m.end() < end), end]
        for a, b in zip(inner, inner[1:], strict=False):
            here = strength if a == begin else WORD
            while _size(text[a:b]) > most:
                used, k = 0, a
                while True:
                    width = _size(text[k])
                    if k > a and used + width > most:
                        break
                    used, k = used + width, k + 1
                out.append((a, k, here))
                a, here = k, CHARACTER
            if a < b:
                out.append((a, b, here))
    return out


def split_text(text: str, max_size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(begin of the overlap, begin of the own part, end), in characters, of each piece.

    Own parts join to the text; own part and overlap together hold at most ``max_size`` UTF-8 bytes,
    unless one single character alone is larger.
    """
    if _size(text) <= max_size:
        return [(0, 0, len(text))]
    overlap = max(0, min(overlap, max_size // 2))
    room = max_size - overlap
    atoms = _atoms(text, room)
    size = [_size(text[a:b]) for a, b, _ in atoms]
    strength = [s for _, _, s in atoms]
    following = [*range(1, len(atoms)), -1]
    before = [-1, *range(len(atoms) - 1)]
    version, alive = [0] * len(atoms), [True] * len(atoms)

    def offer(i: int) -> None:
        j = following[i]
        if j >= 0 and size[i] + size[j] <= room:
            heapq.heappush(heap, (strength[j], size[i] + size[j], i, j, version[i], version[j]))

    heap: list[tuple[int, int, int, int, int, int]] = []
    for i in range(len(atoms)):
        offer(i)
    while heap:
        _, _, i, j, vi, vj = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or version[i] != vi or version[j] != vj:
            continue
        size[i] += size[j]
        alive[j], following[i] = False, following[j]
        if following[j] >= 0:
            before[following[j]] = i
        version[i] += 1
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    starts = [atoms[i][0] for i in range(len(atoms)) if alive[i]]
    out = []
    for k, begin in enumerate(starts):
        end = starts[k + 1] if k + 1 < len(starts) else len(text)
        out.append((_overlap_begin(text, starts[k - 1] if k else 0, begin, overlap) if k else 0, begin, end))
    return out


def _overlap_begin(text: str, least: int, begin: int, overlap: int) -> int:
    """Where the at most ``overlap`` bytes before ``begin`` start: at a word if one starts in the first quarter of them."""
    at, used = begin, 0
    while at > least:
        width = _size(text[at - 1])
        if used + width > overlap:
            break
        used, at = used + width, at - 1
    if at > least and at < begin and not text[at - 1].isspace():
        gap = _GAP.search(text, at, at + max(1, (begin - at) // 4))
        if gap and gap.end() < begin:
            return gap.end()
    return at


_PIECES = "{id} {id_type}, piece_no int, n_pieces int, begin_char long, own_begin_char long, end_char long, n_bytes int, overlap_bytes int, piece string"


_COLUMNS = ["_id", "piece_no", "n_pieces", "begin_char", "own_begin_char", "end_char", "n_bytes", "overlap_bytes", "piece"]
#: Bytes of pieces a worker holds before it passes them on.
HELD_BYTES = 16_000_000


def split_oversized(texts: DataFrame, row: str, text: str, kind: str, limits: DataFrame, limit_name: str = "limit_name", max_size: str = "max_size", overlap: str = "overlap_size") -> DataFrame:
    """Pieces of every text, one row each, within the limit of its kind.

    A text within its limit, of an unknown or null kind, or of a limit below 1 is one piece; an
    empty text is one empty piece; a null text gives no row.  Rows are taken as they come, repeated
    ones again; of repeated limits the smallest holds.  Other columns are ignored.
    """
    bounds = limits.groupBy(F.col(limit_name).alias("_kind")).agg(F.min(max_size).alias("_max"), F.min(overlap).alias("_over"))
    rows = texts.select(F.col(row).alias("_id"), F.col(text).alias("_text"), F.col(kind).alias("_kind")).filter(F.col("_text").isNotNull())
    id_type = dict(texts.select(F.col(row).alias("_id")).dtypes)["_id"]
    joined = rows.join(bounds, "_kind", "left").select("_id", "_text", "_max", "_over")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for batch in batches:
            for row_id, body, most, over in zip(batch["_id"], batch["_text"], batch["_max"], batch["_over"], strict=True):
                bounded = most is not None and most == most and most >= 1
                parts = split_text(body, int(most), int(over) if over == over and over is not None else 0) if bounded else [(0, 0, len(body))]
                for k, (a, b, c) in enumerate(parts):
                    out.append((row_id, k, len(parts), a, b, c, _size(body[a:c]), _size(body[a:b]), body[a:c]))
                    held += out[-1][6]
                    if held >= HELD_BYTES:
                        yield pd.DataFrame(out, columns=_COLUMNS)
                        out, held = [], 0
        yield pd.DataFrame(out, columns=_COLUMNS)

    return joined.mapInPandas(pieces, _PIECES.format(id="_id", id_type=id_type)).withColumnRenamed("_id", row)
