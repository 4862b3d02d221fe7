"""Near-duplicate texts: a set similarity join that skips by set relations.

Each text is the set of its distinct substrings of a fixed length (lower case, no white space).
Texts with the same letters are one set.  Index lists are kept for groups of four minima out of a
family of hash functions: two sets share such a list with the fourth power of their similarity, so
that among 56 of them a pair at the threshold of 0.6 is missed once in 2,400, a pair at 0.7 once in
2.8 million.  (Lists of single substrings, cut to prefixes, are exact but as long as the corpus here:
texts of one trade are made of the same phrases, and their prefixes still reach common ones.)

* Index skipping: every list is ordered by set size and cut into blocks at powers of the threshold; a
  set reads its own block and the next larger one, the others cannot hold a partner.
* Answer skipping: sets that agree in a long run of minima form a family.  A family stands once in a
  list, not once for each set; the candidates of a member are those computed for its family, and only
  lists in which it differs from the others add to them.

Lists carry a byte of each of 32 further minima of a set that is alone in its family, which drops most
chance meetings of such sets where they happen; what a larger family meets is never dropped there.
Candidates are then compared by all their minima, and at last exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryweave.plans import materialise

#: Minima of one list, lists, minima a family agrees in.
ROWS, BANDS, FAMILY_ROWS = 4, 56, 24
#: Bytes of minima that a list carries for each set alone in its family, and how many must agree for two such sets to be
#: candidates: about 19 do at the threshold, 3 in texts that share a tenth; at 7 a pair is lost once in 100,000.
CARRIED, CARRIED_AGREE = 32, 7
#: Standard errors of the similarity by minima that a candidate may lie below the threshold.
MARGIN = 4.0

_MIX = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str) -> str:
    """Lower case without white space."""
    return "".join(text.lower().split())


def shingle_set(body: str, length: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the substrings of a text without white space."""
    codes = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(codes) - length + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        h = (h ^ codes[k : k + n]) * _MIX
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, count, dtype=np.uint64)


def minima(shingles: np.ndarray, count: int) -> np.ndarray:
    """The smallest value of each of ``count`` hash functions over a set."""
    a, b = _factors(count)
    out = np.empty(count, dtype=np.uint32)
    for k in range(count):
        out[k] = ((shingles * a[k] + b[k]) >> np.uint64(32)).min()
    return out


def _sketches(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for row, text in zip(batch["row"], batch["text"], strict=True):
            body = letters(text)
            if not body:
                continue
            digest = hashlib.sha256(body.encode("utf-8", "surrogatepass")).digest()[:16]
            shingles = shingle_set(body, length)
            rows.append((row, digest, len(shingles), minima(shingles, ROWS * BANDS).view(np.int32) if len(shingles) else None))
        yield pd.DataFrame(rows, columns=["row", "digest", "size", "sketch"])


def _compared(batches: Iterator[pd.DataFrame], length: int, threshold: float) -> Iterator[pd.DataFrame]:
    """Exact similarity of pairs of texts; the pairs of one left text come together and its set is kept for them."""
    last, left = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        out = []
        for a, b, x, y in zip(batch["rep_a"], batch["rep_b"], batch["xa"], batch["xb"], strict=True):
            if a != last:
                last, left = a, shingle_set(letters(x), length)
            right = shingle_set(letters(y), length)
            shared = len(np.intersect1d(left, right, assume_unique=True))
            every = len(left) + len(right) - shared
            if every and shared >= threshold * every:
                out.append((a, b, shared / every))
        yield pd.DataFrame(out, columns=["rep_a", "rep_b", "similarity"])


def near_duplicates(texts: DataFrame, row: str, text: str, length: int = 12, threshold: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """Links between different texts and the membership of rows in texts.

    Returns ``(links, members)``: ``links(rep_a, rep_b, similarity)`` with ``rep_a < rep_b`` for texts
    of at least the threshold, and ``members(row, rep)`` giving each row the smallest row with the same
    letters, its class.  Null, empty and blank texts are in neither.  Rows of one value have one text.  A text shorter than ``length``
    has no substrings: it is a member with its copies but has no links.  Rows may repeat; other columns
    are ignored.
    """
    rows = texts.select(F.col(row).alias("row"), F.col(text).alias("text")).filter("text is not null and row is not null")
    id_type = dict(rows.dtypes)["row"]
    sketched = rows.mapInPandas(lambda b: _sketches(b, length), f"row {id_type}, digest binary, size int, sketch array<int>")
    sketched = materialise(sketched, "sketches")
    members = sketched.select("row", F.min("row").over(Window.partitionBy("digest")).alias("rep")).distinct()
    members = materialise(members, "members")
    reps = members.select(F.col("rep").alias("row")).distinct()
    sets = sketched.join(reps, "row", "left_semi").dropDuplicates(["row"])

    # families, and the block of a set by its size
    base = sets.filter("size > 0").select("row", "size", "sketch").withColumn("family_key", F.xxhash64(F.slice("sketch", 1, FAMILY_ROWS)))
    low_bytes = F.transform(F.slice("sketch", FAMILY_ROWS + 1, CARRIED), lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("byte"))
    of_family = Window.partitionBy("family_key")
    base = base.withColumn("family", F.min("row").over(of_family)).withColumn("carried", F.when(F.count("*").over(of_family) == 1, low_bytes)).drop("family_key")
    base = base.withColumn("step", F.floor(F.log(F.col("size").cast("double")) / F.lit(-np.log(threshold))).cast("int"))
    base = materialise(base, "sets")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice("sketch", b * ROWS + 1, F.lit(ROWS))))
    lists = base.select("family", "step", "carried", F.explode(bands).alias("list")).distinct()
    lists = materialise(lists, "lists")
    probe = lists.select("list", F.col("family").alias("fa"), F.col("step").alias("sa"), F.col("carried").alias("ca"), F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("sb"))
    entry = lists.select("list", F.col("family").alias("fb"), F.col("step").alias("sb"), F.col("carried").alias("cb"))
    alike = F.aggregate(F.zip_with("ca", "cb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) >= CARRIED_AGREE
    met = probe.join(entry, ["list", "sb"]).filter("sa < sb or fa <= fb").filter(F.coalesce(alike, F.lit(True))).select("fa", "sa", "fb", "sb").distinct()
    met = materialise(met, "met")

    left = base.select(F.col("family").alias("fa"), F.col("step").alias("sa"), F.col("row").alias("ra"), F.col("size").alias("na"), F.col("sketch").alias("ka"))
    right = base.select(F.col("family").alias("fb"), F.col("step").alias("sb"), F.col("row").alias("rb"), F.col("size").alias("nb"), F.col("sketch").alias("kb"))
    total = ROWS * BANDS
    agree = F.aggregate(F.zip_with("ka", "kb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    floor_ = threshold - MARGIN * float(np.sqrt(threshold * (1 - threshold) / total))
    fits = F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")
    pairs = met.join(left, ["fa", "sa"]).join(right, ["fb", "sb"]).filter(fits & (F.col("ra") != F.col("rb")) & (agree >= F.lit(int(floor_ * total))))
    pairs = materialise(pairs.select(F.least("ra", "rb").alias("rep_a"), F.greatest("ra", "rb").alias("rep_b")).distinct(), "candidates")

    # the texts of candidates alone are read again and travel, not their sets, which are several times as large
    needed = pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("row")).distinct()
    texts_of = rows.join(needed, "row", "left_semi").dropDuplicates(["row"])
    a = texts_of.select(F.col("row").alias("rep_a"), F.col("text").alias("xa"))
    b = texts_of.select(F.col("row").alias("rep_b"), F.col("text").alias("xb"))
    joined = pairs.join(b, "rep_b").join(a, "rep_a").sortWithinPartitions("rep_a").select("rep_a", "rep_b", "xa", "xb")
    links = joined.mapInPandas(lambda batches: _compared(batches, length, threshold), f"rep_a {id_type}, rep_b {id_type}, similarity double")
    return links, members


def all_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of rows ``(a, b)``, ``a < b``: copies of one text, and rows of linked texts."""
    a = members.select(F.col("rep").alias("rep_a"), F.col("row").alias("a"))
    b = members.select(F.col("rep").alias("rep_b"), F.col("row").alias("b"))
    same = a.join(b, F.col("rep_a") == F.col("rep_b")).filter("a < b").select("a", "b")
    linked = links.select("rep_a", "rep_b").join(a, "rep_a").join(b, "rep_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return same.unionByName(linked).distinct()
