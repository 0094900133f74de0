"""SimHash near-duplicates found through deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that two fingerprints that differ in at
most ``distance`` bits differ in at most one bit of some segment, or of some choice of a few of
them. Each is indexed once per bit with that bit left out, so such a pair shares a key: the
candidates come from an equality join, and every candidate is verified on all 64 bits.

Only distinct fingerprints are indexed and joined; copies are members of their fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.common import slices, stored
from motorledger.llm.links import components

BITS = 64
SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as an unsigned number; 0 where the text has no word."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-1].tolist()]
        stops = (ends[width - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    ones = np.zeros(BITS, np.int64)
    packed = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(packed), 65536):
        ones += np.unpackbits(packed[at : at + 65536], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprinter(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(found)], ["key", "bits"]
            )

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", width: int = SHINGLE_WORDS) -> DataFrame:
    """``key`` and ``bits`` (the fingerprint as a signed long) of every row; a null text has 0."""
    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return pairs.mapInArrow(_fingerprinter(width), "key long, bits long")


def cut_for(count: int, distance: int = DISTANCE) -> tuple[int, int]:
    """(segments, segments used in a key) that suit so many fingerprints.

    Any cut finds the same pairs. Longer keys cost more index rows a fingerprint and leave fewer
    candidates, whose number grows with the square of the fingerprints: with 4 bits, 64 rows of
    21 bits, 260 rows of 25, or 640 rows of 31.
    """
    if count < 1 << 23 or distance < 2:
        return distance // 2 + 1, 1
    return (distance + 1, 2) if count < 1 << 27 else (distance + 2, 3)


def segments(count: int) -> list[int]:
    """The bits of each of ``count`` segments as a mask, lowest bits first."""
    sizes = [BITS // count + (i < BITS % count) for i in range(count)]
    return [((1 << size) - 1) << sum(sizes[:i]) for i, size in enumerate(sizes)]


def keys_of(distance: int, cut: tuple[int, int]) -> list[int]:
    """The bits of every key: all choices of the segments used. Two fingerprints that differ in at
    most ``distance`` bits differ in at most one bit of some key."""
    count, used = cut
    # the bits spread evenly leave most to the segments with least: these must hold one at most
    even = sorted(distance // count + (i < distance % count) for i in range(count))
    if sum(even[:used]) > 1:
        raise ValueError(f"{used} of {count} segments may differ in more than one of {distance} bits")
    return [sum(chosen) for chosen in combinations(segments(count), used)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _bits_of(mask: int) -> list[int]:
    return [bit for bit in range(BITS) if mask >> bit & 1]


def _variants(bits: Column, keys: list[int]) -> Column:
    """All one-wildcard variants of every key as structs of key and bit left out, and the remaining bits."""
    out = []
    for number, mask in enumerate(keys):
        for bit in _bits_of(mask):
            rest = bits.bitwiseAND(F.lit(_signed(mask & ~(1 << bit))))
            out.append(F.struct(F.lit(number * BITS + bit).alias("bit"), rest.alias("rest")))
    return F.array(*out)


def _first_shared(keys: list[int]) -> Column:
    """True for the one index row at which a pair is reported, however many it shares."""
    differ = F.expr("a.bits ^ b.bits")
    found = F.lit(False)
    for number, mask in reversed(list(enumerate(keys))):
        part = differ.bitwiseAND(F.lit(_signed(mask)))
        mine = F.col("a.bit") - number * BITS
        here = (mine >= 0) & (mine < BITS) & (
            ((part != 0) & (part == F.expr(f"shiftleft(1L, cast(pmod(a.bit, {BITS}) as int))"))) | ((part == 0) & (mine == _bits_of(mask)[0]))
        )
        found = F.when(F.bit_count(part) <= 1, here).otherwise(found)
    return found


def near_pairs(distinct: DataFrame, distance: int = DISTANCE, cut: tuple[int, int] | None = None) -> DataFrame:
    """Pairs ``low``, ``high`` of different ``bits`` that differ in at most ``distance`` bits, each once.

    ``cut`` says into how many segments fingerprints are cut and how many of them make a key; by
    default it follows the number of fingerprints. The pairs are the same for every cut.
    """
    keys = keys_of(distance, cut or cut_for(distinct.count(), distance))
    index = distinct.select("bits", F.explode(_variants(F.col("bits"), keys)).alias("v")).select(
        "bits", "v.bit", "v.rest"
    )
    # a fingerprint has one row per bit here, which size estimates do not see: never broadcast
    return (
        index.alias("a")
        .hint("merge")
        .join(
            index.alias("b"),
            (F.col("a.bit") == F.col("b.bit"))
            & (F.col("a.rest") == F.col("b.rest"))
            & (F.col("a.bits") < F.col("b.bits"))
            & (F.bit_count(F.expr("a.bits ^ b.bits")) <= distance)
            & _first_shared(keys),
        )
        .select(F.col("a.bits").alias("low"), F.col("b.bits").alias("high"))
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", width: int = SHINGLE_WORDS, distance: int = DISTANCE, cut: tuple[int, int] | None = None
) -> DataFrame:
    """One row per input row: ``key``, ``bits`` and ``component``, the least key reachable over links.

    Rows link when their fingerprints differ in at most ``distance`` bits. A null or wordless
    text has fingerprint 0 and links like any other; repeated rows stay repeated; null keys
    never become a component name unless a component has no other; an empty table gives no rows.
    """
    found = stored(fingerprints(docs, key, width), "fingerprints")
    classes = stored(found.groupBy("bits").agg(F.min("key").alias("least")), "classes")
    roots = components(stored(near_pairs(classes.select("bits"), distance, cut), "near-pairs"))
    joined = classes.join(roots, classes.bits == roots.node, "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "least"
    )
    names = joined.groupBy("root").agg(F.min("least").alias("component"))
    named = stored(joined.join(names, "root").select("bits", "component"), "components")
    return found.join(named, "bits").select("key", "bits", "component")
