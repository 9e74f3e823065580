"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Every distinct fingerprint takes part. Fingerprints with the same population counts in
each of `segments` equal parts form one profile; tiles are parts of a profile, at most
about `tile` fingerprints each. Two fingerprints that differ in r bits have profiles
that differ by r or less in total, so pairs of tiles whose counts are further apart are
never made. Within a pair of tiles numpy compares everything with exclusive-or and bit
counts. Of the links found there only a spanning forest goes on, so a group of near
copies costs rows in proportion to its size.

With four segments about 1.6 % of all pairs of random fingerprints are compared, with
eight 0.04 %, with sixteen a millionth; more segments make more and smaller tiles, so
raise `segments` with the number of fingerprints. Results don't depend on it.

Missing text is empty text. Empty text has fingerprint zero. Rows are independent:
repeated rows, also of one doc_id, each come out once, and a missing doc_id has a
fingerprint and a component but is never the smallest. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, components, stored


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash of a text's word shingles, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, k = b" ".join(parts), min(shingle, len(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        raw = np.array(hashes[at : at + (1 << 16)], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = np.array([fingerprint(t, shingle) for t in rows["text"]], dtype=np.int64)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "fp": found})

    return run


def _spanning(a: np.ndarray, b: np.ndarray, radius: int, block: int = 256) -> np.ndarray:
    """Edges of a spanning forest of the links between two tiles (or within one)."""
    us, vs = [], []
    for at in range(0, len(a), block):
        i, j = np.nonzero(np.bitwise_count((a[at : at + block, None] ^ b[None, :]).view(np.uint64)) <= radius)
        us.append(i + at)
        vs.append(j)
    u, v = np.concatenate(us), np.concatenate(vs)
    values, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[u], at[len(a) + v]
    u, v = u[u != v], v[u != v]
    if not len(u):
        return np.empty((0, 2), np.int64)
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.nonzero(label != np.arange(len(values)))[0]
    return np.stack((values[own], values[label[own]]), axis=1)


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            found = [_spanning(np.asarray(a, np.int64), np.asarray(b, np.int64), radius) for a, b in zip(pairs["fps"], pairs["other"], strict=True)]
            found = np.concatenate([np.empty((0, 2), np.int64), *found])
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return run


def links(fingerprints: DataFrame, radius: int = 2, segments: int = 4, tile: int = 2048) -> DataFrame:
    """A spanning set of links (a, b) between distinct fingerprints (column `fp`)."""
    width = 64 // segments
    code = 1 + width + 2 * radius  # a place value with room for neighbours out of range
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))) for i in range(segments)]
    profile = sum(((c.cast("long") + radius) * F.lit(code**i) for i, c in enumerate(counts)), F.lit(0).cast("long"))
    known = fingerprints.select("fp", profile.alias("profile"))
    sizes = known.groupBy("profile").agg(F.ceil(F.count("*") / tile).alias("n_tiles"))
    tiles = stored(
        known.join(sizes, "profile")
        .groupBy("profile", F.pmod(F.xxhash64("fp"), "n_tiles").alias("part"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    steps = [sum(d * code**i for i, d in enumerate(s)) for s in product(range(-radius, radius + 1), repeat=segments) if sum(map(abs, s)) <= radius]
    near = F.array(*[F.lit(s).cast("long") for s in sorted(steps) if s >= 0])
    reach = tiles.select("profile", "part", "fps", F.explode(F.transform(near, lambda s: s + F.col("profile"))).alias("near"))
    other = tiles.select(F.col("profile").alias("near"), F.col("part").alias("other_part"), F.col("fps").alias("other"))
    pairs = reach.join(other, "near").where("near <> profile or other_part >= part").select("fps", "other")
    return pairs.mapInPandas(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, segments: int | None = None, tile: int = 2048) -> DataFrame:
    """One row per row of `docs` (doc_id, text): `doc_id`, `fp` (signed), `component_id`,
    the smallest doc_id among texts reachable over links of `radius` differing bits or
    fewer, itself included. Unless given, `segments` is four up to four million different
    fingerprints, and eight beyond."""
    own = stored(as_long(docs.select(as_text("doc_id"), "text").mapInPandas(_fingerprints(shingle), "doc_id string, fp long"), "doc_id"))
    known = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    segments = segments or (4 if known.count() <= 4_000_000 else 8)
    roots = components(stored(links(known, radius, segments, tile)))
    placed = known.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    member = stored(placed.join(smallest, "root").select("fp", "component_id"))
    return own.join(member, "fp").select("doc_id", "fp", "component_id")


def smallest_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each component (`found`: doc_id, component_id) the row of its smallest doc_id
    stays; of rows that repeat this doc_id the one least by text, lang and source.
    Documents without a doc_id stay, as nothing names them."""
    least = found.where("doc_id = component_id").select("doc_id").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = docs.join(least, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(whole, F.struct("text", "lang", "source")).alias("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents without near copies; see `smallest_rows`."""
    return smallest_rows(docs, near_duplicates(docs, **options))


def digest(fp: str = "fp"):
    """A signed fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
