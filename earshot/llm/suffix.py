"""Removal of repeated passages by prefix-free parsing.

Every byte covered by a `length`-byte string that also starts earlier in the corpus goes
(earlier: a smaller doc_id, or the same document at an earlier start). Matches never
cross documents; strings are judged on the input.

Rolling-hash triggers cut each text into phrases. A place triggers when the hash of its
`gram` bytes is the least within some `length`-byte string, so every such string holds
exactly one trigger that stands for it, at the same place wherever the string occurs,
and the strings of one trigger start next to each other: a phrase of the parse, with the
context they span. (Triggers by a modulus leave strings without any.)

* The parse: phrases are counted by trigger. A trigger that occurs once stands for
  strings that occur once, and is done. That is most of a corpus.
* The dictionary: phrases of equal trigger and context hold equal strings. All but the
  first in corpus order are repeats as a whole, however many there are.
* Dictionary suffixes: where one trigger has several contexts, the strings of the first
  phrase of each are put into classes of equal strings, as neighbours in the dictionary's
  suffix array are, and each class takes its first place in corpus order; later ones are
  repeats. Most of these strings are still alone, and most others have neighbours that
  are equal, too. So runs of eight strings come first: of equal runs all but the first
  are repeats as a whole, and only runs that have the bytes common to their eight strings
  in common with a different run are taken apart.

One suffix array of everything would need one task; classes by hash shuffle instead, and
give the order relation that is needed, the first place. Hashes have 64 bits within one
trigger and 128 bits for strings.

Missing text is empty. Rows that repeat a doc_id are versions of one document: a string
at the same start in several of them is not earlier in any. A missing doc_id sorts first
and is one document. Texts shorter than `length` keep everything. Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

GRAM = 32
BLOCK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_TABLE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
#: What stands for a missing doc_id.
NO_ID = -(1 << 63)


def _rolling(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every `gram` bytes, by doubling (gram is a power of two)."""
    h, n = _TABLE[codes], 1
    while n < gram:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def phrases(data: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(trigger hash, trigger place, first start, last start) of each phrase of a text.

    Very long texts are parsed in blocks; a phrase over a block's end comes out in two
    parts, with equal results."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), BLOCK):
        codes = np.frombuffer(data, np.uint8, min(BLOCK + length - 1, len(data) - at), at)
        h = _rolling(codes, gram)
        keyed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        place = (_sliding_min(keyed, length - gram + 1) & _PLACE).astype(np.int64)
        cut = np.concatenate(([0], np.nonzero(np.diff(place))[0] + 1))
        last = np.concatenate((cut[1:], [len(place)])) - 1
        out.append((h[place[cut]].view(np.int64), place[cut] + at, cut + at, last + at))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _version(data: bytes) -> int:
    """Tells versions of a document apart, in 17 bits."""
    return xxhash.xxh3_64_intdigest(data, 7) & 0x1FFFF


# A place packs a phrase's first start (31 bits), its version (17 bits), the number of
# its strings (8 bits) and how far the trigger is from the first start (7 bits).


def _parse(length: int, with_context: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found: list = [[], [], [], []]
            for doc, text in zip(rows["doc"].tolist(), rows["text"], strict=True):
                data = _bytes(text)
                trigger, place, first, last = phrases(data, length)
                if not len(trigger):
                    continue
                found[0].append(trigger)
                if with_context:
                    context = xxhash.xxh3_64_intdigest
                    found[1].append(np.array([context(data[s : e + length]) for s, e in zip(first.tolist(), last.tolist(), strict=True)], np.uint64).view(np.int64))
                    found[2].append(np.full(len(trigger), doc))
                    found[3].append(first << 32 | _version(data) << 15 | (last - first + 1) << 7 | (place - first))
            columns = [np.concatenate([np.empty(0, np.int64), *f]) for f in found]
            frame = pd.DataFrame({"trigger": columns[0]})
            if with_context:
                frame["context"], frame["doc"], frame["place"] = columns[1:]
            yield frame

    return run


def _own(places, version: int) -> list[tuple[int, int, int]]:
    """(first start, number of strings, distance of the trigger) at a version's places."""
    return [(p >> 32, p >> 7 & 0xFF, p & 0x7F) for p in places.tolist() if p >> 15 & 0x1FFFF == version]


def _runs(length: int, run_of: int = 8):
    """The runs of strings of the given phrases, aligned to the trigger, hashed by the
    bytes that all strings of a full run have in common, and by all their bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            core, whole, docs, out = [], [], [], []
            for doc, text, places in zip(rows["doc"].tolist(), rows["text"], rows["places"], strict=True):
                data = _bytes(text)
                version, digest = _version(data), xxhash.xxh3_64_intdigest
                for first, n, far in _own(places, version):
                    trigger, s = first + far, first
                    while s < first + n:
                        q = (trigger - s) // run_of
                        last = min(first + n - 1, trigger - q * run_of)
                        start = trigger - q * run_of
                        core.append(digest(data[start : start + length - run_of + 1], q))
                        whole.append(digest(data[s : last + length], trigger - s))
                        docs.append(doc)
                        out.append(s << 32 | version << 15 | (last - s + 1) << 7)
                        s = last + 1
            hashes = np.array([core, whole], np.uint64).view(np.int64)
            yield pd.DataFrame({"core": hashes[0], "whole": hashes[1], "doc": np.array(docs, np.int64), "place": np.array(out, np.int64)})

    return run


def _strings(length: int):
    """Every string of the given runs, hashed; its place keeps start and version."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[pd.DataFrame] = []
        size = 0
        for rows in batches:
            for doc, text, places in zip(rows["doc"].tolist(), rows["text"], rows["places"], strict=True):
                data = _bytes(text)
                version, digest = _version(data), xxhash.xxh3_128_digest
                starts = [s for first, n, _ in _own(places, version) for s in range(first, first + n)]
                raw = np.frombuffer(b"".join([digest(data[s : s + length]) for s in starts]), np.int64).reshape(-1, 2)
                out.append(pd.DataFrame({"h1": raw[:, 0], "h2": raw[:, 1], "doc": doc, "place": np.array(starts, np.int64) << 32 | version << 15 | 1 << 7}))
                size += len(starts)
                if size > 100_000:
                    yield pd.concat(out)
                    out, size = [], 0
        if out:
            yield pd.concat(out)

    return run


def removed_runs(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings at the places."""
    runs: list[list[int]] = []
    for p in np.sort(places).tolist():
        start, end = p >> 32, (p >> 32) + (p >> 7 & 0xFF) - 1 + length
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def _finish(length: int, texts: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for doc, text, places in zip(rows["doc"].tolist(), rows["text"], rows["places"], strict=True):
                data = _bytes(text)
                version = _version(data)
                own = np.array([p for p in (places.tolist() if places is not None else ()) if p >> 15 & 0x1FFFF == version], np.int64)
                runs, kept, at = removed_runs(own, length), [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                last = rest.decode("utf-8", "ignore") if texts else hashlib.sha256(rest).hexdigest()
                out.append((pd.NA if doc == NO_ID else doc, len(data), len(data) - len(rest), len(runs), last))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text" if texts else "kept_sha256"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return run


def _later(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each key but those at its first place in corpus order."""
    return rows.join(firsts, keys).where("doc <> first.doc or (place >> 32) <> (first.place >> 32)").select("doc", "place")


def _of_several(firsts: DataFrame, key: str) -> DataFrame:
    """First places of what shares its key with something else."""
    several = stored(firsts.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key))
    return firsts.join(several, key).select("first.*")


def _by_document(places: DataFrame) -> DataFrame:
    return places.groupBy("doc").agg(F.collect_list("place").alias("places"))


def without_repeats(docs: DataFrame, length: int = 100, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256, or with
    `texts` the kept text (cut characters dropped)."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    # What joins a hot key is stored first: adaptive execution can't split a partition
    # that the same stage has grouped.
    triggers = rows.mapInPandas(_parse(length, False), "trigger long").groupBy("trigger").agg(F.count("*").alias("n"))
    triggers = stored(triggers.where("n > 1").select("trigger"))
    parsed = rows.mapInPandas(_parse(length, True), "trigger long, context long, doc long, place long")
    # Phrases.
    again = stored(parsed.join(triggers, "trigger"))
    firsts = stored(again.groupBy("trigger", "context").agg(F.min(F.struct("doc", "place")).alias("first")))
    repeats = stored(_later(again, firsts, ["trigger", "context"]))
    discard(again)
    open_phrases = stored(_by_document(_of_several(firsts, "trigger")))
    discard(firsts)
    # Runs of strings.
    cut = rows.join(open_phrases, "doc").select("doc", "text", "places")
    pieces = stored(cut.mapInPandas(_runs(length), "core long, whole long, doc long, place long"))
    firsts = stored(pieces.groupBy("core", "whole").agg(F.min(F.struct("doc", "place")).alias("first")))
    repeats = repeats.unionAll(stored(_later(pieces, firsts, ["core", "whole"])))
    discard(pieces)
    open_runs = stored(_by_document(_of_several(firsts, "core")))
    discard(firsts)
    # Strings.
    cut = rows.join(open_runs, "doc").select("doc", "text", "places")
    strings = stored(cut.mapInPandas(_strings(length), "h1 long, h2 long, doc long, place long"))
    classes = strings.groupBy("h1", "h2").agg(F.min(F.struct("doc", "place")).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    repeats = repeats.unionAll(stored(_later(strings, stored(classes), ["h1", "h2"])))
    discard(strings)
    runs = _by_document(repeats)
    return rows.join(stored(runs), "doc", "left").select("doc", "text", "places").mapInPandas(
        _finish(length, texts), f"doc_id long, n_bytes long, n_removed long, n_spans long, {'kept_text' if texts else 'kept_sha256'} string"
    )
