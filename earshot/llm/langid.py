"""Language identification by nearest centroid.

A text's vector counts its character n-grams (bytes of the lower-cased text, n = 1 to 4,
all but letters as a space), hashed into `dims` places, damped by a logarithm, weighted
by inverse document frequency and scaled to length one. Every language has up to
`clusters` centroids from spherical k-means; a text gets the language of the centroid
with the largest cosine. A text whose cosine is lower than all but a thousandth of its
language's own training texts is marked as rejected: it is in no language learnt.

Fitted on a bounded sample, by hash, of at most `per_language` different labelled texts
per language, whole texts; every text is predicted. Missing text and text without letters is
`und` with score 0; with nothing to learn from everything is. Repeated rows, ties
(smaller language name) and a missing doc_id (learnt from by no one, not held out) have
one result. The language, source and id are no inputs of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import as_long, as_text, stored

NOT_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
LETTER = re.compile(r"[^\W\d_]")


def counts(text: str, dims: int, longest: int = 4, block: int = 1 << 20) -> np.ndarray:
    """Damped n-gram counts of a whole text; very long texts in blocks."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(NOT_LETTERS).split()) + b" "
    out = np.zeros(dims, np.float64)
    for at in range(0, len(raw), block):
        codes = np.frombuffer(raw[at : at + block + longest - 1], np.uint8).astype(np.uint32)
        rolled = np.zeros(len(codes), np.uint32)
        for n in range(1, longest + 1):
            rolled = (rolled[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ (codes[n - 1 :] + np.uint32(n << 8))
            mixed = rolled ^ (rolled >> np.uint32(15))
            own = mixed[: min(block, len(raw) - at)] * np.uint32(0x2C1B3C6D)
            out += np.bincount(own >> np.uint32(32 - dims.bit_length() + 1), minlength=dims)
    return np.log1p(out)


def has_letters(text: str | None) -> bool:
    return bool(text) and bool(LETTER.search(text))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _vectors(dims: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows[[has_letters(t) for t in rows["text"]]]
            vectors = [counts(t, dims).astype(np.float32).tobytes() for t in rows["text"]]
            yield pd.DataFrame({"lang": rows["lang"], "vector": vectors})

    return run


def _centroids(idf: np.ndarray, clusters: int, rounds: int = 12, seed: int = 3):
    """Spherical k-means of one language's vectors, at most `per_language` of them."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float32) for v in sorted(rows["vector"])])
        x = _unit(x * idf)
        rng = np.random.default_rng(seed)
        centres = x[rng.choice(len(x), min(clusters, len(x)), replace=False)]
        for _ in range(rounds):
            own = (x @ centres.T).argmax(axis=1)
            centres = np.stack([_unit(x[own == i].mean(axis=0)) if (own == i).any() else c for i, c in enumerate(centres)])
        least = np.quantile((x @ centres.T).max(axis=1), 0.001)
        return pd.DataFrame({"lang": [key[0]] * len(centres), "centre": [c.astype(np.float32).tobytes() for c in centres], "least": least})

    return run


def learn(labelled: DataFrame, dims: int = 4096, clusters: int = 4, per_language: int = 600, slots: int = 64):
    """(languages, centroids, rejection cosines, idf) from text and lang, or None."""
    known = labelled.where("lang is not null and text is not null").select("text", "lang", F.xxhash64("text").alias("key"))
    # Copies count once. Only keys are ranked, in slots first, so a task's share is fixed.
    keys = known.select("lang", "key").distinct().withColumn("slot", F.pmod("key", F.lit(slots)))
    for groups in (["lang", "slot"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*groups).orderBy("key"))
        keys = keys.withColumn("rank", rank).where(F.col("rank") <= per_language).drop("rank")
    chosen = stored(keys.select("lang", "key"))
    sample = known.join(chosen, ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))
    vectors = stored(sample.select("text", "lang").mapInPandas(_vectors(dims), "lang string, vector binary"))

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(dims, np.int64), 0
        for rows in batches:
            for v in rows["vector"]:
                seen += np.frombuffer(v, np.float32) > 0
                n += 1
        yield pd.DataFrame({"place": np.append(np.nonzero(seen)[0], -1), "n": np.append(seen[seen > 0], n)})

    found = vectors.mapInPandas(present, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    total = int(found.loc[found["place"] < 0, "n"].sum())
    if not total:
        return None
    seen = np.zeros(dims)
    inside = found[found["place"] >= 0]
    seen[inside["place"]] = inside["n"]
    idf = np.log((1 + total) / (1 + seen)) + 0.05
    rows = vectors.groupBy("lang").applyInPandas(_centroids(idf, clusters), "lang string, centre binary, least double").toPandas()
    rows["key"] = rows["centre"]
    rows = rows.sort_values(["lang", "key"])
    return rows["lang"].tolist(), np.stack([np.frombuffer(c, np.float32) for c in rows["centre"]]), rows["least"].to_numpy(), idf


def _predict(model, dims: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text in rows["text"]:
                if model is None or not has_letters(text):
                    out.append(("und", 0.0, True))
                    continue
                langs, centres, least, idf = model
                cosines = centres @ _unit(counts(text, dims) * idf)
                i = int(cosines.argmax())
                out.append((langs[i], float(np.clip(cosines[i], 0, 1)), bool(cosines[i] < least[i])))
            frame = pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])
            frame.insert(0, "held_out", rows["held_out"].to_numpy())
            frame.insert(0, "doc_id", rows["doc_id"].to_numpy())
            yield frame

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by a checksum of the id; ids that are missing are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def languages(docs: DataFrame, dims: int = 4096, **options) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected. Learns from
    the documents with an id that are not held out."""
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = learn(rows.where("doc_id is not null and not held_out").select("text", "lang"), dims, **options)
    schema = "doc_id string, held_out boolean, lang_pred string, score double, rejected boolean"
    return as_long(rows.select(as_text("doc_id"), "held_out", "text").mapInPandas(_predict(model, dims), schema), "doc_id")
