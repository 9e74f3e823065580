"""SentencePiece encoding and decoding through a relational lattice.

The words of all documents are counted, and the `dictionary` most frequent are encoded
by Spark: every substring of bounded length is exploded, equi-joined to the piece table
(whose size is fixed by the vocabulary), the edges found are grouped by word, and a
higher-order `aggregate` folds each word's lattice into its pieces. For a unigram table
the fold is Viterbi's: the path of largest total score. A BPE table's scores are merge
ranks, and the path of largest total is not what such a vocabulary encodes to; there
the fold goes over the same edges in merge order and keeps a bit set of boundaries.

Documents are then encoded where they are, by looking their words up. The dictionary's
size is a parameter, so what every task holds doesn't grow with the corpus; a word that
is not in it (or longer than a bit set) takes the same fold inside the task. Which
words are in the dictionary never changes a result.

Characters without a piece become their UTF-8 bytes' pieces. Missing text is empty text,
with no pieces. Repeated rows are encoded alike. Other columns are kept by the
operators that take documents, under their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, stored

SPACE = "▁"
#: A word is its leading spaces and what follows up to the next space; no piece spans
#: more. Line ends, which no piece of several characters holds, stand alone.
WORD = f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
LONGEST = 60
#: Documents whose ids a task holds at once.
ROWS = 500


@dataclass(frozen=True)
class Vocabulary:
    """The normal pieces (piece -> (id, score)), the ids of the 256 bytes, and the kind."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    kind: str = "bpe"

    @property
    def unknown_score(self) -> float:
        return min(s for _, s in self.pieces.values()) - 10.0

    @property
    def parts(self) -> tuple:
        """What a broadcast holds: plain data, as executors need not have this module."""
        return self.pieces, self.byte_ids, self.kind


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte fallback, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in normal}
    if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in pieces):
        raise ValueError("a piece spans several words")
    # In a BPE model scores are whole merge ranks.
    kind = "bpe" if all(float(s).is_integer() for _, s in pieces.values()) else "unigram"
    return Vocabulary(pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], kind)


def _edges(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The lattice of each word: struct(score, s, n, ids) per matching substring."""
    spark = words.sparkSession
    table = spark.createDataFrame([(p, i, s) for p, (i, s) in vocabulary.pieces.items()], "piece string, id int, score double")
    longest = max(map(len, vocabulary.pieces), default=1)
    byte_ids = F.array(*map(F.lit, vocabulary.byte_ids))
    code = F.hex(F.encode("piece", "UTF-8"))
    fallback = F.transform(
        F.sequence(F.lit(1), F.octet_length("piece")),
        lambda i: F.get(byte_ids, F.conv(code.substr(i * 2 - 1, F.lit(2)), 16, 10).cast("int")),
    )
    at = words.select("word", F.length("word").alias("l"), F.explode(F.sequence(F.lit(1), F.length("word"))).alias("s"))
    at = at.select("word", "l", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("l") - F.col("s") + 1))).alias("n"))
    subs = at.select("word", "l", "s", "n", F.col("word").substr(F.col("s"), F.col("n")).alias("piece"))
    found = subs.join(F.broadcast(table), "piece", "left").where("id is not null or n = 1")
    return found.select(
        "word",
        "l",
        F.struct(
            (-F.coalesce("score", F.lit(vocabulary.unknown_score))).alias("cost"),
            F.col("s"),
            F.col("n"),
            F.when(F.col("id").isNotNull(), F.array("id")).otherwise(fallback).alias("ids"),
            F.expr("shiftleft(1L, s - 1) | shiftleft(1L, s - 1 + n)").alias("ends"),
            F.expr("shiftleft(shiftleft(1L, n - 1) - 1, s)").alias("inside"),
        ).alias("edge"),
    )


def _merge_fold(edges: Column, length: Column) -> Column:
    """Boundaries after all merges: edges in order of cost and place, each applied if it
    joins exactly two of the present pieces."""
    merges = F.filter(F.array_sort(edges), lambda e: e["n"] > 1)

    def step(marks: Column, e: Column) -> Column:
        fits = (marks.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(marks.bitwiseAND(e["inside"])) == 1)
        return F.when(fits, marks.bitwiseAND(F.bitwise_not(e["inside"]))).otherwise(marks)

    return F.aggregate(merges, length, step)


def _viterbi_fold(edges: Column) -> Column:
    """The best path's ids: the fold's state has, for every position reached, the best
    cost and its ids; the longest piece wins ties."""
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.array().cast("array<int>").alias("ids")))

    def step(reached: Column, p: Column) -> Column:
        options = F.transform(
            F.filter(edges, lambda e: e["s"] + e["n"] == p + 1),
            lambda e: F.struct(
                (F.get(reached, e["s"] - 1)["cost"] + e["cost"]).alias("cost"),
                (-e["n"]).alias("short"),
                F.concat(F.get(reached, e["s"] - 1)["ids"], e["ids"]).alias("ids"),
            ),
        )
        best = F.array_min(options)
        return F.concat(reached, F.array(F.struct(best["cost"].alias("cost"), best["ids"].alias("ids"))))

    return F.aggregate(F.sequence(F.lit(1), F.col("l")), start, step, lambda reached: F.element_at(reached, -1)["ids"])


def encoded_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """word (distinct, at most LONGEST code points, spaces as U+2581) -> word, ids."""
    grouped = _edges(words, vocabulary).groupBy("word", "l").agg(F.collect_list("edge").alias("edges"))
    if vocabulary.kind == "unigram":
        return grouped.select("word", _viterbi_fold(F.col("edges")).alias("ids"))
    marked = grouped.withColumn("marks", _merge_fold(F.col("edges"), F.expr("shiftleft(1L, l + 1) - 1")))
    whole = F.filter(
        F.array_sort("edges", lambda x, y: x["s"] - y["s"]),
        lambda e: (F.col("marks").bitwiseAND(e["ends"]) == e["ends"]) & (F.col("marks").bitwiseAND(e["inside"]) == 0),
    )
    return marked.select("word", F.flatten(F.transform(whole, lambda e: e["ids"])).alias("ids"))


def fold_word(word: str, vocabulary: Vocabulary) -> list[int]:
    """The same for one word inside a task."""
    pieces = vocabulary.pieces
    if vocabulary.kind == "unigram":
        longest = max(map(len, pieces), default=1)
        best: list = [(0.0, 0, 0)]
        for end in range(1, len(word) + 1):
            options = []
            for n in range(1, min(longest, end) + 1):
                found = pieces.get(word[end - n : end])
                if found or n == 1:
                    options.append((best[end - n][0] - (found[1] if found else vocabulary.unknown_score), -n, end - n))
            best.append(min(options))
        parts, end = [], len(word)
        while end:
            parts.append(word[best[end][2] : end])
            end = best[end][2]
        parts.reverse()
    elif len(word) <= 200:
        parts, none = list(word), (0, -math.inf)
        scores = [pieces.get(a + b, none)[1] for a, b in zip(word, word[1:], strict=False)]
        while scores and (top := max(scores)) > -math.inf:
            at = scores.index(top)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = pieces.get(parts[at - 1] + parts[at], none)[1]
            if at < len(scores):
                scores[at] = pieces.get(parts[at] + parts[at + 1], none)[1]
    else:
        parts = _merge_long(word, pieces)
    out = []
    for part in parts:
        found = pieces.get(part)
        out += [found[0]] if found else [vocabulary.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
    return out


def _merge_long(word: str, pieces: dict) -> list[str]:
    """Merges in order of score and place with a heap, for very long words."""
    import heapq

    parts: list = list(word)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts) and (found := pieces.get(parts[i] + parts[j])):
            heapq.heappush(heap, (-found[1], i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if parts[i] is None or after[i] != j or parts[i] + parts[j] != whole:
            continue
        parts[i], parts[j], after[i] = whole, None, after[j]
        if after[i] < len(parts):
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


def normalised(text: Column) -> Column:
    """A space before the text and every space as U+2581; nothing else changes."""
    return F.when(F.length(text) > 0, F.concat(F.lit(SPACE), F.translate(text, " ", SPACE)))


def frequent_words(docs: DataFrame, n: int) -> DataFrame:
    """The most frequent words of all documents that fit a bit set, n at most.

    The words' counts are counted in steps of a sixteenth of a doubling, a bounded table
    that says from which step on the words are n at most; nothing is sorted."""
    word = F.explode(F.regexp_extract_all(normalised(F.col("text")), F.lit(f"({WORD})"), F.lit(1)))
    counted = docs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    step = F.floor(F.log2("n") * 16).cast("int")
    fitting = stored(counted.where(F.length("word") <= LONGEST).withColumn("step", step))
    steps = sorted((tuple(r) for r in fitting.groupBy("step").count().collect()), reverse=True)
    total, least = 0, None
    for at, inside in steps:
        total += inside
        if total > n:
            break
        least = at
    return fitting.where(F.col("step") >= F.lit(least) if least is not None else F.lit(False)).select("word")


def _texts_to_ids(vocabulary: Vocabulary, known: dict[str, bytes], cache: int = 200_000):
    """A function from a text to its ids as bytes; rare words are kept until `cache`."""
    find, local = re.compile(WORD).findall, {}

    def encode(text: str | None) -> bytes:
        blobs = []
        for w in find(SPACE + text.replace(" ", SPACE)) if text else ():
            ids = known.get(w) or local.get(w)
            if ids is None:
                if len(local) >= cache:
                    local.clear()
                ids = local[w] = np.array(fold_word(w, vocabulary), np.int32).tobytes()
            blobs.append(ids)
        return b"".join(blobs)

    return encode


def dictionary(docs: DataFrame, vocabulary: Vocabulary, size: int = 200_000) -> dict[str, bytes]:
    """The frequent words' ids, at most `size` of them, for every task."""
    found = encoded_words(stored(frequent_words(docs, size).repartition("word")), vocabulary).toPandas()
    return {w: np.asarray(ids, np.uint32).tobytes() for w, ids in zip(found["word"], found["ids"], strict=True)}


def encoder(docs: DataFrame, vocabulary: Vocabulary, size: int = 200_000):
    """A column function from text to ids, with the frequent words of `docs` ready."""
    known = docs.sparkSession.sparkContext.broadcast((vocabulary.parts, dictionary(docs, vocabulary, size)))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        parts, words = known.value
        encode_text = _texts_to_ids(Vocabulary(*parts), words)
        for texts in batches:
            for at in range(0, len(texts), ROWS):
                yield pd.Series([np.frombuffer(encode_text(t), np.int32) for t in texts[at : at + ROWS]], dtype=object)

    return encode


def encoded(docs: DataFrame, vocabulary: Vocabulary, size: int = 200_000) -> DataFrame:
    """`docs` with `ids` in place of `text` (and of a column of that name)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "ids")]
    return docs.select(*rest, encoder(docs, vocabulary, size)(F.col("text")).alias("ids"))


def text_of(ids: np.ndarray, table: list[bytes]) -> str:
    raw = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
    return raw.replace(SPACE, " ")[1:]


def byte_table(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of every id; ids of no piece have none."""
    ids = {i: p.encode() for p, (i, _) in vocabulary.pieces.items()} | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    return [ids.get(i, b"") for i in range(max(ids, default=-1) + 1)]


def decoder(vocabulary: Vocabulary):
    """A column function from ids to text; null ids are null."""
    table = byte_table(vocabulary)

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else text_of(np.asarray(x), table))

    return decode


def decoded(frame: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`frame` with `text` in place of `ids`."""
    rest = [F.col(f"`{c}`") for c in frame.columns if c not in ("text", "ids")]
    return frame.select(*rest, decoder(vocabulary)(F.col("ids")).alias("text"))


def checked(docs: DataFrame, vocabulary: Vocabulary, size: int = 200_000) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (of the ids as little-endian
    32-bit numbers) and round_trip, whether decoding gives the text again (U+2581 reads
    back as a space, as spaces are written with it)."""
    known = docs.sparkSession.sparkContext.broadcast((vocabulary.parts, dictionary(docs, vocabulary, size), byte_table(vocabulary)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, words, table = known.value
        encode = _texts_to_ids(Vocabulary(*parts), words)
        for rows in (batch[at : at + ROWS] for batch in batches for at in range(0, len(batch), ROWS)):
            texts = [t or "" for t in rows["text"]]
            ids = [encode(t) for t in texts]
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "n_tokens": [len(b) // 4 for b in ids],
                    "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids],
                    "round_trip": [text_of(np.frombuffer(b, np.int32), table) == t.replace(SPACE, " ") for b, t in zip(ids, texts, strict=True)],
                }
            )

    found = docs.select(as_text("doc_id"), "text").mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, round_trip boolean")
    return as_long(found, "doc_id")
