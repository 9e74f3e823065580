"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are pairs of adjacent words, edges are triples: an edge leads from its first two
words to its last two and weighs as often as they stand in a row inside a piece of text.
One shuffle counts all edges, together with the pairs and the words that end a piece.
Every shorter count follows: a pair occurs as often as edges leave its node, plus the
pieces that it ends; a word as often as the pairs that it begins, plus the pieces that it
ends.

Words of a language stand as 64-bit hashes in the graph. A dictionary of all different
words is made first; if two of them share a hash, all is hashed anew under another salt,
so every hash is one word's. Tasks count the edges of about `flush` words at a time and
send them, packed, to one of `parts` groups by their node, of about `group` bytes of text
each, where numpy adds them up. What leaves a group is its edges and nodes of weight
`least` or more, which alone can be candidates, and the sums of its nodes by first word.

Among those edges, paths through nodes with one edge in and one out are compacted by
pointer doubling, in rounds that grow with the logarithm of the longest path; a circle is
cut at its smallest edge. A path is stored in parts of at most `part` edges. Inside a path
the edges around a pair are neighbours in its row, only the ends of paths meet in a shuffle.

A phrase of two words is dropped if a phrase of three words around it has at least half
of its occurrences. The score of a cut after k words is floor(1000000 a a / (l r)), in
decimal arithmetic of 38 digits, exact for counts below 10^16.

Missing text has no words; a missing language is `und`, as is the language so named. Long
texts are counted in parts. Repeated rows count as often as they occur. An empty table
has no phrases. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STOPS = "[.,;:!?\\x0A-\\x0D]"
#: The seed of Spark's xxhash64.
SEED = 42


def _named(lang: Column) -> Column:
    return F.coalesce(lang, F.lit("und")).alias("lang")


def dictionary(docs: DataFrame, salt: str = "") -> DataFrame:
    """Every different word of every language: lang, word and `h`, its hash."""
    spaced = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), STOPS, " ")
    words = docs.select(_named(F.col("lang")), F.explode(F.array_remove(F.split(spaced, "[\\x20\\x09]+"), "")).alias("word")).distinct()
    return words.select("lang", "word", F.xxhash64(F.concat(F.lit(salt), "lang", F.lit("\t"), "word")).alias("h"))


# Counting, in numpy.


def _totals(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of `words` (n, 3), by node, and the sum of each one's counts."""
    order = np.lexsort((words[:, 2], words[:, 1], words[:, 0]))
    words, counts = words[order], counts[order]
    first = np.concatenate(([True], (words[1:] != words[:-1]).any(axis=1)))
    return words[first], np.add.reduceat(counts, np.nonzero(first)[0])


def _starts(words: np.ndarray, columns: int) -> np.ndarray:
    """Where rows differ from the row before in their first columns."""
    return np.nonzero(np.concatenate(([True], (words[1:, :columns] != words[:-1, :columns]).any(axis=1))))[0]


def _pack(words: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted edges as bytes: their nodes once, with the number of edges of each."""
    starts = _starts(words, 2)
    sizes = np.diff(np.append(starts, len(words)))
    head = np.array([len(starts), len(words)], np.int64)
    small = bool(counts.max() < 256)
    return b"".join((head.tobytes(), words[starts, :2].tobytes(), sizes.astype(np.int32).tobytes(), words[:, 2].tobytes(), bytes([small]), counts.astype(np.uint8 if small else np.int64).tobytes()))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n_nodes, n = np.frombuffer(blob, np.int64, 2)
    at = 16
    nodes = np.frombuffer(blob, np.int64, 2 * n_nodes, at).reshape(-1, 2)
    at += 16 * int(n_nodes)
    sizes = np.frombuffer(blob, np.int32, n_nodes, at)
    at += 4 * int(n_nodes)
    last = np.frombuffer(blob, np.int64, n, at)
    at += 8 * int(n)
    counts = np.frombuffer(blob, np.uint8 if blob[at] else np.int64, n, at + 1).astype(np.int64)
    return np.column_stack((np.repeat(nodes, sizes, axis=0), last)), counts


def _edges(parts: int, flush: int, salt: str):
    """Documents to packed edges. 0 stands for the end of a piece, so a word that ends one
    is an edge to two ends, and a pair an edge to one."""
    cut = re.compile(rb"[.,;:!?\x0a-\x0d]").split

    def packed(tokens: np.ndarray) -> Iterator[tuple[int, bytes]]:
        words = np.column_stack((tokens[:-2], tokens[1:-1], tokens[2:]))[tokens[:-2] != 0]
        if not len(words):
            return
        words, counts = _totals(words, np.ones(len(words), np.int64))
        mixed = (words[:, 0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (words[:, 1].view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ends = np.nonzero(np.diff(np.append(part[order], -1)))[0] + 1
        for first, end in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
            own = order[first:end]
            yield int(part[own[0]]), _pack(words[own], counts[own])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, dict[bytes, int]] = {}
        tokens: list[int] = []

        def out() -> pd.DataFrame:
            # The last two words go on in the next lot, as their edges lead there.
            found = list(packed(np.array(tokens, np.int64)))
            del tokens[:-2]
            if sum(map(len, known.values())) > flush:
                known.clear()
            return pd.DataFrame(found, columns=["part", "blob"])

        for rows in batches:
            for lang, text in zip(rows["lang"], rows["text"], strict=True):
                if not text:
                    continue
                prefix = (salt + lang + "\t").encode("utf-8", "surrogatepass")
                ids = known.setdefault(prefix, {})
                for piece in cut(text.encode("utf-8", "surrogatepass").lower()):
                    words = piece.split()
                    for at in range(0, len(words), flush):
                        for w in words[at : at + flush]:
                            h = ids.get(w)
                            if h is None:
                                h = xxhash.xxh64_intdigest(prefix + w, SEED)
                                h = ids[w] = h - (1 << 64) if h >= 1 << 63 else h
                            tokens.append(h)
                        if len(tokens) >= flush:
                            yield out()
                    if words:
                        tokens += (0, 0)
        if tokens:
            yield out()

    return run


def _sums(least: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b) for b in group["blob"]]
        words, counts = _totals(np.concatenate([w for w, _ in parts]), np.concatenate([c for _, c in parts]))
        edges = (counts >= least) & (words[:, 2] != 0)
        starts = _starts(words, 2)
        nodes, flow = words[starts], np.add.reduceat(counts, starts)
        common = (flow >= least) & (nodes[:, 1] != 0)
        begins = _starts(nodes, 1)
        frames = []
        for size, own, f in (
            (3, words[edges], counts[edges]),
            (2, nodes[common], flow[common]),
            (1, nodes[begins], np.add.reduceat(flow, begins)),
        ):
            frames.append(pd.DataFrame({"size": np.full(len(f), size, np.int32), "w1": own[:, 0], "w2": own[:, 1], "w3": own[:, 2], "f": f}))
        return pd.concat(frames)

    return run


def counted(docs: DataFrame, least: int = 10, salt: str = "", flush: int = 1 << 20, group: int = 8 << 20) -> DataFrame:
    """Edges (size 3) and nodes (size 2) of weight `least` or more as w1, w2, w3 and f,
    and words (size 1) with parts of their counts; what a size doesn't need is anything."""
    rows = docs.select(_named(F.col("lang")), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // group))
    sent = rows.mapInPandas(_edges(parts, flush, salt), "part int, blob binary")
    return sent.groupBy("part").applyInPandas(_sums(least), "size int, w1 long, w2 long, w3 long, f long")


# Paths.


def _rows(frame: DataFrame) -> tuple:
    return tuple(frame.agg(F.count_if("moved"), F.sum("least")).first())


def _follow(links: DataFrame, end_at_circles: bool) -> tuple[DataFrame, int]:
    """Doubles `links` (edge, to, steps, least) until chains are at their ends and, if
    asked for, circles know their least edge. Returns the state and how many rows still
    move, which are those in circles: rows of chains that move get fewer every round."""
    state, before = links, None
    while True:
        ahead = state.select(F.col("edge").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("steps2"), F.col("least").alias("least2"))
        joined = state.drop("moved").join(ahead, "to", "left")
        now = stored(
            joined.select(
                "edge",
                F.coalesce("to2", "to").alias("to"),
                (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
                F.least("least", "least2").alias("least"),
                F.col("to2").isNotNull().alias("moved"),
            )
        )
        if before is not None:
            discard(state)
        state, (moving, least) = now, _rows(now)
        if not moving or (before is not None and before[0] == moving and (not end_at_circles or before[1] == least)):
            return state, moving
        before = (moving, least)


def paths(links: DataFrame) -> DataFrame:
    """Unary links (edge, next), each edge at most once on either side -> edge, `path`,
    the last edge of its path, and `steps`, the number of edges from there."""
    links = links.select("edge", F.col("next").alias("to"), F.lit(1).cast("long").alias("steps"), F.least("edge", "next").alias("least"))
    state, circling = _follow(links, True)
    ended = state.where("not moved")
    if circling:
        circles = state.where("moved").select("edge", F.col("least").alias("first"))
        cut = links.join(circles, "edge").where("to <> first").select("edge", "to", "steps", "least")
        opened, _ = _follow(stored(cut), False)
        ended = ended.unionByName(opened)
    inner = ended.select("edge", F.col("to").alias("path"), "steps")
    last = inner.select(F.col("path").alias("edge"), "path", F.lit(0).cast("long").alias("steps")).distinct()
    return inner.unionByName(last)


def compacted(edges: DataFrame, part: int = 1024) -> DataFrame:
    """Edges (w1, w2, w3, f), each once -> path, part and `edges`, the array of
    (w1, w2, w3, f) along the path; every edge is in one array."""
    named = stored(edges.select("w1", "w2", "w3", "f", F.monotonically_increasing_id().alias("edge")))
    out = named.groupBy(F.col("w1").alias("a"), F.col("w2").alias("b")).agg(F.count("*").alias("n_out"), F.min("edge").alias("next"))
    into = named.groupBy(F.col("w2").alias("a"), F.col("w3").alias("b")).agg(F.count("*").alias("n_in"), F.min("edge").alias("edge"))
    unary = into.where("n_in = 1").join(out.where("n_out = 1"), ["a", "b"]).where("edge <> next")
    found = stored(paths(stored(unary.select("edge", "next"))))
    placed = named.join(found, "edge", "left").select(
        F.coalesce("path", "edge").alias("path"),
        F.floor(F.coalesce("steps", F.lit(0)) / part).alias("part"),
        F.struct((-F.coalesce("steps", F.lit(0))).alias("at"), "w1", "w2", "w3", "f").alias("e"),
    )
    rows = placed.groupBy("path", "part").agg(F.array_sort(F.collect_list("e")).alias("edges"))
    return rows.select("path", "part", F.transform("edges", lambda e: F.struct(e["w1"].alias("w1"), e["w2"].alias("w2"), e["w3"].alias("w3"), e["f"].alias("f"))).alias("edges"))


def _around(rows: DataFrame) -> DataFrame:
    """w1, w2 and `most`, the largest weight of an edge around that pair."""

    def first(e: Column, i: Column) -> Column:
        before = F.get("edges", i - 1)["f"]
        return F.struct(e["w1"].alias("w1"), e["w2"].alias("w2"), F.greatest(e["f"], before).alias("most"))

    last = F.element_at("edges", -1)
    pairs = F.concat(F.transform("edges", first), F.array(F.struct(last["w2"].alias("w1"), last["w3"].alias("w2"), last["f"].alias("most"))))
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.w1", "p.w2").agg(F.max("p.most").alias("most"))


def _score(a: str, left: str, right: str) -> Column:
    whole = "CAST({} AS DECIMAL(16, 0))".format
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {whole(a)} * {whole(a)}) DIV ({whole(left)} * {whole(right)})")


def candidates(docs: DataFrame, least: int = 10, **counting) -> DataFrame:
    """All phrases of two or three words with `least` occurrences or more that no longer
    phrase covers: lang, phrase, a, l, r, n and score, as long numbers."""
    salt = ""
    while True:
        words = stored(dictionary(docs, salt))
        if not words.groupBy("h").count().where("count > 1").take(1):
            break
        discard(words)
        salt += "+"
    found = stored(counted(docs, least, salt, **counting))
    edges = stored(compacted(found.where("size = 3")))
    each_word = found.where("size = 1").groupBy(F.col("w1").alias("h")).agg(F.sum("f").alias("f"))
    known = stored(words.join(each_word, "h"))
    discard(words)
    totals = known.groupBy("lang").agg(F.sum("f").alias("n"))
    common = stored(known.where(F.col("f") >= least))
    pairs = found.where("size = 2").select("w1", "w2", F.col("f").alias("a"))

    def word(i: int) -> DataFrame:
        """The i-th word's hash, text and count; the first one's language, too."""
        own = common.select(F.col("h").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"), "lang")
        return own if i == 1 else own.drop("lang")

    kept = pairs.join(_around(edges), ["w1", "w2"], "left").where(F.coalesce(F.col("most") * 2 < F.col("a"), F.lit(True)))
    of_two = kept.join(word(1), "w1").join(word(2), "w2")
    of_two = of_two.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    of_two = of_two.withColumn("score", _score("a", "l", "r"))

    each = edges.select(F.explode("edges").alias("e")).select("e.*").withColumnRenamed("f", "a")
    start = pairs.select("w1", "w2", F.col("a").alias("f_start"))
    end = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f_end"))
    each = each.join(start, ["w1", "w2"]).join(end, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    cuts = F.array_min(
        F.array(
            F.struct(_score("a", "f1", "f_end").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f_end").alias("r")),
            F.struct(_score("a", "f_start", "f3").alias("score"), F.lit(2).alias("k"), F.col("f_start").alias("l"), F.col("f3").alias("r")),
        )
    )
    of_three = each.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", cuts.alias("cut"))
    of_three = of_three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return of_two.unionByName(of_three).join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, deals: int = 16, **counting) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score. A language is
    dealt into `deals` parts that are cut first, so no task ranks all of its phrases."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = candidates(docs, least, **counting).withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deals)))
    for keys in (["lang", "deal"], ["lang"]):
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", ranked).where(F.col("rank") <= top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
