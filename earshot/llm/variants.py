"""Spelling variants by bidirectional FM-index search schemes.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. That edit lies in one half of a word of m code points, so the other half, the
first m // 2 or the last, stands unchanged at the same end of its near words. Search
schemes use this: match one half exactly, then extend across the other, one edit allowed.

Spark sends every word to the shards of its halves: as a query to the one of its own
half, as an entry to those of the half lengths that words one shorter, as long and one
longer have. Shards are hashed so that each holds about `size` code points; the words of
one half that are more than that are dealt into parts, and every part of the queries
meets every part of the entries. A shard's task builds an index of its delimited
vocabulary in numpy: the suffix array and Burrows-Wheeler transform of the text and of
its reverse, with symbol counts at every 64th place. A search state is a pair of suffix
rank intervals, one in each array, that an extension to either side keeps in step; all
queries of a shard advance together. An interval that reaches a delimiter on both sides
is a whole word. For words that are alike at their end the shard holds reversed words.

A word's form is its near word of largest n, the smallest of those in code-point order,
if that n is at least `times` the word's; its root is where forms lead in the end, found
by doubling, as n grows at every step.

Words are distinct; a table that repeats one counts its n together. Missing words are
left out. Missing text has no runs, a missing doc_id is empty where runs are hashed. An
empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = 64
WITHIN = np.arange(STEP, dtype=np.uint8)
END, MARK = 0, 1  # codes of the text's end and of the delimiter; letters follow


# The index and its search, for the words of one shard.


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """By prefix doubling from as many codes as one key holds; the last code is smaller
    than all others."""
    n = len(codes)
    bits = int(codes.max()).bit_length()
    k = max(1, min(n, 62 // bits))
    key = np.zeros(n, np.int64)
    for i in range(k):
        key <<= bits
        key[: n - i] |= codes[i:]
    while True:
        order = np.argsort(key, kind="stable")
        changed = np.concatenate(([0], np.cumsum(key[order[1:]] != key[order[:-1]])))
        if changed[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = changed
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + after
        k *= 2


class Index:
    """One direction: transform, first ranks, and counts of symbols before each STEP."""

    def __init__(self, codes: np.ndarray, symbols: int):
        self.suffixes = suffix_array(codes)
        last = codes[self.suffixes - 1]
        n = len(codes)
        self.symbols = symbols
        self.last = np.full((n // STEP + 1) * STEP, symbols, np.uint8)
        self.last[:n] = last
        blocks = np.arange(n) // STEP
        per_block = np.bincount(blocks * symbols + last, minlength=(n // STEP + 1) * symbols).reshape(-1, symbols)
        self.before = np.concatenate((np.zeros((1, symbols), np.int64), np.cumsum(per_block, axis=0)[:-1]))
        self.smaller = np.cumsum(self.before, axis=1) - self.before
        total = np.bincount(codes, minlength=symbols)
        self.first = np.cumsum(total) - total

    def _inside(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of places, and what of the transform is in them before the places."""
        block = at // STEP
        inside = self.last.reshape(-1, STEP)[block]
        inside[WITHIN >= (at % STEP).astype(np.uint8)[:, None]] = self.symbols
        return block, inside

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first `at` of the transform, per place."""
        block, inside = self._inside(at)
        places = np.arange(len(at))[:, None] * (self.symbols + 1) + inside
        counts = np.bincount(places.ravel(), minlength=len(at) * (self.symbols + 1))
        return self.before[block] + counts.reshape(len(at), self.symbols + 1)[:, : self.symbols]

    def rank(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one symbol, and for all smaller ones together."""
        block, inside = self._inside(at)
        symbols = symbol.astype(np.uint8)[:, None]
        own = self.before[block, symbol] + np.count_nonzero(inside == symbols, axis=1)
        return own, self.smaller[block, symbol] + np.count_nonzero(inside < symbols, axis=1)


class Shard:
    """Both directions of the delimited words (distinct)."""

    def __init__(self, words: list[str]):
        self.words = words
        text = "\x01".join(["", *words, ""])
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet = np.unique(points)  # the delimiter is the least
        codes = (np.searchsorted(self.alphabet, points) + MARK).astype(np.int64)
        self.symbols = len(self.alphabet) + 1
        self.forward = Index(np.append(codes, END), self.symbols)
        self.reverse = Index(np.append(codes[::-1], END), self.symbols)
        starts = np.nonzero(codes == MARK)[0]
        self.word_at = np.full(len(codes) + 1, -1, np.int64)
        self.word_at[starts[:-1]] = np.arange(len(words))
        self.size = len(codes) + 1

    def coded(self, word: str) -> np.ndarray:
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.searchsorted(self.alphabet, points) + MARK

    def left(self, lo: np.ndarray, lo2: np.ndarray, width: np.ndarray, symbol: np.ndarray) -> tuple:
        """Intervals of the extension by a symbol before the match."""
        return self._by_one(self.forward, lo, lo2, width, symbol)

    def right(self, lo: np.ndarray, lo2: np.ndarray, width: np.ndarray, symbol: np.ndarray) -> tuple:
        """And behind it."""
        lo2, lo, width = self._by_one(self.reverse, lo2, lo, width, symbol)
        return lo, lo2, width

    def every_right(self, lo: np.ndarray, lo2: np.ndarray, width: np.ndarray) -> tuple:
        """Intervals of all extensions by a symbol behind the match, each (states, symbols)."""
        n = len(lo)
        both = self.reverse.ranks(np.concatenate((lo2, lo2 + width)))
        new = both[n:] - both[:n]
        smaller = np.cumsum(new, axis=1) - new
        return lo[:, None] + smaller, self.reverse.first + both[:n], new

    @staticmethod
    def _by_one(own: Index, lo: np.ndarray, other: np.ndarray, width: np.ndarray, symbol: np.ndarray) -> tuple:
        n = len(lo)
        rank, smaller = own.rank(np.concatenate((lo, lo + width)), np.concatenate((symbol, symbol)))
        return own.first[symbol] + rank[:n], other + smaller[n:] - smaller[:n], rank[n:] - rank[:n]


def one_edit(shard: Shard, queries: list[str], halves: list[int], block: int = 1024) -> list[tuple[int, int]]:
    """(query, word) numbers of words one edit away whose first `half` code points are the
    query's. Queries are among the shard's words."""
    out = []
    for at in range(0, len(queries), block):
        found = _search(shard, [shard.coded(q) for q in queries[at : at + block]], np.array(halves[at : at + block]))
        out += [(at + q, w) for q, w in found]
    return out


def _search(shard: Shard, queries: list[np.ndarray], halves: np.ndarray) -> list[tuple[int, int]]:
    lengths = np.array([len(q) for q in queries])
    starts = np.cumsum(lengths) - lengths
    symbols = np.concatenate([*queries, [MARK]])
    n = len(queries)
    # The exact half, from its end to the delimiter before it.
    lo, lo2, width = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, shard.size)
    for step in range(int(halves.max()) + 1):
        live = np.nonzero(halves >= step)[0]
        wanted = np.where(halves[live] > step, symbols[starts[live] + np.maximum(halves[live] - 1 - step, 0)], MARK)
        lo[live], lo2[live], width[live] = shard.left(lo[live], lo2[live], width[live], wanted)
    # Then to the right, as query, place in it and intervals: states without an edit ...
    query, place = np.arange(n), halves.copy()
    edited = [np.zeros(0, np.int64)] * 5
    out = []
    while len(query) or len(edited[0]):
        # ... and with one, which follow the query to its end, and to the delimiter there.
        i, j, lo_1, lo2_1, width_1 = edited
        ended = j == lengths[i]
        wanted = np.where(ended, MARK, symbols[starts[i] + j])
        lo_1, lo2_1, width_1 = shard.right(lo_1, lo2_1, width_1, wanted)
        for q, first, many in zip(i[ended], lo_1[ended], width_1[ended], strict=True):
            out += [(int(q), int(shard.word_at[p])) for p in shard.forward.suffixes[first : first + many]]
        on = ~ended & (width_1 > 0)
        states = [(i[on], j[on] + 1, lo_1[on], lo2_1[on], width_1[on])]
        # An edit: another letter in place of the query's, a letter more, or one less.
        ended = place == lengths[query]
        wanted = np.where(ended, MARK, symbols[starts[query] + place])
        every = np.arange(len(query))
        a, b, w = shard.every_right(lo, lo2, width)
        present = w > 0
        present[:, : MARK + 1] = False
        replaced = present & ~ended[:, None]
        replaced[every, wanted] = False
        for chosen, forward in ((replaced, 1), (present, 0)):
            i, c = np.nonzero(chosen)
            states.append((query[i], place[i] + forward, a[i, c], b[i, c], w[i, c]))
        on = ~ended
        states.append((query[on], place[on] + 1, lo[on], lo2[on], width[on]))
        edited = [np.concatenate(x) for x in zip(*states, strict=True)]
        query, place, wanted = query[on], place[on] + 1, wanted[on]
        lo, lo2, width = a[every[on], wanted], b[every[on], wanted], w[every[on], wanted]
    return out


# Spark.


def _near(groups: pd.DataFrame) -> pd.DataFrame:
    entries = groups[groups["entry"]].drop_duplicates("word")
    queries = groups[groups["asks"]]
    empty = pd.DataFrame({"word": [], "n": [], "near": [], "near_n": []}).astype({"word": "object", "n": "int64", "near": "object", "near_n": "int64"})
    if not len(entries) or not len(queries):
        return empty
    words, counts = entries["word"].tolist(), entries["n"].tolist()
    known = set(words)
    asked = [(w, n, h) for w, n, h in zip(queries["word"], queries["n"], queries["half"], strict=True)]
    # Queries of other parts may have letters that no entry has: their half may still match.
    shard = Shard(words + sorted({w for w, _, _ in asked} - known))
    pairs = one_edit(shard, [w for w, _, _ in asked], [h for _, _, h in asked])
    rows = [(asked[q][0], asked[q][1], words[w], counts[w]) for q, w in set(pairs) if w < len(words)]
    return pd.DataFrame(rows, columns=empty.columns).astype(empty.dtypes) if rows else empty


def near_words(words: DataFrame, size: int = 100_000) -> DataFrame:
    """Distinct words (word, n) -> word, n, near, near_n, a row per ordered pair."""
    length = F.length("word")
    sides = []
    for side, less in (("first", 0), ("last", 1)):
        # A word of m code points is matched by m // 2 of them at its start or
        # (m + 1) // 2 at its end; words up to one shorter or longer must be there as well.
        halves = F.array_distinct(F.array(*[F.floor((length + less + d) / 2).cast("int") for d in (-1, 0, 1)]))
        held = words.select("n", (F.col("word") if not less else F.reverse("word")).alias("word"), F.explode(halves).alias("half"))
        held = held.where((F.col("half") >= 0) & (F.col("half") <= F.length("word")))
        sides.append(held.withColumn("side", F.lit(side)).withColumn("asks", F.col("half") == F.floor((F.length("word") + less) / 2)))
    key = F.xxhash64("side", "half", F.expr("substring(word, 1, half)"))
    rows = stored(sides[0].unionByName(sides[1]).withColumn("key", key))
    letters = F.sum(F.length("word") + 1)
    total = rows.agg(letters).first()[0] or 0
    shards = max(1, total // size)
    # Keys that overfill a shard are dealt into parts.
    parts = rows.groupBy("key").agg(F.ceil(letters / size).cast("int").alias("parts")).where("parts > 1")
    dealt = rows.join(stored(parts), "key", "left").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int"))
    single = dealt.where("parts is null").select("side", F.pmod("key", F.lit(shards)).alias("shard"), F.lit(0).alias("i"), F.lit(0).alias("j"), "word", "n", "half", F.lit(True).alias("entry"), "asks")
    many = dealt.where("parts is not null")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    entries = many.select("side", F.col("key").alias("shard"), F.col("own").alias("i"), other.alias("j"), "word", "n", "half", F.lit(True).alias("entry"), F.lit(False).alias("asks"))
    queries = many.where("asks").select("side", F.col("key").alias("shard"), other.alias("i"), F.col("own").alias("j"), "word", "n", "half", F.lit(False).alias("entry"), F.lit(True).alias("asks"))
    grouped = single.unionByName(entries).unionByName(queries).groupBy("side", "shard", "i", "j")
    found = grouped.applyInPandas(lambda key, g: _near(g).assign(side=key[0]), "side string, word string, n long, near string, near_n long")
    forward = F.col("side") == "first"
    turned = found.select(*[F.when(forward, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "near")], "n", "near_n")
    return turned.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: where forms lead in the end. Forms have no circles."""
    state = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = state.join(ahead, "root", "left")
        now = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        discard(state)
        if not now.where("moved").take(1):
            return now.select("word", "root")
        state = now.select("word", "root")


def variants(words: DataFrame, times: int = 10, size: int = 100_000) -> DataFrame:
    """Words (word, n) -> word, n, n_near, form, form_n, root."""
    known = stored(words.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")))
    near = near_words(known, size).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    follows = -F.col("best.less") >= F.col("n") * times
    near = stored(near.select("word", "n_near", F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n")))
    led = roots(near.where("form is not null").select("word", "form"))
    out = known.join(near, "word", "left").join(led, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def misspelt_words(docs: DataFrame, every: int = 31) -> DataFrame:
    """Runs of letters in all texts, A-Z lower-cased, one in `every` (by a checksum of
    doc_id and run) with one letter deleted: word, n."""
    found = F.explode(F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(LETTERS), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), found.alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word: Column = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return runs.select("run", h.alias("h")).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def common_words(counted: DataFrame, least_length: int = 7, least: int = 2) -> DataFrame:
    return counted.where((F.length("word") >= least_length) & (F.col("n") >= least))
