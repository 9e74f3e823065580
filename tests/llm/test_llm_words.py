"""Exact duplicates, phrases and spelling variants against brute force and hand-made rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.llm import exact, phrases, variants

SCHEMA = "doc_id long, text string, lang string, source string"
BIG = 2**53 + 1
LONG = "word and another word of a very long text " * 3000


def _docs(spark, rows):
    frame = spark.createDataFrame([(i, t, lang, "s") for i, t, lang in rows], SCHEMA)
    clash = ["ids", "extra", "row", "print", "salt", "word", "n", "edge", "path", "part", "a", "l", "r", "h", "run", "_kept", "_row"]
    return frame.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns."""
    return _docs(
        spark,
        [
            (1, None, "en"),
            (2, "", None),
            (None, "no id at all here", "en"),
            (None, "no id  at all here", "en"),
            (3, LONG, "en"),
            (BIG, LONG, "en"),
            (4, "one two three one two three " * 12, "de"),
            (4, "one two three one two three " * 12, "de"),
            (5, " \n\t", "fr"),
            (6, "x" * 100_000, None),
            (7, "Ünïcode – 你好 \U0001f600 " * 5, "und"),
        ],
    )


# Exact duplicates


def _equal_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        least = known[0] if known else None
        kept = [False] * len(ids)
        kept[ids.index(least)] = True
        out += [(i, least, len(ids), k, hashlib.sha256(text.encode()).hexdigest()) for i, k in zip(ids, kept)]
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"bits": 3}, {"every": 2, "longest": 3, "widest": 7, "bits": 8}])
def test_exact_duplicates_equal_brute_force(spark, odd, options):
    """With few bits most identifiers are those of several chunks, and are told apart."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(["a", "bb", "ccc", "dd  dd", "\te"]) for _ in range(rng.randrange(6)))
        rows.append((i, text if rng.random() < 0.9 else None, "en"))
    frame = odd.unionByName(_docs(spark, rows))
    found = sorted((tuple(r) for r in exact.exact_duplicates(frame, **options).collect()), key=str)
    assert found == _equal_groups([(r.doc_id, r.text) for r in frame.collect()])
    assert exact.exact_duplicates(frame.limit(0), **options).count() == 0


def test_another_seed_ends_doubt(spark, odd):
    """More doubtful identifiers than the limit: texts are hashed again until they fit."""
    tries = []
    real = exact.doubtful

    def counted(parts, seed, bits):
        tries.append(seed)
        return real(parts, seed, bits)

    exact.doubtful = counted
    try:
        found = exact.exact_duplicates(odd, bits=5, limit=1, every=4).collect()
    finally:
        exact.doubtful = real
    assert len(found) == 11 and tries == list(range(len(tries)))


def test_hot_groups_are_dealt_and_whole(spark):
    rows = [(i, "the one hot text", "en") for i in range(3000)] + [(10_000 + i, f"own {i % 700}", "en") for i in range(1400)]
    found = exact.exact_duplicates(_docs(spark, rows), salts=7).collect()
    assert Counter((r.keep_id, r.group_size) for r in found if r.doc_id < 10_000) == {(0, 3000): 3000}
    assert sum(r.kept for r in found) == 701


def test_chunks_give_the_text_back_and_follow_content(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(5000)]
    text = " ".join(words)
    shifted = "some words put before it " + text
    rows = spark.createDataFrame([(1, text), (2, shifted), (3, " "), (4, ""), (5, "y" * 30_000)], "i long, text string")
    found = {r.i: (r.text, r.chunks) for r in rows.select("i", "text", exact.chunks(F.col("text")).alias("chunks")).collect()}
    assert all("".join(c) == t + " " for t, c in found.values())
    assert len(set(found[1][1]) - set(found[2][1])) <= 1 and max(map(len, found[5][1])) <= 8192
    assert max(len(c.split()) for c in found[1][1]) <= 128


def test_distinct_rows(odd):
    kept = exact.distinct_rows(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "None"]


# Phrases


def _phrases(rows, top=2000, least=10):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        longer = defaultdict(int)
        for p, a in f.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least or 2 * longer[p] >= a and len(p) == 2:
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def test_phrases_equal_brute_force(spark, odd):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        words = [rng.choice(["New", "york", "city", "of", "the", "a", "É", "x.", "sea,", "\t"]) for _ in range(rng.randrange(40))]
        rows.append((i, " ".join(words), rng.choice(["en", "de", None])))
    rows += [(1000 + i, "a b c a b c a b c a b c. one two three four five six seven\n", "en") for i in range(12)]
    frame = odd.unionByName(_docs(spark, rows))
    for top, counting in ((2000, {}), (7, {"flush": 5, "group": 300})):
        found = sorted(tuple(r) for r in phrases.collocations(frame, top=top, **counting).collect())
        assert found == _phrases([(r.text, r.lang) for r in frame.collect()], top=top)
    assert phrases.collocations(frame.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_paths_of_chains_and_circles(spark, seed):
    """Every edge is in one path, and paths follow the links; circles are cut once."""
    rng = random.Random(seed)
    names = list(range(200))
    rng.shuffle(names)
    links, at = {}, 0
    for length, circle in ((1, False), (2, True), (3, True), (30, False), (47, True), (64, True), (40, False)):
        own = names[at : at + length]
        at += length
        links |= dict(zip(own, own[1:]))
        if circle:
            links[own[-1]] = own[0]
    found = defaultdict(dict)
    for r in phrases.paths(spark.createDataFrame(list(links.items()), "edge long, next long")).collect():
        assert r.steps not in found[r.path]
        found[r.path][r.steps] = r.edge
    followed = 0
    for path, steps in found.items():
        assert sorted(steps) == list(range(len(steps))) and steps[0] == path
        for s in range(1, len(steps)):
            assert links[steps[s]] == steps[s - 1]
            followed += 1
    assert sum(map(len, found.values())) == len(set(links) | set(links.values()))
    assert followed == len(links) - 4  # each circle is cut at one link
    assert phrases.paths(spark.createDataFrame([], "edge long, next long")).count() == 0


def test_compacted_paths_hold_every_edge_in_order(spark):
    edges = [(i, i + 1, i + 2, 10 + i) for i in range(58)] + [(100, 0, 1, 11), (101, 0, 1, 12), (7, 7, 7, 99)]
    found = phrases.compacted(spark.createDataFrame(edges, "w1 long, w2 long, w3 long, f long"), part=16).collect()
    assert sorted(tuple(e) for r in found for e in r.edges) == sorted(edges)
    for r in found:
        assert len(r.edges) <= 16
        assert all((a.w2, a.w3) == (b.w1, b.w2) for a, b in zip(r.edges, r.edges[1:]))
    assert len(found) == 3 + 4  # one path of 58 in four parts, three of one edge


def test_hashes_of_two_words_are_made_anew(spark, monkeypatch):
    """Words that share a hash under one salt are told apart under the next."""
    docs = _docs(spark, [(1, "a b c. " * 20, "en")])
    real, salts = phrases.dictionary, []

    def doubtful(docs, salt=""):
        salts.append(salt)
        found = real(docs, salt)
        return found.withColumn("h", F.lit(5).cast("long")) if len(salts) == 1 else found

    monkeypatch.setattr(phrases, "dictionary", doubtful)
    assert [r.phrase for r in phrases.collocations(docs).collect()] == ["a b c"] and salts == ["", "+"]


def test_packed_edges_come_back(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    words, counts = phrases._totals(rng.integers(-3, 3, (500, 3)), rng.integers(1, 400, 500))
    back = phrases._unpack(phrases._pack(words, counts))
    assert (back[0] == words).all() and (back[1] == counts).all()


# Spelling variants


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def _variants(counts, times=10):
    near = {w: sorted(((-counts[v], v) for v in counts if _near(w, v))) for w in counts}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= times * counts[w] else None for w in counts}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w in counts)


def _words(rng, n):
    """Words of a small alphabet and their misspellings, with counts far apart."""
    out = {}
    for _ in range(n):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 10)))
        for _ in range(rng.randrange(4)):
            out[w] = rng.choice([1, 2, 25, 300, 4000])
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice("abÿ") + w[i:], w[:i] + w[i + 1 :], w[:i] + "b" + w[i + 1 :]]) or "a"
    return out


@pytest.mark.parametrize("size", [100_000, 300, 30])
def test_variants_equal_brute_force(spark, size):
    """With small shards, the words of one half are dealt into parts that all meet."""
    counts = _words(random.Random(4), 160)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = sorted(tuple(r) for r in variants.variants(frame, size=size).collect())
    assert found == _variants(counts)
    assert any(r[3] and r[3] != r[5] for r in found)


def test_variants_odd_rows(spark):
    long = "ab" * 20_000
    rows = [("banana", 100), ("banan", 3), (None, 5), ("banan", 2), (long, 2), (long + "c", 40), ("", 1), ("a", 10)]
    found = {r.word: tuple(r)[1:] for r in variants.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert found["banan"] == (5, 1, "banana", 100, "banana")
    assert found[long] == (2, 1, long + "c", 40, long + "c")
    assert found[""] == (1, 1, "a", 10, "a") and None not in found
    assert variants.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_misspelt_words_equal_brute_force(odd):
    import zlib

    expected = Counter()
    for r in odd.collect():
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", r.text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            i = h % len(run)
            expected[run[:i] + run[i + 1 :] if h % 31 == 0 else run] += 1
    assert {r.word: r.n for r in variants.misspelt_words(odd).collect()} == expected
