"""Personal data: fixed patterns, and a character BiLSTM with a CRF that adds to them.

The patterns (email, ip, card, phone) are exact and always stay. The tagger is a
bidirectional LSTM over character classes with linear-chain CRF transitions, trained in
numpy from labelled spans: windows around pattern matches of a bounded sample of
documents, some rewritten into forms the patterns don't cover (spaced addresses, numbers
without a country code), and windows with digits but no match as counter-examples.

Every span of these kinds holds a digit or an `@`, so the tagger reads exactly the
windows around those characters in the whole text; all other characters are outside by
definition. Windows overlap. Each is decoded by Viterbi; a decoded span's confidence is
the least probability of its characters' tags. Spans of all windows of a text are then
reconciled globally: the set of disjoint spans, none touching a pattern match, with the
largest total length-weighted confidence is kept, by weighted interval scheduling.

Missing or empty text has no spans. Repeated rows come out as often as they came in.
Without labelled spans in the sample there is no tagger, and the patterns stand alone.
Other columns are not looked at; long texts are tagged in blocks of windows.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, as_text, stored

KINDS = ["email", "ip", "card", "phone"]
#: A match starts where no digit is before it; saying so keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
TRIGGER = re.compile(r"[0-9@]")
#: Java's form of TRIGGER, for filters before any Python.
TRIGGERS = "[0-9@]"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern local@domain finds them, without its square running time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches that pass their checks, in order."""
    if not text or not TRIGGER.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# The tagger. Tags: 0 outside, then begin and inside of each kind.

N_TAGS = 1 + 2 * len(KINDS)
PUNCTUATION = "@.-+()_ \n,:;#*$%&|<>!?\"'=/[]{}"
N_CLASSES = 5 + len(PUNCTUATION)
_CLASS = np.full(128, 4, np.int64)
for _c in range(128):
    _CLASS[_c] = 1 if chr(_c).isdigit() else 2 if "a" <= chr(_c) <= "z" else 3 if "A" <= chr(_c) <= "Z" else 5 + PUNCTUATION.index(chr(_c)) if chr(_c) in PUNCTUATION else 4


def classes(text: str, length: int) -> np.ndarray:
    """Character classes, padded with 0 to `length`."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(length, np.int64)
    out[: len(codes)] = np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 2)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _lstm(p: dict, d: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (batch, time, hidden) of one direction, and what backward needs."""
    b, t = x.shape
    n = p[f"{d}U"].shape[0]
    h, c, hs, saved = np.zeros((b, n)), np.zeros((b, n)), np.zeros((b, t, n)), []
    for i in range(t) if d == "f" else range(t - 1, -1, -1):
        z = p[f"{d}W"][x[:, i]] + h @ p[f"{d}U"] + p[f"{d}b"]
        g_in, g_forget, g_out, new = _sigmoid(z[:, :n]), _sigmoid(z[:, n : 2 * n]), _sigmoid(z[:, 2 * n : 3 * n]), np.tanh(z[:, 3 * n :])
        before, c = (h, c), g_forget * c + g_in * new
        h = g_out * np.tanh(c)
        hs[:, i] = h
        saved.append((i, before, g_in, g_forget, g_out, new, c))
    return hs, saved


def _lstm_back(p: dict, grad: dict, d: str, x: np.ndarray, saved: list, dhs: np.ndarray) -> None:
    n = p[f"{d}U"].shape[0]
    dh, dc = np.zeros((len(x), n)), np.zeros((len(x), n))
    for i, (h, c0), g_in, g_forget, g_out, new, c in reversed(saved):
        dh = dh + dhs[:, i]
        th = np.tanh(c)
        dc = dc + dh * g_out * (1 - th * th)
        dz = np.concatenate((dc * new * g_in * (1 - g_in), dc * c0 * g_forget * (1 - g_forget), dh * th * g_out * (1 - g_out), dc * g_in * (1 - new * new)), axis=1)
        np.add.at(grad[f"{d}W"], x[:, i], dz)
        grad[f"{d}U"] += h.T @ dz
        grad[f"{d}b"] += dz.sum(axis=0)
        dh, dc = dz @ p[f"{d}U"].T, dc * g_forget


def emissions(p: dict, x: np.ndarray) -> np.ndarray:
    hidden = np.concatenate((_lstm(p, "f", x)[0], _lstm(p, "b", x)[0]), axis=2)
    return hidden @ p["V"] + p["v"]


def _forward_backward(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition, alphas and betas of a batch of chains."""
    b, t, k = e.shape
    alpha, beta = np.zeros((b, t, k)), np.zeros((b, t, k))
    alpha[:, 0] = e[:, 0]
    for i in range(1, t):
        alpha[:, i] = e[:, i] + _logsumexp(alpha[:, i - 1, :, None] + trans[None], 1)
    for i in range(t - 2, -1, -1):
        beta[:, i] = _logsumexp(trans[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
    return _logsumexp(alpha[:, -1], 1), alpha, beta


def _rules() -> np.ndarray:
    """Transitions that no labelling has: into the inside of a kind from outside of it."""
    ban = np.zeros((N_TAGS, N_TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        ban[:, inside] = -1e4
        ban[[inside - 1, inside], inside] = 0
    return ban


BANNED = _rules()


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], length: int = 96, hidden: int = 16, steps: int = 160, batch: int = 48, rate: float = 0.02, seed: int = 5) -> dict | None:
    """Weights from labelled windows (text, [(start, kind, end)]), by Adam on the CRF's
    negative log likelihood. None without a labelled span."""
    if not any(spans for _, spans in windows):
        return None
    rng = np.random.default_rng(seed)
    x = np.stack([classes(t[:length], length) for t, _ in windows])
    y = np.zeros(x.shape, np.int64)
    for row, (_, spans) in zip(y, windows, strict=True):
        for s, k, e in spans:
            row[s:e] = 2 + 2 * k
            row[s : s + 1] = 1 + 2 * k
    p = {"V": rng.normal(0, 0.3, (2 * hidden, N_TAGS)), "v": np.zeros(N_TAGS), "T": np.zeros((N_TAGS, N_TAGS))}
    for d in "fb":
        p |= {f"{d}W": rng.normal(0, 0.3, (N_CLASSES, 4 * hidden)), f"{d}U": rng.normal(0, 0.2, (hidden, 4 * hidden)), f"{d}b": np.zeros(4 * hidden)}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    labelled = np.nonzero(y.any(axis=1))[0]
    for step in range(1, steps + 1):
        rows = np.concatenate((rng.choice(labelled, batch // 2), rng.integers(0, len(x), batch // 2)))
        bx, by = x[rows], y[rows]
        (hf, sf), (hb, sb) = _lstm(p, "f", bx), _lstm(p, "b", bx)
        h = np.concatenate((hf, hb), axis=2)
        e, trans = h @ p["V"] + p["v"], p["T"] + BANNED
        z, alpha, beta = _forward_backward(e, trans)
        de = np.exp(alpha + beta - z[:, None, None])
        np.subtract.at(de, (np.arange(len(bx))[:, None], np.arange(length)[None], by), 1)
        dt = np.zeros_like(trans)
        for i in range(length - 1):
            dt += np.exp(alpha[:, i, :, None] + trans[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.subtract.at(dt, (by[:, :-1].ravel(), by[:, 1:].ravel()), 1)
        de, dt = de / len(bx), dt / len(bx)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["T"], grad["v"], grad["V"] = dt, de.sum(axis=(0, 1)), np.einsum("bth,btk->hk", h, de)
        dh = de @ p["V"].T
        _lstm_back(p, grad, "f", bx, sf, dh[:, :, :hidden])
        _lstm_back(p, grad, "b", bx, sb, dh[:, :, hidden:])
        norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1, 5 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in p.items()}


def decode(p: dict, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    """Viterbi spans (start, kind, end, confidence) of each window."""
    e, trans = emissions(p, x), p["T"] + BANNED
    z, alpha, beta = _forward_backward(e, trans)
    sure = np.exp(alpha + beta - z[:, None, None])
    b, t, _ = e.shape
    score, back = e[:, 0], np.zeros(e.shape, np.int8)
    for i in range(1, t):
        total = score[:, :, None] + trans[None]
        back[:, i] = total.argmax(axis=1)
        score = total.max(axis=1) + e[:, i]
    tags = np.zeros((b, t), np.int64)
    tags[:, -1] = score.argmax(axis=1)
    for i in range(t - 1, 0, -1):
        tags[:, i - 1] = back[np.arange(b), i, tags[:, i]]
    out = []
    for row, own in zip(tags, sure, strict=True):
        spans, i = [], 0
        while i < t:
            if row[i] % 2 == 1:
                end = i + 1
                while end < t and row[end] == row[i] + 1:
                    end += 1
                spans.append((i, int(row[i] // 2), end, float(own[np.arange(i, end), row[i:end]].min())))
                i = end
            else:
                i += 1
        out.append(spans)
    return out


def window_starts(text: str, length: int) -> list[int]:
    """Starts of half-overlapping windows that hold all digits and `@` with context."""
    out: list[int] = []
    step = length // 2
    for m in TRIGGER.finditer(text):
        cell = m.start() // step
        for c in (cell - 1, cell):
            if c >= 0 and (not out or c * step > out[-1]):
                out.append(c * step)
    return out


def reconcile(spans: list[tuple[int, int, int, float]], fixed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The disjoint spans of largest total confidence x length that touch no fixed one."""
    best: dict[tuple[int, int, int], float] = {}
    for s, k, e, sure in spans:
        best[s, k, e] = max(best.get((s, k, e), 0.0), sure)
    starts, furthest, top = [s for s, _, _ in fixed], [], 0
    for _, _, e in fixed:
        furthest.append(top := max(top, e))
    free = []
    for (s, k, e), sure in best.items():
        i = bisect.bisect_left(starts, e)
        if not (i and furthest[i - 1] > s):
            free.append((e, s, k, sure * (e - s)))
    free.sort()
    ends, total, take = [f[0] for f in free], [0.0], []
    for i, (_, s, _, gain) in enumerate(free):
        j = bisect.bisect_right(ends, s, 0, i)
        take.append(total[j] + gain > total[i])
        total.append(max(total[i], total[j] + gain))
    out, i = [], len(free)
    while i:
        if take[i - 1]:
            e, s, k, _ = free[i - 1]
            out.append((s, k, e))
            i = bisect.bisect_right(ends, s, 0, i - 1)
        else:
            i -= 1
    return out[::-1]


def plausible(kind: int, text: str) -> bool:
    """What any span of a kind must hold, whatever the model says."""
    digits = sum(c.isdigit() for c in text)
    if kind == 0:
        return "@" in text and "." in text and any(c.isalpha() for c in text)
    if kind == 1:
        return digits >= 4 and text.count(".") == 3
    if kind == 2:
        return 14 <= digits <= 19 and luhn("".join(c for c in text if "0" <= c <= "9"))
    return 10 <= digits <= 15 and not any(c.isalpha() for c in text)


def added_spans(p: dict | None, text: str, fixed: list[tuple[int, int, int]], length: int = 96, least: float = 0.9, block: int = 256) -> list[tuple[int, int, int]]:
    """Spans that the tagger adds to the fixed ones."""
    if p is None:
        return []
    starts, found = window_starts(text, length), []
    for at in range(0, len(starts), block):
        part = starts[at : at + block]
        x = np.stack([classes(text[s : s + length], length) for s in part])
        for s0, spans in zip(part, decode(p, x), strict=True):
            for s, k, e, sure in spans:
                whole = (s > 0 or s0 == 0) and (e < length or s0 + length >= len(text)) and s0 + e <= len(text)
                if whole and sure >= least and plausible(k, text[s0 + s : s0 + e]):
                    found.append((s0 + s, k, s0 + e, sure))
    return reconcile(found, fixed)


# Labelled windows for training.


def _rewritten(text: str, kind: int, rng: np.random.Generator) -> str:
    """The same datum in a form the patterns don't cover."""
    if kind == 0:
        return text.replace("@", " @ ") if rng.random() < 0.5 else text
    if kind == 3:
        digits = re.sub(r"[^0-9]", "", text)[-10:]
        return rng.choice([f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}", text])
    if kind == 2:
        return rng.choice([text, ".".join(text[i : i + 4] for i in range(0, len(text), 4))])
    return text


def labelled_windows(text: str | None, length: int = 96, per_text: int = 4) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of a text with their spans, as found and as rewritten, and some with
    digits but no span."""
    fixed = base_spans(text)
    if not text or not TRIGGER.search(text):
        return []
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], "big"))
    out, seen = [], 0
    for s, k, e in fixed[:per_text]:
        if e - s > length // 2:
            continue
        for own in (text[s:e], _rewritten(text[s:e], k, rng)):
            before = text[max(0, s - int(rng.integers(4, length - len(own) - 2))) : s]
            if any(a < s and b > s - len(before) for a, _, b in fixed) or TRIGGER.search(text[e : e + length]):
                before, after = before[-3:] if not TRIGGER.search(before[-3:]) else "", ""
            else:
                after = text[e : e + length]
            if TRIGGER.search(before):
                before = ""
            window = (before + own + after)[:length]
            out.append((window, [(len(before), k, min(len(before) + len(own), length))]))
    for m in TRIGGER.finditer(text):
        if seen == per_text:
            break
        s = max(0, m.start() - int(rng.integers(0, length - 8)))
        if not any(a < s + length and b > s for a, _, b in fixed):
            out.append((text[s : s + length], []))
            seen += 1
    return out


def tagger(docs: DataFrame, sample_docs: int = 20000, sample_windows: int = 600, length: int = 96) -> dict | None:
    """A tagger from the labelled spans of a bounded, seeded sample of the documents:
    about `sample_docs` documents and at most `sample_windows` windows of `length`."""
    n = docs.count()
    share = max(1, n // sample_docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [w for t in rows["text"] for w in labelled_windows(t, length)]
            yield pd.DataFrame(
                {
                    "window": [w for w, _ in found],
                    "spans": [[x for span in s for x in span] for _, s in found],
                    "key": [hashlib.sha256(w.encode("utf-8", "surrogatepass")).hexdigest() for w, _ in found],
                }
            )

    some = docs.where(F.col("text").rlike(TRIGGERS) & (F.pmod(F.xxhash64("text"), F.lit(share)) == 0)).select("text")
    kept = stored(some.mapInPandas(run, "window string, spans array<int>, key string").distinct())
    kind = F.coalesce(F.get("spans", F.lit(1)), F.lit(-1))
    rows = []
    for k in range(-1, len(KINDS)):
        rows += kept.where(kind == k).orderBy("key", "window").limit(sample_windows // (len(KINDS) + 1)).collect()
    return train([(r["window"], [(r["spans"][0], r["spans"][1], r["spans"][2])] if r["spans"] else []) for r in rows], length)


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _find(p: dict | None, length: int, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
                fixed = base_spans(text)
                spans = sorted(fixed + added_spans(p, text, fixed, length, least)) if text and TRIGGER.search(text) else []
                n = np.bincount([k for _, k, _ in fixed], minlength=len(KINDS)).tolist()
                out.append((doc_id, *n, hashlib.sha256(_named(fixed).encode()).hexdigest(), _named(spans)))
            frame = pd.DataFrame(out, columns=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
            yield frame

    return run


def _suspects() -> Column:
    """Texts that can hold a span; the others go to Python as null."""
    return F.when(F.col("text").rlike(TRIGGERS), F.col("text")).alias("text")


def personal_data(docs: DataFrame, least: float = 0.9, length: int = 96, learn_from: DataFrame | None = None, **sample) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of
    the pattern matches, and `spans`, all spans as kind:start:end. The tagger learns from
    the same documents, unless others are given."""
    p = tagger(docs if learn_from is None else learn_from, length=length, **sample)
    schema = "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return as_long(docs.select(as_text("doc_id"), _suspects()).mapInPandas(_find(p, length, least), schema), "doc_id")


def _mask(p: dict | None, length: int, least: float):
    def masked(text: str | None) -> str | None:
        fixed = base_spans(text)
        spans = sorted(fixed + added_spans(p, text, fixed, length, least))
        out, at = [], 0
        for s, k, e in spans:
            if s >= at:
                out += [text[at:s], f"<{KINDS[k].upper()}>"]
            at = max(at, e)
        return "".join(out) + text[at:]

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else masked(t))

    return run


def masked_documents(docs: DataFrame, least: float = 0.9, length: int = 96, **sample) -> DataFrame:
    """The documents with every span replaced by its kind, and n_chars to match. Texts
    without a digit or `@` don't leave the JVM's columns changed."""
    p = tagger(docs, length=length, **sample)
    new = F.coalesce(_mask(p, length, least)(_suspects()), F.col("text"))
    out = docs.withColumn("text", new)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)
