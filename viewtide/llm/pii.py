"""Personal data: rules for four kinds, and a character-level bidirectional LSTM with a CRF.

Base spans (email, ip, card, phone) follow fixed rules over the whole text. The tagger is trained in
numpy from labelled spans: windows of 96 characters in which the base spans are the labels, at most
``max_windows`` with and as many without a span, chosen by a hash. It then reads every whole text in
windows that overlap by half. Windows are decoded by Viterbi; runs of tags that touch a window's edge are joined
with those of the neighbours, so a span may be longer than a window; what windows propose is reconciled over the whole
document by weighted interval scheduling, and joins the base spans where it overlaps none. All of it is linear in
the text, but for sorting a document's spans.

All four kinds contain a digit or an @ under any labelling the tagger was trained on, so only windows that a run of
ASCII characters with one of them reaches into are run through the network; the others are "outside" by constraint. Work is one scan of
the texts, which keeps those windows (well under 1 % of the text), then the training sample, then
a map-only pass over the kept windows.

Defined cases: null text counts as empty and has no spans; very long texts are read whole; positions are code points, ends exclusive;
without any base span nothing is learned and nothing added; rows repeating a doc_id get a row each;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, written

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 96, 48
MAX_WINDOWS = 1_200
HIDDEN = 12
ROUNDS, BATCH, RATE = 320, 24, 0.05
CONFIDENCE = 0.9
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

# Fixed values of the contract: the patterns of the four kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_RUN = re.compile(r"[!-~]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of local@domain; a local part is the run of its characters before the @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    """Four dotted numbers at a time, from the left of each dotted run."""
    for run in _DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            start, at = at, at + sum(map(len, four)) + 4
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, at - 1


def base_spans(text: str | None) -> list[Span]:
    """By start, then kind."""
    out: list[Span] = []
    if not text:
        return out
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [("ip", s, e) for s, e in _ips(text)]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def split_spans(text: str) -> list[Span]:
    return [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in text.split(","))] if text else []


# --- the tagger -------------------------------------------------------------------------------
_MARKS = "@.-+() _%,:;\"'/=\n"
CLASSES = 6 + len(_MARKS)  # padding, other, digit, lower, upper, other letter, then the marks


def char_classes(text: str, width: int = WINDOW) -> np.ndarray:
    out = np.zeros(width, np.int64)
    for i, c in enumerate(text[:width]):
        at = _MARKS.find(c)
        out[i] = (6 + at if at >= 0 else 2 if "0" <= c <= "9" else 3 if "a" <= c <= "z" else
                  4 if "A" <= c <= "Z" else 5 if c.isalpha() else 1)
    return out


def tags_of(spans: list[Span], start: int, width: int = WINDOW) -> np.ndarray:
    out = np.zeros(width, np.int64)
    for kind, s, e in spans:
        k = 1 + 2 * KINDS.index(kind)
        lo, hi = max(s, start), min(e, start + width)
        if lo < hi and not out[lo - start:hi - start].any():
            out[lo - start:hi - start] = k + 1
            if s >= start:
                out[s - start] = k
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class BiLstmCrf:
    """Both directions run as one batch of two; ``p`` holds the parameters."""
    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int = 1, hidden: int = HIDDEN) -> "BiLstmCrf":
        r = np.random.default_rng(seed)
        x = r.normal(0, 0.3, (2, CLASSES, 4 * hidden))
        x[:, :, hidden:2 * hidden] += 1.0  # remember at first
        return cls({"x": x, "h": r.normal(0, 0.3, (2, hidden, 4 * hidden)), "o": r.normal(0, 0.3, (2 * hidden, TAGS)),
                    "b": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS)), "s": np.zeros(TAGS)})

    def emissions(self, codes: np.ndarray):
        """Tag scores (batch, time, tag), and what the gradient needs."""
        both = np.stack([codes, codes[:, ::-1]])
        n, width = codes.shape
        hid = self.p["h"].shape[1]
        h, c = np.zeros((2, n, hid)), np.zeros((2, n, hid))
        side = np.arange(2)[:, None]
        steps = []
        for t in range(width):
            z = self.p["x"][side, both[:, :, t]] + h @ self.p["h"]
            gates, g = _sigmoid(z[..., :3 * hid]), np.tanh(z[..., 3 * hid:])
            i, f, o = gates[..., :hid], gates[..., hid:2 * hid], gates[..., 2 * hid:]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            steps.append((h, c, i, f, o, g, tc))
            h, c = o * tc, c_new
        hs = np.stack([s[4] * s[6] for s in steps], axis=2)  # (2, n, width, hid)
        top = np.concatenate([hs[0], hs[1][:, ::-1]], axis=2)
        return top @ self.p["o"] + self.p["b"], (both, steps, top)

    def marginals(self, em: np.ndarray):
        """Log-partition, forward and backward tables."""
        n, width, _ = em.shape
        a = [em[:, 0] + self.p["s"]]
        for t in range(1, width):
            a.append(em[:, t] + _lse(a[-1][:, :, None] + self.p["t"], 1))
        b = [np.zeros((n, TAGS))]
        for t in range(width - 1, 0, -1):
            b.append(_lse(self.p["t"] + (em[:, t] + b[-1])[:, None, :], 2))
        a, b = np.stack(a, 1), np.stack(b[::-1], 1)
        return _lse(a[:, -1], 1), a, b

    def viterbi(self, em: np.ndarray) -> np.ndarray:
        n, width, _ = em.shape
        best, back = em[:, 0] + self.p["s"], []
        for t in range(1, width):
            paths = best[:, :, None] + self.p["t"]
            back.append(paths.argmax(axis=1))
            best = paths.max(axis=1) + em[:, t]
        tags = [best.argmax(axis=1)]
        for pointers in reversed(back):
            tags.append(pointers[np.arange(n), tags[-1]])
        return np.stack(tags[::-1], 1)

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tag sequences."""
        em, (both, steps, top) = self.emissions(codes)
        z, a, b = self.marginals(em)
        n, width, _ = em.shape
        rows, times = np.arange(n)[:, None], np.arange(width)[None]
        d_em = np.exp(a + b - z[:, None, None])
        d_em[rows, times, tags] -= 1
        pair = np.exp(a[:, :-1, :, None] + self.p["t"] + (em + b)[:, 1:, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        np.add.at(pair, (tags[:, :-1], tags[:, 1:]), -1)
        d_em /= n
        g = {"t": pair / n, "s": d_em[:, 0].sum(axis=0), "b": d_em.sum(axis=(0, 1)),
             "o": np.einsum("ntd,ntk->dk", top, d_em)}
        d_top = d_em @ self.p["o"].T
        hid = self.p["h"].shape[1]
        d_hs = np.stack([d_top[..., :hid], d_top[:, ::-1, hid:]])
        g["h"], d_zs = np.zeros_like(self.p["h"]), []
        d_h, d_c = np.zeros((2, n, hid)), np.zeros((2, n, hid))
        back = self.p["h"].transpose(0, 2, 1)
        for t in range(width - 1, -1, -1):
            h, c, i, f, o, gg, tc = steps[t]
            d_h = d_h + d_hs[:, :, t]
            d_c = d_c + d_h * o * (1 - tc * tc)
            d_z = np.concatenate([d_c * gg * i * (1 - i), d_c * c * f * (1 - f), d_h * tc * o * (1 - o),
                                  d_c * i * (1 - gg * gg)], axis=2)
            d_zs.append(d_z)
            g["h"] += h.transpose(0, 2, 1) @ d_z
            d_h, d_c = d_z @ back, d_c * f
        hot = both.reshape(2, 1, -1) == np.arange(CLASSES)[:, None]
        g["x"] = hot.astype(float) @ np.stack(d_zs[::-1], axis=2).reshape(2, n * width, -1)
        return g

    def fit(self, codes: np.ndarray, tags: np.ndarray, rounds: int = ROUNDS, seed: int = 1) -> "BiLstmCrf":
        """Adam over random batches."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, rounds + 1):
            at = r.integers(0, len(codes), BATCH)
            rate = RATE * min(1, 2 * (1 - (step - 1) / rounds))
            for k, g in self.gradient(codes[at], tags[at]).items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
        return self

    def window_runs(self, windows: list[tuple[int, str, bool]]) -> list[list["Run"]]:
        """Per window (start, text, whether the text ends there): its runs of tags of one kind."""
        out: list[list[Run]] = []
        for w in range(0, len(windows), 256):
            some = windows[w:w + 256]
            em, _ = self.emissions(np.stack([char_classes(t) for _, t, _ in some]))
            z, a, b = self.marginals(em)
            sure = np.exp(a + b - z[:, None, None])
            for row, (tags, (start, text, last)) in enumerate(zip(self.viterbi(em), some)):
                found, i = [], 0
                while i < len(text):
                    kind = (tags[i] - 1) // 2
                    if tags[i] == 0 or tags[i] % 2 == 0 and (i > 0 or start == 0):  # outside, or the rest of nothing
                        i += 1
                        continue
                    j = i + 1
                    while j < len(text) and tags[j] == 2 * kind + 2:
                        j += 1
                    found.append((float(sure[row, np.arange(i, j), tags[i:j]].min()), (KINDS[kind], start + i, start + j),
                                  i == 0 and start > 0, j == len(text) and not last))
                    i = j
                out.append(found)
        return out

    def window_spans(self, windows: list[tuple[int, str, bool]]) -> list[list[tuple[float, Span]]]:
        """Per window its (confidence, span) proposals that it holds whole."""
        return [join_runs(runs) for runs in self.window_runs(windows)]


Run = tuple[float, Span, bool, bool]  # confidence, span, whether it may go on before and after its window


def join_runs(runs: list[Run]) -> list[tuple[float, Span]]:
    """The spans of a document's windows: runs that no edge cuts, and chains of overlapping runs cut by edges."""
    out = [(conf, span) for conf, span, before, after in runs if not before and not after]
    chain: dict[str, tuple[float, int, int]] = {}  # of each kind the open one
    for conf, (kind, start, end), before, after in sorted((r for r in runs if r[2] or r[3]), key=lambda r: r[1][1:]):
        if before:
            if kind not in chain or start > chain[kind][2]:
                continue  # what it would go on from is not there
            least, first, last = chain[kind]
            conf, start, end = min(conf, least), first, max(end, last)
        if after:
            chain[kind] = (conf, start, end)
        else:
            out.append((conf, (kind, start, end)))
    return out


def reconcile(proposals: list[tuple[float, Span]], base: list[Span], least: float = CONFIDENCE) -> list[Span]:
    """The non-overlapping proposals with the largest total of confidence, over the whole document."""
    best: dict[Span, float] = {}
    for conf, span in proposals:
        if conf >= least:
            best[span] = max(conf, best.get(span, 0.0))
    starts, reach = _cover(base)
    # of the base spans that start before a proposal ends, the farthest end lies before it starts
    free = [(s[2], s[1], conf, s) for s, conf in best.items()
            if not (k := bisect.bisect_left(starts, s[2])) or reach[k - 1] <= s[1]]
    free.sort()
    ends = [f[0] for f in free]
    total, taken = [0.0], []  # best total of the first k, and for each whether it is part of that
    for k, (_, start, conf, _span) in enumerate(free):
        with_it = total[bisect.bisect_right(ends, start, 0, k)] + conf
        taken.append(with_it > total[k])
        total.append(max(with_it, total[k]))
    out, k = [], len(free)
    while k:
        k -= 1
        if taken[k]:
            out.append(free[k][3])
            k = bisect.bisect_right(ends, free[k][1], 0, k)
    return out[::-1]


def _cover(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts of the spans in order, and the farthest end up to each."""
    by_start = sorted(spans, key=lambda x: x[1])
    return [s for _, s, _ in by_start], list(itertools.accumulate((e for *_, e in by_start), max))


# --- Spark ------------------------------------------------------------------------------------
SCANNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("base", T.StringType()),
                        T.StructField("starts", T.ArrayType(T.IntegerType())),
                        T.StructField("windows", T.ArrayType(T.StringType())),
                        T.StructField("n_chars", T.IntegerType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                      T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                      T.StructField("n_added", T.LongType())])


def open_windows(text: str | None) -> list[int]:
    """Starts of the windows that a run of ASCII characters with a digit or an @ reaches into."""
    starts: set[int] = set()
    last = max(0, -(-(len(text or "") - WINDOW) // STEP))
    for m in _RUN.finditer(text or ""):
        if _ANCHOR.search(m[0]):
            starts.update(range(min(last, max(0, m.start() // STEP - 1)), min(last, (m.end() - 1) // STEP) + 1))
    return [w * STEP for w in sorted(starts)]


def _scan(batches):
    for b in batches:
        base, starts, windows, n = [], [], [], []
        for text in b.column("text").to_pylist():
            at = open_windows(text)
            base.append(joined(base_spans(text)) if at else "")
            starts.append(at)
            windows.append([text[s:s + WINDOW] for s in at])
            n.append(len(text or ""))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(base, pa.string()), pa.array(starts, pa.list_(pa.int32())),
             pa.array(windows, pa.list_(pa.string())), pa.array(n, pa.int32())], names=SCANNED.names)


def _labelled(batches):
    for b in batches:
        texts, tags = [], []
        for base, starts, windows in zip(*(b.column(c).to_pylist() for c in ("base", "starts", "windows"))):
            spans = split_spans(base)  # by start
            begins, reach = _cover(spans)
            for s, w in zip(starts, windows):
                texts.append(w)
                near = spans[bisect.bisect_right(reach, s):bisect.bisect_left(begins, s + WINDOW)]
                tags.append(tags_of([x for x in near if x[2] > s], s).astype(np.int8).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(tags, pa.binary()),
                                          pa.array([any(t) for t in tags], pa.bool_())], names=["window", "tags", "has"])


def train(scanned: DataFrame, max_windows: int = MAX_WINDOWS) -> BiLstmCrf | None:
    """Fit on at most ``max_windows`` windows with and as many without a base span; None without any span."""
    rows = scanned.where(F.size("starts") > 0).select("base", "starts", "windows")
    rows = rows.mapInArrow(_labelled, "window string, tags binary, has boolean").distinct()  # a window of many copies counts once
    order = (F.xxhash64("window", "tags"), "window", "tags")
    got = [r for has in (True, False) for r in rows.where(F.col("has") == has).orderBy(*order).limit(max_windows).collect()]
    if not any(r.has for r in got):
        return None
    codes = np.stack([char_classes(r.window) for r in got])
    return BiLstmCrf.start().fit(codes, np.stack([np.frombuffer(bytes(r.tags), np.int8) for r in got]).astype(np.int64))


def find_personal_data(spark: SparkSession, docs: DataFrame, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added."""
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = written(spark, rows.mapInArrow(_scan, SCANNED), "pii-windows")
    shared = spark.sparkContext.broadcast(train(scanned, max_windows))

    def decode(batches):
        model = shared.value
        for b in batches:
            base = [split_spans(x) for x in b.column("base").to_pylist()]
            windows, owner = [], []
            for k, (starts, texts, n) in enumerate(zip(*(b.column(c).to_pylist() for c in ("starts", "windows", "n_chars")))):
                windows += [(s, w, s + len(w) >= n) for s, w in zip(starts, texts)]
                owner += [k] * len(starts)
            runs: list[list[Run]] = [[] for _ in base]
            for k, found in zip(owner, model.window_runs(windows) if model else []):
                runs[k] += found
            added = [reconcile(join_runs(r), spans) for r, spans in zip(runs, base)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64()) for kind in KINDS],
                 pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string()),
                 pa.array([joined(ordered(spans + more)) for spans, more in zip(base, added)], pa.string()),
                 pa.array([len(more) for more in added], pa.int64())], names=FOUND.names)

    return scanned.mapInArrow(decode, FOUND)
