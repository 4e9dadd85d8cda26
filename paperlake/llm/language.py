"""Languages of documents and of their segments, by a byte convolutional network.

Texts are cut into sentences, sentences into fixed-length byte windows. A window's bytes are embedded, convolved with
filters of several widths, max-pooled and classified by softmax. The network is trained here, in numpy, on labelled
sentences, some of them garbled on purpose so that a wrong decoding does not hide the language; sentences that the first
pass contradicts are taken for mislabelled and left out of the second. For prediction embedding and filters are
multiplied out into tables by pairs of bytes, in 16-bit integers, so that a convolution is one or two table look-ups. Sentence scores are smoothed by a chain with a price for every change of language; runs of one language are the
segments.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.llm.canonical import IGNORABLE, TABLE, Canonicalizer
from paperlake.llm.markup import lacks_sentences
from paperlake.llm.sampling import bounded_sample, normalized_label
from paperlake.llm.sentences import sentences

WINDOW = 64
WIDTHS = (2, 3, 4)
FILTERS = 32
DIMENSIONS = 16
#: Price, in nats, of a change of language between two sentences.
CHANGE = 4.0
#: Whole sentences that make a language one of the text's languages when there are several.
ENOUGH = 2


@dataclass
class Network:
    languages: list[str]
    tables: list[list[np.ndarray]]  # per width one (256, FILTERS) int16 table per offset
    scale: float
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width the look-up tables of two neighbouring bytes (65536, FILTERS), and of the odd last one. Made once a
        worker; they never travel."""
        if "_pairs" not in self.__dict__:
            self._pairs = [[(o[k][:, None, :] + o[k + 1][None, :, :]).reshape(-1, FILTERS) if k + 1 < len(o) else o[k] for k in range(0, len(o), 2)] for o in self.tables]
        return self._pairs

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pairs"}

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, languages) for an (n, WINDOW) array of bytes; 0 pads."""
        pooled = np.empty((len(windows), FILTERS * len(WIDTHS)), dtype=np.float32)
        places = WINDOW - max(WIDTHS) + 1
        for at in range(0, len(windows), 64):
            # positions first, so that maxima over positions run over long stretches of memory
            single = np.ascontiguousarray(windows[at : at + 64].T).astype(np.intp)
            pairs = single[:-1] * 256 + single[1:]
            for i, parts in enumerate(self.pair_tables()):
                total = parts[0].take(pairs[:places], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    total += part.take((pairs if len(part) > 256 else single)[2 * k : 2 * k + places], axis=0)
                pooled[at : at + 64, i * FILTERS : (i + 1) * FILTERS] = total.max(axis=0)
        hidden = np.maximum(pooled * self.scale + self.bias, 0)
        return _log_softmax(hidden @ self.out + self.out_bias)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def windows_of(raw: bytes) -> list[bytes]:
    """A sentence's bytes as fixed-length windows, evenly placed so that they cover it and the last is full."""
    if len(raw) <= WINDOW:
        return [raw.ljust(WINDOW, b"\0")]
    n = -(-len(raw) // WINDOW)
    room = len(raw) - WINDOW
    return [raw[room * i // (n - 1) : room * i // (n - 1) + WINDOW] for i in range(n)]


def as_array(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(-1, WINDOW)


class Trainer:
    """Adam on the cross-entropy of single windows. Gradients pass through max pooling to the winning position only."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.rng, self.languages = rng, languages
        total = FILTERS * len(WIDTHS)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, DIMENSIONS)),
            **{f"w{w}_{k}": rng.normal(0, 1 / np.sqrt(w * DIMENSIONS), (DIMENSIONS, FILTERS)) for w in WIDTHS for k in range(w)},
            "bias": np.zeros(total),
            "out": rng.normal(0, 1 / np.sqrt(total), (total, len(languages))),
            "out_bias": np.zeros(len(languages)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.steps = 0

    def table(self, width: int, offset: int) -> np.ndarray:
        """(256, FILTERS): what every byte adds at an offset of a filter."""
        table = self.p["embed"] @ self.p[f"w{width}_{offset}"]
        table[0] = 0  # padding
        return table

    def step(self, x: np.ndarray, y: np.ndarray, rate: float) -> None:
        p = self.p
        places, by_place = WINDOW - max(WIDTHS) + 1, np.ascontiguousarray(x.T).astype(np.intp)
        pooled, best = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32), np.empty((len(x), FILTERS * len(WIDTHS)), np.intp)
        for i, w in enumerate(WIDTHS):
            total = self.table(w, 0).take(by_place[:places], axis=0)
            for k in range(1, w):
                total += self.table(w, k).take(by_place[k : k + places], axis=0)
            mine = slice(i * FILTERS, (i + 1) * FILTERS)
            pooled[:, mine] = total.max(axis=0)
            best[:, mine] = (total == pooled[None, :, mine]).argmax(axis=0)
        pre = pooled + p["bias"]
        keep = (self.rng.random(pre.shape) > 0.2).astype(np.float32) / 0.8
        hidden = np.maximum(pre, 0) * keep
        d = np.exp(_log_softmax(hidden @ p["out"] + p["out_bias"]))
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"out": hidden.T @ d, "out_bias": d.sum(0)}
        back = (d @ p["out"].T) * keep * (pre > 0)
        g["bias"] = back.sum(0)
        g["embed"] = np.zeros_like(p["embed"])
        rows = np.arange(len(x))[:, None]
        for i, w in enumerate(WIDTHS):
            part, at = back[:, i * FILTERS : (i + 1) * FILTERS], best[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(w):
                cells = x[rows, at + k].astype(np.int64) * FILTERS + np.arange(FILTERS)
                G = np.bincount(cells.ravel(), part.ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
                G[0] = 0
                g[f"w{w}_{k}"] = p["embed"].T @ G
                g["embed"] += G @ p[f"w{w}_{k}"].T
        self.steps += 1
        for k, grad in g.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * grad
            self.v[k] = 0.999 * self.v[k] + 0.001 * grad**2
            p[k] -= rate * (self.m[k] / (1 - 0.9**self.steps)) / (np.sqrt(self.v[k] / (1 - 0.999**self.steps)) + 1e-8)

    def epoch(self, x: np.ndarray, y: np.ndarray, rate: float, size: int = 128) -> None:
        order = self.rng.permutation(len(x))
        for at in range(0, len(x), size):
            mine = order[at : at + size]
            self.step(x[mine], y[mine], rate)

    def network(self) -> Network:
        tables = [[self.table(w, k) for k in range(w)] for w in WIDTHS]
        scale = max(np.abs(t).max() for offsets in tables for t in offsets) * max(WIDTHS) / 32000
        whole = [[np.round(t / scale).astype(np.int16) for t in offsets] for offsets in tables]
        return Network(self.languages, whole, float(scale), self.p["bias"], self.p["out"], self.p["out_bias"])


# Wrong decodings that training sentences are put through, (meant, shown).
GARBLES = {
    "": [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("utf-8", "cp1250"), ("utf-8", "gb18030"), ("utf-8", "cp1251")],
    "latin": [("cp1252", "cp850"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252")],
    "ru": [("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1251", "latin-1"), ("cp866", "cp1251"), ("koi8_r", "latin-1")],
    "zh": [("gb18030", "latin-1"), ("gb18030", "cp1252")],
    "ja": [("shift_jis", "latin-1"), ("shift_jis", "cp1252"), ("euc_jp", "latin-1")],
}


def garbled(text: str, language: str, rng: random.Random) -> str:
    own = GARBLES.get(language, GARBLES["latin"])
    meant, shown = rng.choice(rng.choice([GARBLES[""], own]))
    wrong = text.encode(meant, "ignore").decode(shown, "replace")
    if rng.random() < 0.2:
        wrong = wrong.encode("utf-8", "ignore").decode("cp1252", "replace")
    return wrong


def train(labelled: list[tuple[str, str]], per_language: int = 3500, seed: int = 3) -> Network:
    """``labelled``: (language, sentence). Languages with few sentences are repeated up to a fifth of ``per_language``."""
    rng = random.Random(seed)
    by: dict[str, list[str]] = defaultdict(list)
    for language, sentence in labelled:
        by[language].append(sentence)
    languages = sorted(by) or ["en"]
    x, y = [], []
    for n, language in enumerate(languages):
        own = by[language] or ["a"]
        rng.shuffle(own)
        own = own[:per_language]
        own = own * max(1, (per_language // 5) // len(own))
        for s in own:
            if rng.random() < (0.4 if language in GARBLES else 0.2):
                s = garbled(s, language, rng)
            own_windows = windows_of(s.encode("utf-8", "ignore"))
            x += own_windows
            y += [n] * len(own_windows)
    x, y = as_array(x), np.array(y)
    trainer = Trainer(languages, seed)
    trainer.epoch(x, y, 0.004)
    agreed = trainer.network().log_probabilities(x)[np.arange(len(y)), y] > np.log(0.15)
    for rate in (0.004, 0.002, 0.001, 0.0003):
        trainer.epoch(x[agreed], y[agreed], rate)
    return trainer.network()


NOISE = re.compile(r"\$\$.*?\$\$|\$[^$\n]*\$|<[^<>\n]*>|\\[A-Za-z]+\*?|\{\{[^{}]*\}\}|https?://\S+|[{}\\]", re.S)
MARKS = re.compile(r"[$<\\{}]|https?:")
LETTERS = re.compile(r"[^\W\d_].*?[^\W\d_]")
#: Characters that wrong decodings scatter; sentences full of them hardly count where a text has enough others.
SCATTERED = re.compile("[\x80-¿ÃÂâ�─-╿]")


#: What keeps a sentence end from being seen: ignorable characters, full-width letters and stops.
DISGUISED = re.compile(f"[{IGNORABLE}Ａ-Ｚａ-ｚ．]")


def leveled(text: str) -> tuple[str, list[int] | None]:
    """The text with width, spaces and ignorable characters settled, so that sentences are cut alike, and the place that
    every character had (None: where it is)."""
    if text.isascii() or not DISGUISED.search(text):
        return text, None
    letters, places = [], []
    for i, c in enumerate(text):
        for x in TABLE.get(ord(c), c):
            letters.append(x)
            places.append(i)
    return "".join(letters), places


def prepared_sentences(text: str, canonicalizer: Canonicalizer) -> list[tuple[int, int, str]]:
    """(start, end, letters to look at) of every sentence with something to look at."""
    out = []
    for a, b in sentences(text):
        s = canonicalizer(text[a:b])
        if MARKS.search(s):
            s = NOISE.sub(" ", s)
        s = " ".join(s.split())
        if LETTERS.search(s):
            out.append((a, b, s))
    return out


def best_path(scores: np.ndarray) -> np.ndarray:
    """The most probable sequence of languages with CHANGE per change (Viterbi)."""
    n, k = scores.shape
    total, back = scores[0].copy(), np.zeros((n, k), dtype=int)
    for i in range(1, n):
        top = int(total.argmax())
        moved = total[top] - CHANGE > total
        back[i] = np.where(moved, top, np.arange(k))
        total = np.where(moved, total[top] - CHANGE, total) + scores[i]
    path = np.empty(n, dtype=int)
    path[-1] = total.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    return path


FINAL = re.compile(r"[.!?…。！？．][”’»)\]」』“\s]*(?:\[\d[\d, –-]*\])*\Z")


def judge(texts: list[str | None], network: Network, canonicalizer: Canonicalizer) -> list[list[tuple[int, int, int, float, int]]]:
    """Per text its segments (start, end, language number, confidence, whole sentences). All windows of the batch go
    through the network together."""
    pieces: list[bytes] = []
    counts, spans, owners = [], [], []
    for n, given in enumerate(texts):
        text, places = leveled(given) if given else ("", None)
        for a, b, s in prepared_sentences(text, canonicalizer):
            w = windows_of(s.encode("utf-8", "ignore"))
            pieces += w
            counts.append(len(w))
            wild = "\ufffd" in s or not s.isascii() and 4 * len(SCATTERED.findall(s)) > len(s)
            heading = text[a] == "#" or not FINAL.search(text, max(a, b - 24), b)
            first, last = (a, b) if places is None else (places[a], places[b - 1] + 1)
            spans.append((first, last, wild, not heading))
            owners.append(n)
    result: list[list] = [[] for _ in texts]
    if not pieces:
        return result
    logs = network.log_probabilities(as_array(pieces))
    scores = np.add.reduceat(logs, np.cumsum([0, *counts[:-1]]), axis=0)
    scores = np.maximum(scores, scores.max(axis=1, keepdims=True) - 12.0)
    owners, wild, whole = np.array(owners), np.array([x[2] for x in spans]), np.array([x[3] for x in spans])
    first = np.flatnonzero(np.diff(owners, prepend=-1))
    sizes = np.diff(np.append(first, len(owners)))
    # sentences full of scattered signs lose weight where a text has enough others
    sound = np.add.reduceat(whole & ~wild, first)
    scores = np.where((wild & np.repeat(sound >= ENOUGH, sizes))[:, None], scores * 0.02, scores)
    tops = scores.argmax(axis=1)
    same = np.minimum.reduceat(tops, first) == np.maximum.reduceat(tops, first)
    # confidence: probability of a segment's language, evidence tempered as sentences depend on each other
    sure = np.exp(_log_softmax(np.add.reduceat(scores, first, axis=0) / np.sqrt(sizes)[:, None]))
    n_whole = np.add.reduceat(whole, first, dtype=int)
    for g, (low, size) in enumerate(zip(first.tolist(), sizes.tolist(), strict=True)):
        n, high = owners[low], low + size
        if same[g]:
            k = int(tops[low])
            result[n].append((spans[low][0], spans[high - 1][1], k, float(sure[g, k]), int(n_whole[g])))
            continue
        path = best_path(scores[low:high])
        start = 0
        for j in range(1, size + 1):
            if j == size or path[j] != path[start]:
                soft = np.exp(_log_softmax(scores[low + start : low + j].sum(axis=0)[None, :] / np.sqrt(j - start))[0])
                result[n].append((spans[low + start][0], spans[low + j - 1][1], int(path[start]), float(soft[path[start]]), int(whole[low + start : low + j].sum())))
                start = j
    return result


def labelled_sentences(results: DataFrame, rows: int = 6000) -> list[tuple[str, str]]:
    """Training data: sentences of a bounded sample (``rows``) of labelled prose."""
    usable = results.where(F.col("text").isNotNull() & F.col("lang_label").isNotNull())
    sample = bounded_sample(usable.where(~lacks_sentences(F.col("text"))).select("result_id", "lang_label", "text"), "result_id", rows)
    canonicalizer = Canonicalizer({})
    out = []
    for label, text in zip(sample["lang_label"], sample["text"], strict=True):
        code = normalized_label(label)
        if code:
            out += [(code, s) for _, _, s in prepared_sentences(text, canonicalizer) if len(s) > 12]
    return out


SEGMENTS = "result_id bigint, lang_label string, seg_start int, seg_end int, lang string, confidence double, n_sentences int"
#: Rows judged together.
ROWS = 256


def language_segments(results: DataFrame, network: Network) -> DataFrame:
    """One row per segment of every text with at least two letters: its place (code points), language, confidence and
    whole sentences. Null and blank texts have no segments."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonicalizer = Canonicalizer({})
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                rows = []
                for result_id, label, segments in zip(part["result_id"], part["lang_label"], judge(part["text"].tolist(), network, canonicalizer), strict=True):
                    rows += [(result_id, label, a, b, network.languages[k], c, n) for a, b, k, c, n in segments]
                yield pd.DataFrame(rows, columns=["result_id", "lang_label", "seg_start", "seg_end", "lang", "confidence", "n_sentences"])

    return results.where("text is not null").select("result_id", "lang_label", "text").mapInPandas(run, SEGMENTS)


def text_languages(segments: list[tuple[int, int, int, float, int]]) -> list[int]:
    """Language numbers of a text: those with ENOUGH whole sentences; if there are not two such, the one with most text."""
    whole: dict[int, int] = defaultdict(int)
    size: dict[int, int] = defaultdict(int)
    for a, b, k, _, n in segments:
        whole[k] += n
        size[k] += b - a
    if not size:
        return []
    several = [k for k, n in whole.items() if n >= ENOUGH]
    return several if len(several) > 1 else [max(size, key=lambda k: (size[k], -k))]


def relabelled(results: DataFrame, network: Network) -> DataFrame:
    """result_id, lang: the rows whose label is missing or wrong or whose text is in several languages, one row per
    language. A right label in another notation is no case; texts that are no prose and blank texts are none."""
    prose = results.where(F.col("text").rlike(r"\S") & ~lacks_sentences(F.col("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonicalizer = Canonicalizer({})
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                rows = []
                for result_id, label, segments in zip(part["result_id"], part["lang_label"], judge(part["text"].tolist(), network, canonicalizer), strict=True):
                    found = [network.languages[k] for k in text_languages(segments)]
                    if found and (len(found) > 1 or normalized_label(label) != found[0]):
                        rows += [(result_id, code) for code in sorted(found)]
                yield pd.DataFrame(rows, columns=["result_id", "lang"])

    return prose.select("result_id", "lang_label", "text").mapInPandas(run, "result_id bigint, lang string")
