"""One consistent form for texts that look the same.

Every token is run through a weighted edit automaton over a trie of known words. An edge between look-alike letters and
the skipping of an ignorable character cost nothing, a replaced, missing or further letter costs one. With the budget of
zero, which is the one for texts that read the same, a token reaches exactly the known words that look like it, and the
one most frequent in texts of the same script is its spelling: a Latin abbreviation in a Russian text stays Latin, a
Russian word stays Russian, whichever letters were used. Tokens that reach no word are rewritten by the look-alike table
into the script of the text. Width, ligatures, kinds of space and hyphen, and the composition of accents are settled by
table before. All decisions depend only on what does not change between look-alike texts, so two texts that read the same
get the same form.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize

# Letters of other alphabets drawn like a Latin letter.
CYRILLIC = dict(zip("аеорсухіѕјԁԛԝһАВЕКМНОРСТУХІЅЈԚԜ", "aeopcyxisjdqwhABEKMHOPCTYXISJQW", strict=True))
GREEK = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovABEZHIKMNOPTYX", strict=True))
TO_LATIN = CYRILLIC | GREEK
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "ſt", "ﬆ": "st", "Ĳ": "IJ", "ĳ": "ij"}
SPACES = "               　"
HYPHENS = "‐‑﹣－"
IGNORABLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤﻿"

CLASS_OF = defaultdict(set)
for _other, _latin in TO_LATIN.items():
    CLASS_OF[_latin] |= {_other, _latin}
for _latin, _members in list(CLASS_OF.items()):
    for _m in _members:
        CLASS_OF[_m] = _members


def _width_table() -> dict[int, str]:
    """Full-width and half-width forms, from their Unicode decompositions."""
    table = {}
    for code in range(0xFF01, 0xFFEF):
        kind, *target = unicodedata.decomposition(chr(code)).split()[:1] or [""], unicodedata.decomposition(chr(code)).split()[1:]
        if kind and kind[0] in ("<wide>", "<narrow>"):
            table[code] = "".join(chr(int(x, 16)) for x in target[0])
    return table


TABLE = _width_table() | {ord(k): v for k, v in LIGATURES.items()} | {ord(c): " " for c in SPACES} | {ord(c): "-" for c in HYPHENS} | {ord(c): "" for c in IGNORABLE}
NEEDS_TABLE = re.compile("[" + "".join(map(re.escape, map(chr, TABLE))) + "]")
COMBINING = "̀-ͯ"
FOREIGN = re.compile(rf"[^\W\d_][\w{COMBINING}]*[Ͱ-ϿЀ-ԯ][\w{COMBINING}]*|[Ͱ-ϿЀ-ԯ][\w{COMBINING}]*")
#: Every match of FOREIGN holds one of these.
OTHER_ALPHABET = re.compile("[Ͱ-ϿЀ-ԯ]")
#: Every text whose script is not Latin holds one of these before NFC, which makes some of them letters of the two blocks.
MAYBE_OTHER = "[\u0370-\u052f\u1f00-\u1fff\u2126]"
#: Different words that a task counts before it gives its counts out.
HELD_WORDS = 100_000
WORD = re.compile(rf"[^\W\d_][\w{COMBINING}]*")
STRICT_CYRILLIC = re.compile("[" + "".join(c for c in map(chr, range(0x400, 0x530)) if c not in CYRILLIC and unicodedata.normalize("NFD", c)[0] not in CYRILLIC) + "]")
STRICT_GREEK = re.compile("[" + "".join(c for c in map(chr, range(0x370, 0x400)) if c.isalpha() and c not in GREEK and unicodedata.normalize("NFD", c)[0] not in GREEK) + "]")
STRICT_LATIN = re.compile("[" + "".join(c for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" if c not in CLASS_OF) + "ßæøœÆØŒ]")
LATIN_TO = {"cyrillic": {v: k for k, v in reversed(CYRILLIC.items())}, "greek": {v: k for k, v in reversed(GREEK.items())}}


def script_of(token: str, context: str) -> str:
    """The script a token belongs to: that of a letter which looks like no other, else that of its text."""
    if STRICT_CYRILLIC.search(token):
        return "cyrillic"
    if STRICT_GREEK.search(token):
        return "greek"
    if STRICT_LATIN.search(token):
        return "latin"
    return context


def to_script(token: str, script: str) -> str:
    """Rewrite every look-alike letter into one script; accents are kept apart while letters change."""
    apart = unicodedata.normalize("NFD", token)
    latin = "".join(TO_LATIN.get(c, c) for c in apart)
    if script != "latin":
        back = LATIN_TO[script]
        latin = "".join(back.get(c, c) for c in latin)
    return unicodedata.normalize("NFC", latin)


class WordTrie:
    """Known words in decomposed form. A node is a dict; the key "" holds the word that ends there and its count."""

    def __init__(self, counts: dict[str, int]):
        self.root: dict = {}
        for word, n in counts.items():
            node = self.root
            for c in unicodedata.normalize("NFD", word):
                node = node.setdefault(c, {})
            node[""] = (word, n)

    def reach(self, token: str, budget: int = 0) -> dict[str, tuple[int, int]]:
        """word -> (cost, count) of all words within ``budget``. The automaton's live states are trie nodes with the least
        cost to get there; after every character of the token states above the budget die."""
        states = self._with_missing({id(self.root): (0, self.root)}, budget)
        for c in unicodedata.normalize("NFD", token):
            if c in IGNORABLE:
                continue
            alike, after = CLASS_OF.get(c, c), {}
            for cost, node in states.values():
                if cost < budget:
                    self._keep(after, cost + 1, node)  # the token has a further letter
                    for letter, child in node.items():
                        if letter and letter not in alike:
                            self._keep(after, cost + 1, child)
                for letter in alike:
                    if letter in node:
                        self._keep(after, cost, node[letter])
            states = self._with_missing(after, budget)
            if not states:
                return {}
        return {node[""][0]: (cost, node[""][1]) for cost, node in states.values() if "" in node}

    @staticmethod
    def _keep(states: dict, cost: int, node: dict) -> None:
        if cost < states.get(id(node), (cost + 1,))[0]:
            states[id(node)] = (cost, node)

    def _with_missing(self, states: dict, budget: int) -> dict:
        """Adds the states reached by letters that the token lacks."""
        layer = states if budget else {}
        while layer:
            further: dict = {}
            for cost, node in layer.values():
                if cost < budget:
                    for letter, child in node.items():
                        if letter and cost + 1 < states.get(id(child), (budget + 1,))[0]:
                            self._keep(further, cost + 1, child)
            states |= further
            layer = further
        return states


class Canonicalizer:
    """Callable text -> canonical text. Null stays null, empty stays empty. ``counts``: (script of the text, word) -> how
    often."""

    CACHE = 200_000

    def __init__(self, counts: dict[tuple[str, str], int]):
        self.tries = {script: WordTrie({w: n for (c, w), n in counts.items() if c == script}) for script in ("latin", *LATIN_TO)}
        self.cache: dict[tuple[str, str], str] = {}

    def token(self, token: str, context: str) -> str:
        key = (token, context)
        if (known := self.cache.get(key)) is None:
            words = [(n, w) for w, (_, n) in self.tries[context].reach(token).items()]
            if context == "latin":
                # texts of ASCII letters only are their own form, so here the Latin spelling always holds
                script = script_of(token, context)
                words = [(n, w) for n, w in words if to_script(w, script) == w]
            known = max(words)[1] if words else to_script(token, script_of(token, context))
            if len(self.cache) >= self.CACHE:
                self.cache.clear()
            self.cache[key] = known
        return known

    def __call__(self, text: str | None) -> str | None:
        if text is None or text.isascii():
            return text
        if NEEDS_TABLE.search(text):
            text = text.translate(TABLE)
        text = unicodedata.normalize("NFC", text)
        if not OTHER_ALPHABET.search(text):
            return text
        context = text_script(text)
        words = FOREIGN if context == "latin" else WORD
        return unicodedata.normalize("NFC", words.sub(lambda m: self.token(m[0], context), text))


def text_script(text: str) -> str:
    """The script with most letters that look like no other; Latin if two are equal."""
    cyrillic, greek, latin = (len(p.findall(text)) for p in (STRICT_CYRILLIC, STRICT_GREEK, STRICT_LATIN))
    return "latin" if latin >= max(cyrillic, greek) else "cyrillic" if cyrillic >= greek else "greek"


def vocabulary(results: DataFrame) -> dict[tuple[str, str], int]:
    """(script of the text, word) -> count over all texts: the spellings of the tries, words met at least twice. Tokens of
    mixed scripts are no spellings.

    Words are counted where they lie. Of the words that look alike only the most frequent (of equally frequent ones the
    greatest) reaches the driver, and only if the table alone would write it otherwise: the others change no form. In Latin
    texts that holds for every word, so they are not counted.
    """
    counted = results.where(F.col("text").rlike(MAYBE_OTHER)).select("text").mapInPandas(_word_counts, "context string, plain string, word string, n bigint")
    words = counted.groupBy("context", "plain", "word").agg(F.sum("n").alias("n")).where("n > 1")
    best = words.groupBy("context", "plain").agg(F.max(F.struct("n", "word")).alias("best")).where("best.word <> plain")
    return {(r["context"], r["word"]): r["n"] for r in best.select("context", "best.word", "best.n").collect()}


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """context, plain (the word as the table writes it, one for all that look alike), word, n: partial counts, given out
    whenever ``HELD_WORDS`` words are held."""
    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            text = unicodedata.normalize("NFC", text.translate(TABLE))
            if (context := text_script(text)) != "latin":
                counts.update((context, w) for w in WORD.findall(text))
            if len(counts) >= HELD_WORDS:
                yield _spellings(counts)
                counts.clear()
    yield _spellings(counts)


def _spellings(counts: Counter) -> pd.DataFrame:
    kept = ((c, w, n) for (c, w), n in counts.items() if any(to_script(w, s) == w for s in ("latin", *LATIN_TO)))
    return pd.DataFrame([(c, to_script(w, script_of(w, c)), w, n) for c, w, n in kept], columns=["context", "plain", "word", "n"])


def canonical_texts(results: DataFrame, counts: dict[tuple[str, str], int]) -> DataFrame:
    """result_id, canonical: the consistent form of every text. ASCII texts are that already and stay in the JVM."""
    convert = _converter(counts)

    @F.pandas_udf("string")
    def canonical(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        do = convert()
        for texts in batches:
            yield texts.map(do, na_action="ignore")

    odd = F.col("text").rlike(r"[^\x00-\x7f]")
    return results.select("result_id", F.coalesce(canonical(F.when(odd, F.col("text"))), F.col("text")).alias("canonical"))


def _converter(counts: dict[tuple[str, str], int]):
    held: list[Canonicalizer] = []

    def get() -> Canonicalizer:
        if not held:
            held.append(Canonicalizer(counts))
        return held[0]

    return get


def reading_keys(results: DataFrame, counts: dict[tuple[str, str], int]) -> DataFrame:
    """result_id, form (128-bit digest of the canonical form), exact (128-bit digest of the text)."""
    convert = _converter(counts)

    @F.pandas_udf("binary")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        do = convert()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else hashlib.md5(do(t).encode("utf-8", "surrogatepass")).digest())

    odd = F.col("text").rlike(r"[^\x00-\x7f]")
    exact = F.unhex(F.md5("text"))
    return results.where("text is not null").select(
        "result_id", F.coalesce(digest(F.when(odd, F.col("text"))), exact).alias("form"), exact.alias("exact")
    )


def reading_pairs(results: DataFrame, counts: dict[tuple[str, str], int]) -> DataFrame:
    """result_a < result_b: rows whose texts differ but read the same.

    Only forms with at least two different texts reach the join; they are found by one pre-aggregation (min and max of
    the text digest differ). Rows of one text are matched through their form's other texts only, so copies of a single
    text, however many, form no pairs. Null texts take part in nothing.
    """
    keys = materialize(reading_keys(results, counts), "reading-keys")
    mixed = keys.groupBy("form").agg(F.min("exact").alias("lo"), F.max("exact").alias("hi")).where("lo <> hi").select("form")
    keep = keys.join(mixed, "form", "left_semi")
    a, b = keep.alias("a"), keep.alias("b")
    return a.join(b, F.expr("a.form = b.form and a.result_id < b.result_id and a.exact <> b.exact")).select(
        F.col("a.result_id").alias("result_a"), F.col("b.result_id").alias("result_b")
    )


def reading_classes(results: DataFrame, counts: dict[tuple[str, str], int]) -> DataFrame:
    """One row per result: its class (smallest id that reads the same), the class's rows and different spellings."""
    keys = materialize(reading_keys(results, counts), "reading-keys")
    classes = keys.groupBy("form").agg(
        F.min("result_id").alias("class_id"), F.count("*").alias("n_rows"), F.countDistinct("exact").alias("n_spellings")
    )
    return keys.join(classes, "form").select("result_id", "class_id", "n_rows", "n_spellings")
