"""Garbled text from wrong character encoding.

A stretch is garbled if some chain "write it back in encoding A, read it as encoding B" shortens its description: every
candidate reading is compressed with a zstandard dictionary of each language, the chain's own cost is added, and the
shortest description wins. If that is the stretch as it stands, it is left alone. Characters that can only come from a
failed decoding (replacement marks, C1 controls, box drawing inside words) mark a text as garbled even where no chain
brings it back.
"""

from __future__ import annotations

import codecs
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.llm.sampling import bounded_sample, normalized_label

# Single-byte encodings through which UTF-8 bytes get misread, and encodings that get taken for each other.
SINGLE_BYTE = ["cp1252", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8_r", "mac_roman"]
LATIN_MIXES = [("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252")]
CYRILLIC_MIXES = [(a, b) for a in ("cp1252", "cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic", "mac_roman", "cp437", "cp850") for b in ("cp1251", "koi8_r", "cp866", "iso8859_5") if a != b]
WIDE_MIXES = [(a, b) for a in ("cp1252", "cp850", "cp437", "mac_roman", "cp1251", "koi8_r") for b in ("gb18030", "cp932", "euc_jp", "big5")] + [("gb18030", b) for b in ("cp932", "euc_jp", "big5")] + [(a, "gb18030") for a in ("cp932", "big5")]
WIDE_UTF8 = ["gb18030", "cp932", "big5", "euc_jp"]
#: Bytes that naming one chain costs in a description.
CHAIN_COST = 2


@lru_cache(None)
def byte_table(encoding: str) -> dict[int, int]:
    """Code point -> byte of a single-byte encoding; bytes it leaves undefined stand for the C1 control of their value,
    and C1 controls are accepted for their byte everywhere (the two conventions get mixed in practice)."""
    table = {c: c for c in range(0xA0)}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            table[b] = b
    return table


def to_bytes(text: str, encoding: str) -> bytes | None:
    """The bytes that ``encoding`` would have shown as ``text``; None if it cannot show it."""
    if encoding in WIDE_UTF8:
        try:
            return text.encode(encoding)
        except UnicodeEncodeError:
            return None
    try:
        return codecs.charmap_encode(text, "strict", byte_table(encoding))[0]
    except UnicodeEncodeError:
        return None


def from_bytes(raw: bytes, encoding: str) -> str | None:
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        return None


#: Characters that a restored text may consist of, besides ASCII.
PLAUSIBLE = re.compile(
    r"[\x00-\xffƒˆ˜†‡‰ŒœŸŠšŽžĀ-ſΑ-Ωα-ω‘’‚“”„†•…‰‹›€™–—−√≤≥≠≈∞∂∑∏∫∈→←↔×"
    r"А-яЁё　-〿ぁ-ヿ一-鿿！-～ﬀ-ﬆ​-‏   ‐‑⁠﻿̀-ͯ]*"
)
CYRILLIC_LETTER = re.compile("[А-яЁё]")
WIDE = re.compile("[ぁ-ヿ一-鿿]")
LATIN_LETTER = re.compile("[A-Za-z]")
CYRILLIC_WORD = re.compile("[Ѐ-ӿ]+")
NATURAL = re.compile("[А-ЯЁ]?[а-яё]+|[А-ЯЁ]{1,3}")
DENSE = re.compile("[\x80-˿ˆ-˝–-›€™]{3,}")
HIGH_RUN = re.compile(r"[^\x00-\x7f]+")

#: No correct text holds these: replacement marks, C1 controls, private use, block and box drawing.
STRONG = re.compile("[¡-ÿ]{4,}")
HARD = re.compile("[�\x80-\x84\x86-\x9f-─-▟]")
SYMBOL = "¢£¤¥¦§¨©¬®¯±´µ¶·¸¹¼½¾¿¡×÷ˆ˜‰†‡•‹›™€ƒ„‚ˇ˘˙˛˝∂∑∏π∫Ω√∞≈∆◊⌐₧ªº²³«»…“”–—"
INSIDE = "¢£¤¥¦§¨©¬®¯±´µ¶·¸¹¼½¾¿¡÷ˆ˜‰†‡•‹›™ƒ‚ˇ˘˙˛˝∂∑∏π∫Ω√∞≈∆◊⌐₧ªº²³"
#: A sign or a capital inside a word.
BROKEN_WORD = re.compile(rf"[a-zà-öø-ÿ][{INSIDE}][a-zà-öø-ÿ]|[a-zß-öø-ÿ][À-ÖØ-ÞŠŽŸŒ]")
ODD_WORD = re.compile(rf"\S*(?:[a-zà-öø-ÿ][{INSIDE}][a-zà-öø-ÿ]|[A-Za-zß-öø-ÿ][À-ÖØ-ÞŠŽŸŒ][a-z]|[þÞðÐ]|[a-z][{INSIDE}](?=[\s.,;:)])|(?<!\S)[{INSIDE}][a-z])\S*")
SUSPECT = re.compile(
    "|".join(
        [
            "[�\x80-\x84\x86-\x9f-─-▟]",
            rf"[a-zà-öø-ÿ][{INSIDE}][a-zà-öø-ÿ]",  # a sign inside a word
            r"[a-zß-öø-ÿ][À-ÖØ-ÞŠŽŸŒ]",  # a capital inside a word
            r"[A-Za-z][þÞðÐýÝ]|[þÞðÐ][A-Za-z]|[A-Z][À-ÖØ-Þ][a-z]",
            rf"[a-z][{INSIDE}](?=[\s.,;:)])|(?<=\s)[{INSIDE}][a-z]",
            r"[\xa1-˿][\xa1-˿][\xa1-˿][\xa1-˿]",  # runs of high Latin signs
            r"[A-Za-zÀ-ÿ][бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯЂѓЃђљњќћџЉЊЌЋЏўЎґҐєЄ╦]|[бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ][A-Za-zÀ-ÿ]",
            r"[а-яё][А-ЯЁ]|[ЂЃѓЉЊЌЋЏђљњќћџЎўҐґЄєЇї]|[А-ЯЁ]{2,}[ ,]+[А-ЯЁ]{2,}|\b[А-ЯЁ]{4,}\b",
            r"[РС][°±²³µ¶·¸¹»¼½¾¿\xa0-¯‚-›€™†‡‰“”•–—]",
            r"[a-z][一-鿿]{1,3}[a-z]",
            r"[｡-ﾟ]",
        ]
    )
)


#: Of texts in these characters only a run of four beyond ASCII is suspect: every other part of SUSPECT asks for one that
#: is not here.
HARMLESS = frozenset(map(chr, range(0x80))) | frozenset("àáâãäåæçèéêëìíîïñòóôõöøùúûüÿßœšž‘’“”–—…«»\xa0\u2009\u202f")
HIGH_LATIN = re.compile(r"[\xa1-˿]{4}")


def _misread_patterns() -> tuple[re.Pattern, re.Pattern]:
    """A lead byte followed by continuation bytes, as each single-byte encoding shows them; and a quick test for it."""
    parts, first, second = [], set(), set()
    for encoding in SINGLE_BYTE:
        show = {b: chr(c) for c, b in byte_table(encoding).items() if c >= 0xA0}
        every = lambda lo, hi: "".join(re.escape(show[b]) for b in range(lo, hi) if b in show)
        rest = every(0x80, 0xC0) + "\x80-\x9f"
        two = every(0xC2, 0xC6) + every(0xCE, 0xD2)  # Latin, Greek, Cyrillic
        three = every(0xE2, 0xEA) + every(0xEF, 0xF0)  # punctuation, Han and kana, wide forms
        if encoding == "cp866":
            continue  # its misreadings show as box drawing or as capitals inside words
        parts.append(f"[{two}][{rest}]|[{three}][{rest}][{rest}]")
        first |= {show[b] for b in [*range(0xC2, 0xC6), *range(0xCE, 0xD2), *range(0xE2, 0xEA), 0xEF] if b in show}
        second |= {show[b] for b in range(0x80, 0xC0) if b in show}
    quick = "[{}][{}\x80-\x9f]".format("".join(map(re.escape, sorted(first))), "".join(map(re.escape, sorted(second))))
    return re.compile(quick), re.compile("|".join(parts))


PAIR, MISREAD = _misread_patterns()


def misread(text: str) -> bool:
    return any(MISREAD.match(text, m.start()) for m in PAIR.finditer(text))


WIDE_RUN = re.compile("[㐀-鿿　-ヿ＀-￯-€�]+")


@dataclass
class Verdict:
    garbled: bool
    restored: str
    chain: str


class Decoder:
    """Decides and restores. ``dictionaries``: language -> bytes of sample text."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 3):
        self.compressors = {}
        for language, sample in dictionaries.items():
            held = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level)
            self.compressors[language] = zstandard.ZstdCompressor(dict_data=held, level=level, write_content_size=False, write_checksum=False, write_dict_id=False)
        if not self.compressors:
            self.compressors["none"] = zstandard.ZstdCompressor(level=level, write_content_size=False)

        self.by_script = {
            "wide": [c for n, c in self.compressors.items() if n in ("zh", "ja")],
            "cyrillic": [c for n, c in self.compressors.items() if n in ("ru", "uk", "bg")],
            "latin": [c for n, c in self.compressors.items() if n not in ("zh", "ja", "ru", "uk", "bg", "th", "hi")],
        }

    def length(self, text: str) -> int:
        """Description length in bytes: the best compressed size among the languages of the text's script."""
        wide, cyrillic = len(WIDE.findall(text)), len(CYRILLIC_LETTER.findall(text))
        latin = len(LATIN_LETTER.findall(text))
        script = "wide" if 2 * wide > latin else "cyrillic" if cyrillic > latin else "latin"
        raw = text.encode("utf-8", "surrogatepass")
        return min(len(c.compress(raw)) for c in self.by_script[script] or list(self.compressors.values()))

    @staticmethod
    def plausible(text: str) -> bool:
        return PLAUSIBLE.fullmatch(text) is not None

    def utf8_reading(self, line: str, encoding: str) -> str | None:
        """The line with every high run that ``encoding`` misread from UTF-8 put right; None if there is none."""
        made: list[str] = []

        def put_right(m: re.Match) -> str:
            if "\ufffd" in m[0]:
                read = self.lossy_reading(m[0], encoding)
            else:
                raw = to_bytes(m[0], encoding)
                read = None if raw is None else from_bytes(raw, "utf-8")
            if read is None or not self.plausible(read.replace("\ufffd", "")):
                return m[0]
            made.append(read)
            return read

        result = (WIDE_RUN if encoding in WIDE_UTF8 else HIGH_RUN).sub(put_right, line)
        read = "".join(made)
        few = 0 < len(CYRILLIC_LETTER.findall(read)) < 3 or 0 < len(WIDE.findall(read)) < (3 if encoding in WIDE_UTF8 else 2)
        if encoding in ("cp1251", "koi8_r", "cp866") and re.search("[Ā-őŔ-ž]", read):
            few = True  # Cyrillic letters set among Latin ones are a disguise, not a misreading
        return None if not made or few else result  # one or two letters of another script are no reading

    @staticmethod
    def lossy_reading(run: str, encoding: str) -> str | None:
        """A run in which the wrong decoder gave up on some bytes: what lies between its replacement marks."""
        if encoding not in WIDE_UTF8:
            return None
        pieces = [to_bytes(p, encoding) for p in run.split("\ufffd")]
        if any(p is None for p in pieces):
            return None
        read = re.sub("\ufffd+", "\ufffd", b"\xff".join(pieces).decode("utf-8", "replace"))
        return read if len(WIDE.findall(read)) > len(read) / 2 else None

    def partial_reading(self, line: str) -> str | None:
        """Misread pairs inside runs that also hold correct signs: the pairs alone are put right."""
        if not misread(line):
            return None
        changed = False

        def put_right(m: re.Match) -> str:
            nonlocal changed
            for encoding in ("cp1252", "cp1250", "cp437", "cp850", "mac_roman"):
                raw = to_bytes(m[0], encoding)
                if raw is not None and (read := from_bytes(raw, "utf-8")) is not None and self.plausible(read) and not CYRILLIC_LETTER.search(read) and not WIDE.search(read):
                    changed = True
                    return read
            return m[0]

        result = MISREAD.sub(put_right, line)
        return result if changed else None

    def whole_reading(self, line: str, shown: str, meant: str) -> str | None:
        raw = to_bytes(line, shown)
        if raw is None:
            return None
        read = from_bytes(raw, meant)
        return read if read is not None and read != line and self.plausible(read) else None

    def candidates(self, line: str) -> Iterator[tuple[str, str]]:
        for encoding in SINGLE_BYTE:
            if (read := self.utf8_reading(line, encoding)) is not None:
                yield f"{encoding}>utf-8", read
        if WIDE_RUN.search(line):
            for encoding in WIDE_UTF8:
                if (read := self.utf8_reading(line, encoding)) is not None:
                    yield f"{encoding}>utf-8", read
        if (read := self.partial_reading(line)) is not None:
            yield "pairs>utf-8", read
        high = len(re.findall(r"[^\x00-\x7f]", line))
        latin = len(LATIN_LETTER.findall(line))
        if latin > 2 * high:
            for shown, meant in LATIN_MIXES:
                read = self.whole_reading(line, shown, meant)
                if read is not None and not DENSE.search(read) and not BROKEN_WORD.search(read):
                    yield f"{shown}>{meant}", read
                read = ODD_WORD.sub(lambda m: self.whole_reading(m[0], shown, meant) or m[0], line)  # noqa: B023
                if read != line and not BROKEN_WORD.search(read):
                    yield f"words:{shown}>{meant}", read
        words = CYRILLIC_WORD.findall(line)
        natural = len(words) > 0 and sum(NATURAL.fullmatch(w) is not None for w in words) >= 0.9 * len(words)
        if high > latin / 2 and not natural:
            for shown, meant in CYRILLIC_MIXES:
                read = self.whole_reading(line, shown, meant)
                if read is not None and 10 * len(CYRILLIC_LETTER.findall(read)) > 8 * high and not re.search("[а-яё][А-ЯЁ]", read):
                    yield f"{shown}>{meant}", read
            for shown, meant in WIDE_MIXES:
                read = self.whole_reading(line, shown, meant)
                if read is not None and 3 * len(WIDE.findall(read)) > high / 2 and not DENSE.search(read) and not re.search("[｡-ﾟ]", read):
                    yield f"{shown}>{meant}", read

    @staticmethod
    def cost(chain: str, line: str) -> int:
        """Bytes to name a chain. Valid UTF-8 hardly arises by accident and costs nothing more; mixes of alphabets give
        shorter text by their nature (two bytes a letter become one or three for two) and must earn their share."""
        if "utf-8" in chain:
            return 0
        return CHAIN_COST + (len(line) // 16 if (chain.removeprefix("words:").split(">")[0], chain.split(">")[1]) not in LATIN_MIXES else 0)

    def best(self, line: str, depth: int = 0) -> tuple[str, str]:
        """(chain, reading) of the shortest description; chain "" is the line itself. A reading may itself be garbled."""
        choice = (self.length(line), "", line)
        seen: dict[str, str] = {}
        for chain, read in self.candidates(line):
            seen.setdefault(read, chain)
        for read, chain in seen.items():
            size = self.length(read) + self.cost(chain, line)
            if size < choice[0] + (not choice[1] and bool(STRONG.search(line))):
                choice = (size, chain, read)
        if choice[1] and depth < 2 and self.suspect(choice[2]):
            chain, read = self.best(choice[2], depth + 1)
            return (f"{choice[1]}|{chain}", read) if chain else choice[1:]
        return choice[1:]

    def wide_misread(self, text: str) -> bool:
        for m in WIDE_RUN.finditer(text):
            if len(m[0]) > 1:
                raw = to_bytes(m[0], "gb18030")
                if raw is not None and from_bytes(raw, "utf-8") is not None:
                    return True
        return False

    def suspect(self, text: str) -> bool:
        sign = HIGH_LATIN if HARMLESS.issuperset(text) else SUSPECT
        return bool(sign.search(text)) or misread(text) or self.wide_misread(text)

    def judge(self, text: str | None) -> Verdict:
        """Null and empty texts are not garbled."""
        if not text or text.isascii() or not self.suspect(text):
            return Verdict(False, text or "", "")
        out, chains, garbled = [], [], False
        for line in text.split("\n"):
            if not self.suspect(line):
                out.append(line)
                continue
            chain, read = self.best(line)
            if not chain:  # a stretch of the line may be garbled where the whole line is not
                parts = re.split(r"(?<=[.!?。！？][\s])", line)
                if len(parts) > 1:
                    done = [self.best(p) if self.suspect(p) else ("", p) for p in parts]
                    chain, read = next((c for c, _ in done if c), ""), "".join(p for _, p in done)
            garbled |= bool(chain) or HARD.search(line) is not None or STRONG.search(line) is not None
            chains += [chain] if chain else []
            out.append(read)
        return Verdict(garbled, "\n".join(out), ",".join(dict.fromkeys(chains)))


def dictionaries(results: DataFrame, rows: int = 6000, size: int = 48_000) -> dict[str, bytes]:
    """Per-language sample text: the labelled texts of a bounded sample (``rows``), lines without suspicious characters,
    repeated lines once, ``size`` bytes a language."""
    sample = bounded_sample(results.where("text is not null and lang_label is not null").select("result_id", "lang_label", "text"), "result_id", rows)
    lines: dict[str, dict[str, None]] = defaultdict(dict)
    for label, text in zip(sample["lang_label"], sample["text"], strict=True):
        code = normalized_label(label)
        for line in text.split("\n"):
            if code and len(line) > 20 and not SUSPECT.search(line) and not misread(line):
                lines[code].setdefault(line)
    return {code: "\n".join(own).encode("utf-8", "ignore")[-size:] for code, own in lines.items() if len(own) >= 8}


def texts_of(results: DataFrame, entries: DataFrame) -> DataFrame:
    """tab, row_id, file_name, text of both tables; files with a null content have no text."""
    from_results = results.select(F.lit("results").alias("tab"), F.col("result_id").alias("row_id"), F.lit("").alias("file_name"), "text")
    files = entries.select(F.lit("entries").alias("tab"), F.col("entry_seq").alias("row_id"), F.explode("tex_files").alias("f"))
    return from_results.unionByName(files.select("tab", "row_id", F.col("f.name").alias("file_name"), F.col("f.content").alias("text"))).where(
        F.col("text").rlike(r"[^\x00-\x7f]")
    )


SCHEMA = "tab string, row_id bigint, file_name string, chain string, restored string"


def garbled_texts(texts: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """One row per garbled text with the chains undone and the text as far as it could be restored.

    Only texts with a character beyond ASCII are looked at (others cannot be garbled). Several files of one name in one
    entry give one row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = Decoder(samples)
        for batch in batches:
            rows = []
            for tab, row_id, file_name, text in zip(batch["tab"], batch["row_id"], batch["file_name"], batch["text"], strict=True):
                verdict = decoder.judge(text)
                if verdict.garbled:
                    rows.append((tab, row_id, file_name, verdict.chain, verdict.restored))
            yield pd.DataFrame(rows, columns=["tab", "row_id", "file_name", "chain", "restored"])

    return texts.mapInPandas(run, SCHEMA)
