"""Sentence boundaries across languages and scripts, by cascading tables of break and no-break rules.

A rule is (decision, pattern before, pattern after). At every candidate position – after a final mark with its closing
quotes, brackets and references, or at a space between Thai letters – the tables of the paragraph are read in order and
the first rule whose two patterns match decides. Tables cascade: the language's own, then its script's, then the common
one. Headings and list lines are units of their own and never looked into; blank lines end a paragraph; single line
breaks end nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

UPPER = "A-ZÀ-ÖØ-ÞŒŠŽА-ЯЁΑ-Ω"
LOWER = "a-zß-öø-ÿœšžа-яёα-ω"
UNCASED = "฀-๿ऀ-ॿ一-鿿ぁ-ヿ㐀-䶿"
BREAK, KEEP = True, False

# Abbreviations of the languages: titles, words before a number, and words before more of the sentence. Those
# under "" are used in references of any language.
TITLES = {
    "": "Dr|Prof", "en": "Mr|Mrs|Ms", "de": "Hr|Fr", "fr": "MM|M|Mme|Mlle", "es": "Sr|Sra|Srta|Dra", "it": "dott|prof|sig|ing", "pt": "Sr|Sra|Dra", "ru": "проф|акад",
    "hi": "डॉ|श्री",
}
NUMBERED = {
    "": "Fig|Figs|fig|figs|Eq|Eqs|eq|Sec|Secs|Ref|Refs|Vol|vol|No|no|Nos|nos|Tab|tab|Ch|App|p|pp|n|num|ca|al|cf|vs|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec",
    "en": "approx|ex|sec|ff|sqq", "de": "Abb|S|Nr|Bd|Kap|vgl|ff", "fr": "éq|éqs|env|ex|art", "es": "ec|núm|núms|aprox|art|cap|ej|es", "it": "cap|art|sec|es", "pt": "aprox|cap|art|ex",
    "ru": "рис|табл|стр|гл",
}
POINTING = {
    "": "cf|vs|ca|App|Eq|Fig|Sec|Tab|Ref|Vol|EE", "en": r"i\.\s?e|e\.\s?g|approx", "de": r"vgl|Vgl|bzw|s|z\.\s*B|d\.\s*h|u\.\s*a|Anh|Abb|Nr|S|Kap", "fr": r"p\.\s*ex",
    "es": r"p\.\s*ej|aprox", "it": r"ad\s+es", "pt": r"p\.\s*ex|aprox", "ru": r"см|См|т\.\s*е",
}
MONTHS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"


def abbreviations(*languages: str) -> list[tuple[bool, str, str]]:
    """No break behind the abbreviations of the languages; one rule for each kind."""
    of = lambda kind: "|".join(kind[k] for k in languages if k in kind)
    kinds = [(of(TITLES), r""), ("|".join(x for x in (of(NUMBERED), of(POINTING)) if x), r"\s*[\d(\[½]"), (of(POINTING), rf"\s*[{UPPER}]")]
    return [(KEEP, rf"(?<!\w)(?:{words})\.", after) for words, after in kinds if words]


COMMON = [
    (KEEP, r"\d\.", r"\d"),  # decimals, versions
    (BREAK, rf"[{LOWER}]{{7}}[.!?]+", rf"\s+[{UPPER}][{LOWER}’' ]"),  # a long word is no abbreviation; settles most places
    (KEEP, r"", r"\s*[,;:)\]}]"),
    (KEEP, r"", r"\s?[—–]\s*(?![A-Z])"),
    (KEEP, r"", rf"\s*[“„«\"(\[‘]?[{LOWER}](?![{UPPER}])"),  # a sentence does not begin with a small letter
    (KEEP, rf"(?<!\w)[{LOWER}]\.", rf"\s?[{UPPER}]\."),  # z. B., u. U.
    (BREAK, rf"\d\s[{UPPER}]\.", rf"\s+[“„«¿¡(]?[{UPPER}]"),  # a unit such as K, not an initial
    (BREAK, rf"(?:App|Anh|Ref|Eq|Tab)\.\s[{UPPER}]\.", rf"\s+[“„«¿¡(]?[{UPPER}]"),
    (KEEP, rf"(?<![\w’'])[{UPPER}]\.", rf"\s*[{UPPER}]"),  # initials
    (KEEP, rf"(?<!\w)[{UPPER}]\.[{UPPER}]\.", rf"\s*[{UPPER}]"),
    (KEEP, r"\.", r"\s*\(\d"),
    (KEEP, r"(?<!\w)\w\.", r"[^\s]"),  # k.h. and the like, written without spaces
    (KEEP, r"\w\.", r"\d"),
    (BREAK, r"", rf"[{UPPER}][{LOWER}’' ]|[“„«¿¡][{UPPER}¿¡]|\s*[{UNCASED}]"),  # the space is missing
    (BREAK, r"", rf"\s+[“„«\"(\[‘¿¡#-]*\s*[{UPPER}{UNCASED}0-9]|\s+[a-z][{UPPER}]|\s+[√∑∫$≤≥±]"),
    (KEEP, r"", r""),
]
#: Days in German; they hold in all cascades, as texts quote German passages and no other language writes this.
GERMAN = [(KEEP, r"(?<!\w)(?:[Aa]m|AM)\s+\d+\.", r"\s"), (KEEP, r"\d\.", rf"\s+(?:{MONTHS})\b")]
WIDE = [
    (KEEP, r"[。！？!?][”」』’]+", r"[^。！？!?\n“「『]{0,16}?(?:问道|問道|问|說道|说道|写道|答道|說|说)"),  # the speaker follows
    (KEEP, r"[。！？!?][”」』’]+", r"\s*(?:と|って)"),
    (KEEP, r"", r"[」』）)，、；：]"),
    (KEEP, r"…", r""),
    (BREAK, r"[。！？．｡][”」』’）)》]*(?:\s*\[\d[\d, –-]*\])*", r""),
]
HINDI = [(BREAK, r"[।॥][”’)]*(?:\s*\[\d[\d, –-]*\])*", r"")]
THAI = [(BREAK, r"[฀-๿0-9)”]", r" +[฀-๿]"), (KEEP, r"[฀-๿]", r" ")]
LANGUAGES = sorted({*TITLES, *NUMBERED, *POINTING} - {""})
#: Without a label the abbreviations of all languages hold.
ALL = [*GERMAN, *abbreviations("", *LANGUAGES)]
#: The cascades: of the Latin, Cyrillic and Greek paragraphs of a language, of those without a known label, and of those in
#: scripts that decide by themselves (whose abbreviations are those of quoted languages).
TABLES = {code: [GERMAN, abbreviations("", code), COMMON] for code in LANGUAGES}
TABLES |= {"": [ALL, COMMON], "wide": [WIDE, ALL, COMMON], "hi": [HINDI, ALL, COMMON], "th": [THAI, HINDI, ALL, COMMON]}

FINAL = re.compile(
    r"(?:[.!?]+|…|[。！？．｡।॥]+)"
    r"(?:[”’»)\]」』）》]|“(?![\w¿¡«„“])|\"(?=[\s,.;:]|$)|[  \xa0]»|(?<=[。！？])[”」』]|)*"
    r"(?:[ ]?\[\d[\d, –-]*\])*"
)
SPACE_THAI = re.compile(r"(?<=[฀-๿0-9)”])(?= +[฀-๿])")
HEADING = re.compile(r"\s*#{1,6}[ \t]")
ITEM = re.compile(r"\s*[-*•][ \t]")
#: What a heading or list line begins with.
MARKS = "#-*•"


QUICK_AFTER = re.compile(rf"\s+[{UPPER}][{LOWER}’' ]")


#: Words of the tables that can stand before a full stop inside a sentence.
ABBREVIATED = {w for kind in (TITLES, NUMBERED, POINTING) for words in kind.values() for w in words.split("|")}


class Rules:
    """The cascade of one kind of paragraph, compiled: neighbouring rules stay in order, the first match decides."""

    REACH = 24

    def __init__(self, tables: list[list[tuple[bool, str, str]]]):
        self.rules = [(d, re.compile(f"(?:{b})\\Z") if b else None, re.compile(a) if a else None) for table in tables for d, b, a in table]

    def decide(self, text: str, at: int) -> bool:
        if QUICK_AFTER.match(text, at) and text[at - 1] in ".!?":
            word = text[text.rfind(" ", max(0, at - self.REACH), at - 1) + 1 : at - 1]
            if len(word) > 2 and word.isalpha() and word.islower() and word not in ABBREVIATED:
                return BREAK  # a whole small word that no table knows before a new sentence: every cascade says so (tested)
        before = text[max(0, at - self.REACH) : at]
        for decision, b, a in self.rules:
            if (a is None or a.match(text, at)) and (b is None or b.search(before)):
                return decision
        return KEEP


RULES = {name: Rules(tables) for name, tables in TABLES.items()}
THAI_LETTER = re.compile("[฀-๿]")
WIDE_LETTER = re.compile("[一-鿿ぁ-ヿ]")
HINDI_LETTER = re.compile("[ऀ-ॿ]")
OTHER_LETTER = re.compile("[฀-๿一-鿿ぁ-ヿऀ-ॿ]")


def table_for(paragraph: str, language: str | None) -> str:
    """The cascade is chosen by the paragraph's own script, and among languages of one script by the label."""
    if paragraph.isascii() or not OTHER_LETTER.search(paragraph):
        return language if language in TABLES and language not in ("hi", "wide", "th") else ""
    if THAI_LETTER.search(paragraph):
        return "th"
    if WIDE_LETTER.search(paragraph):
        return "wide"
    if HINDI_LETTER.search(paragraph):
        return "hi"
    return ""


def blocks(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole): headings and list lines are whole units, the rest are paragraphs."""
    begin = None
    at = 0
    for line in text.split("\n"):
        end = at + len(line)
        head = line.lstrip()[:1]
        single = head and head in MARKS and (HEADING.match(line) or ITEM.match(line))
        if single or not head:
            if begin is not None:
                yield begin, at, False
                begin = None
            if single:
                yield at, end, True
        elif begin is None:
            begin = at
        at = end + 1
    if begin is not None:
        yield begin, len(text), False


def sentences(text: str | None, language: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of every unit, in code points. Null, empty and blank texts have none."""
    if not text:
        return []
    units = []
    for start, end, whole in blocks(text):
        piece = text[start:end]
        cuts = [0]
        if not whole:
            name = table_for(piece, language)
            rules = RULES[name]
            ends = [m.end() for m in FINAL.finditer(piece)]
            if name == "th":
                ends = sorted({*ends, *(m.start() for m in SPACE_THAI.finditer(piece))})
            cuts += [e for e in ends if e < len(piece) and rules.decide(piece, e)]
        for a, b in zip(cuts, [*cuts[1:], len(piece)], strict=True):
            unit = piece[a:b]
            body = unit.strip()
            if body:
                first = start + a + len(unit) - len(unit.lstrip())
                units.append((first, first + len(body)))
    return units


SCHEMA = "doc_id bigint, sent_no int, sent_start int, sent_end int, sentence string"


def sentence_units(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per unit of every document, with its place (code points of ``text``) and number. Whole texts are read;
    documents without a character other than white space give no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, language in zip(batch["doc_id"], batch["text"], batch["lang"], strict=True):
                for n, (a, b) in enumerate(sentences(text, language.strip().lower() if language else None)):
                    rows.append((doc_id, n, a, b, text[a:b] if with_text else None))
            yield pd.DataFrame(rows, columns=["doc_id", "sent_no", "sent_start", "sent_end", "sentence"])

    return documents.where("text is not null").select("doc_id", "text", "lang").mapInPandas(run, SCHEMA)
