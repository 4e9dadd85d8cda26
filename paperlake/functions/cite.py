"""Citations, labels, references and links."""

from __future__ import annotations

import re
from collections import Counter

from paperlake.functions.scan import after_option, arg, args, command, keep_last, option, replace_words, rewrite

# Journal macros.
JOURNALS = {
    "aap": "A&A", "aapr": "A&A Rev.", "aaps": "A&AS", "apj": "ApJ", "apjl": "ApJL", "apjs": "ApJS", "apss": "Ap&SS", "araa": "ARA&A", "icarus": "Icarus", "jcap": "JCAP",
    "mnras": "MNRAS", "nat": "Nature", "pasj": "PASJ", "pasp": "PASP", "planss": "Planet. Space Sci.", "prd": "Phys. Rev. D", "prl": "Phys. Rev. Lett.", "procspie": "Proc. SPIE",
    "sci": "Science", "solphys": "Sol. Phys.",
}
CITE = re.compile(r"\\cite(?:p|t|alp|alt|author|year|num)?(?![A-Za-z])\*?")
REFERENCES = ("ref", "eqref", "pageref", "autoref", "cref", "Cref", "nameref")
LABEL = re.compile(r"\\label\{[^{}]*\}")


def bibliography_items(s: str) -> list[tuple[str, str | None]]:
    """(key, label in brackets) of every item, in order."""
    found, at = [], 0
    while (m := command("bibitem").search(s, at)) is not None:
        label = option(s, m.end())
        key = arg(s, label.end if label else m.end())
        at = key.end if key else m.end()
        if key:
            found.append((key.text, label.text if label else None))
    return found


def citation_names(s: str) -> dict[str, str]:
    """Key -> what a citation shows: its label if any label is more than a number, else its position. The first item of
    a key counts, positions go on."""
    items = bibliography_items(s)
    by_label = any(t and t.strip() and not re.fullmatch("[0-9]+", t.strip()) for _, t in items)
    names: dict[str, str] = {}
    for n, (key, label) in enumerate(items, 1):
        names.setdefault(key, label if by_label and label is not None else str(n))
    return names


def label_numbers(s: str) -> dict[str, str]:
    """Label -> number, counted separately for every prefix before a colon and for labels without one."""
    numbers: dict[str, str] = {}
    counts: Counter = Counter()
    at = 0
    while (m := command("label").search(s, at)) is not None:
        key = arg(s, m.end())
        at = key.end if key else m.end()
        if key:
            kind = key.text.split(":", 1)[0] if ":" in key.text else None
            counts[kind] += 1
            numbers.setdefault(key.text, str(counts[kind]))
    return numbers


def convert_references(s: str, section_numbers: dict[str, str]) -> str:
    s = replace_words(s, JOURNALS)
    names = citation_names(s)
    numbers = label_numbers(s) | section_numbers

    def cite(t: str, m: re.Match) -> tuple[str, int] | None:
        keys = arg(t, after_option(t, after_option(t, m.end())))
        return keys and ("[" + ",".join(names.get(k.strip(), k.strip()) for k in keys.text.split(",")) + "]", keys.end)

    def refer(t: str, m: re.Match) -> tuple[str, int] | None:
        key = arg(t, m.end())
        return key and (numbers.get(key.text, key.text), key.end)

    def item(t: str, m: re.Match) -> tuple[str, int]:
        at = after_option(t, m.end())
        key = arg(t, at)
        return (f"\n[{names.get(key.text, key.text)}] ", key.end) if key else ("\n", at)

    def hyper(t: str, m: re.Match) -> tuple[str, int] | None:
        shown = arg(t, after_option(t, m.end()))
        return shown and (shown.text, shown.end)

    s = rewrite(s, CITE, cite)
    for name in REFERENCES:
        s = rewrite(s, command(name), refer)
    s = LABEL.sub("", s)
    s = keep_last(s, "url", 1, star=False)
    s = keep_last(s, "href", 2, star=False)
    s = rewrite(s, command("hyperref"), hyper)
    return rewrite(s, command("bibitem"), item)


__all__ = ["args", "citation_names", "convert_references", "label_numbers"]
