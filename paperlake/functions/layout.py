"""Sections, titles and the three ways in which authors are tied to affiliations."""

from __future__ import annotations

import re
from typing import NamedTuple

from paperlake.functions.scan import BLANK, after_option, arg, blank, command, flat, option, raised, rewrite

SECTION = re.compile(r"\\(chapter|section|subsection|subsubsection)(?![A-Za-z])(\*?)(?![A-Za-z])")
LEVEL = {"chapter": 0, "section": 1, "subsection": 2, "subsubsection": 3}
TITLES = {"title": "\n# ", "author": "\n", "authors": "\n", "date": "\n", "address": "\n", "affiliation": "\n", "affiliations": "\n"}
ACKNOWLEDGEMENT = re.compile(r"\\(begin|end)\{acknowledge?ments?\}")
PROCLAIM = re.compile(r"\\proclaim")
SUBHEAD = re.compile(r"\\subhead\s*")


def proclaimed(t: str, m: re.Match) -> tuple[str, int]:
    """A proclamation opens with its name, or as a theorem."""
    at = blank(t, m.end())
    name = flat(t, at)
    return f"\n**{name.text if name and name.text else 'Theorem'}.** ", name.end if name else at


def section_number(counts: list[int], level: int) -> str:
    """Count a section of ``level``; its number begins at the highest level that has been used."""
    counts[level] += 1
    counts[level + 1 :] = [0] * (3 - level)
    first = next(i for i in range(level + 1) if counts[i] > 0)
    return ".".join(map(str, counts[first : level + 1]))


def numbered_sections(s: str, labels: dict[str, str]) -> str:
    """Headings with numbers; a label that follows at once is entered in ``labels``."""
    counts = [0, 0, 0, 0]

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        title = arg(t, after_option(t, m.end()))
        if title is None:
            return None
        number = ""
        if not m[2]:
            number = section_number(counts, LEVEL[m[1]])
            follows = BLANK.match(t, title.end).end()
            if t.startswith("\\label", follows) and (key := arg(t, follows + 6)):
                labels[key.text] = number
            number += ". "
        return f"\n{'#' * (LEVEL[m[1]] + 1)} {number}{title.text}\n", title.end

    return rewrite(s, SECTION, handler)


def headed(s: str, name: str, before: str, after: str = "\n") -> str:
    """``\\name*[short]{x}`` -> before x after."""
    if "\\" + name not in s:
        return s

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        part = arg(t, after_option(t, m.end()))
        return part and (before + part.text + after, part.end)

    return rewrite(s, re.compile(rf"\\{name}(?!\*?[A-Za-z])\*?"), handler)


class Entry(NamedTuple):
    kind: str
    start: int
    end: int
    text: str


PEOPLE = re.compile(r"\\(author|affiliation|altaffiliation)(?![A-Za-z])")


def _people(s: str) -> list[Entry] | None:
    """Authors and affiliations in order; None if an author carries a label in brackets."""
    found, at = [], 0
    while (m := PEOPLE.search(s, at)) is not None:
        at = m.end()
        if m[1] == "author" and s.startswith("[", BLANK.match(s, at).end()):
            return None
        part = arg(s, after_option(s, at, escapes=False) if m[1] == "altaffiliation" else at)
        if part:
            found.append(Entry(m[1], m.start(), part.end, part.text))
            at = part.end
    return found


def shared_affiliations(s: str) -> str:
    """Authors share the affiliation that follows them; an alternative one belongs to the last author alone. Needs two
    authors and an affiliation. The list of distinct affiliations stands where the first was."""
    entries = _people(s) if "\\author" in s and "\\affiliation" in s else None
    if not entries or sum(e.kind == "author" for e in entries) < 2 or not any(e.kind == "affiliation" for e in entries):
        return s
    number: dict[str, int] = {}
    of: dict[int, list[int]] = {}
    waiting: list[int] = []
    last = None
    for i, e in enumerate(entries):
        if e.kind == "author":
            waiting.append(i)
            last = i
            continue
        n = number.setdefault(e.text.strip(), len(number) + 1)
        for a in waiting if e.kind == "affiliation" else [last] if last is not None else []:
            if n not in of.setdefault(a, []):
                of[a].append(n)
        if e.kind == "affiliation":
            waiting = []
    out, at, listed = [], 0, False
    for i, e in enumerate(entries):
        out.append(s[at : e.start])
        at = e.end
        if e.kind == "author":
            out.append("\n" + e.text + ",".join(raised(n) for n in of.get(i, [])))
        elif not listed:
            listed = True
            out.append("\n" + "".join(f"{raised(n)} {name}\n" for name, n in number.items()))
    return "".join(out) + s[at:]


def labelled_addresses(s: str) -> str:
    """``\\address[l]{x}`` is numbered, ``\\author[l,m]{x}`` gets the numbers of its labels."""
    number: dict[str, int] = {}
    count = 0

    def address(t: str, m: re.Match) -> tuple[str, int] | None:
        nonlocal count
        labels = option(t, m.end(), escapes=False)
        part = labels and arg(t, labels.end)
        if not part:
            return None
        count += 1
        number.update({x.strip(): count for x in labels.text.split(",") if x.strip()})
        return f"\n{raised(count)} {part.text}\n", part.end

    def author(t: str, m: re.Match) -> tuple[str, int] | None:
        labels = option(t, m.end(), escapes=False)
        part = labels and arg(t, labels.end)
        if not part:
            return None
        known = [str(number[x.strip()]) for x in labels.text.split(",") if x.strip() in number]
        return "\n" + part.text + raised(",".join(known)), part.end

    done = rewrite(s, command("address"), address)
    return rewrite(done, command("author"), author) if number else s


BREAK = re.compile(r"\\\\(?:\[[^\]]*(?:\]|$))?")
INST = re.compile(r"\\inst\{([^}]*)\}")
LABEL_KEY = re.compile(r"\\label\{([^{}]*)\}")
REF_KEY = re.compile(r"\\ref\{([^{}]*)\}")


def institutes(content: str) -> list[tuple[int, str]]:
    """(number, text) of the institutes in one argument: separated by ``\\and``, or begun by ``\\inst{n}`` where no
    ``\\and`` stands. Empty ones are left out but keep their number."""
    flat = BREAK.sub(" ", content)
    if "\\and" in flat or "\\inst{" not in flat:
        return [(n, part.strip()) for n, part in enumerate(flat.split("\\and"), 1) if part.strip()]
    found, marks = [], list(INST.finditer(flat))
    for m, following in zip(marks, [*marks[1:], None], strict=True):
        text = flat[m.end() : following.start() if following else len(flat)].strip()
        if text:
            wanted = m[1].strip()
            found.append((int(wanted) if wanted.isdigit() else len(found) + 1, text))
    return found


def institute_lists(s: str) -> str:
    """``\\institute`` becomes a numbered list, ``\\inst`` on a name its numbers."""
    number: dict[str, int] = {}

    def listing(t: str, m: re.Match) -> tuple[str, int] | None:
        part = arg(t, m.end())
        if not part:
            return None
        lines = []
        for n, text in institutes(part.text):
            number.update(dict.fromkeys(LABEL_KEY.findall(text), n))
            lines.append(f"\n{raised(n)} {LABEL_KEY.sub('', text).strip()}")
        return "".join(lines) + "\n", part.end

    def mark(t: str, m: re.Match) -> tuple[str, int] | None:
        part = arg(t, m.end())
        if not part:
            return None
        shown = []
        for piece in map(str.strip, part.text.split(",")):
            ref = REF_KEY.search(piece)
            shown.append(str(number[ref[1]]) if ref and ref[1] in number else piece)
        joined = ",".join(shown)
        return raised(joined) if re.fullmatch("[0-9,]*", joined) else joined, part.end

    return rewrite(rewrite(s, command("institute"), listing), command("inst"), mark)


def convert_structure(s: str, labels: dict[str, str]) -> str:
    s = numbered_sections(s, labels)
    s = headed(s, "part", "\n# ")
    for name in ("paragraph", "subparagraph"):
        s = headed(s, name, "\n**", "** ")
    s = labelled_addresses(shared_affiliations(s))
    for name, before in TITLES.items():
        s = headed(s, name, before)
    s = s.replace("\\maketitle", "").replace("\\begin{abstract}", "\n**Abstract.** ").replace("\\end{abstract}", "\n")
    s = ACKNOWLEDGEMENT.sub(lambda m: "\n## Acknowledgements\n" if m[1] == "begin" else "\n", s)
    s = headed(s, "abstract", "\n**Abstract.** ")
    s = rewrite(s, PROCLAIM, proclaimed).replace("\\endproclaim", "\n")
    s = SUBHEAD.sub("\n### ", s).replace("\\endsubhead", "\n")
    return institute_lists(s)
