"""Comments, shorthand environments and author macros."""

from __future__ import annotations

import re
import time
from typing import NamedTuple

from paperlake.functions.scan import WHOLE_COMMAND, arg, group, option, replace_words, rewrite

def remove_comments(s: str) -> str:
    """A percent sign after an even number of backslashes takes the rest of its line and the line break with it."""
    out, last, at = [], 0, 0
    while (i := s.find("%", at)) >= 0:
        at = i + 1
        if (i - len(s[last:i].rstrip("\\")) - last) % 2 == 0:
            out.append(s[last:i])
            end = s.find("\n", i)
            last = at = len(s) if end < 0 else end + 1
    return "".join([*out, s[last:]]) if out else s


# Shorthands and the environments they open or close.
SHORTHANDS = {"beq": "equation", "bea": "eqnarray", "bse": "subequations", "be": "equation", "ba": "align"}
SHORTHAND_TABLE = {k: f"\\begin{{{v}}}" for k, v in SHORTHANDS.items()} | {"e" + k[1:]: f"\\end{{{v}}}" for k, v in SHORTHANDS.items()}


def normalize_shorthands(s: str) -> str:
    return replace_words(s, SHORTHAND_TABLE)


# Names that authors may not redefine; all single letters are protected too.
PROTECTED = set(
    "at author be begin bf bi chapter cite date def do documentclass em end footnotesize ge huge Huge if in include input it item label large Large LARGE le let ne "
    "newcommand normalfont normalsize of on or paragraph part ref renewcommand rm sc scriptsize section sf sl small subparagraph subsection subsubsection tiny title to tt usepackage".split()
) | set("abcdefghijklmnopqrstuvwxyz")
NEW = re.compile(r"\\(?:newcommand|renewcommand|providecommand)\*?\{\\([A-Za-z]+)\}")
DEF = re.compile(r"\\def\s*\\([A-Za-z]+)")
SPACE = re.compile(r"[ \t\n\r\f]*")
PARAMETERS = re.compile(r"(?:#[0-9])+")


class Macro(NamedTuple):
    name: str
    n_args: int
    body: str
    default: str | None = None


def _definitions(s: str):
    """(name, position behind it, whether by \\def): all \\newcommand-like ones first, then the \\def ones."""
    for m in NEW.finditer(s):
        yield m[1], SPACE.match(s, m.end()).end(), False
    for m in DEF.finditer(s):
        yield m[1], SPACE.match(s, m.end()).end(), True


def collect_macros(s: str) -> dict[str, str]:
    """Macros without arguments; a later definition wins, and any \\def wins over any \\newcommand."""
    found = {}
    for name, at, _ in _definitions(s):
        body = group(s, at)
        if body and name not in PROTECTED:
            found[name] = body.text
    return found


def collect_parametric(s: str) -> list[Macro]:
    """Macros with one to nine arguments, in order of their last definition."""
    found: dict[str, Macro] = {}
    for name, at, by_def in _definitions(s):
        if name in PROTECTED:
            continue
        default = None
        if by_def:
            parameters = PARAMETERS.match(s, at)
            if not parameters or not 1 <= (n := len(parameters[0]) // 2) <= 9:
                continue
            at = SPACE.match(s, parameters.end()).end()
        else:
            count = option(s, at) if s.startswith("[", at) else None
            if not count or not re.fullmatch(r"\+?[0-9]+", count.text.strip()) or not 1 <= (n := int(count.text)) <= 9:
                continue
            at = SPACE.match(s, count.end).end()
            if s.startswith("[", at) and (given := option(s, at)):
                default, at = given.text, given.end
        body = group(s, at)
        if body:
            found.pop(name, None)
            found[name] = Macro(name, n, body.text, default)
    return list(found.values())


THEOREM = re.compile(r"\\newtheorem\*?(?![A-Za-z])")


def collect_theorems(s: str) -> dict[str, str]:
    """Environment name -> display name."""
    found, at = {}, 0
    while (m := THEOREM.search(s, at)) is not None:
        at = m.end()
        name = arg(s, at)
        if not name:
            continue
        counter = option(s, name.end, escapes=False)
        display = arg(s, counter.end if counter else name.end)
        if display:
            found[name.text] = display.text
            at = display.end
    return found


# Limits of growth, in bytes.
LARGE, RATIO, MOST = 5_000_000, 10, 50_000_000


class Deadline(NamedTuple):
    """When work on a paper has to stop; looked at between passes."""

    at: float | None = None

    @property
    def passed(self) -> bool:
        return self.at is not None and time.monotonic() > self.at


def octets(s: str) -> int:
    return len(s) if s.isascii() else len(s.encode("utf-8", "surrogatepass"))


def _limits(s: str, most_passes: int, few_passes: int) -> tuple[int, int]:
    size = octets(s)
    return (few_passes if size > LARGE else most_passes), min(size * RATIO, MOST)


def expand_macros(s: str, macros: dict[str, str], deadline: Deadline = Deadline()) -> str:
    """Up to five passes (three on large texts); a pass that outgrows the cap is thrown away."""
    if not macros:
        return s
    passes, cap = _limits(s, 5, 3)
    for _ in range(passes):
        if deadline.passed or octets(s) > cap:
            break
        # the size is known before the text is built
        growth = sum(octets(macros[m[0][1:]]) - len(m[0]) for m in WHOLE_COMMAND.finditer(s) if m[0][1:] in macros)
        if octets(s) + growth > cap:
            break
        grown = replace_words(s, macros)
        if grown == s:
            break
        s = grown
    return s


PLACE = re.compile(r"#([#0-9]?)")


def fill(body: str, values: list[str]) -> str:
    """#n by the n-th value (nothing if there is none), ## by #; values are not looked into."""
    return PLACE.sub(lambda m: "#" if m[1] in ("", "#") else values[int(m[1]) - 1] if 1 <= int(m[1]) <= len(values) else "", body)


def _expand_one(s: str, macro: Macro) -> str:
    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        at, values = m.end(), []
        if macro.default is not None:
            given = option(t, at)
            values.append(given.text if given else macro.default)
            at = given.end if given else at
        while len(values) < macro.n_args:
            part = arg(t, at)
            if part is None:
                return None
            values.append(part.text)
            at = part.end
        return fill(macro.body, values), at

    return rewrite(s, re.compile(r"\\" + macro.name + "(?![A-Za-z])"), handler)


def expand_parametric(s: str, macros: list[Macro], deadline: Deadline = Deadline()) -> str:
    """Up to three passes (two on large texts), macros in order; a pass that outgrows the cap is undone and ends all."""
    if not macros:
        return s
    passes, cap = _limits(s, 3, 2)
    for _ in range(passes):
        before = s
        for macro in macros:
            if deadline.passed:
                return s
            if "\\" + macro.name in s:
                s = _expand_one(s, macro)
                if octets(s) > cap:
                    return before
        if s == before:
            break
    return s
