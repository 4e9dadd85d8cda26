"""Scanning primitives for TeX source.

Everything that needs balanced brackets goes through ``rewrite``: a pattern finds where a command may begin, a handler
reads its arguments from there and either says what replaces the command and where reading goes on, or declines. Nothing
that was replaced is read again in the same pass.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

BRACES = re.compile(r"\\.|[{}]", re.S)
BRACKETS = re.compile(r"\\.|[\[\]]", re.S)
PLAIN_BRACKETS = re.compile(r"[\[\]]")
PLAIN_BRACES = re.compile(r"[{}]")
BLANK = re.compile(r"[ \t\n]*")
#: Where an unclosed argument is taken to end: a paragraph break or the next command.
LOOSE_END = re.compile(r"\n\n|\\[A-Za-z]")


class Part(NamedTuple):
    """An argument: its content and the position behind it."""

    text: str
    end: int


def _close(s: str, at: int, marks: re.Pattern, left: str, right: str) -> int | None:
    """Position of the bracket that closes the one at ``at``; a backslash hides the character after it if ``marks``
    knows backslashes."""
    depth = 0
    for m in marks.finditer(s, at):
        token = m[0]
        if token == left:
            depth += 1
        elif token == right:
            depth -= 1
            if depth == 0:
                return m.start()
    return None


def group(s: str, at: int) -> Part | None:
    """The braced group that begins exactly at ``at``."""
    if not s.startswith("{", at):
        return None
    end = _close(s, at, BRACES, "{", "}")
    return None if end is None else Part(s[at + 1 : end], end + 1)


def arg(s: str, at: int, tolerant: bool = False) -> Part | None:
    """The next argument, after blanks. A tolerant one that is never closed ends at a paragraph break, at the next
    command or at the end of the text, but must hold something."""
    at = BLANK.match(s, at).end()
    found = group(s, at)
    if found or not tolerant or not s.startswith("{", at):
        return found
    stop = LOOSE_END.search(s, at + 1)
    end = stop.start() if stop else len(s)
    return Part(s[at + 1 : end], end) if stop or end > at + 1 else None


def option(s: str, at: int, escapes: bool = True) -> Part | None:
    """The next bracketed option, after blanks; nested brackets belong to it."""
    at = BLANK.match(s, at).end()
    if not s.startswith("[", at):
        return None
    end = _close(s, at, BRACKETS if escapes else PLAIN_BRACKETS, "[", "]")
    return None if end is None else Part(s[at + 1 : end], end + 1)


def after_option(s: str, at: int, escapes: bool = True) -> int:
    found = option(s, at, escapes)
    return found.end if found else at


def run_to_close(s: str, at: int, left: str, right: str) -> int:
    """Behind the bracket that closes the one at ``at``, escapes not heeded; the end of the text if there is none."""
    end = _close(s, at, PLAIN_BRACKETS if left == "[" else PLAIN_BRACES, left, right)
    return len(s) if end is None else end + 1


SPACE = re.compile(r"\s*")


def blank(s: str, at: int) -> int:
    """Behind white space of any kind."""
    return SPACE.match(s, at).end()


def flat(s: str, at: int, depth: int = 0) -> Part | None:
    """The group that begins exactly at ``at``, if groups nest in it at most ``depth`` deep; escapes are not heeded."""
    if not s.startswith("{", at):
        return None
    level = 0
    for m in PLAIN_BRACES.finditer(s, at):
        level += 1 if m[0] == "{" else -1
        if level > depth + 1:
            return None
        if level == 0:
            return Part(s[at + 1 : m.start()], m.end())
    return None


def flat_option(s: str, at: int) -> Part | None:
    """The option that begins exactly at ``at`` and ends with the first closing bracket."""
    end = s.find("]", at) if s.startswith("[", at) else -1
    return None if end < 0 else Part(s[at + 1 : end], end + 1)


def skip_flat_option(s: str, at: int) -> int:
    found = flat_option(s, at)
    return found.end if found else at


def args(s: str, at: int, n: int) -> tuple[list[str], int] | None:
    """``n`` arguments in a row."""
    out = []
    for _ in range(n):
        part = arg(s, at)
        if part is None:
            return None
        out.append(part.text)
        at = part.end
    return out, at


Handler = Callable[[str, re.Match], "tuple[str, int] | None"]


def rewrite(s: str, pattern: re.Pattern, handler: Handler) -> str:
    out, last, at = [], 0, 0
    while (m := pattern.search(s, at)) is not None:
        done = handler(s, m)
        if done is None:
            at = m.end()
            continue
        out.append(s[last : m.start()])
        out.append(done[0])
        last = at = done[1]
    if not out:
        return s
    out.append(s[last:])
    return "".join(out)


@lru_cache(None)
def command(name: str, boundary: str = "A-Za-z") -> re.Pattern:
    """A command by name, not the beginning of a longer one."""
    return re.compile(re.escape("\\" + name) + (f"(?![{boundary}])" if boundary else ""))


def unwrap(s: str, name: str, before: str = "", after: str = "") -> str:
    """``\\name[option]{x}`` -> before x after. A starred form is another command and stays."""
    if "\\" + name not in s:
        return s

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        part = arg(t, after_option(t, m.end()), tolerant=True)
        return None if part is None else (before + part.text + after, part.end)

    return rewrite(s, command(name, "A-Za-z" if name.endswith("*") else "A-Za-z*"), handler)


def keep_last(s: str, name: str, n: int, star: bool = True) -> str:
    """Of ``n`` arguments the last stays."""
    if "\\" + name not in s:
        return s

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        found = args(t, m.end() + (star and t.startswith("*", m.end())), n)
        return None if found is None else (found[0][-1], found[1])

    return rewrite(s, re.compile(re.escape("\\" + name) + (r"(?!\*?[A-Za-z])" if star else "(?![A-Za-z])")), handler)


def strip_call(s: str, name: str, n: int) -> str:
    """The command and its ``n`` arguments vanish; without all of them it stays."""
    if "\\" + name not in s:
        return s

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        found = args(t, m.end(), n)
        return None if found is None else ("", found[1])

    return rewrite(s, command(name, "" if name.endswith("*") else "A-Za-z"), handler)


def drop_words(s: str, names: tuple[str, ...]) -> str:
    """Commands without argument vanish."""
    return any_command(names).sub("", s)


@lru_cache(None)
def any_command(names: tuple[str, ...]) -> re.Pattern:
    return re.compile(r"\\(?:" + "|".join(sorted(map(re.escape, names), key=len, reverse=True)) + ")(?![A-Za-z])")


@lru_cache(None)
def words_beginning(names: tuple[str, ...]) -> re.Pattern:
    """Commands by name where something that is no letter has to follow anyway, as the handler checks."""
    return re.compile(r"\\(?:" + "|".join(sorted(map(re.escape, names), key=len, reverse=True)) + ")")


WHOLE_COMMAND = re.compile(r"\\[A-Za-z]+")


def replace_words(s: str, table: dict[str, str]) -> str:
    """Whole commands by dictionary; keys without backslash."""
    return WHOLE_COMMAND.sub(lambda m: table.get(m[0][1:], m[0]), s)


# Environments whose content is mathematics, in the order in which their numbers are given out.
MATH_ENVIRONMENTS = (
    "equation equation* align align* gather gather* multline multline* eqnarray eqnarray* displaymath flalign flalign* alignat alignat* math dmath dmath* "
    "split cases aligned gathered alignedat subequations pmatrix bmatrix vmatrix Bmatrix Vmatrix smallmatrix psmallmatrix bsmallmatrix"
).split()
OPENER = re.compile(r"\\.|\$\$?", re.S)
CLOSERS = {"\\(": re.compile(r"\\\)"), "\\[": re.compile(r"\\\]"), "$": re.compile(r"(?<!\\)\$|\\\$"), "$$": re.compile(r"\\\$|\$\$")}


class Regions:
    """Stretches of mathematics, sorted and merged; ``position in regions`` is a binary search."""

    def __init__(self, s: str):
        found = list(self._delimited(s))
        if "\\begin{" in s:
            for name in MATH_ENVIRONMENTS:
                opening, closing, at = f"\\begin{{{name}}}", f"\\end{{{name}}}", 0
                while (a := s.find(opening, at)) >= 0 and (b := s.find(closing, a)) >= 0:
                    at = b + len(closing)
                    found.append((a, at))
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(found):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    @staticmethod
    def _delimited(s: str):
        at = 0
        while (m := OPENER.search(s, at)) is not None:
            at = m.end()
            closer = CLOSERS.get(m[0])
            if closer is None:
                continue
            end = None
            for c in closer.finditer(s, at):
                if c[0] != "\\$":
                    end = c.end()
                    break
            if end is None:
                return
            yield m.start(), end
            at = end

    def __contains__(self, position: int) -> bool:
        i = bisect_right(self.starts, position) - 1
        return i >= 0 and position < self.ends[i]


# Characters with a superscript or subscript form.
SUPERSCRIPT = str.maketrans("0123456789+-=()ni*", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿⁱ∗")
SUBSCRIPT = str.maketrans("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")


def raised(text: object) -> str:
    return str(text).translate(SUPERSCRIPT)
