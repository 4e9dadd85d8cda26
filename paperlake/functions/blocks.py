"""Environments: lists, floats, theorems, displays, tables and the rest."""

from __future__ import annotations

import re
from collections import Counter

from paperlake.functions.scan import MATH_ENVIRONMENTS, after_option, arg, blank, flat, flat_option, rewrite, run_to_close, skip_flat_option

# Names of environments by treatment, down to the drawings.
LISTS = "itemize enumerate description compactitem compactenum compactdesc inparaenum".split()
FLOATS = dict.fromkeys("figure figure* wrapfigure subfigure subfloat sidewaysfigure".split(), "Figure") | dict.fromkeys("table table* wraptable sidewaystable".split(), "Table")
QUOTES = "quote quotation verse".split()
THEOREMS = (
    "theorem lemma proposition corollary conjecture definition example remark proof claim observation notation assumption hypothesis property fact question problem "
    "exercise solution case condition"
).split()
TABLES = "tabular tabular* tabularx tabulary longtable longtable* supertabular array".split()
ALGORITHMS = "algorithm algorithm* algorithmic algorithm2e procedure function".split()
ALGORITHM_WORDS = re.compile(
    r"\\(?:State|If|Else|ElsIf|EndIf|While|EndWhile|For|EndFor|ForAll|EndForAll|Return|Require|Ensure|Input|Output|Procedure|EndProcedure|Function|EndFunction|"
    r"Loop|EndLoop|Repeat|Until|Comment)\b"
)
KEYWORDS = "keywords keyword IEEEkeywords".split()
FRAMES = "minipage adjustbox adjustwidth spacing singlespace doublespace onehalfspace multicols multicols* widetext titlepage landscape".split()
VERBATIM = "verbatim Verbatim lstlisting minted alltt".split()
DRAWINGS = "filecontents filecontents* tikzpicture tikzcd pgfpicture pspicture picture".split()

ITEM = re.compile(r"\\item")
GRAPHICS = re.compile(r"\\includegraphics")
CAPTION = re.compile(r"\\caption(?!\*?[A-Za-z])\*?")
BREAK = re.compile(re.escape("\\\\"))
FLOAT_BEGIN = re.compile(r"\\begin\{(" + "|".join(map(re.escape, FLOATS)) + r")\}")
REST = re.compile(r"\\(begin|end)(?=\{)")


def begin(name: str) -> re.Pattern:
    return re.compile(re.escape(f"\\begin{{{name}}}"))


def skip_option(s: str, at: int) -> int:
    """Behind a bracketed option that begins right here; an unclosed one takes the rest."""
    return run_to_close(s, at, "[", "]") if s.startswith("[", at) else at


def skip_arguments(s: str, at: int) -> int:
    while s.startswith("{", at):
        at = run_to_close(s, at, "{", "}")
    return skip_option(s, at)


def unmark(s: str, name: str, skip=skip_option, opening: str = "\n") -> str:
    """The begin mark with what ``skip`` passes over becomes ``opening``, the end mark a line break."""
    if f"{{{name}}}" not in s:
        return s
    s = rewrite(s, begin(name), lambda t, m: (opening, skip(t, m.end())))
    return s.replace(f"\\end{{{name}}}", "\n")


def item(t: str, m: re.Match) -> tuple[str, int]:
    """``\\item[x]`` -> a list mark and its label."""
    at = blank(t, m.end())
    label = flat_option(t, at)
    end = label.end if label else at
    return (f"\n- {label.text} " if label and label.text else "\n- "), end


def graphics(t: str, m: re.Match) -> tuple[str, int] | None:
    name = flat(t, blank(t, skip_flat_option(t, blank(t, m.end()))))
    return name and ("", name.end)


def row_end(t: str, m: re.Match) -> tuple[str, int]:
    return "\n", skip_flat_option(t, m.end())


def rest(t: str, m: re.Match) -> tuple[str, int] | None:
    """A begin or end mark that no rule has taken becomes a line break, a begin mark with its arguments and option."""
    name = flat(t, m.end())
    if name is None:
        return None
    end = name.end
    if m[1] == "begin":
        while part := flat(t, end):
            end = part.end
        end = skip_flat_option(t, end)
    return "\n", end


def between(s: str, name: str, make, skip=lambda t, at: at) -> str:
    """Whole environments by ``make(content)``; one without end stays."""
    if f"\\begin{{{name}}}" not in s:
        return s
    closing = f"\\end{{{name}}}"

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        first = skip(t, m.end())
        last = t.find(closing, first)
        return None if last < 0 else (make(t[first:last]), last + len(closing))

    return rewrite(s, begin(name), handler)


def floats(s: str) -> str:
    """Floats are numbered by kind, one number for every caption; a float ends at the first matching end."""
    counts: Counter = Counter()

    def captioned(content: str, kind: str) -> str:
        def handler(t: str, m: re.Match) -> tuple[str, int] | None:
            part = arg(t, after_option(t, m.end()))
            if not part:
                return None
            counts[kind] += 1
            return f"\n{kind} {counts[kind]}: {part.text}\n", part.end

        return rewrite(content, CAPTION, handler)

    def handler(t: str, m: re.Match) -> tuple[str, int] | None:
        first = skip_option(t, m.end())
        closing = f"\\end{{{m[1]}}}"
        last = t.find(closing, first)
        if last < 0:
            return None
        content = rewrite(t[first:last], GRAPHICS, graphics).replace("\\centering", "")
        return f"\n{captioned(content, FLOATS[m[1]]).strip()}\n", last + len(closing)

    return rewrite(rewrite(s, FLOAT_BEGIN, handler), GRAPHICS, graphics)


def theorem(s: str, name: str, shown: str) -> str:
    """``\\begin{theorem}[x]`` -> bold label with the name in parentheses; a proof ends with a box unless it has one."""
    if f"{{{name}" not in s:
        return s
    for form in (name, name + "*"):

        def handler(t: str, m: re.Match) -> tuple[str, int]:
            named = re.compile(r"[ \t\n]*\[([^\]]*)\]").match(t, m.end())
            return (f"\n**{shown} ({named[1]}).** ", named.end()) if named else (f"\n**{shown}.** ", m.end())

        s = rewrite(s, begin(form), handler)
    for form in (name, name + "*"):
        mark = f"\\end{{{form}}}"
        if name == "proof":
            pieces = s.split(mark)
            s = "".join(p + ("\n" if "\\qed" in p else " □\n") for p in pieces[:-1]) + pieces[-1]
        else:
            s = s.replace(mark, "\n")
    return s


def displays(s: str) -> str:
    """Numbered and unnumbered displays. Numbers run over the names in their fixed order, then over positions."""
    n = 0

    def numbered(content: str) -> str:
        nonlocal n
        n += 1
        return f"\n$$\n{content} ({n})\n$$\n"

    for name in MATH_ENVIRONMENTS:
        if name.endswith("*") or name == "displaymath":
            s = s.replace(f"\\begin{{{name}}}", "\n$$\n").replace(f"\\end{{{name}}}", "\n$$\n")
        else:
            s = between(s, name, numbered)
    return s


FENCE = "\n$$\n"


def display_rows(s: str) -> str:
    """Between display fences cells are parted by spaces and rows by line breaks. A closing fence opens the next
    stretch."""
    pieces = s.split(FENCE)
    # fences that share a line break cannot both match, so splitting finds the same fences from left to right
    return FENCE.join([pieces[0], *(rewrite(p.replace("&", " "), BREAK, row_end) for p in pieces[1:-1]), *pieces[1:][-1:]])


def convert_environments(s: str, theorems: dict[str, str]) -> str:
    for name in LISTS:
        s = unmark(s, name)
    s = rewrite(s, ITEM, item)
    s = floats(s)
    for name in (*QUOTES, "center"):
        s = unmark(s, name)
    s = s.replace("\\centering", "")
    for name in THEOREMS:
        s = theorem(s, name, name.capitalize())
    for name in sorted(theorems):
        if name not in THEOREMS:
            s = theorem(s, name, theorems[name])
    s = display_rows(displays(s))
    s = s.replace("\\[", FENCE).replace("\\]", FENCE)
    for name in TABLES:
        s = between(s, name, lambda content: f"\n{content.replace('&', ' ')}\n", skip_arguments)
    for name in ALGORITHMS:
        s = unmark(s, name)
    s = ALGORITHM_WORDS.sub("", s)
    for name in KEYWORDS:
        s = s.replace(f"\\begin{{{name}}}", "\n**Keywords:** ").replace(f"\\end{{{name}}}", "\n")
    for name in FRAMES:
        s = unmark(s, name, skip_arguments)
    for name in VERBATIM:
        s = unmark(s, name)
    s = unmark(s, "thebibliography", skip_arguments, "\n## References\n")
    for name in DRAWINGS:
        s = between(s, name, lambda content: "")
    return rewrite(s, REST, rest)
