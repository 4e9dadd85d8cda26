"""Inline formatting."""

from __future__ import annotations

import re
import unicodedata

from paperlake.functions.scan import SUBSCRIPT, SUPERSCRIPT, Regions, after_option, arg, args, command, drop_words, keep_last, option, rewrite, strip_call, unwrap

# Commands by what becomes of their argument.
EMPHASIS = "emph textit textsl".split()
BOLD = "textbf mathbf boldsymbol bm".split()
TRANSPARENT = (
    "textrm textsc texttt textsf text textnormal mathrm mathit operatorname cal widetilde widehat ensuremath mbox hbox vbox fbox country citenamefont bibnamefont "
    "bibfnamefont newblock xspace normalfont bfseries itshape Vert lVert rVert centering uline uuline sout xout"
).split()
SECOND = "textcolor colorbox texorpdfstring".split()
NOTES = "footnote footnotetext thanks authornote cortext corref fntext ead corauth collaboration onbehalf endnote".split()
MARKS = "corauthref fnref thanksref".split()
SIZES = tuple("tiny scriptsize footnotesize small normalsize large Large LARGE huge Huge".split())
BEFORE_CAPITAL = "authornote email affiliation address institute institution cortext".split()
ACCENTS = {
    "hat": "\u0302", "tilde": "\u0303", "bar": "\u0305", "vec": "\u20d7", "dot": "\u0307", "ddot": "\u0308", "acute": "\u0301", "grave": "\u0300", "check": "\u030c",
    "breve": "\u0306", "overline": "\u0305", "underline": "\u0332", "dddot": "\u20db", "ddddot": "\u20dc",
}
VERB = re.compile(r"\\verb\*?(?![A-Za-z])")
LISTING = re.compile(r"\\lstinline(?![A-Za-z])")
FRACTION = re.compile(r"\\(?:d|t|nice|c)?frac")
BINOMIAL = re.compile(r"\\(?:t|d)?binom")
SCRIPTABLE = re.compile(r"[0-9, \-+=()*ni]*")


def _delimited(t: str, at: int) -> tuple[str, int] | None:
    """What stands between a character and its next occurrence."""
    if at >= len(t):
        return None
    end = t.find(t[at], at + 1)
    return None if end < 0 else (t[at + 1 : end], end + 1)


def inline_code(s: str) -> str:
    s = rewrite(s, VERB, lambda t, m: _delimited(t, m.end()))

    def listing(t: str, m: re.Match) -> tuple[str, int] | None:
        at = after_option(t, m.end())
        part = arg(t, at) if t.startswith("{", at) else None
        if part or t.startswith("{", at):
            return part and (part.text, part.end)
        return _delimited(t, at)

    s = rewrite(s, LISTING, listing)
    return keep_last(s, "mintinline", 2, star=False)


def math_accents(s: str) -> str:
    """A single character takes the accent, composed where Unicode has the letter; a longer argument loses it."""
    for name, mark in ACCENTS.items():
        if "\\" + name in s:

            def handler(t: str, m: re.Match, mark: str = mark) -> tuple[str, int] | None:
                part = arg(t, m.end())
                return part and (unicodedata.normalize("NFC", part.text + mark) if len(part.text) == 1 else part.text, part.end)

            s = rewrite(s, command(name), handler)
    return s


def text_math(s: str) -> str:
    """Fractions, roots and binomials outside mathematics, one kind after the other."""

    def of_two(pattern: re.Pattern, shape: str, t: str) -> str:
        if not pattern.search(t):
            return t
        inside = Regions(t)

        def handler(u: str, m: re.Match) -> tuple[str, int] | None:
            both = None if m.start() in inside else args(u, m.end(), 2)
            return both and (shape.format(*both[0]), both[1])

        return rewrite(t, pattern, handler)

    s = of_two(FRACTION, "{}/{}", s)
    if "\\sqrt" in s:
        inside = Regions(s)

        def root(u: str, m: re.Match) -> tuple[str, int] | None:
            if m.start() in inside:
                return None
            degree = option(u, m.end()) if u.startswith("[", m.end()) else None
            part = arg(u, degree.end if degree else m.end())
            return part and (f"√{f'[{degree.text}]' if degree else ''}({part.text})", part.end)

        s = rewrite(s, command("sqrt"), root)
    return of_two(BINOMIAL, "C({},{})", s)


def scripts(s: str) -> str:
    for name, table in (("textsuperscript", SUPERSCRIPT), ("textsubscript", SUBSCRIPT)):

        def handler(t: str, m: re.Match, table: dict = table) -> tuple[str, int] | None:
            part = arg(t, m.end())
            return part and (part.text.translate(table) if SCRIPTABLE.fullmatch(part.text) else part.text, part.end)

        s = rewrite(s, command(name), handler)
    return s


def quantum(s: str) -> str:
    def braket(t: str, m: re.Match) -> tuple[str, int] | None:
        if both := args(t, m.end(), 2):
            return "⟨{}|{}⟩".format(*both[0]), both[1]
        one = arg(t, m.end())
        return one and (f"⟨{one.text}⟩", one.end)

    def ketbra(t: str, m: re.Match) -> tuple[str, int] | None:
        both = args(t, m.end(), 2)
        return both and ("|{}⟩⟨{}|".format(*both[0]), both[1])

    s = rewrite(rewrite(s, command("braket"), braket), command("ketbra"), ketbra)
    return unwrap(unwrap(s, "ket", "|\u200b", "⟩"), "bra", "⟨", "|\u200b")


def convert_formatting(s: str) -> str:
    if "\\" not in s:
        return s
    s = math_accents(inline_code(s))
    for name in EMPHASIS:
        s = unwrap(s, name, "*", "*")
    for name in BOLD:
        s = unwrap(s, name, "**", "**")
    for name in TRANSPARENT:
        s = unwrap(s, name)
    for name in SECOND:
        s = keep_last(s, name, 2)
    s = keep_last(s, "multicolumn", 3)
    s = drop_words(text_math(s), SIZES)
    for name in NOTES:
        s = unwrap(s, name, " ", " ")
    for name in MARKS:
        s = strip_call(s, name, 1)
    s = unwrap(s.replace("\\footnotemark", ""), "operatorname*")
    s = quantum(scripts(s))
    for name in BEFORE_CAPITAL:
        s = re.sub(rf"\\{name}(?=[A-Z])", " ", s)
    return s
