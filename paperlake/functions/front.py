"""The document's body, and what of the preamble is worth keeping."""

from __future__ import annotations

import re

from paperlake.functions.expand import remove_comments
from paperlake.functions.layout import institutes
from paperlake.functions.scan import Part, after_option, arg, command, option, raised

BEGIN = "\\begin{document}"
END = re.compile(r"\\end\{document\}")


def _calls(s: str, pattern: re.Pattern, options: bool = False):
    """(start, labels, argument) of every call that has an argument."""
    at = 0
    while (m := pattern.search(s, at)) is not None:
        labels = option(s, m.end(), escapes=False) if options else None
        part = arg(s, labels.end if labels else m.end())
        at = part.end if part else m.end()
        if part:
            yield m.start(), labels, part


def _numbers(labels: Part | None, number: dict[str, int]) -> str:
    known = [str(number[x.strip()]) for x in labels.text.split(",") if x.strip() in number] if labels else []
    return raised(",".join(known))


def _in_body(body: str, name: str) -> bool:
    return f"\\{name}{{" in body or f"\\{name} " in body


def metadata(preamble: str, body: str) -> list[str]:
    """Title, authors, affiliations, addresses, institutes, abstract and mail addresses, in this order, from a preamble
    without its comments; title and authors only if the body does not have them."""
    s = remove_comments(preamble)
    texts = lambda name, options=False: [p.text for _, _, p in _calls(s, command(name), options)]
    number: dict[str, int] = {}
    addresses = []
    for n, (_, labels, part) in enumerate(_calls(s, command("address"), True), 1):
        addresses.append(part.text)
        number.update({x.strip(): n for x in (labels.text.split(",") if labels else []) if x.strip()})
    items = []
    if not _in_body(body, "title"):
        items += ["# " + p.text for _, _, p in _calls(s, re.compile(r"\\title(?![A-Za-z])\*?"), True)]
    if not _in_body(body, "author"):
        items += [p.text + _numbers(labels, number) for _, labels, p in _calls(s, re.compile(r"\\author(?![A-Za-z])\*?"), True)]
        items += texts("authors")
    items += texts("affiliations") + texts("affiliation", True)
    items += [f"{raised(n)} {a}" for n, a in enumerate(addresses, 1)] if number else addresses
    for _, _, part in _calls(s, command("institute")):
        items += [text for _, text in institutes(part.text)]
    if "\\institute" not in s:
        items += texts("inst")
    items += ["**Abstract.** " + t for t in texts("abst")]
    return items + texts("email", True) + texts("emailAdd")


NOTES = [command("thanks"), command("footnote"), re.compile(r"\\footnotetext"), command("funding")]


def notes(preamble: str, body: str | None = None) -> list[str]:
    """Footnote-like texts of the preamble as it stands, comments included, but for those inside a title and author that
    are kept (``body`` does not have them); without a body all of them."""
    taken = []
    for name in ("title", "author") if body is not None else ():
        if not _in_body(body, name):
            taken += [(start, part.end) for start, _, part in _calls(preamble, re.compile(rf"\\{name}(?![A-Za-z])\*?"), True)]
    out = []
    for pattern in NOTES:
        at = 0
        while (m := pattern.search(preamble, at)) is not None:
            at = m.end()
            if any(a <= m.start() < b for a, b in taken):
                continue
            if part := arg(preamble, m.end()):
                out.append(part.text)
                at = part.end
    return out


def split_document(s: str) -> tuple[list[str], str]:
    """(texts kept from the preamble, body). Without a begin mark all is body; an end mark on a comment line is none."""
    at = s.find(BEGIN)
    if at < 0:
        return [], s
    preamble, rest = s[:at], s[at + len(BEGIN) :]
    body = rest
    for m in END.finditer(rest):
        if not rest[rest.rfind("\n", 0, m.start()) + 1 : m.start()].lstrip().startswith("%"):
            body = rest[: m.start()]
            break
    return metadata(preamble, rest) + notes(preamble, rest), body


__all__ = ["after_option", "metadata", "notes", "split_document"]
