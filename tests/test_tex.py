"""Vectors of the TeX operators: input and what has to come out."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperlake.functions import blocks, cite, columns, expand, front, glyphs, includes, layout, scan, style, tidy
from paperlake.functions.extract import extract, extract_text
from paperlake.functions.includes import TexFile


def structure(s):
    return layout.convert_structure(s, {})


def references(s):
    return cite.convert_references(s, {})


def environments(s):
    return blocks.convert_environments(s, {})


EXACT = [
    (expand.remove_comments, "word%\njoined", "wordjoined"),
    (expand.remove_comments, "line\\\\% comment\nnext", "line\\\\next"),
    (expand.remove_comments, r"10\% tax", r"10\% tax"),
    (expand.remove_comments, "", ""),
    (expand.normalize_shorthands, r"\bea x \eea", r"\begin{eqnarray} x \end{eqnarray}"),
    (expand.normalize_shorthands, r"\beta \bear", r"\beta \bear"),
    (structure, r"\section[short]{Full Title Here}", "\n## 1. Full Title Here\n"),
    (structure, r"\section*{Introduction}", "\n## Introduction\n"),
    (structure, r"\subsection{Alone}", "\n### 1. Alone\n"),
    (structure, r"\sectionmark{x}\section{A}", "\\sectionmark{x}\n## 1. A\n"),
    (references, r"\cite{unknown}", "[unknown]"),
    (references, r"See \ref{fig:unknown}", "See fig:unknown"),
    (references, r"\citation{x}", r"\citation{x}"),
    (references, r"\cite{a,b}\bibitem{a}\bibitem{b}", "[1,2]\n[1] \n[2] "),
    (references, r"\citep{a}\bibitem[Smith et al., 2020]{a}", "[Smith et al., 2020]\n[Smith et al., 2020] "),
    (references, r"\cite{b}\bibitem{a}\bibitem{a}\bibitem{b}", "[3]\n[1] \n[1] \n[3] "),
    (style.convert_formatting, r"\textbf{\emph{nested}}", "***nested***"),
    (style.convert_formatting, r"text\footnote{note}more", "text note more"),
    (style.convert_formatting, r"\frac{a}{b}", "a/b"),
    (style.convert_formatting, r"$\frac{a}{b}$", r"$\frac{a}{b}$"),
    (style.convert_formatting, r"\sqrt[3]{x}", "√[3](x)"),
    (style.convert_formatting, r"\verb·code·", "code"),
    (style.convert_formatting, r"\verbatim|x|", r"\verbatim|x|"),
    (style.convert_formatting, r"H\textsubscript{2}O", "H₂O"),
    (style.convert_formatting, r"\emph{a \emph{b}}", r"*a \emph{b}*"),
    (style.convert_formatting, r"\textbf{open" + "\n\nnext", "**open**\n\nnext"),
    (environments, r"\item[Note] Important", "\n- Note  Important"),
    (environments, r"\itemsep", "\n- sep"),
    (environments, r"\begin{equation}a\end{equation}\begin{equation*}b\end{equation*}", "\n$$\na (1)\n$$\n\n$$\nb\n$$\n"),
    (environments, r"\begin{thebibliography}{99}x\end{thebibliography}", "\n## References\nx\n"),
    (environments, r"\begin{proof}a\qed\end{proof}", "\n**Proof.** a\\qed\n"),
    (environments, r"\begin{proof}a\end{proof}", "\n**Proof.** a □\n"),
    (glyphs.convert_diacritics, r"Schr\"odinger", "Schrödinger"),
    (glyphs.convert_diacritics, r"\v{C}ade\v{z}", "Čadež"),
    (glyphs.convert_diacritics, r"\vskip \baselineskip \dots", r"\vskip \baselineskip \dots"),
    (glyphs.convert_diacritics, r"\not x \not\in \nothing", "x\u0338 \\in \\nothing"),
    (glyphs.convert_symbols, r"\infty \in \input", r"∞ ∈ \input"),
    (glyphs.convert_symbols, "!`Hola", "¡Hola"),
    (glyphs.convert_symbols, "!``hello''", "!“hello”"),
    (glyphs.convert_symbols, r"\mathbb{C}\mathbb{A}\mathcal{L}\mathfrak{Z}\mathscr{o}", "ℂ𝔸ℒℨℴ"),
    (glyphs.convert_symbols, r"\nleq \ngeq \nsubseteq \notin \gtrless \succcurlyeq \rceil \rhd", "≰ ≱ ⊈ ∉ ≷ ≽ ⌉ ⊳"),
    (glyphs.convert_symbols, r"\varepsilon \upLambda \Lambda \lambda", r"ε \upLambda Λ λ"),
    (tidy.strip_layout, r"\left\{ x \right\}", "{ x }"),
    (tidy.strip_layout, r"\left. x \right)", " x )"),
    (tidy.cleanup, r"\protect\foo{bar}", "bar"),
    (tidy.cleanup, r"$\frac{1}{2}$", r"$\frac{1}{2}$"),
    (tidy.cleanup, "a\nb", "a b"),
    (tidy.cleanup, "a\n\nb", "a\n\nb"),
    (tidy.cleanup, "- a\n- b", "- a\n- b"),
    (tidy.cleanup, r"\foo*{x} \bar;", "x ;"),
    (tidy.cleanup, "", ""),
]


@pytest.mark.parametrize(("fn", "source", "wanted"), EXACT, ids=range(len(EXACT)))
def test_exact(fn, source, wanted):
    assert fn(source) == wanted


def test_sections_and_labels():
    labels = {}
    out = layout.convert_structure(r"\section{A}\subsection{B}\label{s:b}\subsection{C}\section{D}", labels)
    assert [line for line in out.split("\n") if line] == ["## 1. A", "### 1.1. B", "\\label{s:b}", "### 1.2. C", "## 2. D"]
    assert labels == {"s:b": "1.1"}


def test_authors():
    shared = structure(r"\author{Alice}\author{Bob}\affiliation{MIT}\author{Carol}\affiliation{Stanford}")
    assert "Alice¹" in shared and "Bob¹" in shared and "Carol²" in shared and "¹ MIT\n² Stanford" in shared
    assert "Smith¹,²" in structure(r"\author{Smith\inst{\ref{a},\ref{b}}}\institute{A\label{a}\and B\label{b}}")
    assert "Jo¹,²" in structure(r"\address[x]{A}\address[y]{B}\author[x,y]{Jo}")
    assert structure(r"\institute{Université\\Köln \and B}").strip() == "¹ Université Köln\n² B"


def test_macros():
    assert expand.collect_macros(r"\newcommand{\foo}[1]{bar #1}") == {}
    assert expand.collect_macros(r"\newcommand{\em}{x}\def\em{y}\newcommand{\ok}{z}") == {"ok": "z"}
    chain = {"aaa": r"\bbb", "bbb": r"\ccc", "ccc": "done"}
    assert expand.expand_macros(r"\aaa", chain) == r"\aaa" or expand.expand_macros(r"\aaa" + " " * 40, chain).strip() == "done"
    assert expand.expand_macros(r"\foobar", {"foo": "x"}) == r"\foobar"
    grown = expand.expand_macros(r"\x" * 100, {"x": r"\y\y\y", "y": r"\x\x\x"})
    assert len(grown) <= 10 * 200
    greet = expand.collect_parametric(r"\newcommand{\greet}[2][Hello]{#1, #2!}")
    assert expand.expand_parametric(r"\greet{World}" + " " * 40, greet).strip() == "Hello, World!"
    assert expand.expand_parametric(r"\greet[Hi]{World}" + " " * 40, greet).strip() == "Hi, World!"
    assert expand.fill("#1 has a ## sign #7", ["test"]) == "test has a # sign "
    assert expand.collect_parametric(r"\newcommand{\x}[0]{y}") == []
    assert [m.name for m in expand.collect_parametric(r"\def\one#1{a}\def\two#1#2{b}\renewcommand{\one}[1]{c}")] == ["one", "two"]


def test_preamble_and_body():
    kept, body = front.split_document("\\title{T}\n%\\email{no}\n\\email{yes}\\thanks{t}\\begin{document}a\n% \\end{document}\nb\\end{document}c")
    assert body == "a\n% \\end{document}\nb"
    assert kept == ["# T", "yes", "t"]
    assert front.split_document("plain") == ([], "plain")


def test_includes():
    files = [TexFile("intro.tex", "I"), TexFile("main.tex", r"\documentclass{a}\begin{document}\input{intro} x \input{intro}"), TexFile("alone.tex", "S")]
    roots = includes.ordered_roots(files)
    assert [r.name for r in roots] == ["main.tex", "alone.tex"]
    assert roots[0].content.endswith(r"\input{intro} x I")
    loop = [TexFile("a.tex", r"\documentclass{a}\input{b}"), TexFile("b.tex", r"\input{a}\input{b}")]
    assert len(includes.ordered_roots(loop)) == 1
    for name, content in [("iclr_conference.tex", ""), ("sample_x.tex", ""), ("s.tex", r"\ProvidesPackage{x}"), ("f.tex", "Formatting Instructions: do not modify")]:
        assert includes.is_template(TexFile(name, content))
    assert not includes.is_template(TexFile("f.tex", "do not modify"))


def test_whole_paper():
    paper = [
        TexFile("main.tex", r"\documentclass{a}\title{T}\newcommand{\who}{World}\begin{document}\section{S}\label{sec:s}Hello \who{}, see \ref{sec:s}. \input{p}\end{document}"),
        TexFile("p.tex", r"\textbf{Part} \cite{k} \begin{thebibliography}{9}\bibitem{k} K\end{thebibliography}"),
    ]
    text = extract_text(paper)
    assert text.startswith("# T\n\n## 1. S\nHello World, see 1. **Part** [1]") and text.endswith("[1] K")
    assert extract([]).text is None and extract([TexFile("x.tex", " \n ")]).text is None
    with pytest.raises(TimeoutError):
        extract([TexFile("x.tex", r"\section{x}" * 2000)], timeout=0.0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\{}[]$%ab \n#&~^_-", max_size=80))
def test_any_source_is_taken(source):
    extract_text([TexFile("x.tex", source)])
    inside = scan.Regions(source)
    assert all(a < b for a, b in zip(inside.starts, inside.ends, strict=True)) and inside.starts == sorted(inside.starts)


def test_native_columns_agree(spark):
    texts = [r"a% c" + "\nb", r"\bea x\eea \beta", r"\unknown{x} \sum \foo; \bar*y", "a\nb\n\n# h\nc\n- d\n$$\ne\n**f**", r"\Large x \Larger", "", None, r"10\% \\% c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    pairs = [(columns.remove_comments, expand.remove_comments), (columns.normalize_shorthands, expand.normalize_shorthands), (columns.drop_orphans, tidy.drop_orphans), (columns.reflow, tidy.reflow),
             (columns.drop_sizes, lambda s: scan.drop_words(s, style.SIZES))]
    for native, plain in pairs:
        got = [r[0] for r in df.select(native(df.t)).collect()]
        assert got == [None if t is None else plain(t) for t in texts], native.__name__
