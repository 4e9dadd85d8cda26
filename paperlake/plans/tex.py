"""Queries of the TeX operators. Each runs over a whole table; its SQL states the text that the markup stands for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.functions import blocks, cite, expand, front, glyphs, layout, style, tidy
from paperlake.functions.extract import extract_text
from paperlake.functions.includes import TexFile
from paperlake.operators.text import apply
from paperlake.plans.catalogue import cells, expected


def structure(s: str) -> str:
    return layout.convert_structure(s, {})


def references(s: str) -> str:
    return cite.convert_references(s, {})


def environments(s: str) -> str:
    return blocks.convert_environments(s, expand.collect_theorems(s))


def macros(s: str) -> str:
    return expand.expand_parametric(expand.expand_macros(s, expand.collect_macros(s)), expand.collect_parametric(s))


def structure_references(s: str) -> str:
    labels: dict[str, str] = {}
    return cite.convert_references(layout.convert_structure(s, labels), labels)


def body(s: str) -> str:
    return front.split_document(s)[1]


def preamble(s: str) -> str:
    return "|".join(front.split_document(s)[0])


def whole(s: str) -> str | None:
    return extract_text([TexFile("main.tex", s)])


NATION, REGION, PART, CUSTOMER, SUPPLIER, ORDERS = ("nation", "n_nationkey"), ("region", "r_regionkey"), ("part", "p_partkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")
NL = "chr(10)"

# name, table, function, Spark expression, SQL of the result
CATALOGUE = [
    ("tex_comments", PART, expand.remove_comments, r"concat(p_name, r' % note 50\% ', p_type, chr(10), r'  50\% of ', p_size)", r"p_name || '   50\% of ' || p_size"),
    ("tex_comments_native", PART, "remove_comments", r"concat(p_name, r' % note 50\% ', p_type, chr(10), r'  50\% of ', p_size)", r"p_name || '   50\% of ' || p_size"),
    ("tex_shorthands", REGION, expand.normalize_shorthands, r"concat(r'\bea ', r_name, r'\eea \beta \be x\ee')", r"'\begin{eqnarray} ' || r_name || '\end{eqnarray} \beta \begin{equation} x\end{equation}'"),
    ("tex_shorthands_native", REGION, "normalize_shorthands", r"concat(r'\bea ', r_name, r'\eea \beta \be x\ee')", r"'\begin{eqnarray} ' || r_name || '\end{eqnarray} \beta \begin{equation} x\end{equation}'"),
    ("tex_macro_simple", NATION, macros, r"concat(r'\newcommand{\who}{', n_name, r'}\who{} and \whom')", r"'\newcommand{' || n_name || '}{' || n_name || '}' || n_name || '{} and \whom'"),
    ("tex_macro_chain", NATION, macros, r"concat(r'\def\aaa{\bbb}\def\bbb{\ccc}\def\ccc{', n_name, r'}: \aaa')", r"'\def' || n_name || '{' || n_name || '}\def' || n_name || '{' || n_name || '}\def' || n_name || '{' || n_name || '}: ' || n_name"),
    ("tex_macro_arguments", SUPPLIER, lambda s: macros(s).split("::")[1], r"concat(r'\newcommand{\pair}[2]{#2 before #1 ##}::\pair{', s_suppkey, '}{', s_nationkey, '}')", r"s_nationkey || ' before ' || s_suppkey || ' #'"),
    ("tex_macro_default", SUPPLIER, lambda s: macros(s).split("::")[1], r"concat(r'\newcommand{\greet}[2][Hello]{#1, #2!}::\greet{', s_suppkey, r'} \greet[Hi]{', s_nationkey, '}')", r"'Hello, ' || s_suppkey || '! Hi, ' || s_nationkey || '!'"),
    ("tex_macro_growth_cap", REGION, lambda s: str(len(expand.expand_macros(s, {"grow": r"\grow\grow\grow"})) <= 10 * len(s)), r"concat(repeat(r'\grow', 40), r_name)", "'True'"),
    ("tex_theorem_names", NATION, lambda s: ",".join(f"{k}={v}" for k, v in sorted(expand.collect_theorems(s).items())), r"concat(r'\newtheorem{thm}[section]{', n_name, r'}\newtheorem*{dfn}{Definition}')", "'dfn=Definition,thm=' || n_name"),
    ("tex_sections", NATION, structure, r"concat(r'\section{', n_name, r'}\subsection[s]{B}\subsection*{C}\subsection{D}\section{E}\subsubsection{F}')", f"{NL} || '## 1. ' || n_name || {NL} || {NL} || '### 1.1. B' || {NL} || {NL} || '### C' || {NL} || {NL} || '### 1.2. D' || {NL} || {NL} || '## 2. E' || {NL} || {NL} || '#### 2.0.1. F' || {NL}"),
    ("tex_section_references", NATION, structure_references, r"concat(r'\section{A}\subsection{', n_name, r'}\label{sec:x}see \ref{sec:x} and \eqref{eq:none}')", f"{NL} || '## 1. A' || {NL} || {NL} || '### 1.1. ' || n_name || {NL} || 'see 1.1 and eq:none'"),
    ("tex_titles", CUSTOMER, structure, r"concat(r'\title{', c_mktsegment, r'}\author{', c_custkey, r'}\date{today}\maketitle\paragraph{P}x')", f"{NL} || '# ' || c_mktsegment || {NL} || {NL} || c_custkey || {NL} || {NL} || 'today' || {NL} || {NL} || '**P** x'"),
    ("tex_authors_shared", CUSTOMER, structure, r"concat(r'\author{A', c_custkey, r'}\author{B}\affiliation{X}\author{C}\affiliation{Y', c_nationkey, '}')", f"{NL} || 'A' || c_custkey || '¹' || {NL} || 'B¹' || {NL} || '¹ X' || {NL} || '² Y' || c_nationkey || {NL} || {NL} || 'C²'"),
    ("tex_authors_labelled", CUSTOMER, structure, r"concat(r'\address[a]{X', c_nationkey, r'}\address[b]{Y}\author[a,b]{N', c_custkey, '}')", f"{NL} || '¹ X' || c_nationkey || {NL} || {NL} || '² Y' || {NL} || {NL} || 'N' || c_custkey || '¹,²'"),
    ("tex_institutes", CUSTOMER, structure, r"concat(r'N', c_custkey, r'\inst{\ref{k},1}\institute{X\and Y', c_nationkey, r'\label{k}}')", f"'N' || c_custkey || '²,¹' || {NL} || '¹ X' || {NL} || '² Y' || c_nationkey || {NL}"),
    ("tex_abstract_thanks", NATION, structure, r"concat(r'\begin{abstract}', n_name, r'\end{abstract}\begin{acknowledgments}ok\end{acknowledgments}\proclaim{Fact}f\endproclaim\subhead h\endsubhead')", f"{NL} || '**Abstract.** ' || n_name || {NL} || {NL} || '## Acknowledgements' || {NL} || 'ok' || {NL} || {NL} || '**Fact.** f' || {NL} || {NL} || '### h' || {NL}"),
    ("tex_citations", ORDERS, references, r"concat(r'\cite{k', o_orderkey, r',zz}\citep[see][p]{b}\bibitem{k', o_orderkey, r'}A\bibitem{b}B')", f"'[1,zz][2]' || {NL} || '[1] A' || {NL} || '[2] B'"),
    ("tex_citations_by_label", ORDERS, references, r"concat(r'\citet{a}\bibitem[', o_orderpriority, r']{a}A\bibitem{b}B')", f"'[' || o_orderpriority || ']' || {NL} || '[' || o_orderpriority || '] A' || {NL} || '[2] B'"),
    ("tex_labels_by_prefix", ORDERS, references, r"concat(r'\label{fig:a}\label{eq:a}\label{fig:b}\label{x}\ref{fig:b}\eqref{eq:a}\autoref{x}\pageref{', o_orderkey, '}')", "'211' || o_orderkey"),
    ("tex_links", PART, references, r"concat(r'\url{http://', p_partkey, r'} \href{x}{', p_type, r'} \hyperref[a]{', p_size, '}')", "'http://' || p_partkey || ' ' || p_type || ' ' || p_size"),
    ("tex_journals", REGION, references, r"concat(r'\apj \mnras \apjx ', r_name)", r"'ApJ MNRAS \apjx ' || r_name"),
    ("tex_emphasis", PART, style.convert_formatting, r"concat(r'\emph{', p_name, r'} \textbf{\textit{', p_type, r'}} \textsc{', p_size, r'} \textbf*{x}')", r"'*' || p_name || '* ***' || p_type || '*** ' || p_size || ' \textbf*{x}'"),
    ("tex_notes", PART, style.convert_formatting, r"concat(p_name, r'\footnote{', p_size, r'}\fnref{x}\footnotemark ', p_type)", "p_name || ' ' || p_size || '  ' || p_type"),
    ("tex_later_arguments", PART, style.convert_formatting, r"concat(r'\textcolor{red}{', p_name, r'} \multicolumn{2}{c}{', p_size, r'} \texorpdfstring{a}{', p_partkey, '}')", "p_name || ' ' || p_size || ' ' || p_partkey"),
    ("tex_text_math", PART, style.convert_formatting, r"concat(r'\frac{', p_size, r'}{2} $\frac{', p_size, r'}{2}$ \sqrt[3]{', p_size, r'} \binom{', p_size, '}{2}')", r"p_size || '/2 $\frac{' || p_size || '}{2}$ √[3](' || p_size || ') C(' || p_size || ',2)'"),
    ("tex_scripts", PART, style.convert_formatting, r"concat(r'H\textsubscript{', p_size, r'}O x\textsuperscript{', p_partkey, r'} y\textsuperscript{th}')", "'H' || translate(CAST(p_size AS VARCHAR), '0123456789', '₀₁₂₃₄₅₆₇₈₉') || 'O x' || translate(CAST(p_partkey AS VARCHAR), '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') || ' yth'"),
    ("tex_quantum", PART, style.convert_formatting, r"concat(r'\braket{', p_size, r'}{b} \ketbra{a}{b} \ket{', p_partkey, r'} \bra{x}')", "'⟨' || p_size || '|b⟩ |a⟩⟨b| |' || chr(8203) || p_partkey || '⟩ ⟨x|' || chr(8203)"),
    ("tex_verbatim_inline", PART, style.convert_formatting, r"concat(r'\verb|', p_name, r'| \lstinline{', p_type, r'} \mintinline{py}{', p_size, r'} \verb·x·')", "p_name || ' ' || p_type || ' ' || p_size || ' x'"),
    ("tex_math_accents", NATION, style.convert_formatting, r"concat(r'\hat{e} \ddot{o} \vec{', n_nationkey, r'ab} \tilde{n}')", "'ê ö ' || n_nationkey || 'ab ñ'"),
    ("tex_sizes_capitals", NATION, style.convert_formatting, r"concat(r'\Large ', n_name, r'\tiny x\emailBob \smallskip')", r"' ' || n_name || ' x Bob \smallskip'"),
    ("tex_lists", NATION, environments, r"concat(r'\begin{itemize}\item ', n_name, r'\item[N] two\end{itemize}\begin{quote}q\end{quote}')", f"{NL} || {NL} || '- ' || n_name || {NL} || '- N  two' || {NL} || {NL} || 'q' || {NL}"),
    ("tex_floats", ORDERS, environments, r"concat(r'\begin{figure}[h]\includegraphics{x}\centering\caption{F', o_orderkey, r'}\end{figure}\begin{table}\caption[s]{T}\end{table}\begin{figure*}\caption{G}\end{figure*}')", f"{NL} || 'Figure 1: F' || o_orderkey || {NL} || {NL} || 'Table 1: T' || {NL} || {NL} || 'Figure 2: G' || {NL}"),
    ("tex_theorems", NATION, environments, r"concat(r'\newtheorem{thm}{Satz}\begin{theorem}[', n_name, r']x\end{theorem}\begin{thm}y\end{thm}\begin{lemma*}z\end{lemma*}')", rf"'\newtheorem{{thm}}{{Satz}}' || {NL} || '**Theorem (' || n_name || ').** x' || {NL} || {NL} || '**Satz.** y' || {NL} || {NL} || '**Lemma.** z' || {NL}"),
    ("tex_proofs", NATION, environments, r"concat(r'\begin{proof}', n_name, r'\end{proof}\begin{proof}b\qed\end{proof}')", rf"{NL} || '**Proof.** ' || n_name || ' □' || {NL} || {NL} || '**Proof.** b\qed' || {NL}"),
    ("tex_equations", PART, environments, r"concat(r'\begin{align}', p_size, r'&=b\\ c\end{align}\begin{equation}z\end{equation}\begin{gather*}w\end{gather*}')", f"{NL} || '$$' || {NL} || p_size || ' =b' || {NL} || ' c (2)' || {NL} || '$$' || {NL} || {NL} || '$$' || {NL} || 'z (1)' || {NL} || '$$' || {NL} || {NL} || '$$' || {NL} || 'w' || {NL} || '$$' || {NL}"),
    ("tex_display_brackets", PART, environments, r"concat(p_name, r'\[', p_size, r'\]')", f"p_name || {NL} || '$$' || {NL} || p_size || {NL} || '$$' || {NL}"),
    ("tex_tables", SUPPLIER, environments, r"concat(r'\begin{tabular}{l|r}', s_suppkey, '&', s_nationkey, r'\\\end{tabular}')", rf"{NL} || s_suppkey || ' ' || s_nationkey || '\\' || {NL}"),
    ("tex_bibliography", SUPPLIER, environments, r"concat(r'\begin{thebibliography}{99}', s_suppkey, r'\end{thebibliography}')", f"{NL} || '## References' || {NL} || s_suppkey || {NL}"),
    ("tex_algorithms_keywords", SUPPLIER, environments, r"concat(r'\begin{algorithm}\State ', s_suppkey, r'\EndFor\end{algorithm}\begin{keywords}k\end{keywords}')", f"{NL} || ' ' || s_suppkey || {NL} || {NL} || '**Keywords:** k' || {NL}"),
    ("tex_drawings_frames", SUPPLIER, environments, r"concat(r'\begin{tikzpicture}\draw x;\end{tikzpicture}\begin{minipage}{5cm}', s_suppkey, r'\end{minipage}\begin{verbatim}v\end{verbatim}\begin{odd}{a}o\end{odd}')", f"{NL} || s_suppkey || {NL} || {NL} || 'v' || {NL} || {NL} || 'o' || {NL}"),
    ("tex_accents", NATION, glyphs.convert_diacritics, r"""concat(r'Schr\', chr(34), r'odinger \v{C} \c{c} \ss \o ', n_name, r' \', chr(39), r'{e} \~n \v z \vskip \not= \not\in')""", r"'Schrödinger Č ç ß ø ' || n_name || ' é ñ \v z \vskip =' || chr(824) || ' \in'"),
    ("tex_ligatures", PART, glyphs.convert_symbols, r"concat('``', p_name, chr(39), chr(39), r' a--b---c~\& \% !`x \,', p_size)", "'“' || p_name || '” a–b—c & % ¡x ' || chr(8201) || p_size"),
    ("tex_greek", REGION, glyphs.convert_symbols, r"concat(r'\alpha \Omega \varphi \infty \in \input \leq \rightarrow \textdegree ', r_name)", r"'α Ω φ ∞ ∈ \input ≤ → ° ' || r_name"),
    ("tex_alphabets", REGION, glyphs.convert_symbols, r"concat(r'\mathbb{C} \mathbb{A} \mathcal{L} \mathscr{e} \mathfrak{g} \mathsf{X} \mathtt{7} ', r_name)", "'ℂ 𝔸 ℒ ℯ 𝔤 𝖷 𝟽 ' || r_name"),
    ("tex_pre_diacritic", NATION, tidy.strip_layout, r"concat(r'\left\{', n_name, r'\right.\vskip 1cm\parskip=2pt\bf x\pagestyle{p}\setlength{a}{b}\bfx')", r"'{' || n_name || '   x\bfx'"),
    ("tex_spacing", NATION, tidy.cleanup, r"concat(n_name, r'\quad b\hspace*{2cm}c\\[2pt]d\phantom{x}\rule{1pt}{2pt}')", "n_name || ' b c d'"),
    ("tex_generic_unwrap", PART, tidy.cleanup, r"concat(r'\foo{', p_name, r'} {g} $\frac{1}{2}$ \protect\x{\y{', p_size, r'}}')", r"p_name || ' g $\frac{1}{2}$ ' || p_size"),
    ("tex_orphans", PART, tidy.drop_orphans, r"concat(p_name, r'\unknown;\sum;\foo{x}')", r"p_name || ' ;\sum;\foo{x}'"),
    ("tex_orphans_native", PART, "drop_orphans", r"concat(p_name, r'\unknown;\sum;\foo{x}')", r"p_name || ' ;\sum;\foo{x}'"),
    ("tex_reflow", NATION, tidy.cleanup, f"concat(n_name, {NL}, 'b', {NL}, {NL}, '# h', {NL}, 'c', {NL}, '- d', {NL}, '- e', {NL}, '**f** g', {NL}, 'h  i')", f"n_name || ' b' || {NL} || {NL} || '# h' || {NL} || 'c' || {NL} || '- d' || {NL} || '- e' || {NL} || '**f** g h i'"),
    ("tex_reflow_native", NATION, "reflow", f"concat(n_name, {NL}, 'b', {NL}, {NL}, '# h', {NL}, 'c', {NL}, '- d', {NL}, '- e', {NL}, '**f** g', {NL}, 'h')", f"n_name || ' b' || {NL} || {NL} || '# h' || {NL} || 'c' || {NL} || '- d' || {NL} || '- e' || {NL} || '**f** g h'"),
    ("tex_whitespace_native", NATION, "collapse_whitespace", f"concat('  ', n_name, chr(8201), chr(9), 'b  ', {NL}, {NL}, {NL}, {NL}, ' c')", f"n_name || ' b' || {NL} || {NL} || 'c'"),
    ("tex_body", CUSTOMER, body, r"concat(r'\title{x}\begin{document}', c_custkey, chr(10), r'% \end{document}', chr(10), r'y\end{document}z')", rf"c_custkey || {NL} || '% \end{{document}}' || {NL} || 'y'"),
    ("tex_preamble", CUSTOMER, preamble, r"concat(r'\title{T', c_custkey, r'}\author[a]{N}\address[a]{X', c_nationkey, r'}%\email{no}', chr(10), r'\email{me}\thanks{t}\begin{document}b\end{document}')", "'# T' || c_custkey || '|N¹|¹ X' || c_nationkey || '|me|t'"),
    ("tex_extras", CUSTOMER, lambda s: "|".join(front.notes(s)), r"concat(r'\title{T\thanks{a}}\thanks{t', c_custkey, r'}\footnote{n}\funding{', c_nationkey, '}')", "'a|t' || c_custkey || '|n|' || c_nationkey"),
    ("tex_whole_paper", NATION, whole, r"concat(r'\documentclass{a}\title{T}\newcommand{\who}{', n_name, r'}\begin{document}\section{S}\label{sec:s}\who{} is $x$, see \ref{sec:s}.\end{document}')", f"'# T' || {NL} || {NL} || '## 1. S' || {NL} || n_name || ' is $x$, see 1.'"),
    ("tex_operator_names", PART, style.convert_formatting, r"concat(r'\operatorname*{', p_size, r'} \operatorname{x}')", "p_size || ' x'"),
    ("tex_leaked_definitions", PART, tidy.cleanup, r"concat(p_name, r' \newcommand{\x}[1]{a{b}c}\def\y{', p_size, r'}z')", "p_name || ' z'"),
    ("tex_stray_backslashes", PART, tidy.cleanup, r"concat(p_name, r' \; a\ b \1 ', p_size)", "p_name || ' ; a b 1 ' || p_size"),
    ("tex_escapes", PART, glyphs.convert_symbols, r"concat(r'\&\#\$\%\_ \| ?`', p_name, r' !``x', chr(39), chr(39), r' a\;b\:c\!d')", f"'&#$%_ ‖ ¿' || p_name || ' !“x” a' || chr(8287) || 'b' || chr(8201) || 'cd'"),
]

#: Every name of the symbol tables, as used in a text.
SYMBOLS = {
    "text_commands": (glyphs.TEXT_COMMANDS, glyphs.convert_symbols), "math_symbols": (glyphs.MATH_SYMBOLS, glyphs.convert_symbols), "greek": (glyphs.GREEK, glyphs.convert_symbols),
    "letters": (glyphs.LETTERS, glyphs.convert_diacritics), "journals": (cite.JOURNALS, references),
}


def _all_names(table: dict[str, str], fn) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = spark.createDataFrame([(k,) for k in table], "name string")
        return names.select("name", apply(fn, F.concat(F.lit("x\\"), "name", F.lit(" \\"), "name", F.lit("{}"))).alias("txt"))

    return query


def _shown(table: dict[str, str]) -> str:
    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in table.items())
    return f"SELECT name, 'x' || shown || ' ' || shown || '{{}}' AS txt FROM (VALUES {quoted}) t(name, shown)"


QUERIES = {name: cells(t, k, source, fn) for name, (t, k), fn, source, _ in CATALOGUE}
ORACLES = {name: expected(t, k, sql) for name, (t, k), _, _, sql in CATALOGUE}
QUERIES |= {f"tex_all_{name}": _all_names(table, fn) for name, (table, fn) in SYMBOLS.items()}
ORACLES |= {f"tex_all_{name}": _shown(table) for name, (table, _) in SYMBOLS.items()}
