"""The text operators: vectors, brute force, round trips, held-out accuracy and edge cases."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperlake.llm import canonical, encoding, language, leakage, markup, mixing, quality, quantiles, sampling, sentences

RESULTS = "result_id bigint, text string, lang_label string, form string, found string, score double, status string, total_time_us bigint, peak_memory_bytes bigint, outer_tar string, written_at timestamp"


@pytest.fixture(scope="module")
def results(spark):
    """A frame with null, empty, blank, long and repeated texts and columns whose names clash with internal ones."""
    texts = [
        (1, "The smooth surface is bounded by the outer field. It holds.", "en"), (2, "The ѕmooth ѕurfасe iѕ bounded by the оuter field. It holds.", "eng"),
        (3, "The smooth surface is bounded by the outer field. It holds.", None), (4, None, "en"), (5, "", "en"), (6, "  \n", None), (7, "1.5, 2.5, 3.5\n" * 40, "en"),
        (8, "<p>The <b>bold</b> claim is &amp; stays.</p>", "en"), (9, "DaÃ\xad resulta que a soluÃ§Ã£o Ã© exata e nÃ£o muda mais. A soluÃ§Ã£o Ã© local.", "pt"),
        (10, "Die Lösung ist nicht klar und wird hier gezeigt. " * 2000, "German"), (11, "10² ≤ r3. This is the sign.", "en"), (12, "102 ≤ r3. This is the sign.", "en"),
    ]
    return spark.createDataFrame([(i, t, lang, "x", "y", 1.0, "ok", i * 10, None, "a.tar", None) for i, t, lang in texts], RESULTS).cache()


def test_labels():
    cases = {"EN": "en", "en_US": "en", "Deutsch": "de", "pt-BR": "pt", " fra ": "fr", "rus": "ru", "und": None, "": None, None: None, "n/a": None}
    assert {k: sampling.normalized_label(k) for k in cases} == cases


# 2 -------------------------------------------------------------------------------------------------------------------

CLEAN = {
    "en": "The author’s name is Brosaéé. At 20 °C the ratio √2 is reached, i.e. ½ of the range — “not needed!” they said. The naïve café of the résumé.",
    "fr": "D’après Verol, la mesure est une quantité qui s’annule après un bref régime transitoire. Où êtes-vous ? Ça dépend de l’âge du maître.",
    "de": "Für die Proben wurde geprüft, wie die größte Störung die Lösung überschätzt. „Ist das nötig?“, fragte er. Die Oberfläche bleibt dabei unverändert.",
    "ru": "Отсюда следует, что средняя функция объясняет степенной закон, а локальная фаза не меняется. Верно ли это на всём интервале?",
    "zh": "本文研究平均的测度如何在整个区间上影响平均的函数。由此可知，广义的解证实了已知的上界，并且较弱的边界保持不变。",
    "ja": "本論文では、平均の関数がどのように正確な境界を説明するのかを考える。ここでは、弱い評価が正確な解を変えないことを示す。",
}


@pytest.fixture(scope="module")
def decoder():
    return encoding.Decoder({k: (v * 3).encode() for k, v in CLEAN.items()})


@pytest.mark.parametrize(
    ("lang", "meant", "shown"),
    [("fr", "utf-8", "cp1252"), ("fr", "utf-8", "latin-1"), ("de", "utf-8", "cp437"), ("de", "utf-8", "mac_roman"), ("en", "utf-8", "cp850"), ("fr", "cp1252", "cp850"), ("de", "cp1252", "mac_roman"),
     ("ru", "cp1251", "koi8_r"), ("ru", "koi8_r", "cp1251"), ("ru", "utf-8", "cp1251"), ("zh", "utf-8", "cp1252"), ("zh", "gb18030", "latin-1"), ("ja", "euc_jp", "latin-1"), ("ja", "utf-8", "cp437")],
)
def test_decodings_are_undone(decoder, lang, meant, shown):
    wrong = b"".join(c.encode(meant, "ignore") for c in CLEAN[lang])
    meant_text = wrong.decode(meant)
    if shown == "cp1252":
        wrong_text = "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in wrong)
    else:
        wrong_text = wrong.decode(shown, "replace")
    verdict = decoder.judge(wrong_text)
    assert verdict.garbled
    if "�" not in wrong_text:
        assert verdict.restored == meant_text


@pytest.mark.parametrize("text", [*CLEAN.values(), "The index written Ã differs from the one written Â.", "plain", "", None, "INTRODUÇÃO", "10² ≤ r³."])
def test_sound_texts_stay(decoder, text):
    verdict = decoder.judge(text)
    assert not verdict.garbled and verdict.restored == (text or "")


def test_twice_garbled_and_lost(decoder):
    twice = "déduit que la mesure".encode().decode("cp1252").encode().decode("cp1252")
    assert decoder.judge("On en " + twice).restored == "On en déduit que la mesure"
    assert decoder.judge("la mesure r�duite").garbled
    assert decoder.judge("The author’s name is Riaro├⌐.").restored.endswith("Riaroé.")


def test_garbled_rows(spark, results, rows):
    entries = spark.createDataFrame([(1, [("a.tex", "dÃ©duit"), ("b.tex", None), ("c.tex", "ok é")]), (2, None), (3, [])], "entry_seq bigint, tex_files array<struct<name string, content string>>")
    found = encoding.garbled_texts(encoding.texts_of(results, entries), {k: v.encode() for k, v in CLEAN.items()})
    assert rows(found.select("tab", "row_id", "file_name")) == [("entries", 1, "a.tex"), ("results", 9, "")]
    assert encoding.garbled_texts(encoding.texts_of(results.limit(0), entries.limit(0)), {}).count() == 0


# 3 -------------------------------------------------------------------------------------------------------------------

SAME = [("e\u0301tude", "étude"), ("ｆｕｌｌ　width", "full width"), ("con\u00adtrol\u200b", "control"), ("ﬁne ﬂow", "fine flow"), ("соntrоl", "control"), ("non\u2011stop", "non-stop"), ("a\u202fb\u2009c", "a b c"), ("Кoгдa мaтpицa", "Когда матрица"), ("о́ра y", "óра y")]
DIFFERENT = [("10²", "102"), ("resume", "résumé"), ("v1", "v2"), ("a–b", "a-b"), ("x…", "x..."), ("Ã", "A"), ("½", "1/2")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_look_alikes_are_one(a, b):
    form = canonical.Canonicalizer({("latin", "control"): 5, ("cyrillic", "Когда"): 3})
    context = " in the context of some longer text" if not canonical.STRICT_CYRILLIC.search(b) else ""
    assert form(a + context) == form(b + context)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_others_stay_apart(a, b):
    form = canonical.Canonicalizer({})
    assert form(a) != form(b)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aeopcxABсоаеТ é\u0301ﬁｆ\u200b-\u2010 .1", max_size=30))
def test_form_is_stable(text):
    form = canonical.Canonicalizer({("latin", "cape"): 2, ("cyrillic", "CO"): 2})
    assert form(form(text)) == form(text)


def test_automaton_reaches_known_words():
    trie = canonical.WordTrie({"scope": 3, "score": 1, "core": 2})
    assert list(trie.reach("ѕсо\u200bре")) == ["scope"] and trie.reach("scopes") == {} == trie.reach("")
    assert {w: c for w, (c, _) in trie.reach("scopes", 1).items()} == {"scope": 1}
    assert {w: c for w, (c, _) in trie.reach("ѕсоrе", 1).items()} == {"score": 0, "scope": 1, "core": 1}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc", max_size=5), st.integers(0, 2))
def test_automaton_costs_are_edit_distances(token, budget):
    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            before, row[0] = row[0], i
            for j, b in enumerate(y, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
        return row[-1]

    known = ["abc", "a", "cab", "bbbb", "ac"]
    got = {w: c for w, (c, _) in canonical.WordTrie(dict.fromkeys(known, 1)).reach(token, budget).items()}
    assert got == {w: d for w in known if (d := distance(token, w)) <= budget}


def test_vocabulary_selects_the_spelling():
    """Letters that look alike on both sides: the known word decides, the table only without one."""
    texts = ["Уровень CO растёт в городе", "Уровень СО растёт в городе", "Уровень CО растёт в городе"]
    known = canonical.Canonicalizer({("cyrillic", "CO"): 4, ("cyrillic", "СО"): 1})
    assert {known(t) for t in texts} == {texts[0]} and {canonical.Canonicalizer({})(t) for t in texts} == {texts[1]}
    assert known("The CО level") == "The CO level"


def test_vocabulary_counts_every_text(spark):
    """12 000 texts, and one far longer than a sample text: no row and no length is left out of the counts."""
    texts = spark.range(12_000).select(F.col("id").alias("result_id"), F.when(F.col("id") % 6 == 0, "Уровень СО растёт").otherwise("Уровень CO растёт").alias("text"))
    assert canonical.vocabulary(texts) == {("cyrillic", "CO"): 10_000}
    long = spark.createDataFrame([(1, "Уровень pH растёт. " * 2_000), (2, "Уровень рН растёт."), (3, None), (4, "")], "result_id bigint, text string")
    known = canonical.vocabulary(long)
    assert known == {("cyrillic", "pH"): 2_000} and canonical.vocabulary(long.limit(0)) == {}
    assert {r["canonical"] for r in canonical.canonical_texts(long.where("result_id = 2"), known).collect()} == {"Уровень pH растёт."}


def test_vocabulary_decides_as_all_words_do(spark, monkeypatch):
    """The few words that reach the driver give every text the form that the counts of all words give it."""
    rng = random.Random(3)
    words = ["CO", "СО", "CО", "pH", "рН", "x", "х", "The", "é", "е́", "матрица", "мaтpицa", "город", "ΑΒ", "AB", "λόγος", "λoγoς", "σÅ", "surface", "ѕurfасе", "10²", "µm", "ﬁne"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(400)] + ["", None, "plain", "once Ещё РОТ", "\u2126 όλο"]
    counts = {}
    for text in filter(None, texts):
        text = canonical.unicodedata.normalize("NFC", text.translate(canonical.TABLE))
        for w in canonical.WORD.findall(text):
            key = canonical.text_script(text), w
            counts[key] = counts.get(key, 0) + 1
    pure = {(c, w): n for (c, w), n in counts.items() if n > 1 and any(canonical.to_script(w, s) == w for s in ("latin", *canonical.LATIN_TO))}
    known = canonical.vocabulary(spark.createDataFrame(list(enumerate(texts)), "result_id bigint, text string").repartition(3))
    assert known.items() <= pure.items() and 0 < len(known) < len(pure) / 2
    few, every, table = (canonical.Canonicalizer(c) for c in (known, pure, {}))
    assert [few(t) for t in texts] == [every(t) for t in texts] != [table(t) for t in texts]

    def counted():
        parts = list(canonical._word_counts(iter([canonical.pd.DataFrame({"text": list(filter(None, texts))})])))
        return len(parts), canonical.pd.concat(parts).groupby(["context", "plain", "word"])["n"].sum().to_dict()

    (parts, at_once), _ = counted(), monkeypatch.setattr(canonical, "HELD_WORDS", 5)
    assert parts == 1 and counted()[0] > 10 and counted()[1] == at_once


def test_texts_of_other_scripts_are_all_counted():
    """No character but those of the filter becomes a letter that tells a script."""
    maybe = re.compile(canonical.MAYBE_OTHER)
    for c in map(chr, range(0x110000)):
        settled = canonical.unicodedata.normalize("NFC", c.translate(canonical.TABLE))
        assert maybe.match(c) or not (canonical.STRICT_CYRILLIC.search(settled) or canonical.STRICT_GREEK.search(settled))


def test_reading_pairs(results, rows):
    assert rows(canonical.reading_pairs(results, {})) == [(1, 2), (2, 3)]
    classes = {r["result_id"]: (r["class_id"], r["n_spellings"]) for r in canonical.reading_classes(results, {}).collect()}
    assert classes[2] == (1, 2) and classes[11] == (11, 1) and 4 not in classes
    assert canonical.reading_pairs(results.limit(0), {}).count() == 0
    assert results.count() == canonical.canonical_texts(results, {}).count()


# 4 -------------------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5) | st.integers(0, 10**12), min_size=1, max_size=300), min_size=1, max_size=6), st.integers(4, 40))
def test_rank_bounds_hold(parts, tuples):
    total = quantiles.Summary.exact(np.array([], dtype=np.int64))
    for p in parts:
        total = total.merge(quantiles.Summary.exact(np.array(p, dtype=np.int64)).prune(tuples)).prune(tuples)
    everything = np.sort(np.concatenate([np.array(p) for p in parts]))
    assert total.n == len(everything)
    for q in (0.01, 0.25, 0.5, 0.9, 1.0):
        value, off = total.value(q)
        rank = min(total.n, max(1, int(np.ceil(q * total.n))))
        low, high = np.searchsorted(everything, value, "left") + 1, np.searchsorted(everything, value, "right")
        assert low - off <= rank <= high + off and off <= total.error


def test_error_stays_in_bounds_over_many_merges():
    rng = np.random.default_rng(1)
    tuples = quantiles.tuples_for(0.01, 2)
    leaves = [quantiles.Summary.exact(rng.integers(0, 10**9, 5000)).prune(tuples) for _ in range(64)]
    groups = [quantiles.merged(leaves[i : i + 8]).prune(tuples) for i in range(0, 64, 8)]
    total = quantiles.merged(groups).prune(tuples)
    assert total.error <= 0.01 * total.n


def test_long_partitions_stay_bounded(monkeypatch):
    """Many buffers of one group: few pieces are held, and the tracked error bounds the true one."""
    monkeypatch.setattr(quantiles, "BUFFER", 100)
    rng = np.random.default_rng(5)
    values = rng.integers(0, 10_000, 30_000)
    folder = quantiles._Folder(quantiles.tuples_for(0.01, 1))
    monkeypatch.setattr(quantiles, "FINE", 1)
    for at in range(0, len(values), 50):
        folder.add(values[at : at + 50], 0, 0)
        assert len(folder.pieces) <= 10
    summary = folder.finish()
    ordered = np.sort(values)
    assert summary.n == len(values) and len(summary.v) <= folder.tuples + 1
    for q in (0.1, 0.5, 0.9):
        value, error = summary.value(q)
        rank = math.ceil(q * len(values))
        low, high = np.searchsorted(ordered, value, "left") + 1, np.searchsorted(ordered, value, "right")
        assert max(0, low - rank, rank - high) <= error


def test_percentiles(spark, rows):
    data = [("ok", i) for i in range(1, 101)] + [("ok", -1), ("ok", 2**63 - 1), ("ok", None), (None, 7), ("none", None)]
    df = spark.createDataFrame(data, "status string, t bigint").withColumn("key", F.lit(1)).withColumn("n", F.lit("clash"))
    got = {r["key"]: r for r in quantiles.percentiles(quantiles.summarize(df, {"status": F.col("status")}, ["t"]), [0.5, 0.9]).collect()}
    assert (got["ok"]["n"], got["ok"]["n_null"], got["ok"]["n_sentinel"], got["ok"]["p50"], got["ok"]["p90"], got["ok"]["rank_error"]) == (100, 1, 2, 50, 90, 0)
    assert got[None]["p50"] == 7 and got["none"]["p50"] is None and got["none"]["n"] == 0
    assert quantiles.summarize(df.limit(0), {"status": F.col("status")}, ["t"]).count() == 0


# 5 -------------------------------------------------------------------------------------------------------------------


def sentences_of(lang, n, seed):
    rng = random.Random(seed)
    words = {k: [w for w in v.replace("。", " ").split() if len(w) > 1] for k, v in CLEAN.items()}[lang]
    if lang in ("zh", "ja"):
        chars = CLEAN[lang]
        return ["".join(rng.choice(chars) for _ in range(20)) + "。" for _ in range(n)]
    return [" ".join(rng.choice(words) for _ in range(9)) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def network():
    return language.train([(k, s) for k in CLEAN for s in sentences_of(k, 150, 1)], per_language=300)


def test_held_out_accuracy(network):
    form = canonical.Canonicalizer({})
    texts = [(k, " ".join(sentences_of(k, 3, 99 + i))) for k in CLEAN for i in range(8)]
    judged = language.judge([t for _, t in texts], network, form)
    right = sum(network.languages[language.text_languages(s)[0]] == k for (k, _), s in zip(texts, judged, strict=True))
    assert right >= 0.95 * len(texts)


def test_segments(network):
    form = canonical.Canonicalizer({})
    text = " ".join(s.capitalize() for s in sentences_of("fr", 3, 5)) + "\n" + " ".join(s.capitalize() for s in sentences_of("ru", 3, 6))
    segments = language.judge([text, None, "", "12 34"], network, form)
    assert [network.languages[s[2]] for s in segments[0]] == ["fr", "ru"] and all(0 <= s[3] <= 1 for s in segments[0])
    assert sorted(network.languages[k] for k in language.text_languages(segments[0])) == ["fr", "ru"]
    assert segments[1:] == [[], [], []]


def test_relabelled(spark, network, rows):
    one = {k: " ".join(sentences_of(k, 3, 7)) for k in CLEAN}
    df = spark.createDataFrame([(1, one["fr"], "fr"), (2, one["fr"], "de"), (3, one["ru"], None), (4, one["de"], "Deutsch"), (5, "1.5, 2.5", None), (6, None, None), (7, " ", None)], "result_id bigint, text string, lang_label string")
    assert rows(language.relabelled(df, network)) == [(2, "fr"), (3, "ru")]
    assert language.language_segments(df.limit(0), network).count() == 0


# 6 -------------------------------------------------------------------------------------------------------------------


def test_not_prose(results, rows):
    assert rows(quality.not_prose(results)) == [(7,)]
    assert quality.not_prose(results.limit(0)).count() == 0


def test_ranks_decide_what_is_no_prose(spark, rows, monkeypatch):
    prose = [(i, f"The field of run {i} is bounded, and it holds for all of the cases. We see that in the {'data ' * (i % 9 + 1)}of the paper.", "en") for i in range(60)]
    listed = "\n".join(f"sparse bound {i} | 4.{i} | 7.{i}" for i in range(12))
    junk = [(100, listed + "\nmain.tex", "en"), (101, listed + "\nhttps://www.example.org/a", "en"), (102, listed + "\nSmith et al., 2004", "en"), (103, listed, "en")]
    # no sentence end, but every rank is that of prose
    plain = [(200, "The field of the run is bounded, and it holds for all of the cases that we see in the data:", "en")]
    df = spark.createDataFrame(prose + junk + plain, "result_id bigint, text string, lang_label string")
    assert rows(quality.not_prose(df)) == [(100,), (101,), (102,), (103,)]
    monkeypatch.setattr(quality, "outlying", lambda: F.lit(True))
    assert rows(quality.not_prose(df)) == [(100,), (101,), (102,), (103,), (200,)]


def test_statistics(results):
    got = {r["result_id"]: r for r in quality.text_statistics(results).collect()}
    assert got[4]["text_length"] is None and got[4]["n_words"] == 0 and got[5]["text_length"] == 0
    assert got[9]["text_length"] == len("DaÃ\xad resulta que a soluÃ§Ã£o Ã© exata e nÃ£o muda mais. A soluÃ§Ã£o Ã© local.".encode())
    assert got[10]["lang"] == "de" and got[3]["lang"] == "und"


def test_counts_equal_the_patterns(spark):
    """The pass over marks counts what the patterns count."""
    rng = random.Random(3)
    parts = ["a", "ab", "de", "The", "и", "é", "é", "​", ".", "!", "?", "…", "。", "）", ")", "’", "*", " ", " ", "\n", "\t", "1", "²", "_", "/", "ª", "一", "是", "!?"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    t = F.col("text")
    want = df.select("text", *[quality.count_of(p, t) for p in (quality.SENTENCE_END, quality.CLOSED_END, quality.COMMON)]).collect()
    assert [r[0] for r in want if quality.sentence_counts(r[0]) != tuple(r[1:])] == []


def test_exact_ranks(spark):
    data = [(i, "x" * (i % 7) + " 1" * (i % 5), "en" if i % 3 else None) for i in range(300)] + [(300, None, None), (301, "", "en")]
    stats = quality.text_statistics(spark.createDataFrame(data, "result_id bigint, text string, lang_label string"))
    rows = stats.collect()
    for r in quality.value_ranks(stats, quality.STATISTICS, F.col("n_digits") > 1, 5).collect():
        same = [x for x in rows if x["lang"] == r["lang"]]
        ref = [x[r["stat"]] for x in same if x["n_digits"] > 1]
        assert r["n_rows"] == sum(x[r["stat"]] == r["value"] for x in same)
        assert r["n_below"] == sum(v < r["value"] for v in ref) and r["n_here"] == ref.count(r["value"]) and r["n_total"] == len(ref)


def test_scores_equal_brute_force(spark):
    import math

    data = [(i, f"The case {i} is bounded{' 7' * (i % 4)} {'of data ' * (i % 5)}in it." if i % 3 else f"x{i}|{i % 7}", "en" if i % 5 else "de") for i in range(90)]
    stats = quality.text_statistics(spark.createDataFrame(data, "result_id bigint, text string, lang_label string")).cache()
    rows = stats.collect()
    for hot in (1, 1000):
        quality.HOT_ONE_IN, before = hot, quality.HOT_ONE_IN
        got = {r["result_id"]: (r["n_ref"], r["score"]) for r in quality.outlier_scores(stats).collect()}
        quality.HOT_ONE_IN = before
        for x in rows:
            ref = [r for r in rows if r["lang"] == x["lang"] and r["n_sentence_ends"] > 0]
            score = 0.0
            for s, side in quality.SCORED.items():
                low, high = sum(r[s] <= x[s] for r in ref), sum(r[s] >= x[s] for r in ref)
                tail = low if side < 0 else high if side > 0 else min(len(ref), 2 * min(low, high))
                score -= math.log((tail + 1) / (len(ref) + 1))
            assert got[x["result_id"]][0] == len(ref) and abs(got[x["result_id"]][1] - score) < 1e-9
    assert quality.outlier_scores(stats.limit(0)).count() == 0


# 7 -------------------------------------------------------------------------------------------------------------------

MARKED = ["<p>x</p>", "a<br/>b", "<!-- c -->", "a &amp; b", r"\emph{x}", r"end. \\[1ex] more", "```\ncode\n```", "**bold** x", "__b__ x", "*it* x", "_it_ x", "[a](https://b.c)", "![p](f.png)", "### H", "# H", "== H ==", "* item", "> quote",
          "[[link]]", "{{box|a=1}}", "'''b'''", "`code` x", "1. item", "Title\n=====", "＜ｐ＞x"]
UNMARKED = ["## H\ntext", "- item", "a < b and c > d", "R&D notes", "5 * 3 * 2 terms", "run_30.v2.csv", r"A \ B is", r"$\frac{a}{b}$ and $$x_1$$", "x_1 and x_2", "see [7] and (p. 3)", "50% of it", "", None, "n = 5", "（＄＼ａ＄）"]


@pytest.fixture(scope="module")
def model():
    parts = ["A clean line stands here", "One claim of the paper holds", "The bound 4.5 is met", "Title and heading agree", "More text follows", "We see no limit", "- an item of the list", "## A heading", "Data were taken"]
    rng = random.Random(2)
    lines = [f"{rng.choice(parts)}{rng.choice(['', ' in all cases', ' for some time', ' when it is cold'])}{rng.choice(['.', '.', '!', ''])}" for _ in range(400)]
    return markup.ContentModel().fit(markup.labelled_pages(["\n".join(lines[i : i + 4]) for i in range(0, 400, 4)]))


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_found(text, model):
    assert markup.has_markup(text) and markup.is_residue(text, model) and markup.OWN_HINT.search(markup.prepared(text))


@pytest.mark.parametrize("text", UNMARKED)
def test_plain_signs_are_none(text, model):
    assert not markup.has_markup(text) and not markup.is_residue(text, model)


def test_cleaning(model):
    page = "<nav>Home About Search Login</nav><h2>Title</h2><p>One <em>bold</em> claim &amp; more.</p><ul><li>first point here</li></ul><script>var a = 1;</script><pre>x = 1</pre>"
    assert markup.clean(page, model) == "## Title\n\nOne bold claim & more.\n\n- first point here\n\nx = 1"
    assert markup.clean("\\section{A}\nText $x_1$ is \\emph{fine} \\cite{k}.\n\\begin{equation}a+b\\end{equation}", model) == "## A\n\nText $x_1$ is fine .\n\n$$a+b$$"
    assert markup.clean("## Own\n- kept", model) == "## Own\n- kept"


def test_context_decides(model):
    """The same list is content or a menu by what it holds, and what one item cannot tell, its neighbours do."""
    menu = "<ul>" + "".join(f'<li><a href="/x">{w}</a></li>' for w in ("Home", "Search", "Help", "Our work", "Login")) + "</ul>"
    found = "<ul><li>The bound is met in all cases.</li><li>Data were taken for some time</li></ul>"
    assert markup.clean(menu + found, model) == "- The bound is met in all cases.\n- Data were taken for some time"
    assert markup.clean("\\marked{One claim of the paper holds.}\\vspace{2mm}", model) == "One claim of the paper holds."
    alone = markup.ContentModel()
    alone.node = model.node  # no potentials of edges: no messages
    root, single = markup.parse(menu), markup.parse(menu)
    model.infer(root)
    alone.infer(single)
    assert [n.marginal for n in root.walk()] != [n.marginal for n in single.walk()]


def test_tables_become_rows(model):
    assert markup.clean("The rows are:\n| one case | 4.5 |\n|---|---|\n| two cases | 7.5 |\nAnd so on.", model).count(" | ") == 2
    wiki = markup.clean("We see this.\n{| class=x\n|-\n| one case || '''4.5'''\n|-\n| two cases || 7.5\n|}\nData were taken.", model)
    assert "one case | 4.5" in wiki and "{|" not in wiki and "''" not in wiki


def test_messages_equal_enumeration(model):
    """Sum-product against the sum over all states of a small tree."""
    import itertools

    root = markup.parse("<div><p>One claim stands.</p>{{box}}</div>")
    model.infer(root)
    nodes = list(root.walk())
    of = markup.features(root)
    own = [model.own(of[id(n)]) for n in nodes]
    place = {id(n): i for i, n in enumerate(nodes)}
    weight = np.zeros((len(nodes), 2))
    for states in itertools.product((0, 1), repeat=len(nodes)):
        total = sum(o for o, x in zip(own, states, strict=True) if x)
        total += sum(model.edge[states[place[id(n)]]][states[place[id(c)]]] for n in nodes for c in n.children)
        for i, x in enumerate(states):
            weight[i, x] += np.exp(total)
    assert np.allclose(weight[:, 1] / weight.sum(1), [n.marginal for n in nodes])


def test_marked_rows(results, model, rows):
    assert rows(markup.marked_up(results, model)) == [(8,)]
    assert markup.cleaned(results, model).where("result_id = 4").first()["clean_text"] is None


# 8 -------------------------------------------------------------------------------------------------------------------


def brute(doc, item):
    """The longest passage by trying every pair of positions."""
    best = 0
    for i in range(len(doc)):
        for j in range(len(item)):
            wrong = 0
            for n in range(1, min(len(doc) - i, len(item) - j) + 1):
                same = doc[i + n - 1] == item[j + n - 1]
                wrong += not same
                if n == 1 and not same:
                    break
                if same and n >= leakage.LEAST and wrong * leakage.ONE_IN <= n:
                    best = max(best, n)
    return best


def test_leaks_equal_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    item = [rng.choice(vocabulary) for _ in range(60)]
    items = leakage.prepare([(1, " ".join(item), 0)])
    for trial in range(60):
        n = rng.randint(8, 40)
        at = rng.randint(0, len(item) - n)
        piece = item[at : at + n]
        for k in rng.sample(range(n), min(n, rng.randint(0, 4))):
            piece[k] = "other"
        doc = [rng.choice(vocabulary) for _ in range(9)] + piece + [rng.choice(vocabulary) for _ in range(9)]
        for numbers in (None, {w: i + 1 for i, w in enumerate(sorted(set(item)))}):
            found = leakage.search_shard(leakage.build_shard([" ".join(doc)], numbers), items)
            assert (found[0][4] if found else 0) == brute(doc, item), trial


@pytest.mark.parametrize("known", [False, True])
def test_suffix_order_equals_sorting(known):
    rng = random.Random(7)
    for trial in range(60):
        docs = [" ".join(rng.choice(["aa", "bb", "cc", "zz"]) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        s = leakage.build_shard([*docs, docs[0]], {"aa": 1, "bb": 2, "cc": 3} if known else None)
        got = [tuple(s.ids[a:e]) for a, e in zip(s.suffixes, s.ends, strict=True)]
        assert got == sorted(got), trial


def test_leak_forms():
    item = "On rainy days a warm funnel keeps creaking above the barn although its friction reaches 9.906 newtons there"
    items = leakage.prepare([(1, "Read this instruction well. " + item, 4), (2, "Read this instruction well. Something else entirely stands in this second one of the suite", 4), (3, None, 0), (4, "", 0)])
    text = "x ON RAINY DAYS, a warm fun-\nnel keeps creaking\r\nabove the barn although its friction   reaches 9.906 newtons y"
    shard = leakage.build_shard([text, None, "", "Read this instruction well. " * 9])
    assert [(n, k) for n, k, *_ in leakage.search_shard(shard, items)] == [(0, 0)]


OPENING = "Please read the whole question with great care before you give a short and exact answer in the words of the text"


@pytest.mark.parametrize("suite", ["s", None])
@pytest.mark.parametrize("octets", [700, 4_000_000])
def test_instruction_never_counts(spark, rows, suite, octets):
    """Most items go on with the same word; the others leave out the instruction all the same, in blocks of any size."""
    own = [" ".join(f"{chr(97 + i)}{chr(97 + j % 26)}x{'q' * (j // 26)}" for j in range(30)) for i in range(10)]
    items = spark.createDataFrame([(i, suite, f"{OPENING} {'a' if i < 7 else 'the'} {t}", 1) for i, t in enumerate(own)], "item_id bigint, suite string, text string, n_words int")
    docs = spark.createDataFrame([(1, f"We say: {OPENING} a b c."), (2, f"{OPENING} the {own[9]}"), (3, own[2]), (4, " ".join(own[5].split()[:13])), (5, None)], "doc_id bigint, text string")
    assert rows(leakage.leaks(docs, items, octets).select("doc_id", "item_id")) == [(2, 9), (3, 2)]


def test_leak_rows(spark, rows):
    item = "On rainy days a warm funnel keeps creaking above the barn although its friction reaches 9.906 newtons there"
    docs = spark.createDataFrame([(1, "A. " + item), (2, None), (3, "none"), (4, "B. " + item)], "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(7, "s", item)], "item_id bigint, suite string, text string")
    found = leakage.leaks(docs, items)
    assert rows(found.select("doc_id", "item_id", "n_words")) == [(1, 7, 18), (4, 7, 18)]
    assert sorted(r["doc_id"] for r in leakage.without_leaks(docs, found).collect()) == [2, 3]
    assert leakage.leaks(docs, items.limit(0)).count() == 0 and leakage.leaks(docs.limit(0), items).count() == 0


# 9 -------------------------------------------------------------------------------------------------------------------


def test_exponents():
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    a = mixing.exponent_for_entropy(shares, 1.0)
    assert abs(mixing.entropy(mixing.tempered(shares, a)) - 1.0) < 1e-6
    tokens, limits = {"a": 700, "b": 200, "c": 100}, {"a": 1, "b": 2, "c": 2}
    a = mixing.exponent_for_repeats(tokens, limits, 1000)
    w = mixing.tempered(shares, a)
    assert 0 < a < 1 and all(w[s] * 1000 / tokens[s] <= limits[s] + 1e-6 for s in tokens)


def test_budgets():
    got = {b.source: b for b in mixing.budgets({"big": 0.5, "small": 0.4, "none": 0.1}, {"big": 1, "small": 2, "none": 3}, {"big": 1000, "small": 100})}
    assert got["none"].tokens == 0 and got["small"].tokens == 200 and got["big"].tokens == 900 and got["small"].passes == 2


def test_mix(spark, rows):
    sizes = spark.createDataFrame([(i, "a" if i % 3 else "b", 1 + i % 5) for i in range(600)] + [(900, None, 5), (901, "a", 0)], "doc_id bigint, source string, n_tokens bigint")
    chosen = mixing.plan(sizes, [("a", 0.5, 1), ("b", 0.5, 2), ("gone", 0.0001, 1)])
    mixed = mixing.mix(sizes, chosen).cache()
    uses = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert max(uses.values()) <= 2 and 900 not in uses and 901 not in uses
    for r in mixing.shares(spark, mixed, chosen).collect():
        assert r["mix_tokens"] <= r["budget_tokens"] and (r["budget_tokens"] == 0 or r["budget_tokens"] - r["mix_tokens"] < 6)
        assert r["most_uses"] <= r["max_repeats"]
    assert rows(mixing.mix(sizes.repartition(7), chosen)) == rows(mixed)
    assert mixing.mix(sizes.limit(0), mixing.plan(sizes.limit(0), [("a", 1.0, 1)])).count() == 0


def test_token_counts(spark):
    docs = spark.createDataFrame([(1, "hello world", " Lecture Notes"), (2, None, None), (3, "", "")], "doc_id bigint, text string, source string")
    got = {r["doc_id"]: (r["source"], r["n_tokens"]) for r in mixing.token_counts(docs).collect()}
    assert got == {1: ("lecture_notes", 2), 2: (None, 0), 3: (None, 0)}


# 10 ------------------------------------------------------------------------------------------------------------------

UNITS = [
    "Dr. Päekla and Prof. Rortae measured 1.5 GeV vs. 2.5 GeV at 1.77 K.| Does it hold?| “Is it needed?” asked J. K. Drelal in the discussion.| (The case n = 7 is trivial.)| We used version 7.253.34, cf. Makil (2019, p. 9 ff.).| The U.S. survey lists no. 93.",
    "It holds in 2019, cf. Eq. (841) of Ref. [91].| pH values were kept, e.g. those of R. Tré Jr. and others, i.e. ½ of it.| It is bounded.[7]| We follow Nörkla et al.| The field is weak … but only for n > 8.| 10² ≤ r³.",
    "Vgl. Abb. 63: es gilt, s. Tab. 21 bzw. Anh. B.| Am 81. Mai 1991 hat Dr. X z. B. 5,39 GeV gemessen.| „Ist das nötig?“, fragte Prof. Rokor.| Im Jahr 2018.| Es gilt, vgl. S. 51 f.| Nach X gilt das.",
    "Quelle borne étonnante !| « Est-ce vrai ? » demanda M. Murork.| D’après X et al. (p. 4 sqq.), c’est p. ex. 38 %, cf. éq. (22).| On en déduit.",
    "Los datos de EE. UU. no contienen el caso núm. 25.| «¿Hace falta?», preguntó J. Letiard.|¡Qué cota!| ¿Es así?| La cota está fija.|Cerca del punto.",
    "В 2017 г. было получено значение 18,7 эВ.| «Нужна ли схема?» — спросил проф. Qüaene.| См. рис. 4: т. е. для всех.",
    "多么精确的上界！|“模型真的必要吗？”他在讨论中问道。|测量值约为0.742，见图7。|只在n>2……但成立。",
    "「必要ですか？」と査読者は尋ねた。|測定値は約2.1であった（図5を参照）。|終わり。",
    "แบบจำลองนี้จำเป็นหรือไม่| เราแสดงว่าดี| ค่าที่วัดได้คือ44.851สำหรับ",
    "डॉ. X ने 2.5 का मान पाया।| क्या यह है?| हाँ!| ठीक है।",
]


@pytest.mark.parametrize("marked", UNITS)
def test_units(marked):
    text = marked.replace("|", "")
    want, at = [], 0
    for piece in marked.split("|"):
        want.append(at + len(piece) - len(piece.lstrip()))
        at += len(piece)
    got = [a for a, _ in sentences.sentences(text, "de" if "Vgl" in marked else None)]
    assert got == want, [text[a:b] for a, b in sentences.sentences(text)]


def test_label_decides():
    """An abbreviation of one language is a word of another."""
    assert len(sentences.sentences("Siehe Bd. Vier steht dort. Das ist so.", "de")) == 3 and len(sentences.sentences("Das gilt bzw. Karl sagt es.", "de")) == 1
    assert len(sentences.sentences("They said bzw. Karl says it.", "en")) == 2 and len(sentences.sentences("They said bzw. Karl says it.")) == 1


def test_quick_path_agrees_with_the_tables():
    slow = {}
    for name, tables in sentences.TABLES.items():
        slow[name] = [(d, re.compile(f"(?:{b})\\Z"), re.compile(a)) for table in tables for d, b, a in table]
    for before in ("a computed", "Wertebereich", "«expression", "(результат", "am 3 eigenwert", "the end", "see fig", "na prof", "um ad es", "x dott", "ein der", "на рис", "vgl", "el núm", "is it bzw"):
        for mark in ".!?":
            for after in (" The end", "\nÜber", "  Das ", " В нём"):
                text = before + mark + after
                at = len(before) + 1
                for name, rules in slow.items():
                    first = next(d for d, b, a in rules if a.match(text, at) and b.search(text[max(0, at - 24) : at]))
                    assert sentences.RULES[name].decide(text, at) == first, (name, text)


def test_layout():
    text = "## 1. Title here. Yes\r\n\r\nOne line\nbreaks here. Two.\n- item one. Still it\n- item\n\nno mark\n\n  \n"
    assert [text[a:b] for a, b in sentences.sentences(text)] == ["## 1. Title here. Yes", "One line\nbreaks here.", "Two.", "- item one. Still it", "- item", "no mark"]
    assert sentences.sentences(None) == sentences.sentences("") == sentences.sentences(" \n ") == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB .!?\n-#“”»[]1…。ก ", max_size=60))
def test_units_cover_all_letters(text):
    units = sentences.sentences(text)
    inside = {i for a, b in units for i in range(a, b)}
    assert all(c.isspace() or i in inside for i, c in enumerate(text)) and all(a < b for a, b in units)


def test_unit_rows(spark, rows):
    docs = spark.createDataFrame([(1, "A b. C d.", "en"), (2, None, None), (3, " ", "xx")], "doc_id bigint, text string, lang string")
    assert rows(sentences.sentence_units(docs).select("doc_id", "sent_no", "sent_start", "sentence")) == [(1, 0, 0, "A b."), (1, 1, 5, "C d.")]
    assert sentences.sentence_units(docs.limit(0)).count() == 0
