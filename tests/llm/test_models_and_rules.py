"""Statistics against brute force, fitted models by held-out accuracy, and the pipeline."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from duescope.llm import language, quality_model, quality_rules, textstats, toxicity
from duescope.llm.queries import QUERIES
from duescope.storage import stored
from tests.llm.conftest import SYLLABLES, prose
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def brute_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often, under = Counter(windows), set()
    for i, v in enumerate(windows):
        if often[v] > 1:
            under |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under),
            len(text), len(re.findall("[A-Z]", text)), len(lines), len(re.findall(r"[.,!?]", text)))


def test_statistics_match_brute_force(docs, doc_rows):
    got = textstats.with_statistics(docs, [docs["doc_id"]]).collect()
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=order) == sorted(((r[0], *brute_statistics(r[1])) for r in doc_rows), key=order)


def test_base_rules_and_kept(docs, doc_rows):
    got = quality_rules.judged(docs).collect()
    assert len(got) == len(doc_rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert (r.d2 is None) == r.base_failed and not (r.base_failed and r.kept)


def test_distance_is_mahalanobis_under_the_estimate(spark, docs):
    """Distances written as column expressions equal those of the matrix form."""
    rows = stored(quality_rules.statistics(docs)).where("not base_failed")
    start = quality_rules._start(rows, 9)
    est = quality_rules._step(rows, start, None, 9)
    params = {(r.g_lang, r.g_source): r for r in est.collect()}
    d = quality_rules.DIM
    for r in quality_rules.with_distance(rows, est).collect():
        p = params[r.g_lang, r.g_source]
        low = np.array([[p[f"l{i}_{j}"] if j <= i else 0.0 for j in range(d)] for i in range(d)])
        x = np.array([r[f"x{i}"] - p[f"m{i}"] for i in range(d)])
        assert abs(x @ np.linalg.solve(low @ low.T, x) - r.d2) < 1e-6 * max(1, r.d2)


def test_concentration_does_not_follow_outliers(spark):
    """A third of the rows far off leaves the estimate with the others."""
    rng = random.Random(4)
    rows = [(i, "en", "s", *[rng.gauss(0, 1) + (40 if i % 3 == 0 and i % 4 == 0 else 0) for _ in range(quality_rules.DIM)]) for i in range(1200)]
    df = stored(spark.createDataFrame(rows, ["id", "g_lang", "g_source", *[f"x{i}" for i in range(quality_rules.DIM)]]))
    est = quality_rules._start(df, 1)
    for _ in range(quality_rules.STEPS):
        est = quality_rules._step(df, est, None, 1)
    far = quality_rules.with_distance(df, est).where("d2 > 60").select("id").collect()
    assert {r.id for r in far} == {i for i in range(1200) if i % 12 == 0}


def test_chi2():
    assert abs(quality_rules.chi2_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(quality_rules.chi2(7.8408, 6) - 0.75) < 1e-4


def test_stage_drops_what_is_not_kept(docs, doc_rows):
    kept = quality_rules.passing(docs)
    judged = Counter(r.doc_id for r in quality_rules.judged(docs).collect() if r.kept)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == judged


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=9), min_size=1, max_size=5, unique=True), st.text(alphabet="abcd", max_size=10))
@settings(max_examples=400, deadline=None)
def test_automaton_is_edit_distance(terms, word):
    budget = {t: toxicity.edits(t) for t in terms}
    near = [(distance(t, word), t) for t in terms if distance(t, word) <= budget[t]]
    found = toxicity.Automaton(budget).match(word)
    assert (found is None) == (not near)
    assert not near or found[1] == min(near)[0] and distance(found[0], word) == found[1]


def test_beginnings_match_any_ending():
    a = toxicity.Automaton({"lowe": None, "idiot": 1})
    assert [a.match(w) for w in ("lowest", "lowe", "low", "idoit", "idiots")] == [("lowe", 0), ("lowe", 0), None, None, ("idiot", 1)]


def test_covered_words_match_misspelled(spark):
    """Inflected forms make a beginning surer than its words; these still match misspelled."""
    forms = ["dolterei", "dolterung", "doltersam"]
    rows = [(f"you {forms[i % 3]} n{i}", 1.0) for i in range(90)] + [(f"fine words m{i} here", 0.0) for i in range(200)]
    lex = toxicity.lexicon(spark.createDataFrame(rows, "text string, y double"))
    assert set(forms) <= set(lex.covered) and not set(forms) & set(lex.terms)
    matches = toxicity.Matches(toxicity.Automaton(lex.terms, lex.covered), frozenset())
    for word in forms:
        typo = word[0] + "x" + word[2:]
        begin = lex.covered[word]
        assert matches[word.encode()] == ((begin, 0),) and matches[typo.encode()] == ((begin, 1),)
        assert toxicity.features(f"such a {typo}".encode(), matches, lex)[2] > 0


def test_quotation_is_told_from_abuse():
    lex = toxicity.Lexicon({"idiot": 1}, {"idiot": 5.0}, set())
    of = lambda t: toxicity.features(t.encode(), toxicity.Matches(toxicity.Automaton(lex.terms), frozenset()), lex)
    own, quoted, cited, told, typo = (of(t) for t in (
        "you are an idiot here", 'the word "idiot" is old', "> you idiot", "he wrote idiot once", "such an idiott"))
    assert own[1] > 0 and own[3] == 0 and typo[2] > 0
    assert all(f[1] == 0 and f[3] > 0 for f in (quoted, cited, told))
    assert of("") == of("nothing of it") == [0.0] * toxicity.FEATURES


def accuracy(rows, label, got):
    return np.mean([got[i] == label(v) for i, v in rows])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_toxicity_on_held_out_documents(spark, labels):
    got = {r.doc_id: r for r in QUERIES["op1_toxicity_automata"](spark, DATA).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == held(i) for i, r in got.items())
    out = [r for r in labels.collect() if held(r.doc_id)]
    assert np.mean([got[r.doc_id].predicted == r.toxic for r in out]) >= 0.95
    assert all(got[r.doc_id].predicted == 0 for r in out if not r.toxic)


def test_quality_on_held_out_documents(spark, labels):
    got = {r.doc_id: r for r in QUERIES["op8_rule_ensemble"](spark, DATA).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(i) for i, r in got.items())
    assert np.mean([got[r.doc_id].predicted == r.quality for r in labels.collect() if held(r.doc_id)]) >= 0.97


def test_language_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op3_language_families"](spark, DATA).collect()}
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()
    assert all(0 <= r.score <= 1 and r.held_out == held(i) for i, r in got.items())
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in rows if held(r.doc_id)]) >= 0.98


def test_models_take_awkward_rows(spark, docs, doc_rows, empty):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0), "x") for i in range(60)] + [(None, 1, 1, "x"), (5, None, None, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    for scored in (quality_model.scored(docs, labels), toxicity.scored(docs, labels)):
        rows = scored.collect()
        assert len(rows) == len(doc_rows) and all(0 <= r.score <= 1 for r in rows)
    none = labels.limit(0)
    one_kind = labels.where("quality = 1").withColumn("toxic", F.lit(0))
    assert quality_model.scored(empty, labels).collect() == toxicity.scored(empty, labels).collect() == []
    assert {r.score for r in quality_model.scored(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.0}
    assert {r.score > 0.5 for r in quality_model.scored(docs, one_kind).collect()} == {True}
    assert {r.score for r in toxicity.scored(docs, one_kind).collect()} == {0.0}


def test_language_takes_awkward_rows(spark, docs, doc_rows, empty):
    got = language.predicted(docs, language.fitted(docs)).collect()
    assert len(got) == len(doc_rows)
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert {by[100], by[101], by[102], by[111]} == {"und"} and by[109] != "und"
    assert language.predicted(empty, language.fitted(docs)).collect() == []
    assert {r.lang_pred for r in language.predicted(docs, language.fitted(empty)).collect()} == {"und"}


def test_letters():
    assert [language.has_letter(t.encode()) for t in ("a", "Z", "é", "字", "1 ,", "", "٣", "—")] == [True, True, True, True, False, False, False, False]


def test_rules_are_scored_as_they_read():
    up, low = quality_model.Bound("m", 2.0, True), quality_model.Bound("m", 1.0, True)
    assert quality_model._tightest([low, up]) == frozenset({up})


def test_rule_scores_equal_their_sum(spark):
    rule = frozenset({quality_model.Bound("a", 1.0, True), quality_model.Bound("b", 5.0, False)})
    model = quality_model.RuleModel(-1.0, {"a": 0.5}, {rule: 2.0})
    rows = spark.createDataFrame([(0.0, 0.0), (2.0, 5.0), (2.0, 6.0)], "a double, b double").select("a", "b", model.score().alias("s")).collect()
    for r in rows:
        z = -1 + 0.5 * r.a + (2.0 if r.a > 1 and r.b <= 5 else 0)
        assert abs(r.s - 1 / (1 + np.exp(-z))) < 1e-12


def test_pipeline_stages_on_whole_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept[-1]
        kept.append(set(ids))
    base = {r.doc_id for r in quality_rules.judged(spark.read.parquet(f"{DATA}/documents.parquet")).where("base_failed").collect()}
    good = {i for i, q in labels.items() if q == 1 and i not in base}
    assert len(good & kept[2]) >= 0.99 * len(good)
    assert not {i for i, q in labels.items() if q == 0} & kept[2]
    packed = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept[-1]


def test_pipeline_takes_awkward_rows(spark, docs, empty):
    for start in (docs, empty):
        table = start
        for _, stage in corpus_pipeline.STAGES:
            table = stored(stage(spark, table, DATA))
        assert table.count() >= 0


def test_typographic_marks_part_words():
    """Quotes, dashes, dots and apostrophes beyond ASCII don't hide a term, nor do combining marks split one."""
    lex = toxicity.Lexicon({"idiot": 1, "ab": 0}, {"idiot": 2.0, "ab": 1.0}, set())
    of = lambda t: toxicity.features(t.encode(), toxicity.Matches(toxicity.Automaton(lex.terms), frozenset()), lex)
    plain = of("you idiot now")
    for text in ("you —idiot— now", "you idiot’s now", "you idiot… now", "you idiot now", "you ab́ab idiot now"):
        assert of(text)[0] == plain[0] and of(text)[1] == plain[1], text
    for text in ("you “idiot” now", "you «idiot» now"):
        assert of(text)[0] == 0 and of(text)[3] > 0, text
    assert of("you “idiom” –idoit– now")[2] == 0 and of("you –idiott– now")[2] > 0
    assert of("ab́ab")[0] == 0 and of("x" * 20_000)[0] == 0


def test_terms_of_any_length_count(spark):
    """Words of one letter and of fifty are terms if their documents are surely toxic."""
    long = "un" * 25
    rows = [(f"{'z' if i % 2 else long} plain words here number{i}", 1.0) for i in range(80)]
    rows += [(f"other plain words here number{i}", 0.0) for i in range(400)]
    lex = toxicity.lexicon(spark.createDataFrame(rows, "text string, y double"))
    assert {"z", long} <= set(lex.terms) | set(lex.covered)


def test_languages_beyond_the_table_join_families_like_them():
    base = np.eye(6)
    means = {"en": base[0], "fr": base[1], "x1": base[0] + 0.3 * base[2], "x2": base[3], "x3": base[3] + 0.2 * base[4], "x4": base[5]}
    found = language.families_of(means)
    assert found["x1"] == found["en"] == "germanic" and found["fr"] == "romance"
    assert found["x2"] == found["x3"] == "like x2" and found["x4"] == "like x4"


def test_language_fit_takes_whole_texts(spark):
    """Languages that differ only behind the first hundred thousand bytes."""
    rng = random.Random(2)
    rows = [(i, "0 " * 50_000 + prose(rng, 300, SYLLABLES if i % 2 else ["qu", "xi", "zo", "wy"]), "aa" if i % 2 else "bb") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.predicted(docs, language.fitted(docs)).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_the_jobs_of_a_rule_fit_are_one_task_each(spark, monkeypatch):
    """The rows of the fit are bounded, so its few hundred jobs aren't dealt out by the input's partitions."""
    seen = []

    class Seen(quality_model.GBTClassifier):
        def fit(self, table):
            seen.append(table.rdd.getNumPartitions())
            return super().fit(table)

    monkeypatch.setattr(quality_model, "GBTClassifier", Seen)
    docs = spark.createDataFrame([(i, "a plain line of words, and more. " * (1 + i % 5) if i % 2 else "# $ % & " * 9) for i in range(80)], "doc_id long, text string")
    model = quality_model.fitted(docs.repartition(8), spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int"))
    assert seen == [1] and (model.rules or model.linear)
