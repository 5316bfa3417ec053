"""Hand-computed cases for the cleaning steps."""

import re

import pytest
from pyspark.sql import functions as F

from docloom import lexicon
from docloom.functions import cleaning as c, text as t
from docloom.functions.text import may_have, needed_words, rewrite
from docloom.operators import features as f, normalize as n


@pytest.fixture
def one(spark):
    def run(expr, value):
        df = spark.createDataFrame([(value,)], "text string")
        return df.select(expr(F.col("text")).alias("x")).first()["x"]
    return run


@pytest.fixture
def step(spark):
    def run(fn, value, *args, **kw):
        return fn(spark.createDataFrame([(1, value)], "doc_id long, text string"), *args, **kw).first()
    return run


@pytest.mark.parametrize("value,expected", [("  a \t b\n\nc ", "a b c"), ("a b", "a b"), ("", ""), ("   ", ""), (None, None)])
def test_whitespace(one, value, expected):
    assert one(t.squeeze, value) == expected


@pytest.mark.parametrize("value,limit,expected", [
    ("abc. def. ghi", 10, "abc. def."), ("abcdefghijk", 5, "abcde"), (".bcdefg", 5, ".bcde"), ("short.", 50, "short."), (None, 5, None)])
def test_length_cut(one, value, limit, expected):
    assert one(lambda x: c.cut_length(x, limit), value) == expected


@pytest.mark.parametrize("value,expected", [
    ("score:28 and a;b", "score : 28 and a ; b"),
    ("100mg/day dose", "100mg/day dose"),
    ("FVC = 65% ± 5%", "FVC = 65% ± 5%"),
    ("x=+y", "x=+y".replace("=", " = ").replace("+", " + ").replace("  ", " ")),
    ("ALSFRS-R:42", "ALSFRS-R : 42"),
    (None, None)])
def test_characters_spaced(one, value, expected):
    assert one(c.space_characters, value) == expected


def test_character_counts(one):
    counts = one(c.spaced_character_counts, "a:b:c; p < 0.05 [x] 3-5+2")
    assert (counts[":"], counts[";"], counts["["], counts["="]) == (2, 1, 1, 0)
    assert counts["+"] == 0  # "+2" is a protected value


@pytest.mark.parametrize("value,expected", [("5mg of 10% at 3-5", "5 mg of 10 % at 3 - 5"), ("65±5", "65 ± 5"), ("none", "none")])
def test_open_measurements(one, value, expected):
    assert one(c.open_measurements, value) == expected


def test_compact_measurements(one):
    assert one(c.compact_measurements, "5 mg, 65 % ± 5 %, 3 - 5, 1 / 2") == "5mg, 65% ± 5%, 3-5, 1/2"


def test_scores(step):
    row = step(n.extract_scores, "MMSE  score: 22. Y-BOCS score: 28. Hoehn and Yahr stage 2. 38-degree Cobb angle 40°")
    assert row["scores"] == ["OCD_YBOCS: Y-BOCS score: 28", "Parkinson_Hoehn: Hoehn and Yahr stage 2",
                             "Dementia_MMSE: MMSE  score: 22", "Scoliosis_Cobb: Cobb angle 40°"]
    assert "MMSE score: 22" in row["text"]


def test_abbreviations_first_occurrence_only(step):
    row = step(n.normalize_abbreviations, "ALS trial. ALS again. FUNCTION test CT")
    assert row["text"] == ("amyotrophic lateral sclerosis (ALS) trial. ALS again. "
                           "FUNCTION test Computed Tomography (CT)")
    assert row["expanded"] == {"ALS": "amyotrophic lateral sclerosis", "CT": "Computed Tomography"}


def test_abbreviation_kept_near_its_full_form(step):
    text = "amyotrophic lateral sclerosis (ALS) and als"
    assert step(n.normalize_abbreviations, text)["text"] == text
    assert step(n.normalize_abbreviations, None)["text"] is None


def test_measurement_values(step):
    row = step(n.normalize_abbreviations, "took 5MG and 2.5 mg, 70kg, 3 mgs")
    assert row["measurements"] == {"mg": ["5", "2.5"], "kg": ["70"]}
    assert row["text"] == "took 5 mg and 2.5 mg, 70 kg, 3 mgs"


def test_synonyms_do_not_chain_within_a_table(step):
    row = step(n.standardize_terms, "Intrusive thoughts", tables=[lexicon.CATEGORY_SYNONYMS["OCD"]])
    assert row["text"] == "obsessive thoughts"
    assert row["replacements"] == ["Intrusive thoughts → obsessive thoughts"]


def test_synonyms_chain_across_tables(step):
    row = step(n.standardize_terms, "memory loss, twice daily checkup; testing the test")
    assert row["text"] == "cognitive decline, BID examination; testing the assessment"


def test_replacement_audit(spark):
    df = spark.createDataFrame([(1, "drug and Drug"), (2, "none"), (3, None)], "doc_id long, text string")
    rows = {tuple(r) for r in n.replacement_audit(df).collect()}
    assert rows == {(1, "drug", "medication"), (1, "Drug", "medication")}


def test_category_step(step):
    row = step(n.category_step, "Motor Function at 65 FVC", "ALS")
    assert row["text"] == "motor function at 65 FVC"
    assert row["terms_found"] == ["motor function"] and row["category_measurements"] == ["65 FVC"]


def test_stopwords(step):
    row = step(n.remove_stopwords, "The study of MRI and 5mg motor drug ALSfrsR", category="ALS")
    assert row["text"] == "MRI 5mg motor drug ALSfrsR"
    assert row["removed_stopwords"] == ["The", "study", "of", "and"]
    assert row["preserved_tokens"] == ["MRI", "5mg", "motor", "drug"]


def test_tokenizer(step):
    assert step(n.tokenize, "a   b 5   mg  c")["text"] == "a b 5   mg c"
    assert step(n.tokenize, "Forced X-Y vital", improved=True)["text"] == "Forced X-Y vital"
    assert step(n.tokenize, "aX-Yb", improved=True)["text"] == "a X-Y b"
    assert step(n.tokenize, "Forced", improved=True, split_capitals=True)["text"] == "F orced"


def test_term_step_is_word_bounded(step):
    row = step(n.unify_abbreviations, "clinical trials in ALS and als")
    assert row["text"] == "clinical trials in ALS and ALS"
    assert step(n.unify_abbreviations, "only als")["text"] == "only als"


def test_preserved_terms(step):
    row = step(n.preserve_terms, "Motor and MEMORY")
    assert row["text"] == "motor and memory" and row["terms_found"] == ["motor", "memory"]


def test_compact_units(step):
    row = step(n.compact_measurements, "5 MG and 7 Units")
    assert row["text"] == "5mg and 7units" and row["unit_mentions"] == ["5 MG", "7 Units"]


@pytest.mark.parametrize("value,expected", [
    ("a.b,c", "a . b , c"), ("3-5 a-b x -y", "3-5 a-b x  - y"), ("5%6 7%", "5%6 7 % "), ("1/2 a/b", "1/2 a / b"), ("5±2 a±2", "5±2 a ± 2")])
def test_space_by_context(one, value, expected):
    assert one(c.space_by_context, value) == expected


def test_space_after_marks(one):
    assert one(c.space_after_marks, "a.b  c,d!? e") == "a. b c, d!? e"


def test_numbers(one):
    assert one(c.number_list, "1.5 and 3-5 or 1/2") == ["1.5", "1", "5", "3", "5", "1", "2", "3-5", "1/2"]


def test_validation(spark):
    df = spark.createDataFrame([(1, "x"), (2, " \n"), (3, None), (4, "")], "doc_id long, text string")
    assert [r[0] for r in n.valid_texts(df).select("doc_id").collect()] == [1]
    assert n.rejected_texts(df).count() == 3


def test_ordered_chain(step):
    text = "FVC = 65% ± 5%.  ALSFRS-R score decreased from 42 to 38 over 3 months. Took 100mg/day medicine."
    row = step(n.clean_text, text, n.CleaningConfig(category="ALS"))
    assert "65 % ± 5 %" in row["text"] and "ALS Functional Rating Scale Revised (ALSFR S-R )" in row["text"]
    assert "medication" in row["text"] and "Forced Vital Capacity (FVC)" in row["text"]
    assert "  " not in row["text"]


def test_cleaning_run_figures(step):
    text = "a:b 12 drug " + "x" * 9000
    s = step(n.cleaning_run, text)["stats"]
    assert s["original_length"] == 9012 and s["processed_length"] >= 9000
    assert s["special_chars_removed"] == 1 and s["numbers_found"] == 1 and s["medical_terms_preserved"] == 1
    assert step(n.cleaning_run, text, n.CleaningConfig(max_length=9000))["stats"]["processed_length"] <= 9000


def test_run_lengths(one):
    rows = one(lambda x: t.run_lengths(t.words(x)), "b a b c a b")
    assert [(r["term"], r["tf"]) for r in rows] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(lambda x: t.run_lengths(t.words(x)), "") is None


def test_ngrams(one):
    assert one(lambda x: t.ngrams(t.words(x), 2), "a b c") == ["a b", "b c"]
    assert one(lambda x: t.ngrams(t.words(x), 3), "a b") == []


def test_guards_leave_results_as_they_are(spark):
    """Patterns that need a digit are tried on texts with one only; digits of other scripts count where they did."""
    assert c.needs_digit([r"\d+\s*%?\s*FVC", r"the\s*:?\s*\d+"])
    assert not any(c.needs_digit([p]) for p in (r"a|\d+", r"(\d+)?x", r"\w+", r"x\\\\d+"))
    rows = [(None,), ("",), ("no mark",), ("a-b/c",), ("5mg ± 3 %",), ("± only",), ("٣ mg; x",), ("FVC 65 %  FVC",), ("+ ٣ [x]y",)]
    df = spark.createDataFrame(rows, "text string")
    x = F.col("text")
    p = c.protected_pattern()
    got = df.select(x, c.protected_spans(x), c.number_list(x), c.unit_values(x, ("mg",)), c.open_measurements(x)).collect()
    plain = df.select(x, F.regexp_extract_all(x, F.lit(p), F.lit(0)), F.concat(*[F.regexp_extract_all(x, F.lit(q), F.lit(0)) for q in (r"\d+\.\d+", r"\d+", r"\d+\s*-\s*\d+", r"\d+/\d+")])).collect()
    assert [tuple(r)[:3] for r in got] == [tuple(r) for r in plain]
    assert got[6][3] == {"mg": ["٣"]} and got[5][4] == " ± only" and got[0][4] is None
    scored = [r[0] for r in df.select(c.score_list(x)).collect()]
    assert scored[2] == [] and scored[0] is None and scored[7] != []
    assert "rlike" in str(df.select(c.protected_spans(x))._jdf.queryExecution().analyzed()).lower()


def test_syllables_of_words(spark):
    texts = ["a ba ede oiu iai eae", "Été bébé über Äiöü", "x\u00a0aba\u2003ebe", "", None, "AEIOU strengths queue idea audio"]
    got = f.readability(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        words = (text or "").split()
        counts = [len(re.findall("[aeiou]+", w.lower())) + 1 for w in words]
        assert r["avg_syllables_per_word"] == pytest.approx(sum(counts) / len(counts) if words else 0)
        assert r["complex_words_ratio"] == pytest.approx(sum(k > 2 for k in counts) / len(counts) if words else 0)


def test_texts_that_have_the_mark_are_rewritten_all_the_same(spark):
    rows = spark.createDataFrame([(1, "a\0b 5  mg\0"), (2, "a b 5  mg"), (3, None), (4, ""), (5, "5  mg5 mg")], "id int, text string")
    out = rows.select("id", rewrite(F.col("text"), r"\d+\s*mg", gap=F.upper, span=lambda s: F.replace(s, F.lit(" "), F.lit(""))).alias("t"))
    assert {r["id"]: r["t"] for r in out.collect()} == {1: "A\0B 5mg\0", 2: "A B 5mg", 3: None, 4: "", 5: "5mg5mg"}


def test_patterns_are_kept_for_texts_that_may_match(spark):
    """The byte search in front of a pattern leaves out no text that it matches, in any case and with letters that count as ASCII ones."""
    assert needed_words(r"\d+\s*(?:degree[s]?)?\s*(?:curve|angle)") == ["curve", "angle"]
    assert needed_words(r"Hoehn\s*(?:and)?\s*Yahr\s*:?\d+") == ["Hoehn"]
    assert needed_words(r"abc|\d+") == needed_words(r"(?:ab|cde)?x*\d+") == []
    table = {"test": "assessment", "kidney": "organ", "skin": "cover"}
    texts = ["a TEST", "a teſt", "Kidney", "sKıN", "skİn", "nothing", "contest", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    plain = rewrite(F.col("text"), c.synonym_pattern(table), span=lambda s: F.lit("X"))
    got = rows.select("i", may_have(F.col("text"), list(table)).alias("may"), (plain != F.col("text")).alias("hit")).orderBy("i").collect()
    assert [r["hit"] for r in got] == [True, True, True, True, True, False, False, None]
    assert all(r["may"] for r in got if r["hit"]) and not got[5]["may"]


def test_blanks_and_lone_characters_at_the_ends_of_spans(spark):
    rows = spark.createDataFrame([(1, "a;b 5 mg;c"), (2, "a ; b"), (3, ";a;"), (4, "x y  z 3 - 5;")], "i int, text string")
    got = {r["i"]: r["t"] for r in rows.select("i", c.space_characters(F.col("text")).alias("t")).collect()}
    assert got == {1: "a ; b 5 mg ; c", 2: "a ; b", 3: " ; a ; ", 4: "x y z 3 - 5 ; "}
