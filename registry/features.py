"""Feature queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from docloom import lexicon
from docloom.functions.scale import join_side
from docloom.functions.text import squeeze, unnest, word_tokens, words
from docloom.operators import features as f
from docloom.plans import prepare
from docloom.plans.scaling import VectorScaler
from docloom.plans.stages import feature_names
from docloom.sources import tables
from registry.common import SQUEEZED, WORD_TOKENS, count_sql, docs, in_list, load, query, r, tidy, words_of, workspace


def tfidf_cte(tokens: str = WORD_TOKENS, min_df: int = 2, max_df: str = "0.95", limit: int | None = None) -> str:
    top = f" ORDER BY sum(tf) DESC, term LIMIT {limit}" if limit else ""
    return f"""
tk AS (SELECT doc_id, unnest({tokens}) AS term FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM tk GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM documents),
vo AS (SELECT term, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 AS idf FROM t, n GROUP BY term
  HAVING count(*) >= {min_df} AND count(*) <= {max_df} * any_value(n){top}),
w AS (SELECT doc_id, term, tf, tf * idf AS w FROM t JOIN vo USING (term)),
u AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


ROWS = f"SELECT doc_id, term, tf, {r('weight')} AS weight FROM u"


@query("f01_tfidf", f"WITH {tfidf_cte()} {ROWS}")
def _(spark, sf):
    return tidy(f.tfidf(docs(spark, sf), word_tokens(F.col("text"))))


@query("f01_tfidf_top_features", f"WITH {tfidf_cte(limit=1000)} {ROWS}")
def _(spark, sf):
    return tidy(f.tfidf(docs(spark, sf), word_tokens(F.col("text")), max_features=1000))


CATEGORY_WORDS = {"Corpus": ["the", "nicht", "les", "ción"]}
GENERAL = ["of", "die", "la", *lexicon.GENERAL_TERMS]
WEIGHT = (f"CASE WHEN term IN ({in_list(CATEGORY_WORDS['Corpus'])}) THEN 2.0 WHEN term IN ({in_list(GENERAL)}) THEN 1.2 "
          "WHEN regexp_matches(term, '\\d') THEN 1.5 ELSE 1.0 END")


@query("f02_weighted_tfidf", f"WITH {tfidf_cte(limit=1000)} SELECT doc_id, term, tf, {r(f'weight * {WEIGHT}')} AS weight FROM u")
def _(spark, sf):
    weigh = f.domain_weight("Corpus", category_terms=CATEGORY_WORDS, general=GENERAL)
    return tidy(f.tfidf(docs(spark, sf), word_tokens(F.col("text")), max_features=1000, term_weight=weigh))


W = words_of("text")


def share(cond: str) -> str:
    return r(f"coalesce(len(list_filter({W}, lambda w: {cond})) / nullif(CAST(len({W}) AS DOUBLE), 0), 0)")


@query("f03_densities", f"""
SELECT doc_id, CAST(len({W}) AS BIGINT) AS length, {share(f'lower(w) IN ({in_list(GENERAL)})')} AS medical_term_density,
  {share("regexp_matches(w, '[0-9]')")} AS measurement_density,
  {share(f"lower(w) IN ({in_list(CATEGORY_WORDS['Corpus'])})")} AS disease_term_density FROM documents""")
def _(spark, sf):
    return tidy(f.densities(docs(spark, sf), category="Corpus", category_terms=CATEGORY_WORDS, general=GENERAL))


@query("f04_text_features")
def _(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    cleaned = prepare.clean_once(d)
    rows = PipelineModel(prepare.fit_stages(cleaned, category="ALS")).transform(cleaned)
    stats = F.unwrap_udt("tfidf")
    return tidy(rows.select("doc_id", "length", F.size(stats.getField("indices")).alias("terms"),
                                          F.aggregate(stats.getField("values"), F.lit(0.0), lambda a, x: a + x * x).alias("norm2")))


PERIODS = r"list_filter(string_split(text, '.'), lambda s: regexp_matches(s, '\S'))"
NW, NP = f"CAST(len({W}) AS DOUBLE)", f"CAST(len({PERIODS}) AS DOUBLE)"
BASIC = f"""CAST(len({W}) AS BIGINT) AS word_count, CAST(len({PERIODS}) AS BIGINT) AS sentence_count,
  {r(f'coalesce({NW} / nullif({NP}, 0), 0)')} AS avg_sentence_length,
  {r(f"coalesce(length(array_to_string({W}, '')) / nullif({NW}, 0), 0)")} AS avg_word_length"""
COUNTS = {f"{n}_count": count_sql("text", "(?i)" + p) for n, p in lexicon.MEASUREMENT_RULES.items()}
MEASURES = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in COUNTS.items()) + \
    f", {r('coalesce((' + ' + '.join(COUNTS.values()) + f') / nullif({NW}, 0), 0)')} AS measurement_density"
SYL = f"list_transform({W}, lambda w: len(regexp_extract_all(lower(w), '[aeiou]+')) + 1)"
SYLS = f"coalesce(list_sum({SYL}) / nullif({NW}, 0), 0)"
READ = f"""{r(SYLS)} AS avg_syllables_per_word,
  {r(f'coalesce(len(list_filter({SYL}, lambda c: c > 2)) / nullif({NW}, 0), 0)')} AS complex_words_ratio,
  {r(f'CASE WHEN {NW} > 0 AND {NP} > 0 THEN CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * ({NW} / {NP}) - CAST(84.6 AS DOUBLE) * {SYLS} ELSE 0 END', 4)} AS flesch_reading_ease"""


def _flesch(df):
    return tidy(df.withColumn("flesch_reading_ease", F.round("flesch_reading_ease", 4)))


@query("f05_basic_statistics", f"SELECT doc_id, {BASIC} FROM (SELECT doc_id, {SQUEEZED} AS text FROM documents)")
def _(spark, sf):
    d = docs(spark, sf).select("doc_id", squeeze(F.col("text")).alias("text"))
    return tidy(f.basic_statistics(d))


@query("f06_measurement_statistics", f"SELECT doc_id, {MEASURES} FROM documents")
def _(spark, sf):
    return tidy(f.measurement_statistics(docs(spark, sf)))


CATEGORY_RULES = {"Corpus": {"scores": r"(?:pathetic|disgusting)", "measurements": r"\d+\s*(?:the|of)",
                             "time_patterns": r"(?:the|th)\s*(?:of|in)"}}


@query("f07_category_statistics", "SELECT doc_id, " + ", ".join(
    f"CAST({count_sql('text', '(?i)' + p)} AS BIGINT) AS corpus_{n}_count" for n, p in CATEGORY_RULES["Corpus"].items())
    + " FROM documents")
def _(spark, sf):
    return tidy(f.category_statistics(docs(spark, sf), "Corpus", rules=CATEGORY_RULES))


@query("f08_readability", f"SELECT doc_id, {READ} FROM documents")
def _(spark, sf):
    return _flesch(f.readability(docs(spark, sf)))


@query("f09_statistics", f"""SELECT doc_id, {BASIC}, {MEASURES}, {", ".join(
    f"CAST({count_sql('text', '(?i)' + p)} AS BIGINT) AS als_{n}_count" for n, p in lexicon.CATEGORY_COUNT_RULES['ALS'].items())},
    {READ} FROM documents""")
def _(spark, sf):
    return _flesch(f.statistics(docs(spark, sf), category="ALS"))


ENTITIES = {**lexicon.ENTITY_TERMS, "FILLER": ["pathetic", "disgusting", "clown", "nicht"]}
OWN = {"Corpus": {"words": ["thing", "THE", "che"]}}


def _found(terms) -> str:
    return f"list_filter([{in_list(terms)}], lambda t: contains(lower(text), lower(t)))"


ALL_ENTITIES = {**ENTITIES, "Corpus_words": OWN["Corpus"]["words"]}
ENTITY_ROWS = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS type, array_to_string({_found(v)}, '|') AS terms FROM documents"
                                 for k, v in ALL_ENTITIES.items())


@query("f10_entities", f"SELECT * FROM ({ENTITY_ROWS}) WHERE terms <> ''")
def _(spark, sf):
    out = f.entities(docs(spark, sf), category="Corpus", terms=ENTITIES, category_terms=OWN)
    return out.withColumn("terms", F.array_join("terms", "|"))


@query("f11_entity_features", f"""SELECT doc_id,
  CAST({" + ".join(f"len({_found(v)})" for v in ALL_ENTITIES.values())} AS BIGINT) AS total_entities,
  CAST({" + ".join(f"CAST(len({_found(v)}) > 0 AS INT)" for v in ALL_ENTITIES.values())} AS BIGINT) AS unique_entity_types,
  {", ".join(f"{r(f'coalesce(len({_found(v)}) / nullif({NW}, 0), 0)')} AS {k.lower()}_density" for k, v in ENTITIES.items())},
  CAST(len({_found(ALL_ENTITIES['Corpus_words'])}) AS BIGINT) AS disease_specific_entities FROM documents""")
def _(spark, sf):
    return tidy(f.entity_features(docs(spark, sf), category="Corpus", terms=ENTITIES, category_terms=OWN))


@query("f12_word_vectors", f"SELECT term AS word, 100 AS width FROM (SELECT unnest({WORD_TOKENS}) AS term FROM documents) GROUP BY term HAVING count(*) >= 2")
def _(spark, sf):
    d = docs(spark, sf).select("doc_id", word_tokens(F.col("text")).alias("tokens"))
    model = f.train_word_vectors(d)
    return tidy(model.getVectors().select("word", F.size(vector_to_array("vector")).alias("width")))


# Every word has a row of the embeddings table as its vector, by the first five digits of its digest.
DIGIT = "(strpos('0123456789abcdef', substr(md5(term), {k}, 1)) - 1) * {p}"
WORD_ROW = " + ".join(DIGIT.format(k=k + 1, p=16 ** (4 - k)) for k in range(5))
VECTORS = f"""
fr AS (SELECT DISTINCT unnest({WORD_TOKENS}) AS term FROM documents),
rk AS (SELECT term, ({WORD_ROW}) % (SELECT count(*) FROM embeddings) AS vec_id FROM fr),
v AS (SELECT term, embedding FROM rk JOIN embeddings USING (vec_id)),
tk AS (SELECT doc_id, unnest({WORD_TOKENS}) AS term FROM documents),
e AS (SELECT doc_id, term, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM tk JOIN v USING (term)),
ids AS (SELECT doc_id, i FROM documents, range(1, 65) AS x(i))"""


def _vectors(spark, sf):
    emb = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    words = unnest(docs(spark, sf), [], word_tokens(F.col("text")), "word").distinct()
    row = F.conv(F.substring(F.md5("word"), 1, 5), 16, 10).cast("long") % emb.agg(F.count("*")).scalar()
    return join_side(words.withColumn("vec_id", row), emb, "vec_id").select("word", "vector")


def _embedding(spark, sf, **options):
    d = docs(spark, sf)
    out = f.document_embeddings(d, word_tokens(F.col("text")), _vectors(spark, sf), size=64, **options)
    return tidy(out.select("doc_id", F.posexplode("embedding").alias("i", "x")).withColumn("i", F.col("i") + 1), 5)


@query("f13_mean_embedding", f"""WITH {VECTORS}, m AS (SELECT doc_id, i, avg(CAST(x AS DOUBLE)) AS x FROM e GROUP BY doc_id, i)
SELECT doc_id, i, {r('coalesce(x, 0)', 5)} AS x FROM ids LEFT JOIN m USING (doc_id, i)""")
def _(spark, sf):
    return _embedding(spark, sf)


HEAVY = ["the", "la", "die", "nicht", "que"]


@query("f14_weighted_embedding", f"""WITH {VECTORS}, m AS (SELECT doc_id, i,
  sum(CAST(x AS DOUBLE) * CASE WHEN term IN ({in_list(HEAVY)}) THEN 2 ELSE 1 END) / sum(CASE WHEN term IN ({in_list(HEAVY)}) THEN 2 ELSE 1 END) AS x
  FROM e GROUP BY doc_id, i)
SELECT doc_id, i, {r('coalesce(x, 0)', 5)} AS x FROM ids LEFT JOIN m USING (doc_id, i)""")
def _(spark, sf):
    return _embedding(spark, sf, weighted_terms=HEAVY)


@query("f15_similar_items", f"""
WITH p AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 7)
SELECT vec_id, {r('list_cosine_similarity(CAST(embedding AS DOUBLE[]), q)')} AS similarity FROM embeddings, p WHERE vec_id <> 7
ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) DESC, vec_id LIMIT 10""")
def _(spark, sf):
    return tidy(f.similar_items(load(spark, sf, "embeddings"), 7, 10, "vec_id", "embedding"))


@query("f16_subword_vectors")
def _(spark, sf):
    out = f.subword_vectors(docs(spark, sf), word_tokens(F.col("text")))
    return tidy(out.select("doc_id", F.size(F.unwrap_udt("subwords").getField("indices")).alias("buckets")))


STATISTICS = {"word_count": NW, "sentence_count": NP, "avg_sentence_length": f"coalesce({NW} / nullif({NP}, 0), 0)",
              "avg_word_length": f"coalesce(length(array_to_string({W}, '')) / nullif({NW}, 0), 0)", **COUNTS,
              "measurement_density": f"coalesce(({' + '.join(COUNTS.values())}) / nullif({NW}, 0), 0)", "avg_syllables_per_word": SYLS,
              "complex_words_ratio": f"coalesce(len(list_filter({SYL}, lambda c: c > 2)) / nullif({NW}, 0), 0)",
              "flesch_reading_ease": f"CASE WHEN {NW} > 0 AND {NP} > 0 THEN CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * ({NW} / {NP}) - CAST(84.6 AS DOUBLE) * {SYLS} ELSE 0 END"}
DENSITY = {"length": NW, "medical_term_density": f"coalesce(len(list_filter({W}, lambda w: lower(w) IN ({in_list(lexicon.GENERAL_TERMS)}))) / nullif({NW}, 0), 0)",
           "measurement_density": f"coalesce(len(list_filter({W}, lambda w: regexp_matches(w, '[0-9]'))) / nullif({NW}, 0), 0)", "disease_term_density": "0"}
PLAIN_WEIGHT = (f"CASE WHEN term IN ({in_list(lexicon.GENERAL_TERMS)}) THEN {lexicon.TERM_WEIGHTS['general']} "
                f"WHEN regexp_matches(term, '\\d') THEN {lexicon.TERM_WEIGHTS['measurement']} ELSE {lexicon.TERM_WEIGHTS['other']} END")
OWN_ROWS = " UNION ALL ".join(f"SELECT doc_id, '{kind}:{n}' AS feature, CAST({e} AS DOUBLE) AS x FROM documents"
                              for kind, table in (("density", DENSITY), ("statistics", STATISTICS)) for n, e in table.items())


@query("f17_combined_features", f"""WITH {tfidf_cte(limit=1000)},
x AS (SELECT doc_id, 'tfidf:' || term AS feature, weight * {PLAIN_WEIGHT} AS x FROM u UNION ALL {OWN_ROWS})
SELECT doc_id, feature, {r('x', 4)} AS value FROM x WHERE x <> 0""")
def _(spark, sf):
    """The default features of uncleaned text as one vector; its positions by name, zeros left out."""
    d = docs(spark, sf).select("doc_id", "text")
    rows = prepare.fit_text_features(d, clean=False, statistics=True).transform(d)
    names = F.lit(feature_names(rows))
    cells = F.transform(vector_to_array("features"), lambda x, i: F.struct(F.get(names, i).alias("feature"), x.alias("value")))
    return tidy(unnest(rows, ["doc_id"], F.filter(cells, lambda c: c["value"] != 0), "feature", "value"), 4)


@query("f17_joined_families", f"""SELECT doc_id, feature, {r('x', 4)} AS value FROM (
  {" UNION ALL ".join(f"SELECT doc_id, 'statistics__{n}' AS feature, CAST({e} AS DOUBLE) AS x FROM documents" for n, e in STATISTICS.items())}
  UNION ALL {" UNION ALL ".join(f"SELECT doc_id, 'densities__{n}' AS feature, CAST({e} AS DOUBLE) AS x FROM documents" for n, e in DENSITY.items())})""")
def _(spark, sf):
    d = docs(spark, sf)
    out = f.combine_families({"statistics": f.statistics(d), "densities": f.densities(d), "entities": f.entity_features(d)}, ["statistics", "densities"])
    names = F.lit(feature_names(out))
    return tidy(out.select("doc_id", F.inline(F.transform(vector_to_array("features"), lambda x, i: F.struct(F.get(names, i).alias("feature"), x.alias("value"))))), 4)


SCALED = ["n_chars", "words"]
COLS = f"(SELECT doc_id, n_chars, CAST(len({W}) AS BIGINT) AS words, lang FROM documents)"


def _measures(spark, sf):
    return docs(spark, sf).select("doc_id", "n_chars", F.size(words(F.col("text"))).alias("words"), "lang")


@query("f18_standard_scaling", f"""WITH d AS {COLS}, s AS (SELECT {", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)} FROM d WHERE lang = 'en')
SELECT doc_id, {", ".join(f"{r(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in SCALED)} FROM d, s""")
def _(spark, sf):
    d = _measures(spark, sf)
    return tidy(f.standard_scale(d, f.fit_scaler(d.where("lang = 'en'"), SCALED)))


@query("f19_minmax_scaling", f"""WITH d AS {COLS}, s AS (SELECT {", ".join(
    f"min({c}) AS l_{c}, max({c}) AS h_{c}" for c in SCALED)} FROM d WHERE lang = 'en')
SELECT doc_id, {", ".join(f"{r(f'({c} - l_{c}) / CAST(h_{c} - l_{c} AS DOUBLE)')} AS {c}" for c in SCALED)} FROM d, s""")
def _(spark, sf):
    d = _measures(spark, sf)
    return tidy(f.minmax_scale(d, f.fit_scaler(d.where("lang = 'en'"), SCALED)))


def _bigram_sql() -> str:
    cte = tfidf_cte(limit=1000)
    own = f"""
tk0 AS (SELECT doc_id, {WORD_TOKENS} AS l FROM documents),
tp AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM tk0),
tb AS (SELECT doc_id, w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM tp),
tk AS (SELECT doc_id, w AS term FROM tb UNION ALL SELECT doc_id, w || ' ' || w2 FROM tb WHERE w2 IS NOT NULL),"""
    rest = cte[cte.index("t AS (SELECT doc_id, term, count(*)"):]
    return f"WITH {own} {rest} {ROWS}"


@query("f21_bigram_tfidf", _bigram_sql())
def _(spark, sf):
    return tidy(f.tfidf(docs(spark, sf), f.bigram_tokens(F.col("text")), max_features=1000))


def _fitted(kind, **options):
    """The embeddings scaled by a stage that is fitted on the classes below 5, saved and loaded again."""
    def run(spark, sf):
        emb = load(spark, sf, "embeddings")
        d = emb.select(F.col("vec_id").alias("doc_id"), "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        path = workspace(spark, f"scaling-{kind}")
        tables.save_bundle(PipelineModel([VectorScaler(kind=kind, **options).fit(d.where("label < 5"))]), path)
        rows = tables.load_bundle(spark, path, ["VectorScalerModel"]).transform(d)
        return tidy(rows.select("doc_id", F.posexplode(vector_to_array("scaled")).alias("i", "x")), 5)
    return run


EACH = """v AS (SELECT vec_id AS doc_id, label, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
s AS (SELECT i, avg(v) AS m, stddev_pop(v) AS d, min(v) AS lo, max(v) AS hi FROM v WHERE label < 5 GROUP BY i)"""
query("f18_vector_scaling", f"WITH {EACH} SELECT doc_id, i, {r('(v - m) / d', 5)} AS x FROM v JOIN s USING (i)")(_fitted("standard", centre=True))
query("f19_vector_minmax", f"WITH {EACH} SELECT doc_id, i, {r('(v - lo) / (hi - lo)', 5)} AS x FROM v JOIN s USING (i)")(_fitted("minmax"))
