"""The same results in DuckDB SQL, for every query that SQL can express."""

from __future__ import annotations

from termlift.catalog import settings
from termlift.functions.text import EDGE_CHARACTERS, FEATURE_DELIMITERS, TERM_DELIMITERS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_STOP = "(" + ", ".join(_quoted(word) for word in settings.STOP_WORDS) + ")"


def _exploded(delimiters: str, category: str) -> str:
    return f"""
    SELECT doc_id, {category} AS category,
           unnest(regexp_split_to_array(lower(text), {_quoted(delimiters)})) AS term
    FROM documents WHERE {category} IS NOT NULL AND text IS NOT NULL"""


def _terms(delimiters: str, category: str = "lang") -> str:
    return f"""
    SELECT * FROM ({_exploded(delimiters, category)})
    WHERE length(term) >= 2 AND term NOT IN {_STOP}"""


def _freq_ctes(category: str = "lang") -> str:
    return f"""
    tokens AS ({_terms(TERM_DELIMITERS, category)}),
    freq AS (SELECT category, term, count(*) AS freq_ct FROM tokens GROUP BY category, term)"""


def _score_ctes(category: str = "lang") -> str:
    return f"""{_freq_ctes(category)},
    t AS (SELECT term, sum(freq_ct)::DOUBLE AS tt FROM freq GROUP BY term),
    c AS (SELECT category, sum(freq_ct)::DOUBLE AS ct FROM freq GROUP BY category),
    n AS (SELECT sum(freq_ct)::DOUBLE AS nn FROM freq),
    cells AS (
      SELECT freq.category, freq.term, freq_ct, nn,
             freq_ct::DOUBLE AS a, tt - freq_ct AS b, ct - freq_ct AS c, nn - tt - ct + freq_ct AS d
      FROM freq JOIN t USING (term) JOIN c USING (category) CROSS JOIN n),
    scores AS (
      SELECT category, term, freq_ct,
             round(CASE WHEN (a + b) * (c + d) * (a + c) * (b + d) = 0 THEN 0.0
                        ELSE nn * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * (a + c) * (b + d)) END, 6) AS chi2
      FROM cells)"""


def _top_ctes(category: str = "lang") -> str:
    return f"""{_score_ctes(category)},
    top AS (
      SELECT category, rank, term, chi2 FROM (
        SELECT category, term, chi2,
               row_number() OVER (PARTITION BY category ORDER BY chi2 DESC, term ASC)::INTEGER AS rank
        FROM scores)
      WHERE rank <= {settings.TOP_TERMS})"""


_CLEAN = f"regexp_replace(term, {_quoted(EDGE_CHARACTERS)}, '', 'g')"
_DICTIONARY = f"SELECT DISTINCT {_CLEAN} AS term FROM freq WHERE {_CLEAN} <> ''"
_LINES = """
    SELECT category, category || chr(9) ||
           string_agg(term || ':' || printf('%.6f', chi2), ' ' ORDER BY rank) AS line
    FROM top GROUP BY category"""

_FEATURE_CTES = f"""
    tokens AS ({_terms(FEATURE_DELIMITERS)}),
    docs AS (SELECT doc_id, lang AS category FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
    frequent AS (
      SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM tokens
      GROUP BY term HAVING count(DISTINCT doc_id) >= {settings.MIN_DOCUMENTS}),
    vocab AS (
      SELECT (row_number() OVER (ORDER BY n DESC, term ASC) - 1)::INTEGER AS featureIndex, term, n, df
      FROM frequent QUALIFY featureIndex < {settings.VOCABULARY_SIZE}),
    idf AS (
      SELECT featureIndex, term, df, ln(((SELECT count(*) FROM docs) + 1.0) / (df + 1.0)) AS idf FROM vocab),
    tf AS (
      SELECT doc_id, category, featureIndex, count(*)::DOUBLE AS tf
      FROM tokens JOIN vocab USING (term) GROUP BY doc_id, category, featureIndex),
    weights AS (SELECT doc_id, featureIndex, tf * idf AS w FROM tf JOIN idf USING (featureIndex) WHERE tf * idf <> 0)"""

_STATISTIC_CTES = f"""{_FEATURE_CTES},
    labels_n AS (SELECT category, count(*)::DOUBLE AS col FROM docs GROUP BY category),
    total AS (SELECT count(*)::DOUBLE AS n FROM docs),
    seen AS (SELECT featureIndex, tf AS value, category, count(*)::DOUBLE AS o FROM tf GROUP BY ALL),
    present AS (SELECT featureIndex, category, sum(o) AS p FROM seen GROUP BY ALL),
    zero AS (
      SELECT featureIndex, 0.0 AS value, category, col - coalesce(p, 0) AS o
      FROM (SELECT featureIndex, category, col FROM vocab CROSS JOIN labels_n)
      LEFT JOIN present USING (featureIndex, category)),
    observed AS (SELECT * FROM seen UNION ALL SELECT * FROM zero),
    row_totals AS (SELECT featureIndex, value, sum(o) AS r FROM observed GROUP BY ALL HAVING sum(o) > 0),
    expected AS (
      SELECT featureIndex, value, category, r * col / n AS e
      FROM row_totals CROSS JOIN labels_n CROSS JOIN total),
    statistics AS (
      SELECT featureIndex,
             sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) AS exact, round(exact, 6) AS statistic,
             ((count(DISTINCT value) - 1) * ((SELECT count(*) FROM labels_n) - 1))::INTEGER AS degreesOfFreedom
      FROM expected LEFT JOIN observed USING (featureIndex, value, category)
      GROUP BY featureIndex),
    ranked AS (
      SELECT featureIndex, term, statistic FROM statistics JOIN vocab USING (featureIndex)
      ORDER BY statistic DESC, term LIMIT {settings.VOCABULARY_SIZE}),
    selected AS (
      SELECT featureIndex, statistic, degreesOfFreedom FROM statistics
      ORDER BY statistic DESC, featureIndex LIMIT {settings.SELECTED_FEATURES})"""

# Even degrees of freedom 2m: the tail is a sum of m Poisson terms.
_P_VALUE_CTES = f"""
    documents AS (SELECT conv_id || ':' || turn AS doc_id, role AS lang, text FROM conversations),
    {_STATISTIC_CTES},
    p_values AS (
      SELECT featureIndex, statistic, degreesOfFreedom,
             CASE WHEN exact <= 0 THEN 1.0 ELSE least(1.0, list_sum(list_transform(range(0, degreesOfFreedom // 2),
               lambda i: exp(i * ln(exact / 2) - exact / 2 - lgamma(i + 1))))) END AS exact_p, round(exact_p, 6) AS pValue
      FROM statistics WHERE degreesOfFreedom > 0)"""

_SCALED_CTES = f"""{_FEATURE_CTES},
    spread AS (
      SELECT featureIndex,
             sqrt((sum(w * w) - sum(w) * sum(w) / (SELECT count(*) FROM docs)) / ((SELECT count(*) FROM docs) - 1)) AS std
      FROM weights GROUP BY featureIndex),
    scaled AS (SELECT doc_id, featureIndex, w / std AS s FROM weights JOIN spread USING (featureIndex) WHERE std > 0)"""

_PLACE = "('0x' || substr(md5('42:' || doc_id::VARCHAR), 1, 8))::BIGINT"
_PARTS = f"""
    parts AS (
      SELECT doc_id, lang AS category,
             CASE WHEN {_PLACE} < 3435973836 THEN 'train' WHEN {_PLACE} < 3865470566 THEN 'validation' ELSE 'test' END AS part
      FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL)"""

_LABELS = """
    labelled AS (
      SELECT category, (row_number() OVER (ORDER BY count(*) DESC, category) - 1)::DOUBLE AS label FROM parts GROUP BY category)"""

def _drawn(table: str, seed: int, names: tuple[str, ...], shares: tuple[str, ...]) -> str:
    """A draw of exact sizes: rows in the order of hash and key, cut at ranks."""
    place = f"('0x' || substr(md5('{seed}:' || doc_id::VARCHAR), 1, 8))::BIGINT"
    cases = " ".join(f"WHEN r < {share} THEN '{name}'" for name, share in zip(names, shares))
    return f"""
    SELECT doc_id, CASE {cases} ELSE '{names[-1]}' END AS part
    FROM (SELECT *, row_number() OVER (ORDER BY {place}, doc_id::VARCHAR) - 1 AS r, count(*) OVER () AS n FROM {table})"""


_DRAWN = f"""
    usable AS (SELECT doc_id, lang AS category FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
    drawn AS ({_drawn("usable", 42, ("train", "validation", "test"), ("n * 8 // 10", "n * 9 // 10"))}),
    merged AS (SELECT doc_id FROM drawn WHERE part <> 'test'),
    again AS ({_drawn("merged", 43, ("train", "validation"), ("n * 8 // 9",))})"""

# Vocabulary and weights from the training part; the test part's terms keep their names.
_HELDOUT_CTES = f"""
    everything AS ({_terms(FEATURE_DELIMITERS)}),
    {_PARTS},
    learnt AS (SELECT everything.* FROM everything JOIN parts USING (doc_id) WHERE part = 'train'),
    tested AS (SELECT everything.* FROM everything JOIN parts USING (doc_id) WHERE part = 'test'),
    frequent AS (
      SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM learnt
      GROUP BY term HAVING count(DISTINCT doc_id) >= {settings.MIN_DOCUMENTS}),
    vocab AS (
      SELECT (row_number() OVER (ORDER BY n DESC, term ASC) - 1)::INTEGER AS featureIndex, term,
             ln(((SELECT count(*) FROM parts WHERE part = 'train') + 1.0) / (df + 1.0)) AS idf
      FROM frequent QUALIFY featureIndex < {settings.VOCABULARY_SIZE})"""

_RECORDS = """
    SELECT doc_id, lang AS category, md5(text) AS digest
    FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL"""


def _f1(pairs: str) -> str:
    return f"""
    WITH pairs AS ({pairs}),
    actual AS (SELECT label, count(*) AS n FROM pairs GROUP BY label),
    guessed AS (SELECT prediction AS label, count(*) AS m FROM pairs GROUP BY prediction),
    hits AS (SELECT label, count(*) AS tp FROM pairs WHERE label = prediction GROUP BY label)
    SELECT sum(n)::BIGINT AS rows,
           round(sum(n * 2.0 * coalesce(tp, 0) / (n + coalesce(m, 0)))::DOUBLE / sum(n)::DOUBLE, 6) AS f1
    FROM actual LEFT JOIN guessed USING (label) LEFT JOIN hits USING (label)"""


def _values(numbers) -> str:
    return "(VALUES " + ", ".join(f"({value})" for value in numbers) + ")"


_GRID = " UNION ALL ".join(
    f"""SELECT {k} AS numTopFeatures, count(*) AS n_features, min(statistic) AS lowest_statistic
    FROM (SELECT statistic FROM statistics ORDER BY statistic DESC, featureIndex LIMIT {k})"""
    for k in settings.GRID_FEATURES
)

ORACLES = {
    "json_parse": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               json_extract_string(props, '$.k') AS k_text, true AS parsed
        FROM events""",
    "json_rejects": """
        WITH d AS (SELECT count(*) AS n, count(*) FILTER (lang IS NULL) AS unlabelled,
                          count(*) FILTER (lang IS NOT NULL AND text IS NULL) AS empty FROM documents),
             p AS (SELECT count(*) AS n FROM pages)
        SELECT 2 * d.n + p.n AS lines, p.n AS unparsable, 2 * unlabelled AS no_category,
               d.n - unlabelled + empty AS no_text, d.n - unlabelled - empty AS kept
        FROM d, p""",
    "rejected_lines": """
        WITH lines AS (
          SELECT CASE WHEN lang IS NULL THEN 'no_category' WHEN text IS NULL THEN 'no_text' ELSE 'kept' END AS reason,
                 '' AS line, doc_id, lang, text FROM documents)
        SELECT 'kept' AS reason, '' AS digest, count(*) AS n, count(*) AS positions FROM lines WHERE reason = 'kept'
        UNION ALL
        SELECT 'no_text', md5('{"category":"' || lang || '","doc_id":' || doc_id || '}'), count(*), count(*)
        FROM documents WHERE lang IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT 'no_category', md5('{"reviewText":"' || replace(replace(replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n'), chr(9), '\\t'), chr(13), '\\r') || '"}'), count(*), count(*)
        FROM documents WHERE text IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT 'unparsable', md5(translate(html, chr(13) || chr(10), '  ')), count(*), count(*) FROM pages GROUP BY ALL""",
    "text_scan": _RECORDS,
    "json_scan": _RECORDS,
    "stopword_table": f"""
        SELECT term, count(*) AS n FROM ({_exploded(TERM_DELIMITERS, "lang")})
        WHERE term IN {_STOP} GROUP BY term""",
    "tokens_task1": _terms(TERM_DELIMITERS),
    "tokens_task2": f"""
        SELECT doc_id, len(terms)::INTEGER AS n_terms, array_to_string(terms, ' ') AS terms FROM (
          SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {_quoted(FEATURE_DELIMITERS)}),
                                     lambda x: length(x) >= 2 AND x NOT IN {_STOP}) AS terms
          FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL)""",
    "stopword_file": f"WITH {_freq_ctes()} SELECT * FROM freq",
    "stopword_anti_join": f"""
        WITH stop(term) AS (VALUES {", ".join(f"({_quoted(word)})" for word in settings.STOP_WORDS)}),
        exploded AS ({_exploded(TERM_DELIMITERS, "lang")})
        SELECT category, term, count(*) AS freq_ct FROM exploded ANTI JOIN stop USING (term)
        WHERE length(term) >= 2 GROUP BY category, term""",
    "term_freq": f"WITH {_freq_ctes()} SELECT * FROM freq",
    "term_total": f"WITH {_freq_ctes()} SELECT term, sum(freq_ct)::BIGINT AS term_total FROM freq GROUP BY term",
    "category_total": f"""
        WITH {_freq_ctes()} SELECT category, sum(freq_ct)::BIGINT AS category_total FROM freq GROUP BY category""",
    "grand_total": f"WITH {_freq_ctes()} SELECT sum(freq_ct)::BIGINT AS grand_total, count(*) AS pairs FROM freq",
    "marginals_grouping_sets": f"""
        WITH {_freq_ctes()}
        SELECT category, term, sum(freq_ct)::BIGINT AS n, grouping(category, term)::INTEGER AS level
        FROM freq GROUP BY GROUPING SETS ((category, term), (category), (term), ())""",
    "chi2_scores": f"WITH {_score_ctes()} SELECT * FROM scores",
    "chi2_broadcast_join": f"WITH {_score_ctes()} SELECT * FROM scores",
    "chi2_shuffle_join": f"WITH {_score_ctes()} SELECT * FROM scores",
    "topk_terms": f"WITH {_top_ctes()} SELECT * FROM top",
    "topk_terms_by_source": f"WITH {_top_ctes('source')} SELECT * FROM top",
    "topk_lists": f"""
        WITH {_top_ctes()}
        SELECT category, count(*)::INTEGER AS n, string_agg(term, ' ' ORDER BY rank) AS terms FROM top GROUP BY category""",
    "clean_terms": f"WITH {_freq_ctes()} {_DICTIONARY}",
    "merged_dictionary": f"WITH {_freq_ctes()} {_DICTIONARY} ORDER BY term",
    "category_lines": f"""
        WITH {_top_ctes()}, dictionary AS ({_DICTIONARY})
        SELECT 0 AS section, category, line FROM ({_LINES})
        UNION ALL
        SELECT 1, NULL, term FROM dictionary""",
    "report_from_json": f"WITH {_top_ctes()} {_LINES}",
    "text_sink_roundtrip": f"WITH {_top_ctes()} SELECT * FROM top",
    "doc_freq": f"WITH {_FEATURE_CTES} SELECT term, n, df FROM frequent",
    "vocabulary": f"WITH {_FEATURE_CTES} SELECT * FROM vocab",
    "term_counts": f"WITH {_FEATURE_CTES} SELECT doc_id, featureIndex, tf AS weight FROM tf",
    "idf_weights": f"WITH {_FEATURE_CTES} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf": f"WITH {_FEATURE_CTES} SELECT doc_id, featureIndex, round(w, 6) AS weight FROM weights",
    "feature_pipeline": f"""
        WITH {_FEATURE_CTES},
        labels AS (SELECT category, (row_number() OVER (ORDER BY count(*) DESC, category) - 1)::DOUBLE AS label
                   FROM docs GROUP BY category)
        SELECT doc_id, label, term, round(count(*) * ln(((SELECT count(*) FROM docs) + 1.0) / (df + 1.0)), 6) AS weight
        FROM tokens JOIN vocab USING (term) JOIN labels USING (category) GROUP BY doc_id, label, term, df
        HAVING df < (SELECT count(*) FROM docs)""",
    "count_vectorizer": f"""
        WITH {_FEATURE_CTES},
        cut AS (SELECT CASE WHEN count(*) >= {settings.VOCABULARY_SIZE} THEN min(n) ELSE 0 END AS least FROM vocab)
        SELECT term, n FROM vocab WHERE n > (SELECT least FROM cut)""",
    "label_index": """
        SELECT category, n, (row_number() OVER (ORDER BY n DESC, category ASC) - 1)::DOUBLE AS label
        FROM (SELECT lang AS category, count(*) AS n FROM documents
              WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang)""",
    "label_index_by_source": """
        SELECT category, n, (row_number() OVER (ORDER BY n DESC, category ASC) - 1)::DOUBLE AS label
        FROM (SELECT source AS category, count(*) AS n FROM documents
              WHERE source IS NOT NULL AND text IS NOT NULL GROUP BY source)""",
    "labelled_rows": """
        WITH numbers AS (
          SELECT category, (row_number() OVER (ORDER BY count(*) DESC, category) - 1)::DOUBLE AS label
          FROM (SELECT source AS category FROM documents WHERE source IS NOT NULL AND text IS NOT NULL) GROUP BY category)
        SELECT doc_id, category, label FROM (
          SELECT doc_id, source AS category FROM documents WHERE source IS NOT NULL AND text IS NOT NULL) JOIN numbers USING (category)""",
    "heldout_tfidf": f"""
        WITH {_HELDOUT_CTES}
        SELECT doc_id, featureIndex, round(count(*) * any_value(idf), 6) AS weight
        FROM tested JOIN vocab USING (term) WHERE idf <> 0 GROUP BY doc_id, featureIndex""",
    "heldout_vocabulary": f"""
        WITH {_HELDOUT_CTES}
        SELECT parts.doc_id, count(tested.term)::INTEGER AS n_terms, (count(tested.term) - count(vocab.term))::INTEGER AS n_unknown
        FROM parts LEFT JOIN tested USING (doc_id) LEFT JOIN vocab USING (term) WHERE part = 'test' GROUP BY parts.doc_id""",
    "feature_chi2": f"WITH {_STATISTIC_CTES} SELECT featureIndex, statistic, degreesOfFreedom FROM statistics",
    "feature_chi2_test": f"WITH {_P_VALUE_CTES} SELECT * EXCLUDE (exact_p) FROM p_values",
    "feature_p_values": f"WITH {_P_VALUE_CTES} SELECT * EXCLUDE (exact_p) FROM p_values",
    "select_by_pvalue": f"""
        WITH {_P_VALUE_CTES} SELECT * EXCLUDE (exact_p) FROM p_values ORDER BY exact_p, featureIndex LIMIT {settings.SELECTED_FEATURES}""",
    "feature_chi2_rank": f"WITH {_STATISTIC_CTES} SELECT term, statistic FROM ranked",
    "score_sink_roundtrip": f"""
        WITH {_STATISTIC_CTES} SELECT term || chr(9) || printf('%.6f', statistic) AS line FROM ranked""",
    "top_feature": f"WITH {_STATISTIC_CTES} SELECT term, statistic FROM ranked LIMIT 1",
    "select_by_statistic": f"WITH {_STATISTIC_CTES} SELECT * FROM selected",
    "scaled_features": f"WITH {_SCALED_CTES} SELECT doc_id, featureIndex, round(s, 6) AS weight FROM scaled",
    "l2_features": f"""
        WITH {_SCALED_CTES}
        SELECT doc_id, featureIndex, round(s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)), 6) AS weight FROM scaled""",
    "stable_split": f"WITH {_PARTS} SELECT * FROM parts",
    "model_roundtrip": f"WITH {_PARTS} SELECT doc_id, true AS same FROM parts WHERE part = 'test'",
    "random_split": """
        SELECT doc_id, lang AS category, true AS same FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL""",
    "random_split_sizes": """
        SELECT part, (SELECT count(*) FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL) AS rows, true AS in_bounds
        FROM (VALUES ('train'), ('validation'), ('test')) p(part)""",
    "drawn_split": f"""
        WITH {_DRAWN}
        SELECT doc_id, category, drawn.part, again.part AS tuning_part
        FROM usable JOIN drawn USING (doc_id) LEFT JOIN again USING (doc_id)""",
    "random_tuning": f"""
        WITH {_DRAWN}
        SELECT 2000 AS numTopFeatures, withStd, regParam::DOUBLE AS regParam, maxIter,
               (SELECT count(*) FROM again WHERE part = 'train') AS train,
               (SELECT count(*) FROM again WHERE part = 'validation') AS validation, true AS same
        FROM (VALUES (true), (false)) s(withStd) CROSS JOIN (VALUES (0.01), (0.1), (1.0)) g(regParam)
        CROSS JOIN (VALUES (5), (10)) i(maxIter)""",
    "raw_text_scores": "SELECT doc_id, true AS same, true AS named FROM documents",
    "svm_predictions": f"""
        WITH {_PARTS}, {_LABELS}
        SELECT doc_id, label, true AS agrees FROM parts JOIN labelled USING (category) WHERE part = 'test'""",
    "tuning_metrics": """
        SELECT 2000 AS numTopFeatures, withStd, regParam::DOUBLE AS regParam, maxIter, true AS same
        FROM (VALUES (true), (false)) s(withStd) CROSS JOIN (VALUES (0.01), (0.1), (1.0)) g(regParam)
        CROSS JOIN (VALUES (5), (10)) i(maxIter)""",
    "best_params": f"""
        WITH {_PARTS}, {_LABELS}, guessed AS ({_f1(f"""
          SELECT label, 0.0::DOUBLE AS prediction FROM parts JOIN labelled USING (category) WHERE part = 'test'""")})
        SELECT rows, f1 AS guess_f1, true AS beats_guess, true AS is_best FROM guessed""",
    "train_val_union": f"WITH {_PARTS} SELECT doc_id, category FROM parts WHERE part IN ('train', 'validation')",
    "param_grid": f"""
        WITH {_STATISTIC_CTES}, chosen AS ({_GRID})
        SELECT numTopFeatures, withStd, regParam::DOUBLE AS regParam, maxIter, n_features, lowest_statistic
        FROM chosen CROSS JOIN {_values(settings.GRID_STD)} s(withStd)
        CROSS JOIN {_values(settings.GRID_REG)} g(regParam) CROSS JOIN {_values(settings.GRID_ITER)} i(maxIter)""",
    "weighted_f1": _f1("""
        SELECT lang AS label,
               CASE WHEN contains(lower(text), ' der ') THEN 'de' WHEN contains(lower(text), ' les ') THEN 'fr'
                    WHEN contains(lower(text), ' los ') THEN 'es' ELSE 'en' END AS prediction
        FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL"""),
    "weighted_f1_binary": _f1("SELECT quality AS label, toxic AS prediction FROM labels"),
}
