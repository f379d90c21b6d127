"""The queries as DuckDB SQL over the given tables, written apart from the Spark code."""

from __future__ import annotations

from reviewlens.functions.text import DOMAIN_STOPWORDS_LONG, DOMAIN_STOPWORDS_SHORT

# Spark's English stop words.
ENGLISH = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll "
    "we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've "
    "they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's "
    "who's why's would"
).split()
DOMAIN_LONG, DOMAIN_SHORT = list(DOMAIN_STOPWORDS_LONG), list(DOMAIN_STOPWORDS_SHORT)


def _words(*lists: list[str]) -> str:
    quoted = sorted({word for words in lists for word in words})
    return ", ".join("'" + word.replace("'", "''") + "'" for word in quoted)


SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"

CTES = {
    "reviews": """SELECT d.doc_id, d.text AS Review, CAST(1 + 3 * l.quality + (1 - l.toxic) AS DOUBLE) AS Rating,
        d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "raw_reviews": """SELECT d.doc_id,
            CASE WHEN d.source = 'src7' THEN '   ' WHEN d.source = 'src3' THEN '  ' || d.text || ' '
                 WHEN d.source <> 'src11' THEN d.text END AS Review,
            CASE WHEN d.source = 'src5' THEN 'n/a'
                 ELSE CAST(CAST(1 + 3 * l.quality + (1 - l.toxic) AS DOUBLE) AS VARCHAR) END AS Rating
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        UNION ALL SELECT doc_id, Review, CAST(Rating AS VARCHAR) FROM reviews""",
    "cleaned": """SELECT trim(Review, ' ') AS Review, try_cast(Rating AS DOUBLE) AS Rating
        FROM (SELECT DISTINCT Review, Rating FROM raw_reviews WHERE Review IS NOT NULL AND Rating IS NOT NULL)
        WHERE trim(Review, ' ') <> '' AND try_cast(Rating AS DOUBLE) IS NOT NULL""",
    "labelled": """SELECT *, CASE WHEN Rating >= 3.0 THEN 'positive' ELSE 'negative' END AS Sentiment FROM reviews""",
    "split": """SELECT *, CAST(('0x' || substr(md5(Review || '|' || CAST(Rating AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)
        AS split_key FROM labelled""",
    "sided": "SELECT *, CASE WHEN split_key < 80 THEN 'train' ELSE 'test' END AS split FROM split",
    "predictions": """SELECT doc_id, quality AS label, CAST(n_chars > 1500 AS INTEGER) AS prediction,
        n_chars / (n_chars + 1500.0::DOUBLE) AS score FROM reviews""",
    "by_method": """SELECT 'cut_' || cut AS Method, quality AS label, CAST(n_chars > cut AS INTEGER) AS prediction
        FROM reviews, (VALUES (500), (1500), (5000)) m(cut)""",
    "scores": """SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS label, value AS score,
        CAST(value > 20 AS INTEGER) AS prediction FROM events""",
    "texts": """SELECT doc_id, CASE lang WHEN 'fr' THEN ' ' || upper(Sentiment[1]) || Sentiment[2:] || ' '
        WHEN 'de' THEN upper(Sentiment) WHEN 'es' THEN 'mixed' ELSE Sentiment END AS Sentiment, Review, Rating
        FROM labelled""",
    "clean_words": f"""SELECT doc_id, regexp_extract_all(regexp_replace(lower(text),
        'http[^{SPACE}]+|www[^{SPACE}]+', ' ', 'g'), '[a-z]+') AS words FROM documents""",
    "word_counts": "SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM clean_words) GROUP BY word",
    "lexicon": """SELECT word, embedding AS vector FROM word_counts JOIN embeddings
        ON vec_id = ('0x' || substr(md5(word), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) WHERE n >= 2""",
    "kept_tokens": f"""SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z]', ' ', 'g'), '\\s+'),
        lambda t: t <> '' AND t NOT IN ({_words(ENGLISH)})) AS tokens FROM documents""",
    "kept_terms": "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM kept_tokens) GROUP BY ALL",
    "kept_vocab": """SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM kept_terms GROUP BY term
        HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 10000""",
}
NEEDS = {
    "raw_reviews": ["reviews"],
    "cleaned": ["raw_reviews"],
    "labelled": ["reviews"],
    "split": ["labelled"],
    "sided": ["split"],
    "predictions": ["reviews"],
    "by_method": ["reviews"],
    "texts": ["labelled"],
    "word_counts": ["clean_words"],
    "lexicon": ["word_counts"],
    "kept_terms": ["kept_tokens"],
    "kept_vocab": ["kept_terms"],
}


def _with(select: str, *ctes: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in ctes:
        add(name)
    parts = [f"{name} AS ({CTES[name]})" for name in ordered]
    parts += [f"{name} AS ({body})" for name, body in (extra or {}).items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {select}" if parts else select


def _checksum(array: str) -> str:
    return f"round(list_sum(list_transform({array}, lambda x, i: CAST(x AS DOUBLE) * i)), 6)"


def _tokens(array: str) -> str:
    return f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {array} AS t FROM documents)"


def _metric_rows(source: str, digits: int, by: str = "Method") -> str:
    """Accuracy and support-weighted precision, recall and F1 per ``by`` from 0/1 columns."""
    return f"""SELECT *, round((TN + TP) / n, {digits}) AS Accuracy,
        round(((TN + FP) * p0 + (FN + TP) * p1) / n, {digits}) AS Precision,
        round(((TN + FP) * r0 + (FN + TP) * r1) / n, {digits}) AS Recall,
        round(((TN + FP) * neg_f1 + (FN + TP) * pos_f1) / n, {digits}) AS F1
      FROM (SELECT *, coalesce(TN / nullif(TN + FN, 0), 0) AS p0, coalesce(TP / nullif(TP + FP, 0), 0) AS p1,
              coalesce(TN / nullif(TN + FP, 0), 0) AS r0, coalesce(TP / nullif(TP + FN, 0), 0) AS r1,
              coalesce(2 * TN / nullif(2 * TN + FN + FP, 0), 0) AS neg_f1,
              coalesce(2 * TP / nullif(2 * TP + FN + FP, 0), 0) AS pos_f1
            FROM (SELECT {by}, count(*) AS n,
                    count(*) FILTER (label = 0 AND prediction = 0) AS TN, count(*) FILTER (label = 0 AND prediction = 1) AS FP,
                    count(*) FILTER (label = 1 AND prediction = 0) AS FN, count(*) FILTER (label = 1 AND prediction = 1) AS TP
                  FROM {source} GROUP BY {by}))"""


def _keywords(stop: list[str], k: int | None, class_name: bool) -> str:
    same = "AND word <> lower(label)" if class_name else ""
    counted = f"""SELECT label, word, count(*) AS value
        FROM (SELECT Sentiment AS label, unnest(regexp_extract_all(lower(Review), '[a-z]{{3,}}')) AS word FROM labelled)
        WHERE word NOT IN ({_words(stop)}) {same} GROUP BY label, word"""
    if k is None:
        return _with(counted, "labelled")
    ranked = f"""SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY value DESC, word) AS INTEGER) AS rank
        FROM ({counted})"""
    return _with(f"SELECT * FROM ({ranked}) WHERE rank <= {k}", "labelled")


def _tfidf_test(tokens: str) -> str:
    """TF-IDF fitted on the train side, applied to the test side."""
    extra = {
        "toks": f"SELECT doc_id, split, unnest({tokens}) AS term FROM sided",
        "terms": f"SELECT doc_id, split, term, count(*) AS tf FROM toks WHERE term <> '' AND term NOT IN ({_words(ENGLISH)}) GROUP BY ALL",
        "vocab": """SELECT term, sum(tf) AS n, count(*) AS df FROM terms WHERE split = 'train' GROUP BY term
            HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 10000""",
    }
    return _with(
        """SELECT doc_id, term, round(tf * ln(((SELECT count(*) FROM sided WHERE split = 'train') + 1) / (df + 1)), 6) AS value
        FROM terms JOIN vocab USING (term) WHERE split = 'test'""",
        "sided",
        extra=extra,
    )


def _bigrams() -> str:
    extra = {
        "uni": "SELECT doc_id, regexp_extract_all(lower(Review), '[\\p{L}\\p{N}_]{2,}') AS w FROM reviews",
        "toks": """SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
            FROM uni""",
        "terms": "SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL",
        "vocab": """SELECT term, sum(tf) AS n, count(*) AS df FROM terms GROUP BY term
            HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 10000""",
        "raw": """SELECT doc_id, term, tf * (ln(((SELECT count(*) FROM reviews) + 1) / (df + 1)) + 1) AS v
            FROM terms JOIN vocab USING (term)""",
    }
    return _with(
        "SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS value FROM raw",
        "reviews",
        extra=extra,
    )


def _payload() -> str:
    stats = {
        "trainSamples": "count(*) FILTER (split = 'train')",
        "testSamples": "count(*) FILTER (split = 'test')",
        "negativeCount": "count(*) FILTER (label = 0)",
        "positiveCount": "count(*) FILTER (label = 1)",
        "meanWordCount": "round(avg(w), 2)",
        "varianceWordCount": "round(var_samp(w), 2)",
        "stdWordCount": "round(stddev_samp(w), 2)",
        "medianWordCount": "round(median(w), 2)",
    }
    extra = {
        "items": f"""SELECT Review AS text, CAST(Sentiment = 'positive' AS INTEGER) AS label, Sentiment, split,
            len(list_filter(string_split_regex(Review, '[{SPACE}]+'), lambda x: x <> '')) AS w FROM sided""",
        "results": _metric_rows("by_method", 4),
        "counted": f"""SELECT Sentiment AS label, word, count(*) AS value
            FROM (SELECT Sentiment, unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) AS word FROM items WHERE split = 'train')
            WHERE word NOT IN ({_words(ENGLISH, DOMAIN_LONG)}) AND word <> Sentiment GROUP BY ALL""",
        "ranked": "SELECT *, row_number() OVER (PARTITION BY label ORDER BY value DESC, word) AS rank FROM counted",
    }
    parts = [f"SELECT 'stats.{name}' AS path, CAST({sql} AS DOUBLE) AS value FROM items" for name, sql in stats.items()]
    parts += [
        "SELECT 'class.Negative', CAST(count(*) FILTER (label = 0) AS DOUBLE) FROM items",
        "SELECT 'class.Positive', CAST(count(*) FILTER (label = 1) AS DOUBLE) FROM items",
    ]
    for field in ("classicModels", "embeddingModels"):
        for name in ("Accuracy", "Precision", "Recall", "F1"):
            parts.append(f"SELECT '{field}.{name.lower()}.' || Method, CAST({name} AS DOUBLE) FROM results")
    for name in ("TN", "FP", "FN", "TP"):
        parts.append(f"SELECT 'matrix.{name.lower()}.' || Method, CAST({name} AS DOUBLE) FROM results")
    parts.append("SELECT label || 'Keywords.' || rank || '.' || word, CAST(value AS DOUBLE) FROM ranked WHERE rank <= 120")
    return _with(" UNION ALL ".join(parts), "sided", "by_method", extra=extra)


_SWEEP = {
    "s": "SELECT label, score / (score + 30.0::DOUBLE) AS p FROM scores",
    "t": "SELECT i AS position, 0.3::DOUBLE + i * ((0.3::DOUBLE + 0.02::DOUBLE) - 0.3::DOUBLE) AS threshold FROM range(21) r(i)",
    "c": """SELECT position, threshold, count(*) FILTER (label = 1 AND p >= threshold) AS tp,
        count(*) FILTER (label = 0 AND p >= threshold) AS fp, count(*) FILTER (label = 1 AND p < threshold) AS fn,
        count(*) FILTER (label = 0 AND p < threshold) AS tn FROM s, t GROUP BY ALL""",
    "f": """SELECT position, threshold, ((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)
        + (tn + fp) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / (tp + fp + fn + tn) AS f1 FROM c""",
}


def _smote() -> str:
    def hashed(purpose: str) -> str:
        return f"('0x' || substr(md5('42|' || draw || '|{purpose}'), 1, 13))::BIGINT"

    return f"""WITH rare AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY md5('42|' || vec_id), vec_id) - 1 AS position
            FROM embeddings WHERE label = 0),
        sizes AS (SELECT count(*) FILTER (label = 0) AS small, count(*) FILTER (label <> 0) AS large FROM embeddings),
        near AS (SELECT a.vec_id AS base, b.vec_id AS neighbor, row_number() OVER (PARTITION BY a.vec_id ORDER BY
            list_sum(list_transform(list_zip(a.embedding, b.embedding),
                lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), b.vec_id) AS rank
            FROM rare a JOIN rare b ON a.vec_id <> b.vec_id),
        draws AS (SELECT draw, {hashed("base")} % small AS position,
            {hashed("neighbor")} % least(5, small - 1) + 1 AS rank, {hashed("gap")} / 4503599627370496.0::DOUBLE AS gap
            FROM sizes, range((SELECT large - small FROM sizes)) r(draw)),
        mixed AS (SELECT draw, r.vec_id AS base, near.neighbor, gap,
            list_transform(list_zip(r.embedding, e.embedding),
                lambda p: p[1]::DOUBLE + gap * (p[2]::DOUBLE - p[1]::DOUBLE)) AS v
            FROM draws JOIN rare r USING (position) JOIN near ON near.base = r.vec_id AND near.rank = draws.rank
            JOIN embeddings e ON e.vec_id = near.neighbor)
        SELECT draw, base, neighbor, round(gap, 6) AS gap, {_checksum("v")} AS total FROM mixed"""


def _curve(select: str) -> str:
    extra = {
        "d": "SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scores GROUP BY score",
        "c": """SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM d""",
    }
    return _with(select, "scores", extra=extra)


def statements() -> dict[str, str]:
    embed = f"regexp_replace(lower(text), 'http[^{SPACE}]+|www[^{SPACE}]+', ' ', 'g')"
    spaces = r"'\s+'"
    clean = r"regexp_replace(lower(text), '[^a-zA-Z\s]', ' ', 'g')"
    per_method = _metric_rows("by_method", 4)
    columns = "Method, Accuracy, Precision, Recall, F1, TN, FP, FN, TP"
    notebook = {
        model: (f"(n_chars + {add}) % 10000", f"(n_chars * 3 + {add}) % 10000", f"(n_chars * 7 + {add}) % 10000", f"(n_chars * 11 + {add}) % 10000")
        for model, add in (("Word2Vec", 1), ("GloVe", 2), ("BERT", 3))
    }
    sql = {
        "scan_csv_reviews": _with("SELECT Review, Rating FROM raw_reviews", "raw_reviews"),
        "scan_parquet_vectors": f"SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, {_checksum('embedding')} AS total FROM embeddings",
        "scan_word_vectors_text": _with(
            f"SELECT word, CAST(len(vector) AS INTEGER) AS dims, {_checksum('vector')} AS total FROM lexicon", "lexicon"
        ),
        "scan_notebook_metrics": " UNION ALL ".join(
            f"SELECT CAST(doc_id AS VARCHAR) AS notebook, '{model}' AS model, round(({a}) / 10000, 4) AS accuracy, "
            f"round(({p}) / 10000, 4) AS precision, round(({r}) / 10000, 4) AS recall, round(({f}) / 10000, 4) AS f1 FROM documents"
            for model, (a, p, r, f) in notebook.items()
        ),
        "rows_to_frame": f"SELECT CAST(vec_id AS VARCHAR) AS text, label AS Sentiment, {_checksum('embedding')} AS total FROM embeddings",
        "sink_csv_splits": _with("SELECT Review, Rating, Sentiment, split FROM sided", "sided"),
        "sink_parquet_vectors": f"SELECT vec_id, label, {_checksum('embedding')} AS total FROM embeddings",
        "sink_results_csv": _with(f"SELECT {columns} FROM ({per_method})", "by_method"),
        "sink_payload_json": _payload(),
        "dataset_payload": _payload(),
        "load_or_skip_inputs": """SELECT 'documents' AS input, count(*) AS n FROM documents
            UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'embeddings', count(*) FROM embeddings""",
        "project_review_cols": _with("SELECT Review, Rating FROM raw_reviews", "raw_reviews"),
        "drop_missing": _with(
            "SELECT doc_id, Review, Rating FROM raw_reviews WHERE Review IS NOT NULL AND Rating IS NOT NULL", "raw_reviews"
        ),
        "dedup_reviews": _with("SELECT DISTINCT Review, Rating FROM raw_reviews", "raw_reviews"),
        "trim_nonempty": _with(
            "SELECT doc_id, trim(Review, ' ') AS Review, Rating FROM raw_reviews WHERE trim(Review, ' ') <> ''", "raw_reviews"
        ),
        "cast_rating": _with(
            """SELECT doc_id, Review, try_cast(Rating AS DOUBLE) AS Rating FROM raw_reviews
            WHERE try_cast(Rating AS DOUBLE) IS NOT NULL""",
            "raw_reviews",
        ),
        "clean_reviews": _with("SELECT Review, Rating FROM cleaned", "cleaned"),
        "label_from_rating": """SELECT doc_id, stars AS Rating, CASE WHEN stars >= 3 THEN 'positive' ELSE 'negative' END AS three_positive,
            CASE WHEN stars > 3 THEN 'positive' ELSE 'negative' END AS three_negative
            FROM (SELECT doc_id, CAST(2 + quality + (1 - toxic) AS DOUBLE) AS stars FROM labels JOIN documents USING (doc_id))""",
        "align_labels": _with(
            """SELECT doc_id, Review AS text, Rating, CASE lower(trim(Sentiment, ' ')) WHEN 'positive' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
            FROM texts WHERE lower(trim(Sentiment, ' ')) IN ('positive', 'negative')""",
            "texts",
        ),
        "binary_label": _with("SELECT doc_id, CAST(Sentiment = 'positive' AS INTEGER) AS label FROM texts", "texts"),
        "stable_split": _murmur_split(),
        "stable_split_md5": _with("SELECT doc_id, split_key, split FROM sided", "sided"),
        "random_split": """SELECT doc_id, CAST(('0x' || substr(md5('42|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 >= 0.8 AS INTEGER)
            AS part FROM documents""",
        "filter_by_label": _with("SELECT doc_id, Review, Rating FROM labelled WHERE Sentiment = 'negative'", "labelled"),
        "filter_empty_tokens": _with(
            f"""SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words FROM (SELECT doc_id,
            regexp_extract_all({embed.replace('text', 'Review')}, '[a-z]+') AS w FROM raw_reviews) WHERE len(w) > 0""",
            "raw_reviews",
        ),
        "confidence_filter": _with(
            """SELECT event_id, CASE WHEN p >= 0.95 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS final_label
            FROM (SELECT event_id, score / (score + 5.0) AS p FROM scores) WHERE p >= 0.95 OR p <= 0.05""",
            "scores",
        ),
        "rename_const_cols": "SELECT event_id, value AS rawPrediction, 1.0::DOUBLE AS final_label, 'events' AS method FROM events",
        "preview_rows": _with("SELECT doc_id, Review, Rating FROM reviews ORDER BY doc_id LIMIT 5", "reviews"),
        "clean_text_letters": f"SELECT doc_id, {clean} AS clean_text FROM documents",
        "clean_text_sql": "SELECT doc_id, regexp_replace(lower(text), '[^a-zA-Z]', ' ', 'g') AS clean_text FROM documents",
        "tokenize_whitespace": _tokens(f"list_filter(string_split_regex(lower(text), {spaces}), lambda x: x <> '')"),
        "tokenize_nonword": _tokens(r"list_filter(string_split_regex(lower(text), '\W+'), lambda x: x <> '')"),
        "remove_stopwords": _tokens(
            f"list_filter(string_split_regex({clean}, {spaces}), lambda x: x <> '' AND x NOT IN ({_words(ENGLISH)}))"
        ),
        "embed_clean_tokens": _tokens(f"regexp_extract_all({embed}, '[a-z]+')"),
        "embed_clean_string": f"SELECT doc_id, coalesce(trim(regexp_replace({embed}, '[^a-z]+', ' ', 'g'), ' '), '') AS clean_text FROM documents",
        "keyword_tokens": _tokens("regexp_extract_all(lower(text), '[a-z]{3,}')"),
        "word_count_clean": f"""SELECT doc_id, CAST(len(string_split_regex(trim({clean}, ' '), {spaces})) AS INTEGER) AS n_words FROM documents""",
        "word_count_raw": f"""SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '[{SPACE}]+'), lambda x: x <> '')) AS INTEGER)
            AS n_words FROM documents""",
        "ngrams_1_2": r"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS tokens FROM (
            SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents))""",
        "row_counts": _with(
            f"""SELECT (SELECT count(*) FROM raw_reviews) AS raw, (SELECT count(*) FROM p) AS present,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS "distinct", count(*) AS clean,
            count(*) FILTER (k < 80) AS train, count(*) FILTER (k >= 80) AS test,
            count(*) FILTER (len(regexp_extract_all({embed.replace('text', 'Review')}, '[a-z]+')) > 0) AS with_words FROM c""",
            "cleaned",
            extra={
                "p": "SELECT Review, Rating FROM raw_reviews WHERE Review IS NOT NULL AND Rating IS NOT NULL",
                "c": "SELECT *, ('0x' || substr(md5(Review || '|' || CAST(Rating AS VARCHAR)), 1, 8))::BIGINT % 100 AS k FROM cleaned",
            },
        ),
        "class_counts": _with(
            """SELECT Sentiment, count(doc_id) AS n FROM (VALUES ('negative'), ('neutral'), ('positive')) c(Sentiment)
            LEFT JOIN labelled USING (Sentiment) GROUP BY Sentiment""",
            "labelled",
        ),
        "class_share": _with(
            """SELECT count(*) FILTER (Sentiment = 'positive') AS positive, count(*) AS total,
            round(count(*) FILTER (Sentiment = 'positive') * 100.0::DOUBLE / count(*), 6) AS share_percent FROM labelled""",
            "labelled",
        ),
        "word_count_stats": f"""SELECT round(avg(w), 2) AS mean, round(var_samp(w), 2) AS variance,
            round(stddev_samp(w), 2) AS std, true AS median_near
            FROM (SELECT len(string_split_regex(trim({clean}, ' '), {spaces})) AS w FROM documents)""",
        "word_count_stats_exact": f"""SELECT round(avg(w), 2) AS mean, round(var_samp(w), 2) AS variance,
            round(stddev_samp(w), 2) AS std, round(CAST(median(w) AS DOUBLE), 2) AS median
            FROM (SELECT len(list_filter(string_split_regex(text, '[{SPACE}]+'), lambda x: x <> '')) AS w FROM documents)""",
        "class_weights": _with(
            """SELECT Sentiment, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
            FROM (SELECT Sentiment, count(*) AS n FROM labelled GROUP BY Sentiment)""",
            "labelled",
        ),
        "class_weight_rows": _with(
            """SELECT doc_id, round((SELECT count(*) FROM labelled) /
            ((SELECT count(DISTINCT Sentiment) FROM labelled) * count(*) OVER (PARTITION BY Sentiment)), 6) AS classWeight FROM labelled""",
            "labelled",
        ),
        "top_keywords": _keywords([*ENGLISH, *DOMAIN_LONG], 120, True),
        "top_keywords_24": _keywords([*ENGLISH, *DOMAIN_SHORT], 24, True),
        "keyword_counts": _keywords([*ENGLISH, *[w for w in DOMAIN_SHORT if w != "dont"]], None, False),
        "crosstab_predictions": _with(
            """SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1
            FROM predictions GROUP BY label""",
            "predictions",
        ),
        "confusion_matrix": _with(
            """SELECT count(*) FILTER (label = 0 AND prediction = 0) AS TN, count(*) FILTER (label = 0 AND prediction = 1) AS FP,
            count(*) FILTER (label = 1 AND prediction = 0) AS FN, count(*) FILTER (label = 1 AND prediction = 1) AS TP FROM scores""",
            "scores",
        ),
        "classification_report": _with(
            """SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(neg_f1, 6) AS f1, TN + FP AS support FROM m
            UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(pos_f1, 6), FN + TP FROM m
            UNION ALL SELECT 'accuracy', round((TN + TP) / n, 6), round((TN + TP) / n, 6), round((TN + TP) / n, 6), n FROM m
            UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((neg_f1 + pos_f1) / 2, 6), n FROM m
            UNION ALL SELECT 'weighted avg', round(Precision, 6), round(Recall, 6), round(F1, 6), n FROM m""",
            "predictions",
            extra={
                "named": "SELECT 'one' AS Method, label, prediction FROM predictions",
                "m": _metric_rows("named", 12),
            },
        ),
        "weighted_metrics": _with(f"SELECT Method, Accuracy, Precision, Recall, F1 FROM ({_metric_rows('by_method', 6)})", "by_method"),
        "by_label_metrics": _with(
            """SELECT Method, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
            FROM (SELECT Method, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
            count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM by_method GROUP BY Method)""",
            "by_method",
        ),
        "binary_metrics": _with(
            """SELECT round((TN + TP) / (TN + FP + FN + TP), 6) AS Accuracy, round(TP / (TP + FP), 6) AS Precision,
            round(TP / (TP + FN), 6) AS Recall, round(2 * TP / (2 * TP + FP + FN), 6) AS F1, TN, FP, FN, TP FROM (SELECT
            count(*) FILTER (label = 0 AND prediction = 0) AS TN, count(*) FILTER (label = 0 AND prediction = 1) AS FP,
            count(*) FILTER (label = 1 AND prediction = 0) AS FN, count(*) FILTER (label = 1 AND prediction = 1) AS TP FROM scores)""",
            "scores",
        ),
        "auc_roc": _with(
            """SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2) / (p * (n - p)), 6) AS auc FROM (SELECT label, p, n,
            rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r
            FROM scores, (SELECT sum(label)::DOUBLE AS p, count(*)::DOUBLE AS n FROM scores)) GROUP BY p, n""",
            "scores",
        ),
        "auc_pr": _curve(
            """SELECT round(sum(pos * (tp / (tp + fp) + coalesce(prev, tp / (tp + fp))) / 2) / sum(pos), 6) AS auc_pr
            FROM (SELECT *, lag(tp / (tp + fp)) OVER (ORDER BY score DESC) AS prev FROM c)"""
        ),
        "vocab_document_freq": _with("SELECT term, n, df FROM kept_vocab", "kept_vocab"),
        "compare_models": _with(f"SELECT {columns} FROM ({per_method})", "by_method"),
        "best_model": _with(
            f"SELECT Method, Accuracy, Precision, Recall, F1 FROM ({per_method}) ORDER BY F1 DESC, Accuracy DESC, Method LIMIT 1",
            "by_method",
        ),
        "unpivot_metrics": _with(
            """SELECT Method AS Model, 'Accuracy' AS Metric, Accuracy AS Score FROM m UNION ALL
            SELECT Method, 'Precision', Precision FROM m WHERE Method <> 'cut_500' UNION ALL
            SELECT Method, 'Recall', Recall FROM m UNION ALL SELECT Method, 'F1', F1 FROM m""",
            "by_method",
            extra={"m": f"SELECT {columns} FROM ({per_method})"},
        ),
        "union_pseudo_labels": _with(
            """SELECT event_id, label::DOUBLE AS final_label FROM scores UNION ALL
            SELECT event_id, CASE WHEN score / (score + 5.0) >= 0.95 THEN 1.0 ELSE 0.0 END FROM scores
            WHERE score / (score + 5.0) >= 0.95 OR score / (score + 5.0) <= 0.05""",
            "scores",
        ),
        "concat_splits": _with("SELECT doc_id, Review, Rating, Sentiment FROM labelled", "labelled"),
        "index_label": """SELECT doc_id, source, (SELECT label FROM (SELECT source AS s, (row_number() OVER (ORDER BY count(*) DESC, source) - 1)::DOUBLE
            AS label FROM documents GROUP BY source) WHERE s = documents.source) AS label FROM documents""",
        "count_vectorize": _with("SELECT doc_id, term, tf FROM kept_terms JOIN kept_vocab USING (term)", "kept_vocab"),
        "tfidf": _with(
            """SELECT doc_id, term, tf, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf
            FROM kept_terms JOIN kept_vocab USING (term)""",
            "kept_vocab",
        ),
        "text_features": _tfidf_test(r"string_split_regex(regexp_replace(lower(Review), '[^a-z]', ' ', 'g'), '\s+')"),
        "text_features_nonword": _tfidf_test(r"string_split_regex(lower(Review), '\W+')"),
        "tfidf_bigram_l2": _bigrams(),
        "tfidf_bigram_l2_long": _bigrams(),
        "word2vec_fit_transform": _with(
            """SELECT doc_id, CAST(Sentiment = 'positive' AS INTEGER) AS Sentiment, 100 AS dims, count(*) AS n,
            count(learned.word) AS known, true AS is_mean
            FROM (SELECT doc_id, Sentiment, unnest(words) AS word FROM sided JOIN clean_words USING (doc_id) WHERE split = 'test') t
            LEFT JOIN learned USING (word) GROUP BY doc_id, Sentiment""",
            "sided",
            "clean_words",
            extra={
                "learned": """SELECT word FROM (SELECT unnest(words) AS word FROM clean_words JOIN sided USING (doc_id)
                WHERE split = 'train') GROUP BY word HAVING count(*) >= 2"""
            },
        ),
        "word_vector_table": _with("SELECT word, 100 AS dims, true AS learned FROM word_counts WHERE n >= 2", "word_counts"),
        "pretrained_doc_vectors": _with(
            f"""SELECT doc_id, coalesce(round(sum(total) / count(total), 6), 0.0) AS total
            FROM (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [NULL] ELSE words END) AS word FROM clean_words)
            LEFT JOIN (SELECT word, {_checksum('vector').replace('round(', '(').replace(', 6)', ')')} AS total FROM lexicon) USING (word)
            GROUP BY doc_id""",
            "lexicon",
        ),
        "batch_encode_text": _with(
            """SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(count(word) AS DOUBLE) AS value
            FROM (SELECT doc_id, place FROM documents, range(16) r(place)) LEFT JOIN
                 (SELECT doc_id, word, ('0x' || substr(md5(word), 1, 8))::BIGINT % 16 AS place
                  FROM (SELECT doc_id, unnest(words) AS word FROM clean_words)) USING (doc_id, place)
            GROUP BY doc_id, place""",
            "clean_words",
        ),
        "batch_encode_truncated": _with(
            """SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(count(word) AS DOUBLE) AS value
            FROM (SELECT doc_id, place FROM documents, range(16) r(place)) LEFT JOIN
                 (SELECT doc_id, word, ('0x' || substr(md5(word), 1, 8))::BIGINT % 16 AS place
                  FROM (SELECT doc_id, unnest(words[1:128]) AS word FROM clean_words)) USING (doc_id, place)
            GROUP BY doc_id, place""",
            "clean_words",
        ),
        "dictionary_labels": """SELECT doc_id, source, CAST(id AS DOUBLE) AS label FROM documents JOIN
            (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS id FROM documents WHERE source IS NOT NULL GROUP BY source)
            USING (source)""",
        "dictionary_terms": _with(
            """SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS id
            FROM kept_terms GROUP BY term HAVING count(*) >= 2""",
            "kept_terms",
        ),
        "dictionary_tfidf": _with(
            """SELECT doc_id, CAST(id AS INTEGER) AS id, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS value
            FROM documents LEFT JOIN (SELECT doc_id, tf, id, df FROM kept_terms JOIN (
              SELECT term, count(*) AS df, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS id
              FROM kept_terms GROUP BY term HAVING count(*) >= 2) USING (term)) USING (doc_id)""",
            "kept_terms",
        ),
        "array_vector_convert": """SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(CAST(embedding[i] AS DOUBLE), 6) AS value
            FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
        "positive_probability": _with("SELECT event_id, round(score / (score + 5.0), 6) AS pos_prob FROM scores", "scores"),
        "margin_to_probability": _with(
            """SELECT event_id, round(1 / (1 + exp(-(score - 40) / 10)), 6) AS prob,
            round(1 / (1 + exp(-2 * (score - 40) / 10)), 6) AS prob_mllib FROM scores""",
            "scores",
        ),
        "soft_vote": _with(
            """SELECT event_id, round(p, 6) AS ensemble_prob, CAST(p >= 0.5 AS INTEGER) AS prediction FROM (SELECT event_id,
            0.35 * (score / (score + 5.0)) + 0.4 * (score / (score + 20.0)) + 0.25 * (score / (score + 80.0)) AS p FROM scores)""",
            "scores",
        ),
        "threshold_sweep": _with(
            "SELECT CAST(position AS INTEGER) AS position, round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM f",
            "scores",
            extra=_SWEEP,
        ),
        "best_threshold": _with(
            "SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, position LIMIT 1",
            "scores",
            extra=_SWEEP,
        ),
        "smote_oversample": _smote(),
        "smote_balance": """SELECT label, max(n) OVER () AS n, n AS original FROM (SELECT CAST(label = 0 AS INTEGER) AS label, count(*) AS n
            FROM embeddings GROUP BY ALL)""",
    }
    return sql | model_rows()


# --- murmur3 -------------------------------------------------------------------------------------

MASK = "4294967295"


def _times(a: str, constant: int) -> str:
    """The low 32 bits of a product, without leaving 64 bits."""
    return f"((({a}) * {constant & 65535} + ((({a}) * {constant >> 16}) & 65535) * 65536) & {MASK})"


def _turned(a: str, bits: int) -> str:
    return f"((({a} << {bits}) | ({a} >> {32 - bits})) & {MASK})"


def _folded(seed: str, words: str, size: str) -> str:
    """Murmur3 over a list of 32-bit words, ended by the number of bytes they stand for."""
    mixed = f"list_transform({words}, lambda k: {_times('k', 0xCC9E2D51)})"
    mixed = f"list_transform({mixed}, lambda k: {_times(_turned('k', 15), 0x1B873593)})"
    state = f"list_reduce(list_prepend({seed}, {mixed}), lambda h, k: ({_turned('xor(h, k)', 13)} * 5 + {0xE6546B64}) & {MASK})"
    end = f"xor({state}, {size})"
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        end = f"list_transform([{end}], lambda h: {_times(f'xor(h, h >> {shift})', factor)})[1]"
    return f"list_transform([{end}], lambda h: xor(h, h >> 16))[1]"


def _murmur_split() -> str:
    """Spark's hash of a text and a double: whole words of four bytes, then single signed bytes; a double by its bits."""
    byte = "('0x' || substr(x, {}, 2))::BIGINT"
    word = " + ".join(f"({byte.format(f'8 * i + {2 * b + 1}')} << {8 * b})" for b in range(4))
    tail = byte.format("2 * i + 1")
    words = f"""list_concat(list_transform(range(0, length(x) // 8), lambda i: {word}),
        list_transform(range(length(x) // 8 * 4, length(x) // 2), lambda i: {tail} + CASE WHEN {tail} > 127 THEN 4294967040 ELSE 0 END))"""
    return _with(
        f"""SELECT doc_id, CAST(abs(CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 100 AS INTEGER) AS split_key,
        CASE WHEN abs(CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM hashed""",
        "labelled",
        extra={
            "hexed": """SELECT doc_id, hex(encode(Review)) AS x, Rating AS r, CASE WHEN Rating <> 0 THEN floor(log2(abs(Rating)))::BIGINT END AS e
              FROM labelled""",
            "bits": """SELECT doc_id, x, CASE WHEN r = 0 THEN 0 ELSE CASE WHEN r < 0 THEN 2147483648 ELSE 0 END + ((e + 1023) << 20)
              + (((abs(r) / power(2.0, e) - 1) * 4503599627370496)::BIGINT >> 32) END AS high,
              CASE WHEN r = 0 THEN 0 ELSE ((abs(r) / power(2.0, e) - 1) * 4503599627370496)::BIGINT & 4294967295 END AS low FROM hexed""",
            "texts_hashed": f"SELECT doc_id, low, high, {_folded('42', words, 'length(x) // 2')} AS t FROM bits",
            "hashed": f"SELECT doc_id, {_folded('t', '[low, high]', '8')} AS h FROM texts_hashed",
        },
    )


# --- models on three small counts ----------------------------------------------------------------

CTES["counted"] = r"""SELECT *, n / (2.0::DOUBLE * count(*) OVER (PARTITION BY label)) AS w,
    CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id) - 1) % 5 AS INTEGER) AS fold
    FROM (SELECT doc_id, quality AS label, count(*) OVER () AS n, least(n_chars // 100, 30)::DOUBLE AS x0,
            least(length(regexp_replace(Review, '[^.]', '', 'g')), 30)::DOUBLE AS x1,
            least(length(regexp_replace(Review, '[^\n]', '', 'g')), 30)::DOUBLE AS x2 FROM reviews)"""
NEEDS["counted"] = ["reviews"]


def _coefficients(weight: str, penalty: float) -> dict[str, str]:
    """Newton steps of a logistic regression on two counts; the penalty acts on scaled coefficients."""
    return {
        "d": f"SELECT label AS y, {weight} AS w, x0 AS a, x1 AS b FROM counted",
        "c": "SELECT sum(w) AS sw, sum(w) - sum(w * w) / sum(w) AS df, sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb FROM d",
        "v": f"""SELECT any_value(sw) * {penalty} * sum(w * (a - ma) ** 2) / any_value(df) AS ra,
            any_value(sw) * {penalty} * sum(w * (b - mb) ** 2) / any_value(df) AS rb FROM d, c""",
        "newton": """
          SELECT 0 AS i, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1, 0.0::DOUBLE AS t2
          UNION ALL
          SELECT i + 1, t0 - (g0 * (h11 * h22 - h12 * h12) + g1 * (h02 * h12 - h01 * h22) + g2 * (h01 * h12 - h02 * h11)) / det,
                 t1 - (g0 * (h02 * h12 - h01 * h22) + g1 * (h00 * h22 - h02 * h02) + g2 * (h01 * h02 - h00 * h12)) / det,
                 t2 - (g0 * (h01 * h12 - h02 * h11) + g1 * (h01 * h02 - h00 * h12) + g2 * (h00 * h11 - h01 * h01)) / det
          FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM (
            SELECT i, t0, t1, t2, sum(w * (p - y)) AS g0, sum(w * (p - y) * a) + any_value(ra) * t1 AS g1,
                   sum(w * (p - y) * b) + any_value(rb) * t2 AS g2, sum(w * p * (1 - p)) AS h00, sum(w * p * (1 - p) * a) AS h01,
                   sum(w * p * (1 - p) * b) AS h02, sum(w * p * (1 - p) * a * a) + any_value(ra) AS h11,
                   sum(w * p * (1 - p) * a * b) AS h12, sum(w * p * (1 - p) * b * b) + any_value(rb) AS h22
            FROM (SELECT *, 1 / (1 + exp(-(t0 + t1 * a + t2 * b))) AS p FROM newton, d, v WHERE i < 30) GROUP BY i, t0, t1, t2))""",
        "learned": "SELECT round(t0, 4) AS intercept, round(t1, 4) AS coefficient_0, round(t2, 4) AS coefficient_1 FROM newton WHERE i = 30",
    }


def _splits(rows: str) -> dict[str, str]:
    """Every split point of every count, per group ``g``, with its weighted Gini gain and the leaves' class shares."""
    return {
        "long": f"SELECT g, label, w, unnest([0, 1, 2]) AS feature, unnest([x0, x1, x2]) AS x FROM {rows}",
        "bins": "SELECT g, feature, x, count(*) AS n, sum(w) AS w, coalesce(sum(w) FILTER (label = 1), 0) AS p FROM long GROUP BY ALL",
        "sums": """SELECT g, feature, (x + lead(x) OVER o) / 2 AS threshold, sum(n) OVER o AS nl, sum(n) OVER a AS n, sum(w) OVER o AS wl,
          sum(w) OVER a AS w, sum(p) OVER o AS pl, sum(p) OVER a AS p FROM bins
          WINDOW o AS (PARTITION BY g, feature ORDER BY x), a AS (PARTITION BY g, feature)""",
        "splits": """SELECT g, feature, threshold, nl, n - nl AS nr, pl / wl AS left_share, (p - pl) / (w - wl) AS right_share,
          2 * (p / w * (1 - p / w) - pl * (1 - pl / wl) / w - (p - pl) * (1 - (p - pl) / (w - wl)) / w) AS gain
          FROM sums WHERE threshold IS NOT NULL""",
    }


def _first_split(weight: str, leaf: str) -> dict[str, str]:
    return {
        "given": f"SELECT 0 AS g, label, {weight} AS w, x0, x1, x2 FROM counted",
        **_splits("given"),
        "learned": f"""SELECT feature, threshold, round({leaf.format('left_share')}, 6) AS "left",
          round({leaf.format('right_share')}, 6) AS "right" FROM splits ORDER BY gain DESC, feature, threshold LIMIT 1""",
    }


def _cross_validated(least: list[int], gains: list[float], metric: str) -> str:
    """Mean score of one-level trees over the folds, per candidate, as the grid deals them."""
    grid = ", ".join(f"({i}, {n}, {g})" for i, (g, n) in enumerate((g, n) for g in gains for n in least))
    figure = {"f1": "2 * tp / (2 * tp + fp + fn)", "recall": "tp / (tp + fn)"}[metric]
    return _with(
        f"""SELECT CAST(c AS INTEGER) AS candidate, round(avg(score), 6) AS score,
        c = first_value(c) OVER (ORDER BY round(avg(score), 12) DESC, c) AS best FROM scored GROUP BY c""",
        "counted",
        extra={
            "trained": "SELECT g, label, w, x0, x1, x2 FROM counted, range(5) f(g) WHERE fold <> g",
            **_splits("trained"),
            "grid": f"SELECT * FROM (VALUES {grid}) v(c, least, gain)",
            "ranked": """SELECT c, g, feature, threshold, left_share, right_share,
              row_number() OVER (PARTITION BY c, g ORDER BY s.gain DESC, feature, threshold) AS place
              FROM splits s JOIN grid ON nl >= least AND nr >= least AND s.gain >= grid.gain AND s.gain > 0""",
            "plain": "SELECT g, sum(w) FILTER (label = 1) > sum(w) FILTER (label = 0) AS one FROM trained GROUP BY g",
            "guessed": """SELECT grid.c, plain.g, label, CASE WHEN place IS NULL THEN one WHEN [x0, x1, x2][feature + 1] <= threshold
              THEN left_share > 0.5 ELSE right_share > 0.5 END AS one
              FROM counted JOIN plain ON fold = g CROSS JOIN grid LEFT JOIN ranked r ON r.c = grid.c AND r.g = plain.g AND place = 1""",
            "scored": f"""SELECT c, g, coalesce({figure}, 0) AS score FROM (SELECT c, g, count(*) FILTER (one AND label = 1) AS tp,
              count(*) FILTER (one AND label = 0) AS fp, count(*) FILTER (NOT one AND label = 1) AS fn FROM guessed GROUP BY c, g)""",
        },
    )


_MAJORITY = """(SELECT Sentiment FROM sided WHERE split = 'train' GROUP BY Sentiment ORDER BY count(*) DESC, Sentiment LIMIT 1)"""
CLASSIC = ["Logistic Regression (Baseline)", "Decision Tree (Weighted)", "Random Forest (Weighted)", "Gradient Boosting"]
BIGRAM = ["Logistic Regression (Baseline)", "Decision Tree", "Random Forest", "Gradient Boosting"]


def _test_rows(methods: list[str], zero: str, *more: str, learned: dict[str, str] | None = None) -> str:
    """A row per method: test rows of class 0 (whose sentiment is ``zero``) and of class 1."""
    names = ", ".join(f"('{name}')" for name in methods)
    extra = "".join(f", {column}" for column in more)
    return _with(
        f"""SELECT Method, count(*) FILTER (Sentiment = {zero}) AS negatives, count(*) FILTER (Sentiment <> {zero}) AS positives,
        true AS accuracy_fits{extra} FROM sided, (VALUES {names}) m(Method){', learned' if learned else ''} WHERE split = 'test' GROUP BY Method""",
        *(["sided", "counted"] if learned else ["sided"]),
        extra=learned,
        recursive=bool(learned),
    )


def model_rows() -> dict[str, str]:
    single = {
        "lr_unweighted": "Logistic Regression",
        "lr_weighted": CLASSIC[0],
        "dt_weighted": CLASSIC[1],
        "rf_weighted": CLASSIC[2],
        "gbt_plain": CLASSIC[3],
    }
    learned = {
        "lr_unweighted": (_coefficients("1.0::DOUBLE", 0.0), ("intercept", "coefficient_0", "coefficient_1")),
        "lr_weighted": (_coefficients("w", 0.01), ("intercept", "coefficient_0", "coefficient_1")),
        "dt_weighted": (_first_split("w", "{}"), ("feature", "threshold", '"left"', '"right"')),
        "rf_weighted": (_first_split("w", "{}"), ("feature", "threshold", '"left"', '"right"')),
        "gbt_plain": (_first_split("1.0::DOUBLE", "(2 * {} - 1)"), ("feature", "threshold", '"left"', '"right"')),
    }
    sql = {}
    for name, method in single.items():
        ctes, columns = learned[name]
        more = [f"any_value(learned.{column}) AS {column}" for column in columns]
        sql[name] = _test_rows([method], _MAJORITY, "count(*) AS sound_rows", *more, learned=ctes)
    sql["compare_classic_models"] = _test_rows(CLASSIC, _MAJORITY)
    sql["bigram_model_suite"] = _test_rows(BIGRAM, "'negative'")
    sql["lr_on_embeddings"] = _test_rows(["Word2Vec", "GloVe", "BERT"], "'negative'", "true AS auc_in_range")
    sql["cv_decision_tree"] = _cross_validated([1, 7, 60], [0.0], "f1")
    sql["cv_random_forest"] = _cross_validated([2, 40], [0.0, 0.02], "recall")
    sql["cv_gbt"] = _cross_validated([1, 30], [0.0], "recall")
    sql["best_params"] = f"""SELECT param, value FROM (VALUES ('maxDepth', '1'), ('impurity', 'gini'), ('maxBins', '128'), ('minInfoGain', '0.0'),
        ('minInstancesPerNode', (SELECT (ARRAY['1', '7', '60'])[candidate + 1] FROM ({sql["cv_decision_tree"]}) WHERE best))) p(param, value)"""
    sql["stratified_folds"] = _with("SELECT doc_id, CAST(label AS INTEGER) AS label, fold FROM counted", "counted")
    sql["weighted_ensemble"] = _test_rows(["Weighted vote"], "'positive'")
    sql["smote_lr"] = _test_rows(["Balanced by synthetic rows"], "'positive'")
    sql["threshold_moving"] = _test_rows(["Moved threshold"], "'positive'", "true AS threshold_in_grid")
    labelled = """(SELECT count(*) FROM sided WHERE split = 'train'
        AND ('0x' || substr(md5('42|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.8) AS labeled_rows"""
    sql["pseudo_label"] = _test_rows(["Learned from own labels"], "'positive'", labelled, "true AS adds_up")
    sql["final_comparison"] = _test_rows(
        ["Plain model", "Balanced by synthetic rows", "Weighted vote", "Moved threshold", "Learned from own labels"], "'positive'"
    )
    sql["baseline_flow"] = _with(
        """SELECT 'Baseline' AS Method, count(*) FILTER (Sentiment = m) AS negatives, count(*) FILTER (Sentiment <> m) AS positives,
        true AS accuracy_fits FROM flow, (SELECT Sentiment AS m FROM flow WHERE side < 80 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        WHERE side >= 80""",
        "cleaned",
        extra={
            "flow": """SELECT CASE WHEN Rating >= 3.0 THEN 'positive' ELSE 'negative' END AS Sentiment,
            ('0x' || substr(md5(Review || '|' || CAST(Rating AS VARCHAR)), 1, 8))::BIGINT % 100 AS side FROM cleaned"""
        },
    )
    sql["load_or_build"] = _with("SELECT Sentiment, count(*) AS n, 2 AS built FROM labelled GROUP BY Sentiment", "labelled")
    return sql
