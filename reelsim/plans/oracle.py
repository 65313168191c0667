"""DuckDB SQL for every registered query (the correctness oracle).

Each string runs on the pre-registered views ``documents`` and ``part``
and recomputes the whole pipeline in plain SQL -- films view, first row
per title, cleaning, n-grams, vocabulary, weights, scoring -- with
brute-force joins (every query against every row), so it checks the
Spark plans (broadcast scoring, zero-score padding, n-gram title index,
closed-form ILS) against the definitions.
"""

from __future__ import annotations

from reelsim.functions.text import default_stop_words
from reelsim.operators.lemma import NOUN_ENDINGS
from reelsim.plans import catalogue as C


# Fixed: text a missing title turns into before keying.
NULL_TITLE = "nan"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_lit(w) for w in words) + "]"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def KEY(x: str) -> str:
    return f"lower({STRIP(f'coalesce({x}, {_lit(NULL_TITLE)})')})"


def NAME(k: str) -> str:
    return STRIP(f"regexp_replace({k}, '\\s*-\\s*\\d{{4}}\\s*$', '')")


def CLEAN(x: str, lexicon: dict | None = None) -> str:
    toks = (f"list_filter(coalesce(regexp_extract_all(lower({x}), '[a-z]+'), []), "
            f"lambda w: length(w) >= 3 AND NOT list_contains({_list(default_stop_words())}, w))")
    if lexicon:
        case = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in sorted(lexicon.items()))
        toks = f"list_transform({toks}, lambda w: CASE w {case} ELSE w END)"
    return toks


def NGRAMS(t: str) -> str:
    return f"list_concat({t}, list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1]))"


FILMS = f"""films AS (
  SELECT *, expanded_genres AS genre_src FROM (
    SELECT doc_id AS row_id,
           CASE WHEN doc_id % 20 = 19 THEN upper(raw_title) ELSE raw_title END AS title,
           CASE WHEN doc_id % 50 = 48 THEN NULL ELSE text END AS description,
           CASE WHEN doc_id % 13 = 0 THEN NULL ELSE p_retailprice END AS ratings,
           lang AS genre,
           CASE WHEN doc_id % 17 = 0 THEN NULL
                WHEN doc_id % 3 = 0 THEN lang || ', ' || source || '|' || p_type
                ELSE lang || '/' || p_type END AS expanded_genres
    FROM (SELECT b.*, p.p_type, p.p_retailprice,
                 p.p_name || ' ' || CAST(b.tid AS VARCHAR) || ' - ' ||
                        CAST(1950 + b.tid % 70 AS VARCHAR) AS raw_title
          FROM (SELECT doc_id, text, lang, source,
                       doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS tid
                FROM documents) b
          LEFT JOIN part p ON p.p_partkey = b.tid) t))"""


def base(dedupe: bool = True, lexicon: dict | None = None, raw: bool = False) -> list[str]:
    """CTEs: films, dedup, catalog, docs, tf, vocab, vocab_idf, postings."""
    src = "dedup" if dedupe else "films"
    terms = NGRAMS("toks") if not raw else NGRAMS("rtoks")
    return [
        FILMS,
        """dedup AS (SELECT * FROM films WHERE description IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY title ORDER BY row_id) = 1)""",
        f"""tok AS (SELECT *, {CLEAN('description', lexicon)} AS tokens FROM {src})""",
        f"""keyed AS (SELECT *, {KEY('title')} AS title_key FROM tok WHERE len(tokens) > 0)""",
        f"""catalog AS (SELECT *, array_to_string(tokens, ' ') AS clean_description,
                        {NAME('title_key')} AS name_only FROM keyed)""",
        f"""docs AS (SELECT row_id, {terms} AS terms FROM
              (SELECT row_id, tokens AS toks,
                      regexp_extract_all(lower(description), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS rtoks
               FROM catalog))""",
        """tf AS (SELECT row_id, term, count(*) AS tf
                  FROM (SELECT row_id, unnest(terms) AS term FROM docs) GROUP BY row_id, term)""",
        """vocab AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term
                     HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 20000)""",
        """vocab_idf AS (SELECT term, df, cf,
                         ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1 AS idf FROM vocab)""",
        """postings AS (SELECT row_id, term, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY row_id)) AS w
                        FROM (SELECT t.row_id, t.term, t.tf, (1 + ln(t.tf)) * v.idf AS raw
                              FROM tf t JOIN vocab_idf v ON v.term = t.term))""",
        f"""all_genres AS (SELECT DISTINCT {STRIP('p')} AS genre FROM
               (SELECT unnest(regexp_split_to_array(genre_src, '[,|/]')) AS p FROM catalog
                WHERE genre_src IS NOT NULL))""",
        """first_row AS (SELECT title_key, min(row_id) AS row_id FROM catalog GROUP BY title_key)""",
        """sample AS (SELECT row_id, title FROM catalog
                      ORDER BY md5(CAST(row_id AS VARCHAR) || '-42'), row_id LIMIT 50)""",
    ]


def sql(*parts: str, dedupe: bool = True, lexicon: dict | None = None, raw: bool = False,
        final: str) -> str:
    return "WITH " + ",\n".join(base(dedupe, lexicon, raw) + list(parts)) + "\n" + final


# ---- recommendation building blocks -------------------------------------
SCORES = """scores AS (SELECT q.query_id, p.row_id, sum(p.w * q.w) AS score
                       FROM qvec q JOIN postings p ON p.term = q.term GROUP BY q.query_id, p.row_id)"""


def by_rows(resolved_sql: str, genre: str | None = None, mask: bool = True, n: int = 5,
            score_name: str = "similarity_score", filters: bool = False) -> list[str]:
    """``resolved(query_id, src)`` -> ranked(query_id, rank, row_id, ...);
    ``filters``: ``resolved`` has a column ``gf``, null for no filter."""
    gcond = f" AND regexp_matches(lower(c.genre_src), {_lit(genre.lower())})" if genre else ""
    if filters:
        gcond = " AND (r.gf IS NULL OR coalesce(regexp_matches(lower(c.genre_src), r.gf), FALSE))"
    score = "coalesce(s.score, 0.0)"
    where = "c.row_id <> r.src" if mask else "TRUE"
    if not mask:
        score = f"CASE WHEN c.row_id = r.src THEN -1.0 ELSE {score} END"
    return [
        f"resolved AS ({resolved_sql})",
        "qvec AS (SELECT r.query_id, p.term, p.w FROM resolved r JOIN postings p ON p.row_id = r.src)",
        SCORES,
        f"""full_ AS (SELECT r.query_id, c.row_id, c.title, c.description, c.ratings, c.genre,
                            c.expanded_genres, {score} AS score
                     FROM resolved r CROSS JOIN catalog c
                     LEFT JOIN scores s ON s.query_id = r.query_id AND s.row_id = c.row_id
                     WHERE {where}{gcond})""",
        f"""ranked AS (SELECT *, round(score, 4) AS {score_name} FROM
                (SELECT *, row_number() OVER (PARTITION BY query_id
                        ORDER BY round(score, 9) DESC, row_id DESC) AS rank FROM full_)
              WHERE rank <= {n})""",
    ]


def by_text(queries_sql: str, genre: str | None = None, skip_empty: bool = True, n: int = 5,
            score_name: str = "similarity_score") -> list[str]:
    """``queries(query_id, text)`` -> ranked."""
    gcond = f" AND regexp_matches(lower(c.genre_src), {_lit(genre.lower())})" if genre else ""
    keep = "WHERE len(toks) > 0" if skip_empty else ""
    return [
        f"qin AS ({queries_sql})",
        f"qtok AS (SELECT query_id, {CLEAN('text')} AS toks FROM qin)",
        f"qdoc AS (SELECT query_id, {NGRAMS('toks')} AS terms FROM qtok {keep})",
        """qtf AS (SELECT query_id, term, count(*) AS tf
                   FROM (SELECT query_id, unnest(terms) AS term FROM qdoc) GROUP BY query_id, term)""",
        """qvec AS (SELECT query_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY query_id)) AS w
                    FROM (SELECT q.query_id, q.term, (1 + ln(q.tf)) * v.idf AS raw
                          FROM qtf q JOIN vocab_idf v ON v.term = q.term))""",
        SCORES,
        f"""full_ AS (SELECT r.query_id, c.row_id, c.title, c.description, c.ratings, c.genre,
                            c.expanded_genres, coalesce(s.score, 0.0) AS score
                     FROM qdoc r CROSS JOIN catalog c
                     LEFT JOIN scores s ON s.query_id = r.query_id AND s.row_id = c.row_id
                     WHERE TRUE{gcond})""",
        f"""ranked AS (SELECT *, round(score, 4) AS {score_name} FROM
                (SELECT *, row_number() OVER (PARTITION BY query_id
                        ORDER BY round(score, 9) DESC, row_id DESC) AS rank FROM full_)
              WHERE rank <= {n})""",
    ]


REC_OUT = "SELECT query_id, rank, row_id, title, ratings, similarity_score FROM ranked"
FIRST_TITLE = "SELECT CAST(0 AS BIGINT) AS query_id, title AS text FROM catalog ORDER BY row_id LIMIT 1"
SAMPLE_RESOLVED = f"""SELECT s.row_id AS query_id, min(c.row_id) AS src FROM sample s
                      JOIN catalog c ON c.title_key = {KEY('s.title')} GROUP BY s.row_id"""
ASKED_RESOLVED = f"""SELECT s.row_id AS query_id, min(c.row_id) AS src FROM catalog s
                      JOIN catalog c ON c.title_key = {KEY('s.title')} WHERE s.row_id % 20 = 0 GROUP BY s.row_id"""
ASKED_TEXTS = "SELECT row_id AS query_id, description AS text FROM catalog WHERE row_id % 20 = 0"
TIER1_OF_FIRST = f"""SELECT CAST(0 AS BIGINT) AS query_id, min(c.row_id) AS src
                     FROM (SELECT title FROM catalog ORDER BY row_id LIMIT 1) f
                     JOIN catalog c ON c.title_key = {KEY('f.title')}"""


def _under_filters() -> str:
    """The first title once per filter; the last filter is no regex."""
    keys = [(i, "NULL" if g in ("", "All") else _lit(g.lower())) for i, g in enumerate(C.DEMO_FILTERS[:-1])]
    values = ", ".join(f"({i}, {g})" for i, g in keys)
    return f"""SELECT CAST(v.i AS BIGINT) AS query_id, f.src, CAST(v.g AS VARCHAR) AS gf
               FROM ({TIER1_OF_FIRST}) f CROSS JOIN (VALUES {values}) v(i, g)"""


def _fixed(text: str) -> str:
    return f"SELECT CAST(0 AS BIGINT) AS query_id, {_lit(text)} AS text"


def members_ils() -> list[str]:
    """Brute-force ILS: every ordered pair of list positions."""
    return [
        f"""members AS (SELECT r.query_id, r.rank, f.row_id FROM ranked r
                        JOIN first_row f ON f.title_key = {KEY('r.title')})""",
        """pairs AS (SELECT a.query_id, a.rank AS ra, b.rank AS rb, a.row_id AS ia, b.row_id AS ib
                     FROM members a JOIN members b ON a.query_id = b.query_id AND a.rank <> b.rank)""",
        """pair_sim AS (SELECT p.query_id, p.ra, p.rb,
                               coalesce((SELECT sum(x.w * y.w) FROM postings x JOIN postings y
                                         ON x.term = y.term WHERE x.row_id = p.ia AND y.row_id = p.ib), 0.0) AS sim
                        FROM pairs p)""",
        """ils AS (SELECT m.query_id, m.k,
                          CASE WHEN m.k >= 2 THEN coalesce(s.total, 0.0) / (m.k * (m.k - 1)) ELSE 0.0 END AS ils
                   FROM (SELECT query_id, count(*) AS k FROM members GROUP BY query_id) m
                   LEFT JOIN (SELECT query_id, sum(sim) AS total FROM pair_sim GROUP BY query_id) s
                   ON s.query_id = m.query_id)""",
    ]


def hist(values_sql: str, bins: int) -> list[str]:
    return [
        f"hvals AS (SELECT CAST(v AS DOUBLE) AS v FROM ({values_sql}) WHERE v IS NOT NULL)",
        """hrng AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                           CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM hvals)""",
        f"""hbin AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / {float(bins)})) AS BIGINT) + 1, {bins}) AS bin
                     FROM hvals, hrng)""",
        "hcnt AS (SELECT bin, count(*) AS c FROM hbin GROUP BY bin)",
        f"""hedge AS (SELECT b AS bin, lo + (b - 1) * (hi - lo) / {bins} AS lo, lo + b * (hi - lo) / {bins} AS hi
                      FROM hrng, range(1, {bins + 1}) t(b))""",
    ]


HIST_OUT = ("SELECT CAST(e.bin AS BIGINT) AS bin, round(e.lo, 6) AS lo, round(e.hi, 6) AS hi, "
            "CAST(coalesce(c.c, 0) AS BIGINT) AS count FROM hedge e LEFT JOIN hcnt c ON c.bin = e.bin")
WORDS = "CASE WHEN description IS NOT NULL THEN len(regexp_extract_all(description, '\\S+')) END"


def _with_recursive(text: str) -> str:
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


def _noun_lemmas() -> list[str]:
    """Every chain of detached noun endings, then the first step that meets a
    known word (the form itself and one step count as one)."""
    steps = " UNION ALL ".join(f"""SELECT form, left(t, length(t) - {len(a)}) || {_lit(b)} AS t, step + 1 AS step FROM chain
        WHERE ends_with(t, {_lit(a)})""" for a, b in NOUN_ENDINGS)
    listed = ", ".join(f"({_lit(k)}, {_lit(v)})" for k, v in sorted(C.DEMO_LEXICON.items()))
    return [
        "spot AS (SELECT row_id, i, tokens[i] AS token FROM (SELECT row_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM catalog))",
        """known AS (SELECT token AS t FROM spot WHERE NOT ends_with(token, 's') GROUP BY token
                     HAVING count(DISTINCT row_id) >= 2)""",
        f"listed(form, t) AS (VALUES {listed})",
        "forms AS (SELECT DISTINCT token AS form FROM spot)",
        f"""chain AS (SELECT form, form AS t, 0 AS step FROM forms WHERE form NOT IN (SELECT form FROM listed)
                      UNION ALL SELECT * FROM ({steps}))""",
        """tries AS (SELECT form, t, greatest(step, 1) AS step FROM chain
                     UNION ALL SELECT form, t, 1 FROM listed UNION ALL SELECT form, form, 1 FROM listed)""",
        """lemma_of AS (SELECT form, t AS lemma FROM (SELECT DISTINCT form, t, step FROM tries JOIN known USING (t))
                        QUALIFY row_number() OVER (PARTITION BY form ORDER BY step, length(t), t) = 1)""",
    ]


def _weights_out() -> str:
    return "SELECT row_id, term, tf, round(w, 6) AS w FROM postings"


def _title_variants() -> list[str]:
    return [
        "tfirst AS (SELECT c.* FROM catalog c JOIN first_row f ON f.title_key = c.title_key AND f.row_id = c.row_id)",
        """queries AS (
             SELECT row_id * 10 + 1 AS query_id, '  ' || upper(title) || ' ' AS text FROM tfirst UNION ALL
             SELECT row_id * 10 + 2, name_only FROM tfirst UNION ALL
             SELECT row_id * 10 + 3, array_to_string(list_reverse(string_split(name_only, ' ')), ' ') FROM tfirst UNION ALL
             SELECT row_id * 10 + 4, substr(title_key, greatest(length(title_key) - 7, 1)) FROM tfirst)""",
        f"""qw AS (SELECT query_id, q, string_split_regex(q, '\\s+') AS words FROM
                   (SELECT query_id, lower({STRIP('text')}) AS q FROM queries) WHERE q <> '')""",
        """m AS (SELECT qw.query_id, c.row_id,
                   CASE WHEN c.title_key = qw.q THEN 1
                        WHEN c.name_only = qw.q THEN 2
                        WHEN len(list_filter(qw.words, lambda w: NOT contains(c.name_only, w))) = 0 THEN 3
                        WHEN contains(c.title_key, qw.q) THEN 4 END AS tier
                 FROM qw CROSS JOIN catalog c)""",
    ]


def _cards_cols() -> str:
    return f"""query_id, rank, lpad(CAST(rank AS VARCHAR), 2, '0') AS rank_label,
       regexp_replace(title, '(?s)^(.*) - .*$', '\\1') AS display_title,
       CASE WHEN length(description) > 200 THEN substr(description, 1, 200) || '…' ELSE description END
         AS short_description,
       CAST(trunc(similarity_score * 100) AS BIGINT) || '% match' AS match_badge,
       printf('%.1f', ratings) AS rating_badge,
       coalesce(CASE WHEN expanded_genres IS NOT NULL THEN {STRIP("split_part(expanded_genres, ',', 1)")} END,
                CASE WHEN genre IS NOT NULL THEN {STRIP("split_part(genre, ',', 1)")} END) AS primary_genre"""


def oracle_sql() -> dict[str, str]:
    films_cols = "row_id, title, description, ratings, genre, expanded_genres, genre_src"
    stats = sql(final="""SELECT CAST((SELECT count(*) FROM catalog) AS BIGINT) AS total_movies,
        CAST((SELECT count(*) FROM vocab) AS BIGINT) AS tfidf_features,
        CAST((SELECT count(*) FROM all_genres) AS BIGINT) AS total_genres,
        round(100.0 * (1.0 - (SELECT count(*) FROM postings) /
              ((SELECT count(*) FROM catalog) * (SELECT count(*) FROM vocab))), 1) AS sparsity_pct""")
    batch, asked = by_rows(SAMPLE_RESOLVED), by_rows(ASKED_RESOLVED)
    out = {
        "normalise_catalog": sql(final=f"SELECT {films_cols} FROM films"),
        "csv_roundtrip": sql(final=f"SELECT {films_cols} FROM films"),
        "null_profile": sql(final="SELECT " + ", ".join(
            f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in C.FILM_COLUMNS) + " FROM films"),
        "duplicate_titles": sql(final="""SELECT count(*) AS n_rows,
            CAST(count(*) - count(DISTINCT title) - CASE WHEN count(*) > count(title) THEN 1 ELSE 0 END AS BIGINT)
            AS duplicate_titles FROM films"""),
        "prep_lineage": sql(final="""SELECT n0 AS rows_raw, n0 - n1 AS dropped_null_description,
            n1 - n2 AS dropped_duplicates, n2 - n3 AS dropped_blank_text, n3 AS rows_retained FROM
            (SELECT (SELECT count(*) FROM films) AS n0,
                    (SELECT count(*) FROM films WHERE description IS NOT NULL) AS n1,
                    (SELECT count(*) FROM dedup) AS n2, (SELECT count(*) FROM catalog) AS n3)"""),
        "dedupe_titles": sql(final="SELECT row_id, title FROM dedup"),
        "title_index": sql(final="""SELECT c.title_key, c.name_only, c.row_id FROM catalog c
            JOIN first_row f ON f.title_key = c.title_key AND f.row_id = c.row_id"""),
        "clean_text": sql(final="SELECT row_id, clean_description FROM catalog"),
        "clean_description_text": sql(final=f"""SELECT row_id,
            array_to_string({CLEAN('description')}, ' ') AS clean_description FROM films"""),
        "lemmatised_tokens": sql(lexicon=C.DEMO_LEXICON, final="SELECT row_id, clean_description FROM catalog"),
        "lemmatised_by_table": sql(lexicon=C.DEMO_LEXICON, final="SELECT row_id, clean_description FROM catalog"),
        "lemmatised_nouns": _with_recursive(sql(*_noun_lemmas(), final="""SELECT row_id,
            array_to_string(list_transform(list_sort(list({'i': i, 't': coalesce(lemma, token)})), lambda x: x.t), ' ') AS clean_description
            FROM spot LEFT JOIN lemma_of ON lemma_of.form = spot.token GROUP BY row_id""")),
        "csv_split_load": sql(final=f"""SELECT row_number() OVER (ORDER BY row_id % 5 = 4, row_id) - 1 AS row_id,
            {films_cols.removeprefix('row_id, ')} FROM films"""),
        "column_rename_cases": sql(final="""SELECT 'renamed' AS kind, row_id, title, description, ratings,
            CAST(NULL AS VARCHAR) AS genre, CAST(NULL AS VARCHAR) AS expanded_genres, expanded_genres AS genre_src FROM films
            UNION ALL SELECT 'bare', row_id, title, description, CAST(NULL AS DOUBLE), NULL, NULL, NULL FROM films"""),
        "desc_length_stats": sql(final=f"""SELECT count(n) AS n_described, round(avg(n), 6) AS avg_words,
            CAST(min(n) AS BIGINT) AS min_words, CAST(max(n) AS BIGINT) AS max_words
            FROM (SELECT {WORDS} AS n FROM films)"""),
        "desc_length_hist": sql(*hist(f"SELECT {WORDS} AS v FROM films", 50), final=HIST_OUT),
        "genre_counts_top12": sql(f"""gp AS (SELECT {STRIP('p')} AS genre FROM
              (SELECT unnest(regexp_split_to_array(genre_src, '[,|/]')) AS p FROM films
               WHERE genre_src IS NOT NULL))""",
            final="SELECT genre, count(*) AS count FROM gp GROUP BY genre ORDER BY count DESC, genre LIMIT 12"),
        "all_genres": sql(final="SELECT genre FROM all_genres"),
        "genre_menu": sql(final="""SELECT CAST(row_number() OVER (ORDER BY grp, genre) - 1 AS BIGINT) AS position,
            genre FROM (SELECT 0 AS grp, 'All' AS genre UNION ALL SELECT 1, genre FROM all_genres)"""),
        "title_years": sql(f"""ty AS (SELECT row_id, {STRIP('title')} AS t,
              regexp_extract({STRIP('title')}, '-\\s*(\\d{{4}})\\s*$', 1) AS y FROM films)""",
            final="""SELECT row_id,
              CASE WHEN y <> '' THEN regexp_replace(t, '\\s*-\\s*\\d{4}\\s*$', '') || ' (' || y || ')' ELSE t END
                AS display,
              CAST(NULLIF(y, '') AS BIGINT) AS year FROM ty"""),
        "bigrams": sql(final="""SELECT row_id, CAST(i - 1 AS BIGINT) AS pos, tokens[i] || ' ' || tokens[i + 1] AS bigram
            FROM (SELECT row_id, tokens, unnest(range(1, len(tokens))) AS i FROM catalog)"""),
        "bow_terms": sql(final="SELECT t.row_id, t.term, t.tf AS n FROM tf t JOIN vocab v ON v.term = t.term"),
        "vocabulary": sql(final="SELECT term, df, CAST(cf AS BIGINT) AS cf, round(idf, 9) AS idf FROM vocab_idf"),
        "tfidf_weights": sql(final=_weights_out()),
        "raw_tfidf_weights": sql(dedupe=False, raw=True, final=_weights_out()),
        "top_terms_bow_vs_tfidf": sql(dedupe=False, final="""
            SELECT row_id, 'bow' AS kind, rank, term, value FROM
              (SELECT row_id, term, CAST(tf AS DOUBLE) AS value,
                      CAST(row_number() OVER (PARTITION BY row_id ORDER BY tf DESC, term) AS BIGINT) AS rank
               FROM postings) WHERE rank <= 10
            UNION ALL
            SELECT row_id, 'tfidf' AS kind, rank, term, value FROM
              (SELECT row_id, term, round(w, 6) AS value,
                      CAST(row_number() OVER (PARTITION BY row_id ORDER BY round(w, 9) DESC, term) AS BIGINT) AS rank
               FROM postings) WHERE rank <= 10"""),
        "resolve_titles": sql(*_title_variants(), final="""SELECT query_id, row_id, CAST(tier AS BIGINT) AS tier
            FROM m WHERE tier IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY tier, row_id) = 1"""),
        "title_suggestions": sql(
            """words AS (SELECT DISTINCT w AS query FROM
                 (SELECT unnest(string_split(name_only, ' ')) AS w FROM catalog) WHERE w <> '')""",
            """cand AS (SELECT q.query, c.row_id, c.title,
                         CASE WHEN starts_with(c.name_only, q.query) THEN 0 ELSE 1 END AS match_rank
                       FROM words q JOIN catalog c ON contains(c.name_only, q.query)
                       QUALIFY row_number() OVER (PARTITION BY q.query, c.title ORDER BY c.row_id) = 1)""",
            final="""SELECT query, rank, row_id, title FROM
              (SELECT query, row_id, title,
                      CAST(row_number() OVER (PARTITION BY query ORDER BY match_rank, row_id) AS BIGINT) AS rank
               FROM cand) WHERE rank <= 8"""),
        "recommend_by_title": sql(*by_rows(TIER1_OF_FIRST), final=REC_OUT),
        "model_roundtrip_search": sql(*by_rows(TIER1_OF_FIRST), final=REC_OUT),
        "recommend_by_title_genre": sql(*by_rows(TIER1_OF_FIRST, genre=C.DEMO_GENRE_FILTER), final=REC_OUT),
        "recommend_by_title_filters": sql(*by_rows(_under_filters(), n=10, filters=True), final=REC_OUT),
        "recommend_many": sql(*by_rows(TIER1_OF_FIRST, n=2000), final=REC_OUT),
        "recommend_batch": sql(*asked, final=REC_OUT),
        "recommend_by_description": sql(*by_text(ASKED_TEXTS), final=REC_OUT),
        "recommend_by_description_genre": sql(*by_text(ASKED_TEXTS, genre=C.DEMO_GENRE_FILTER), final=REC_OUT),
        "recommend_by_description_unknown": sql(*by_text(_fixed(C.UNKNOWN_QUERY)), final=REC_OUT),
        "recommend_by_description_stopwords": sql(*by_text(_fixed(C.STOPWORD_QUERY)), final=REC_OUT),
        "recommend_by_genre": sql(
            """hits AS (SELECT g.genre AS query, c.row_id, c.title, c.ratings FROM all_genres g
                        JOIN catalog c ON regexp_matches(lower(c.genre_src), lower(g.genre)))""",
            final="""SELECT query, rank, row_id, title, ratings FROM
              (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY ratings DESC NULLS LAST, row_id)
                              AS BIGINT) AS rank FROM hits) WHERE rank <= 5"""),
        "notebook_recommend_title": sql(*by_rows(
            """SELECT CAST(0 AS BIGINT) AS query_id, min(c.row_id) AS src
               FROM (SELECT title FROM catalog ORDER BY row_id LIMIT 1) f
               JOIN catalog c ON lower(c.title) = lower(f.title)""", mask=False, score_name="score2"),
            dedupe=False, final="SELECT query_id, rank, row_id, title, score2 AS score FROM ranked"),
        "notebook_recommend_query": sql(*by_text(_fixed(C.DEMO_QUERY), skip_empty=False, score_name="score2"),
            dedupe=False, final="SELECT query_id, rank, row_id, title, score2 AS score FROM ranked"),
        "eval_sample": sql(final="SELECT row_id, title FROM sample"),
        "intra_list_similarity": sql(*batch, *members_ils(),
                                     final="SELECT query_id, k, round(ils, 6) AS ils FROM ils"),
        "eval_summary": sql(*batch, *members_ils(), final="""SELECT
            round(coalesce(avg(CASE WHEN ils > 0 THEN ils END), 0.0), 6) AS mean_ils,
            round(avg(CASE WHEN k >= 2 THEN ils END), 6) AS mean_ils_notebook,
            count(*) AS lists,
            round((SELECT count(DISTINCT title) FROM ranked) / (SELECT count(*) FROM catalog) * 100, 6)
              AS coverage_pct,
            round((SELECT avg(m) FROM (SELECT avg(similarity_score) AS m FROM ranked GROUP BY query_id)), 6)
              AS mean_score
            FROM ils"""),
        "ils_hist": sql(*batch, *members_ils(), *hist("SELECT ils AS v FROM ils WHERE k >= 2", 15),
                        final=HIST_OUT),
        "catalog_shape": sql(final="""SELECT count(*) AS n_rows,
            'row_id,title,description,ratings,genre,expanded_genres,genre_src' AS columns FROM films"""),
        "catalog_preview": sql(final="""SELECT row_id, title, description, ratings, genre, expanded_genres
            FROM films ORDER BY row_id LIMIT 3"""),
        "dense_row_index": sql(final="SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS position FROM catalog"),
        "title_suggestions_gated": sql(
            """words AS (SELECT DISTINCT w AS query FROM
                 (SELECT unnest(string_split(name_only, ' ')) AS w FROM catalog) WHERE length(w) >= 2)""",
            """cand AS (SELECT q.query, c.row_id, c.title,
                         CASE WHEN starts_with(c.name_only, q.query) THEN 0 ELSE 1 END AS match_rank
                       FROM words q JOIN catalog c ON contains(c.name_only, q.query)
                       QUALIFY row_number() OVER (PARTITION BY q.query, c.title ORDER BY c.row_id) = 1)""",
            final="""SELECT query, rank, row_id, title FROM
              (SELECT query, row_id, title,
                      CAST(row_number() OVER (PARTITION BY query ORDER BY match_rank, row_id) AS BIGINT) AS rank
               FROM cand) WHERE rank <= 6"""),
        "score_hist": sql(*batch, *hist("SELECT avg(similarity_score) AS v FROM ranked GROUP BY query_id", 15),
                          final=HIST_OUT),
        "stats_display": sql(final="""SELECT format('{:,}', (SELECT count(*) FROM catalog)) AS total_movies,
            format('{:,}', (SELECT count(*) FROM vocab)) AS tfidf_features,
            format('{:,}', (SELECT count(*) FROM all_genres)) AS total_genres,
            printf('%.1f%%', round(100.0 * (1.0 - (SELECT count(*) FROM postings) /
              ((SELECT count(*) FROM catalog) * (SELECT count(*) FROM vocab))), 1)) AS sparsity"""),
        "notebook_eval_summary": sql(*by_rows(
            """SELECT s.row_id AS query_id, min(c.row_id) AS src FROM sample s
               JOIN catalog c ON lower(c.title) = lower(s.title) GROUP BY s.row_id""",
            mask=False, score_name="score2"),
            """members AS (SELECT r.query_id, r.rank, f.row_id FROM ranked r
                           JOIN (SELECT lower(title) AS lk, min(row_id) AS row_id FROM catalog GROUP BY lower(title)) f
                           ON f.lk = lower(r.title))""",
            *members_ils()[1:], dedupe=False, raw=True, final="""SELECT
            round(avg(CASE WHEN k >= 2 THEN ils END), 6) AS mean_ils,
            count(*) AS lists,
            round((SELECT count(DISTINCT title) FROM ranked) / (SELECT count(*) FROM catalog) * 100, 6)
              AS coverage_pct,
            round((SELECT avg(m) FROM (SELECT avg(score2) AS m FROM ranked GROUP BY query_id)), 6) AS mean_score
            FROM ils"""),
        "bow_vs_tfidf_shapes": sql(dedupe=False, final="""
            SELECT m AS method, (SELECT count(*) FROM catalog) AS n_docs,
                   (SELECT count(*) FROM vocab) AS n_features, (SELECT count(*) FROM postings) AS nnz
            FROM (VALUES ('bow'), ('tfidf')) v(m)"""),
        "model_stats": stats,
        "model_roundtrip": stats,
        "result_cards": sql(*asked, final=f"SELECT {_cards_cols()} FROM ranked"),
        "score_table": sql(*asked, final="""SELECT query_id, rank, title AS "Title",
            coalesce(format('{:.1f}%', CAST(similarity_score AS DOUBLE) * 100), '—')
              AS "Similarity Score",
            ratings AS "Ratings" FROM ranked"""),
        "match_chart": sql(*asked, final="""SELECT query_id, rank, substr(title, 1, 22) || '…' AS movie,
            CAST(format('{:.1f}', CAST(similarity_score AS DOUBLE) * 100) AS DOUBLE) AS score FROM ranked"""),
    }
    return out
