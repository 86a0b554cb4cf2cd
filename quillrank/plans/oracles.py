"""SQL for another engine (DuckDB) that computes what the named queries must give."""

from quillrank.functions.tokens import STOPWORDS, TOKEN_PATTERN
from quillrank.plans import porter_sql
from quillrank.plans.registry import DOCUMENT_QUERIES
from quillrank.sources import tables


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DOCUMENTS = """
articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, string_split(text, chr(10))[1] AS title, source,
         list_filter(string_split(text, chr(10))[2:], lambda line: line <> '') AS paragraphs
  FROM documents)"""


def _unescaped(text: str) -> str:
    for entity, character in tables.HTML_ENTITIES.items():
        text = f"replace({text}, {_quoted(entity)}, {_quoted(character)})"
    return text


_BLOCK = (
    f"regexp_replace(regexp_replace(block, {_quoted(tables.HTML_PARAGRAPH_END)}, '', 'g'), "
    f"{_quoted(tables.HTML_TAG)}, ' ', 'g')"
)
_PAGES = f"""
articles AS (
  SELECT CAST(page_id AS VARCHAR) AS id,
         {_unescaped(f"regexp_extract(html, {_quoted(tables.HTML_TITLE)}, 1)")} AS title, NULL AS source,
         list_transform(
           string_split_regex(
             regexp_replace(html, {_quoted(tables.HTML_HIDDEN)}, ' ', 'g'),
             {_quoted(tables.HTML_PARAGRAPH_START)})[2:],
           lambda block: {_unescaped(_BLOCK)}) AS paragraphs
  FROM pages)"""

_MIXED = """
blocks AS (
  SELECT conv_id, list(text ORDER BY turn) FILTER (role IN ('user', 'assistant') AND text IS NOT NULL) AS paragraphs,
         max(text) FILTER (turn = 3) AS title
  FROM conversations GROUP BY conv_id),
articles AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, title, NULL AS source, coalesce(paragraphs, []) AS paragraphs
  FROM blocks WHERE title IS NOT NULL)"""

# A query file holds one line per query.
_LINE_QUERIES = (
    "queries AS (SELECT row_number() OVER () AS query_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS query "
    "FROM conversations WHERE role = 'user')"
)

_FIXED_QUERIES = "queries(query_id, query) AS (VALUES {})".format(
    ", ".join(f"(CAST({number} AS BIGINT), {_quoted(text)})" for number, text in DOCUMENT_QUERIES)
)
_USER_QUERIES = (
    "queries AS (SELECT conv_id * 4294967296 + turn AS query_id, text AS query FROM conversations WHERE role = 'user')"
)
_BENCHMARK_QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

_STOP = "stop(word) AS (VALUES {})".format(", ".join(f"({_quoted(word)})" for word in STOPWORDS))

_QUERY_TERMS = f"""
query_tokens AS (
  SELECT query_id, tokens, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos
  FROM (SELECT query_id, regexp_extract_all(lower(query), '{TOKEN_PATTERN}') AS tokens FROM queries)),
term_rows AS (SELECT query_id, term, pos FROM query_tokens WHERE term NOT IN (SELECT word FROM stop)),
query_sizes AS (SELECT query_id, count(*) AS n_terms FROM term_rows GROUP BY query_id),
query_counts AS (
  SELECT query_id, term, n_terms, count(*) AS qtf
  FROM term_rows JOIN query_sizes USING (query_id) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM term_rows)"""

_TEXTS = """
texts AS (
  SELECT id, title, array_to_string(list_concat([title], paragraphs[1:5]), chr(10)) AS text FROM articles)"""

_LENGTHS = f"""{_TEXTS},
kept AS (
  SELECT id, token
  FROM (SELECT id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}')) AS token FROM texts)
  WHERE token NOT IN (SELECT word FROM stop)),
lengths AS (
  SELECT t.id, t.title, count(k.token) AS length FROM texts t LEFT JOIN kept k USING (id) GROUP BY ALL),
stats AS (
  SELECT count(*) AS n_docs, CAST(sum(length) AS BIGINT) AS total_len,
         CAST(sum(length) // count(*) AS DOUBLE) AS avg_len
  FROM lengths)"""

_POSTINGS = """
postings AS (
  SELECT id, length, token AS term, count(*) AS tf
  FROM kept JOIN lengths USING (id) WHERE token IN (SELECT term FROM vocabulary) GROUP BY ALL),
frequencies AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM postings GROUP BY term)"""


_STEMS = f"""
all_tokens AS (
  SELECT token FROM kept UNION
  SELECT unnest(regexp_extract_all(lower(query), '{TOKEN_PATTERN}')) AS token FROM queries),
{porter_sql.stems("all_tokens")}"""

_STEMMED_QUERY_TERMS = _QUERY_TERMS.replace(
    "SELECT query_id, term, pos FROM query_tokens WHERE",
    "SELECT query_id, stem AS term, pos FROM query_tokens JOIN stems ON token = term WHERE",
)
_STEMMED_POSTINGS = _POSTINGS.replace(
    "SELECT id, length, token AS term, count(*) AS tf\n  FROM kept JOIN lengths USING (id) WHERE token IN",
    "SELECT id, length, stem AS term, count(*) AS tf\n  FROM kept JOIN stems USING (token) JOIN lengths USING (id) WHERE stem IN",
)


def _scores(ratio: str = "n_docs // cf") -> str:
    grain = 2**40
    return f"""
parts AS (
  SELECT id, term, tf, length, cf, tf / length AS f, avg_len, CAST({ratio} AS DOUBLE) AS rarity
  FROM postings JOIN frequencies USING (term), stats),
term_scores AS (
  SELECT id, term, tf, length, cf,
         round_even((1 - f) * (1 - f) / (tf + 1)
           * (tf * log2(tf * avg_len / length * rarity) + 0.5 * log2(2 * pi() * tf * (1 - f)))
           * {grain}, 0) / {grain} AS term_score
  FROM parts),
scores AS (
  SELECT query_id, id, sum(qtf * term_score) / n_terms + 0.0 AS score
  FROM term_scores JOIN query_counts USING (term) GROUP BY query_id, id, n_terms)"""


def _ranking(pad: bool = True) -> str:
    pairs = (
        """SELECT query_id, id, title, coalesce(score, 0.0) AS score
    FROM query_sizes CROSS JOIN (SELECT DISTINCT id FROM postings) JOIN lengths USING (id)
    LEFT JOIN scores USING (query_id, id)"""
        if pad
        else "SELECT query_id, id, title, score FROM scores JOIN lengths USING (id)"
    )
    return f"""
ranking AS (
  SELECT query_id, id, title, score, row_number() OVER (
    PARTITION BY query_id
    ORDER BY CASE WHEN isnan(score) THEN CAST('-infinity' AS DOUBLE) ELSE score END DESC, id) AS place
  FROM ({pairs}))"""


# levenshtein() counts bytes there, so each character of the titles gets a byte of its own.
_CHOSEN = """
letters AS (
  SELECT id, unnest(string_split(title, '')) AS letter, generate_subscripts(string_split(title, ''), 1) AS pos
  FROM lengths),
alphabet AS (
  SELECT letter, chr(CAST(row_number() OVER (ORDER BY letter) AS INTEGER)) AS code
  FROM (SELECT DISTINCT letter FROM letters)),
coded AS (SELECT id, string_agg(code, '' ORDER BY pos) AS code FROM letters JOIN alphabet USING (letter) GROUP BY id),
titled AS (SELECT r.query_id, r.place, coalesce(c.code, '') AS code FROM ranking r LEFT JOIN coded c USING (id)),
walk AS (
  SELECT query_id, CAST(0 AS BIGINT) AS place, CAST([] AS VARCHAR[]) AS codes, CAST([] AS BIGINT[]) AS places
  FROM query_sizes
  UNION ALL
  SELECT query_id, next_place,
         CASE WHEN near THEN codes ELSE list_append(codes, code) END,
         CASE WHEN near THEN places ELSE list_append(places, next_place) END
  FROM (
    SELECT w.query_id, w.codes, w.places, t.code, t.place AS next_place,
           len(list_filter(w.codes, lambda c:
             2 * levenshtein(c, t.code) < greatest(length(c), length(t.code)))) > 0 AS near
    FROM walk w JOIN titled t ON t.query_id = w.query_id AND t.place = w.place + 1
    WHERE len(w.codes) < 10)),
ends AS (SELECT query_id, arg_max(places, place) AS places FROM walk GROUP BY query_id),
chosen AS (
  SELECT e.query_id, q.query, CAST(e.rank AS INTEGER) AS rank, r.id, r.title, r.score
  FROM (SELECT query_id, unnest(places) AS place, generate_subscripts(places, 1) AS rank FROM ends) e
  JOIN ranking r USING (query_id, place) JOIN queries q USING (query_id))"""

_ROUNDED = "round(score, 6) + 0.0 AS score"


def _with(*parts: str, select: str) -> str:
    return f"WITH RECURSIVE {_STOP}, {', '.join(parts)} {select}"


def _scored(queries: str = _FIXED_QUERIES, corpus: str = _DOCUMENTS, **kw: str) -> list[str]:
    return [queries, _QUERY_TERMS, corpus, _LENGTHS, _POSTINGS, _scores(**kw)]


def _on_chosen(select: str, pad: bool = True, **kw: str) -> str:
    return _with(*_scored(**kw), _ranking(pad), _CHOSEN, select=select)


_TOP = f"SELECT query_id, query, rank, id, title, {_ROUNDED} FROM chosen"
_TOP_WITHOUT_QUERY = f"SELECT query_id, rank, id, title, {_ROUNDED} FROM chosen"
_ARTICLE_OF_HIT = "SELECT id, title, source, len(paragraphs) AS n_blocks FROM articles"

ORACLES: dict[str, str] = {
    "query_terms": _with(
        _USER_QUERIES, _QUERY_TERMS,
        select="""SELECT query_id, query, coalesce(terms, '') AS terms, coalesce(counts, '') AS counts
        FROM queries LEFT JOIN (
          SELECT query_id, string_agg(term, ' ' ORDER BY pos) AS terms, string_agg('1', ' ') AS counts
          FROM term_rows GROUP BY query_id) USING (query_id)""",
    ),
    "query_term_rows": _with(
        _BENCHMARK_QUERIES, _QUERY_TERMS, select="SELECT query_id, n_terms, term, qtf FROM query_counts"
    ),
    "query_word_count": _with(
        _USER_QUERIES, _QUERY_TERMS, select="SELECT term, count(*) AS occurrences FROM term_rows GROUP BY term"
    ),
    "query_vocabulary": _with(_USER_QUERIES, _QUERY_TERMS, select="SELECT term FROM vocabulary"),
    "article_text": _with(_DOCUMENTS, _TEXTS, select="SELECT id, title, text FROM texts"),
    "page_text": _with(_PAGES, _TEXTS, select="SELECT id, title, text FROM texts"),
    "corpus_stats": _with(_DOCUMENTS, _LENGTHS, select="SELECT n_docs, total_len, avg_len FROM stats"),
    "postings": _with(
        _USER_QUERIES, _QUERY_TERMS, _DOCUMENTS, _LENGTHS, _POSTINGS,
        select="SELECT id, length, term, tf FROM postings",
    ),
    "term_corpus_frequency": _with(
        _USER_QUERIES, _QUERY_TERMS, _DOCUMENTS, _LENGTHS, _POSTINGS, select="SELECT term, cf FROM frequencies"
    ),
    "dph_term_scores": _with(
        *_scored(),
        select="SELECT id, term, tf, length, cf, round(term_score, 6) + 0.0 AS term_score FROM term_scores",
    ),
    "query_scores": _with(*_scored(), select=f"SELECT query_id, id, {_ROUNDED} FROM scores"),
    "user_query_scores": _with(*_scored(_USER_QUERIES), select=f"SELECT query_id, id, {_ROUNDED} FROM scores"),
    "ranked_top10": _with(
        *_scored(), _ranking(),
        select=f"""SELECT query_id, query, CAST(place AS INTEGER) AS rank, id, title, {_ROUNDED}
        FROM ranking JOIN queries USING (query_id) WHERE place <= 10""",
    ),
    "deduplicated_top10": _on_chosen(_TOP),
    "real_ratio_top10": _on_chosen(_TOP, ratio="n_docs / cf"),
    "unpadded_top10": _on_chosen(_TOP, pad=False),
    "user_query_top10": _on_chosen(_TOP_WITHOUT_QUERY, queries=_USER_QUERIES),
    "benchmark_page_top10": _on_chosen(_TOP_WITHOUT_QUERY, queries=_BENCHMARK_QUERIES, corpus=_PAGES),
    "hits_ascending": _on_chosen(
        f"""SELECT query_id, CAST(row_number() OVER (
          PARTITION BY query_id ORDER BY score, rank) - 1 AS INTEGER) AS position, id, {_ROUNDED} FROM chosen"""
    ),
    "result_ids": _on_chosen("SELECT DISTINCT id FROM chosen"),
    "result_articles": _on_chosen(f"{_ARTICLE_OF_HIT} WHERE id IN (SELECT id FROM chosen)"),
    "document_ranking": _on_chosen(
        f"""SELECT query_id, query, rank - 1 AS position, id AS docid, articles.title, source,
          len(paragraphs) AS n_blocks, {_ROUNDED}
        FROM chosen LEFT JOIN articles USING (id)"""
    ),
    "rendered_ranking": _on_chosen(
        """SELECT query_id, query, query || chr(10) || string_agg(
          '  ' || rank || ':' || id || ' ' || printf('%.6f', score) || ' ' || title || chr(10), '' ORDER BY rank) AS text
        FROM chosen GROUP BY query_id, query"""
    ),
    "json_article_source": _with(
        _DOCUMENTS, select="SELECT id, title, source, array_to_string(paragraphs, chr(10)) AS body FROM articles"
    ),
    "stemmed_terms": _with(
        _FIXED_QUERIES, _DOCUMENTS, _LENGTHS, _STEMS,
        select="SELECT token, stem AS term FROM stems WHERE token IN (SELECT token FROM kept)",
    ),
    "stemmed_ranking": _with(
        _FIXED_QUERIES, _DOCUMENTS, _LENGTHS, _STEMS, _STEMMED_QUERY_TERMS, _STEMMED_POSTINGS, _scores(), _ranking(), _CHOSEN,
        select=_TOP,
    ),
    "parsed_article_source": _with(
        _DOCUMENTS, select="SELECT id, title, source, array_to_string(paragraphs, chr(10)) AS body FROM articles"
    ),
    "text_query_source": _with(
        _LINE_QUERIES, _QUERY_TERMS,
        select="""SELECT query, coalesce(terms, '') AS terms, count(*) AS queries
        FROM queries LEFT JOIN (
          SELECT query_id, string_agg(term, ' ' ORDER BY pos) AS terms FROM term_rows GROUP BY query_id) USING (query_id)
        GROUP BY ALL""",
    ),
    "mixed_article_text": _with(_MIXED, _TEXTS, select="SELECT id, title, text FROM texts"),
    "mixed_corpus_stats": _with(_MIXED, _LENGTHS, select="SELECT n_docs, total_len, avg_len FROM stats"),
    "rendered_sink": _on_chosen(f"SELECT query_id, query, rank, id, {_ROUNDED}, title FROM chosen"),
    "ranking_sink": _on_chosen(
        f"SELECT query_id, replace(query, ' ', '_') AS file_name, rank, id, title, {_ROUNDED} FROM chosen"
    ),
    "title_distance": _with(
        *_scored(), _ranking(pad=False), _CHOSEN,
        select="""SELECT query_id, id, round(CASE WHEN greatest(length(code), length(best)) = 0 THEN 'nan'::DOUBLE
          ELSE levenshtein(best, code) / greatest(length(code), length(best)) END, 6) AS distance
        FROM (SELECT r.query_id, r.id, t.code, first_value(t.code) OVER (
                PARTITION BY r.query_id
                ORDER BY CASE WHEN isnan(score) THEN 1 ELSE 0 END DESC, score DESC, id DESC) AS best
              FROM ranking r JOIN titled t USING (query_id, place))""",
    ),
}
