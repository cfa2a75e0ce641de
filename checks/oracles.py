"""The same answers in SQL, for every query that SQL can express on the whole tables."""

from __future__ import annotations

from checks.tables import MIN_COUNT, STOP_LIST, TOP, USAGE_WORD, WORDS
from lexspark.operators.ranking import OUTPUTS_PER_WORD
from lexspark.functions.vectors import LAYER_WIDTHS

TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


# named sub-queries and what they need
PARTS = {
    "sents": ((), r"""
        SELECT doc_id, title, p - 1 AS sent_id, s[p] AS sentence
        FROM (
            SELECT doc_id, title, s, unnest(range(1, len(s) + 1)) AS p
            FROM (
                SELECT doc_id, source || ' ' || doc_id AS title,
                       string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s
                FROM documents
            )
        ) WHERE regexp_matches(s[p], '\S')"""),
    "lists": (("sents",), f"""
        SELECT *, regexp_extract_all(sentence, '{TOKEN}') AS toks FROM sents"""),
    "toks": (("lists",), """
        SELECT doc_id, title, sent_id, sentence, i - 1 AS tok_id, lower(toks[i]) AS word, len(toks) AS n
        FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM lists)"""),
    "frequent": (("toks",), rf"""
        SELECT word FROM toks WHERE regexp_matches(word, '^\p{{L}}+$')
        GROUP BY word HAVING count(*) >= {MIN_COUNT}"""),
    "vocab": (("frequent",), f"SELECT word FROM frequent WHERE word NOT IN ({_list(STOP_LIST)})"),
    "flagged": (("toks",), rf"""
        SELECT *, regexp_matches(word, '^\p{{L}}+$') AND word NOT IN ({_list(STOP_LIST)}) AS content
        FROM toks"""),
    "around": (("flagged",), """
        SELECT *,
            max(CASE WHEN content THEN tok_id END) OVER (
                PARTITION BY doc_id, sent_id ORDER BY tok_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
            min(CASE WHEN content THEN tok_id END) OVER (
                PARTITION BY doc_id, sent_id ORDER BY tok_id
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
        FROM flagged"""),
    "heads": (("around",), """
        SELECT doc_id, title, sent_id, sentence, tok_id, word, n,
            CASE WHEN content THEN coalesce(before, tok_id)
                 ELSE coalesce(after, before, 0) END AS head
        FROM around"""),
    "climb": (("heads",), """
        SELECT doc_id, sent_id, tok_id, head AS up, 1 AS depth FROM heads WHERE head <> tok_id
        UNION ALL
        SELECT c.doc_id, c.sent_id, c.tok_id, h.head, c.depth + 1
        FROM climb c JOIN heads h ON h.doc_id = c.doc_id AND h.sent_id = c.sent_id AND h.tok_id = c.up
        WHERE h.head <> h.tok_id"""),
    "ancestors": (("heads", "climb"), """
        SELECT h.doc_id, h.sent_id, h.tok_id, coalesce(c.depth, 0) AS ancestors,
               coalesce(c.leftmost, h.tok_id) AS leftmost
        FROM heads h LEFT JOIN (
            SELECT doc_id, sent_id, tok_id, max(depth) AS depth, min(up) AS leftmost
            FROM climb GROUP BY ALL
        ) c USING (doc_id, sent_id, tok_id)"""),
    "children": (("heads",), """
        SELECT h.doc_id, h.sent_id, h.tok_id, coalesce(c.children, 0) AS children,
               greatest(h.tok_id, coalesce(c.rightmost, h.tok_id)) AS rightmost
        FROM heads h LEFT JOIN (
            SELECT doc_id, sent_id, head AS tok_id, count(*) AS children, max(tok_id) AS rightmost
            FROM heads WHERE head <> tok_id GROUP BY ALL
        ) c USING (doc_id, sent_id, tok_id)"""),
    "scored": (("heads", "ancestors", "children"), """
        SELECT h.*, (ancestors + children + 1)::DOUBLE / n AS score
        FROM heads h JOIN ancestors USING (doc_id, sent_id, tok_id)
                     JOIN children USING (doc_id, sent_id, tok_id)"""),
    "ranked": (("scored", "vocab"), """
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY
            score DESC, sentence DESC, title DESC, doc_id, sent_id, tok_id) AS rank
        FROM scored WHERE word IN (FROM vocab)"""),
    "examples": (("ranked",), f"SELECT * FROM ranked WHERE rank <= {TOP}"),
    "inputs": (("examples",), r"""
        SELECT word, rank - 1 AS n, word || '-' || (rank - 1) AS unique_id, sentence,
            CASE WHEN regexp_matches(sentence, '^[^\n]* \|\|\| [^\n]*\n?\z')
                 THEN regexp_extract(sentence, '^([^\n]*) \|\|\| ([^\n]*)\n?\z', 1)
                 ELSE sentence END AS text_a,
            CASE WHEN regexp_matches(sentence, '^[^\n]* \|\|\| [^\n]*\n?\z')
                 THEN regexp_extract(sentence, '^([^\n]*) \|\|\| ([^\n]*)\n?\z', 2) END AS text_b
        FROM examples"""),
    "letters": (("frequent",), """
        SELECT DISTINCT unnest(regexp_extract_all(word, '.')) AS c FROM frequent"""),
    "token_vocab": (("frequent", "letters"), """
        SELECT t[i] AS token, i - 1 AS id
        FROM (SELECT ['[PAD]', '[UNK]', '[CLS]', '[SEP]'] AS t, unnest(range(1, 5)) AS i)
        UNION ALL
        SELECT token, 3 + row_number() OVER (ORDER BY token) FROM (
            SELECT word AS token FROM frequent UNION SELECT c FROM letters
            UNION SELECT '##' || c FROM letters)"""),
    "turns": ((), r"SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations"),
    "pairs": (("turns",), """
        SELECT a.conv_id || ':' || a.turn AS pair_id, a.text || ' ||| ' || b.text AS sentence
        FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"""),
    "parts": (("pairs",), r"""
        SELECT pair_id, regexp_extract(sentence, '^([^\n]*) \|\|\| ([^\n]*)\n?\z', 1) AS text_a,
               regexp_extract(sentence, '^([^\n]*) \|\|\| ([^\n]*)\n?\z', 2) AS text_b
        FROM pairs"""),
    "pair_lists": (("parts",), f"""
        SELECT pair_id, [lower(x) FOR x IN regexp_extract_all(text_a, '{TOKEN}')] AS a,
               [lower(x) FOR x IN regexp_extract_all(text_b, '{TOKEN}')] AS b
        FROM parts"""),
    # the longer part loses tokens, the second one on ties, until both fit in 125
    "pair_cut": (("pair_lists",), """
        SELECT pair_id AS unique_id,
            a[1:CASE WHEN len(b) = 0 THEN 126 WHEN len(a) + len(b) <= 125 THEN len(a)
                     WHEN len(a) <= 63 THEN len(a) WHEN len(b) <= 62 THEN 125 - len(b) ELSE 63 END] AS a,
            CASE WHEN len(b) > 0 THEN
            b[1:CASE WHEN len(a) + len(b) <= 125 THEN len(b)
                     WHEN len(a) <= 63 THEN 125 - len(a) WHEN len(b) <= 62 THEN len(b) ELSE 62 END] END AS b
        FROM pair_lists"""),
    "codes": (("toks",), r"""
        SELECT doc_id, sent_id, tok_id, ('0x' || md5(word)[1:4])::INT % 64 AS bucket,
               CASE WHEN md5(word)[5:5] < '8' THEN 1 ELSE -1 END AS sign
        FROM toks WHERE regexp_matches(word, '^[\p{L}\p{N}]+$')"""),
    "points": ((), """
        SELECT label::VARCHAR AS word, vec_id AS occ_id, embedding::DOUBLE[] AS v FROM embeddings"""),
    "distances": (("points",), """
        SELECT a.word, a.occ_id, b.occ_id AS other, round(list_distance(a.v, b.v), 9) AS distance
        FROM points a JOIN points b ON a.word = b.word AND a.occ_id <> b.occ_id"""),
    "near": (("distances",), """
        SELECT *, row_number() OVER (PARTITION BY word, occ_id ORDER BY distance, other) AS rank
        FROM distances"""),
    "cores": (("near",), """
        SELECT word, occ_id, max(distance) AS core FROM near WHERE rank <= 4 GROUP BY ALL"""),
}


def _with(main: str, *parts: str) -> str:
    seen: list[str] = []

    def add(name: str) -> None:
        for needed in PARTS[name][0]:
            add(needed)
        if name not in seen:
            seen.append(name)

    for part in parts:
        add(part)
    if not seen:
        return main
    # shared sub-queries are computed once
    body = ",\n".join(
        f"{n} AS {'' if n == 'climb' else 'MATERIALIZED'} ({PARTS[n][1]})" for n in seen
    )
    return f"WITH RECURSIVE {body}\n{main}"


def _vectors(width: int, words: str) -> str:
    """Occurrence vectors of one context width as text."""
    return f"""
        SELECT o.doc_id, o.sent_id, o.tok_id, o.word, coalesce(v.vec, '') AS vec
        FROM (SELECT doc_id, sent_id, tok_id, word FROM toks WHERE word IN {words}) o LEFT JOIN (
            SELECT doc_id, sent_id, tok_id,
                   string_agg(bucket || ':' || millionths, ' ' ORDER BY bucket) AS vec
            FROM (
                SELECT *, round(round(s / nullif(sqrt(sum(s * s) OVER (PARTITION BY doc_id, sent_id, tok_id)), 0), 6)
                                * 1e6)::BIGINT AS millionths
                FROM (
                    SELECT o.doc_id, o.sent_id, o.tok_id, c.bucket, round(sum(c.sign / abs(o.d)), 9) AS s
                    FROM (SELECT *, unnest(range(-{width}, {width + 1})) AS d FROM toks
                          WHERE word IN {words}) o
                    JOIN codes c ON c.doc_id = o.doc_id AND c.sent_id = o.sent_id
                                AND c.tok_id = o.tok_id + o.d
                    WHERE o.d <> 0 GROUP BY ALL
                )
            ) WHERE millionths <> 0 GROUP BY ALL
        ) v USING (doc_id, sent_id, tok_id)"""


_TRIM = rf"regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')"
_ARTICLE = f"list_aggregate([{_TRIM} FOR x IN string_split(text, chr(10))], 'string_agg', ' ')"
_ARTICLES = f"SELECT source || ' ' || doc_id AS title, {_ARTICLE} AS article FROM documents"
_RUNS = """
    SELECT vec_id, label, sum(changed) OVER (ORDER BY vec_id) AS run FROM (
        SELECT *, CASE WHEN lag(label) OVER (ORDER BY vec_id) <> label THEN 1 ELSE 0 END AS changed
        FROM embeddings)"""

ORACLES = {
    "src_articles": _ARTICLES,
    "src_articles_splittable": _ARTICLES,
    "src_manifest_articles": _ARTICLES + """
        WHERE source IN (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 10)""",
    "first_article_per_file": _ARTICLES + """
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1""",
    "parse_doc_title": "SELECT doc_id, source || ' ' || doc_id AS title FROM documents",
    "src_vocab": _with("SELECT DISTINCT word FROM toks", "toks"),
    "src_stopwords": _with("""
        SELECT word FROM (SELECT word FROM toks GROUP BY word HAVING count(DISTINCT doc_id) >= 100)""", "toks"),
    "src_title_weights": "SELECT source || ' ' || doc_id AS title, n_chars AS pageviews FROM documents",
    "top_titles": """
        SELECT source || ' ' || doc_id AS title, n_chars AS pageviews FROM documents
        ORDER BY pageviews DESC, title LIMIT 100""",
    "filter_top_titles": """
        SELECT doc_id, source || ' ' || doc_id AS title FROM documents
        ORDER BY n_chars DESC, title LIMIT 500""",
    "src_examples_json": _with("SELECT word, (rank - 1)::INT AS n, sentence FROM examples", "examples"),
    "sink_examples": _with("""
        SELECT word, count(*) AS n_examples,
               string_agg(sentence || chr(9) || title, chr(10) ORDER BY rank) AS examples
        FROM examples GROUP BY word""", "examples"),
    "src_feature_jsonl": """
        SELECT label::VARCHAR AS word, label || '-' || vec_id || ':1' AS occ_id,
               label || '-' || vec_id AS sentence,
               list_aggregate([round(round(x::DOUBLE, 6) * 1e6)::BIGINT::VARCHAR FOR x IN embedding],
                              'string_agg', ' ') AS vec
        FROM embeddings""",
    "sink_features": _with(f"""
        SELECT unique_id AS linex_index, sentence AS original_sentence,
               len([x FOR x IN regexp_extract_all(sentence, '{TOKEN}') IF lower(x) = word]) AS n_features
        FROM (SELECT *, word || '-' || (row_number() OVER (PARTITION BY word ORDER BY
                  score DESC, sentence DESC, title DESC, doc_id, sent_id, tok_id) - 1) AS unique_id
              FROM scored WHERE word IN ({_list(WORDS)})
              QUALIFY row_number() OVER (PARTITION BY word ORDER BY
                  score DESC, sentence DESC, title DESC, doc_id, sent_id, tok_id) <= {OUTPUTS_PER_WORD})
        """, "scored"),
    "features_by_word": _with(
        "SELECT word, count(*) AS n_records FROM examples GROUP BY word", "examples"),
    "token_text": _with(f"""
        SELECT doc_id || '-' || sent_id AS linex_index,
               string_agg(word, ' ' ORDER BY tok_id) AS token_text
        FROM toks WHERE word IN ({_list(WORDS)}) GROUP BY ALL""", "toks"),
    "sentences": _with("SELECT doc_id, sent_id::INT AS sent_id, sentence FROM sents", "sents"),
    "tokens": _with("SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, word FROM toks", "toks"),
    "sentence_length": _with(
        "SELECT doc_id, sent_id::INT AS sent_id, len(toks) AS n_tokens FROM lists", "lists"),
    "effective_vocab": _with("SELECT word FROM vocab", "vocab"),
    "vocab_occurrences": _with("""
        SELECT word, doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id
        FROM toks WHERE word IN (FROM vocab)""", "toks", "vocab"),
    "filter_word": _with(f"""
        SELECT title, sent_id::INT AS sent_id, tok_id::INT AS tok_id, word, round(score, 9) AS score
        FROM scored WHERE word = '{USAGE_WORD}'""", "scored"),
    "word_list": "SELECT DISTINCT lang, source AS word FROM documents",
    "target_tokens": _with(f"""
        SELECT doc_id || '-' || sent_id AS unique_id, tok_id::INT AS pos, word AS token
        FROM toks WHERE word IN ({_list(WORDS)})""", "toks"),
    "own_word_tokens": _with(f"""
        SELECT word, unique_id AS linex_index, i::INT AS tok_no, word AS token
        FROM (SELECT word, unique_id, unnest(range(len([x FOR x IN
                  regexp_extract_all(sentence, '{TOKEN}') IF lower(x) = word]))) AS i
              FROM inputs WHERE word IN ({_list(WORDS)}))""", "inputs"),
    "explode_scored_words": _with(
        "SELECT doc_id, sent_id::INT AS sent_id, word, round(score, 9) AS score FROM scored", "scored"),
    "pack_struct": _with("""
        SELECT title, word, sentence, round(score, 9) AS simplicity FROM examples""", "examples"),
    "collect_by_word": _with("""
        SELECT word, string_agg(title || '|' || sentence, chr(10) ORDER BY title || '|' || sentence) AS packaged
        FROM examples GROUP BY word""", "examples"),
    "chain_heads": _with("""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, head::INT AS head FROM heads""", "heads"),
    "children_count": _with("""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, children::INT AS children
        FROM children""", "children"),
    "ancestor_count": _with("""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, ancestors::INT AS ancestors
        FROM ancestors""", "ancestors"),
    "simplicity": _with("""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, round(score, 9) AS simplicity
        FROM scored""", "scored"),
    "span_coverage": _with("""
        SELECT h.doc_id, h.sent_id::INT AS sent_id, h.tok_id::INT AS tok_id,
               round((rightmost - leftmost)::DOUBLE / n, 9) AS coverage
        FROM heads h JOIN ancestors USING (doc_id, sent_id, tok_id)
                     JOIN children USING (doc_id, sent_id, tok_id)""", "heads", "ancestors", "children"),
    "top_examples": _with("""
        SELECT word, title, sentence, sent_id::INT AS sent_id, tok_id::INT AS tok_id,
               round(1000 * score, 6) AS score, rank::INT AS rank
        FROM examples""", "examples"),
    "text_pairs": _with("SELECT pair_id, text_a, text_b FROM parts", "parts"),
    "input_examples": _with(
        "SELECT word, n::INT AS n, unique_id, text_a, text_b FROM inputs", "inputs"),
    "features_with_sentence": _with(f"""
        SELECT unique_id, len(regexp_extract_all(text_a, '{TOKEN}')) AS n_tokens, sentence
        FROM inputs""", "inputs"),
    "subwords": _with("""
        , types AS MATERIALIZED (SELECT DISTINCT word FROM toks), spans AS MATERIALIZED (
            SELECT word, start, max(stop) AS stop
            FROM (SELECT word, start, unnest(range(start, length(word) + 1)) AS stop
                  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS start FROM types
                        WHERE length(word) <= 200))
            WHERE CASE WHEN start = 1 THEN '' ELSE '##' END || substr(word, start, stop - start + 1)
                  IN (SELECT token FROM token_vocab)
            GROUP BY ALL
        ), walk AS (
            SELECT word, 1::BIGINT AS place, '' AS pieces FROM types
            UNION ALL
            SELECT w.word, s.stop + 1,
                w.pieces || CASE WHEN s.start = 1 THEN '' ELSE ' ##' END
                         || substr(w.word, s.start, s.stop - s.start + 1)
            FROM walk w JOIN spans s ON s.word = w.word AND s.start = w.place
        )
        SELECT t.word, coalesce(w.pieces, '[UNK]') AS pieces
        FROM types t LEFT JOIN walk w ON w.word = t.word AND w.place = length(t.word) + 1
        """, "toks", "token_vocab"),
    "token_ids": _with("""
        SELECT doc_id || '-' || sent_id AS unique_id,
               string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY tok_id) AS input_ids
        FROM toks LEFT JOIN token_vocab ON token = word GROUP BY ALL""", "toks", "token_vocab"),
    "truncate_single": _with("""
        SELECT doc_id, sent_id::INT AS sent_id, list_aggregate(toks[1:126], 'string_agg', ' ') AS tokens
        FROM lists""", "lists"),
    "truncate_pair": _with("""
        SELECT unique_id, array_to_string(a, ' ') AS tokens_a, array_to_string(b, ' ') AS tokens_b
        FROM pair_cut""", "pair_cut"),
    "pack_sequence": _with("""
        , packed AS (
            SELECT unique_id, list_concat(['[CLS]'], a, ['[SEP]'],
                       CASE WHEN b IS NULL THEN [] ELSE list_concat(b, ['[SEP]']) END) AS tokens,
                   len(a) + 2 AS n_a, coalesce(len(b) + 1, 0) AS n_b
            FROM pair_cut
        ), ids AS (
            SELECT unique_id, string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY i) AS ids
            FROM (SELECT unique_id, i, tokens[i] AS token
                  FROM (SELECT unique_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM packed))
            LEFT JOIN token_vocab USING (token) GROUP BY unique_id
        )
        SELECT unique_id, array_to_string(tokens, ' ') AS tokens,
               ids || repeat(' 0', 128 - n_a - n_b) AS input_ids,
               '1' || repeat(' 1', n_a + n_b - 1) || repeat(' 0', 128 - n_a - n_b) AS input_mask,
               '0' || repeat(' 0', n_a - 1) || repeat(' 1', n_b) || repeat(' 0', 128 - n_a - n_b)
                   AS input_type_ids
        FROM packed JOIN ids USING (unique_id)""", "pair_cut", "token_vocab"),
    "context_vectors": _with(f"""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, word, vec
        FROM ({_vectors(LAYER_WIDTHS[-1], '(FROM vocab)')})""", "toks", "vocab", "codes"),
    "vector_layers": _with(" UNION ALL ".join(f"""
        SELECT doc_id, sent_id::INT AS sent_id, tok_id::INT AS tok_id, {layer}::INT AS layer, vec
        FROM ({_vectors(width, '(' + _list(WORDS) + ')')})"""
        for layer, width in LAYER_WIDTHS.items()), "toks", "codes"),
    "model_features": _with(f"""
        , wanted AS (
            SELECT unique_id, word, [lower(x) FOR x IN regexp_extract_all(text_a, '{TOKEN}')] AS a,
                   [lower(x) FOR x IN regexp_extract_all(text_b, '{TOKEN}')] AS b
            FROM inputs WHERE word IN ({_list(WORDS)})
        ), cut AS (
            SELECT unique_id, word,
                a[1:CASE WHEN coalesce(len(b), 0) = 0 THEN 126 WHEN len(a) + len(b) <= 125 THEN len(a)
                         WHEN len(a) <= 63 THEN len(a) WHEN len(b) <= 62 THEN 125 - len(b) ELSE 63 END] AS a,
                CASE WHEN len(b) > 0 THEN
                b[1:CASE WHEN len(a) + len(b) <= 125 THEN len(b)
                         WHEN len(a) <= 63 THEN 125 - len(a) WHEN len(b) <= 62 THEN len(b) ELSE 62 END] END AS b
            FROM wanted
        ), packed AS (
            SELECT unique_id, word, len(a) + 2 AS n_a, coalesce(len(b) + 1, 0) AS n_b,
                list_concat(['[CLS]'], a, ['[SEP]'], CASE WHEN b IS NULL THEN [] ELSE list_concat(b, ['[SEP]']) END) AS tokens
            FROM cut
        ), places AS (
            SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM packed
        )
        SELECT unique_id AS linex_index,
            (row_number() OVER (PARTITION BY unique_id ORDER BY i) - 1)::INT AS tok_no, word AS token, 1::INT AS n_layers,
            concat_ws(' ', coalesce(id, 1), i - 1, n_a + n_b, CASE WHEN i > n_a THEN 1 ELSE 0 END) AS values
        FROM places LEFT JOIN token_vocab ON token = tokens[i] WHERE tokens[i] = word""", "inputs", "token_vocab"),
    "knn_graph": _with("""
        SELECT word, occ_id, rank::INT AS rank, other, round(distance, 6) AS distance
        FROM near WHERE rank <= 80""", "near"),
    "fuzzy_graph": _with("""
        , gaps AS MATERIALIZED (
            SELECT word, occ_id, list(other ORDER BY rank) AS others,
                   list(greatest(distance - rho, 0) ORDER BY rank) AS gaps
            FROM (SELECT *, coalesce(min(CASE WHEN distance > 0 THEN distance END)
                                     OVER (PARTITION BY word, occ_id), 0) AS rho
                  FROM near WHERE rank <= 80) GROUP BY ALL
        ), search AS (
            SELECT word, occ_id, gaps, 0 AS step, 0::DOUBLE AS lo, 'inf'::DOUBLE AS hi, 1::DOUBLE AS mid
            FROM gaps
            UNION ALL
            SELECT word, occ_id, gaps, step + 1, l, h,
                   CASE WHEN h = 'inf'::DOUBLE THEN l * 2 ELSE (l + h) / 2 END
            FROM (SELECT *, CASE WHEN total > goal THEN lo ELSE mid END AS l,
                            CASE WHEN total > goal THEN mid ELSE hi END AS h
                  FROM (SELECT *, list_sum([exp(-g / mid) FOR g IN gaps]) AS total,
                               log2(len(gaps)) AS goal
                        FROM search WHERE step < 64))
        ), directed AS (
            SELECT word, occ_id, unnest(others) AS other, exp(-unnest(gaps) / mid) AS weight
            FROM (SELECT s.word, s.occ_id, g.others, g.gaps, s.mid
                  FROM search s JOIN gaps g USING (word, occ_id) WHERE step = 64)
        )
        SELECT word, least(occ_id, other) AS a, greatest(occ_id, other) AS b,
               round(max(weight) + CASE WHEN count(*) > 1 THEN min(weight) ELSE 0 END
                     - max(weight) * CASE WHEN count(*) > 1 THEN min(weight) ELSE 0 END, 6) AS weight
        FROM directed GROUP BY ALL""", "near"),
    "core_distance": _with("SELECT word, occ_id, round(core, 6) AS core FROM cores", "cores"),
    "mutual_reachability": _with("""
        SELECT n.word, n.occ_id, n.other,
               round(greatest(n.distance, a.core, b.core), 6) AS reachability
        FROM near n JOIN cores a ON a.word = n.word AND a.occ_id = n.occ_id
                    JOIN cores b ON b.word = n.word AND b.occ_id = n.other
        WHERE n.rank <= 80""", "near", "cores"),
    # shortest edges first; comps[i] names the component of the i-th point of the word
    "spanning_tree": _with("""
        , numbered AS MATERIALIZED (
            SELECT word, occ_id, row_number() OVER (PARTITION BY word ORDER BY occ_id) AS i FROM cores
        ), e AS MATERIALIZED (
            SELECT d.word, d.occ_id AS a, d.other AS b, p.i AS ia, q.i AS ib, greatest(distance, x.core, y.core) AS length,
                   row_number() OVER (PARTITION BY d.word ORDER BY greatest(distance, x.core, y.core), d.occ_id, d.other) AS at
            FROM distances d
            JOIN cores x ON x.word = d.word AND x.occ_id = d.occ_id JOIN cores y ON y.word = d.word AND y.occ_id = d.other
            JOIN numbered p ON p.word = d.word AND p.occ_id = d.occ_id
            JOIN numbered q ON q.word = d.word AND q.occ_id = d.other
            WHERE d.occ_id < d.other
        ), k AS (
            SELECT word, 0::BIGINT AS at, range(1, max(i) + 1) AS comps, NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::DOUBLE AS length
            FROM numbered GROUP BY word
            UNION ALL
            SELECT k.word, e.at,
                   CASE WHEN k.comps[ia] = k.comps[ib] THEN k.comps ELSE list_transform(
                       k.comps, lambda c: CASE WHEN c = k.comps[ib] THEN k.comps[ia] ELSE c END) END,
                   CASE WHEN k.comps[ia] <> k.comps[ib] THEN e.a END, CASE WHEN k.comps[ia] <> k.comps[ib] THEN e.b END,
                   CASE WHEN k.comps[ia] <> k.comps[ib] THEN e.length END
            FROM k JOIN e ON e.word = k.word AND e.at = k.at + 1
        )
        SELECT word, a, b, round(length, 6) AS length FROM k WHERE a IS NOT NULL""", "distances", "cores"),
    "knn_plane": """
        WITH p AS (
            SELECT o_orderstatus AS word, o_orderkey AS occ_id, o_totalprice / 1000 AS x,
                   date_diff('day', DATE '1990-01-01', o_orderdate::DATE)::DOUBLE AS y FROM orders
        ), near AS (
            SELECT a.word, a.occ_id, min({'distance': round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 9),
                                          'other': b.occ_id}, 10) AS n
            FROM p a JOIN p b ON a.word = b.word AND a.occ_id <> b.occ_id GROUP BY a.word, a.occ_id
        )
        SELECT word, occ_id, i::INT AS rank, n[i].other AS other, n[i].distance AS distance
        FROM near, range(1, 11) t(i) WHERE i <= len(n)""",
    "knn_pivots": """
        WITH p AS (SELECT vec_id AS occ_id, embedding::DOUBLE[] AS v FROM embeddings),
        near AS (
            SELECT a.occ_id, min({'distance': round(list_distance(a.v, b.v), 9), 'other': b.occ_id}, 10) AS n
            FROM p a JOIN p b ON a.occ_id <> b.occ_id GROUP BY a.occ_id
        )
        SELECT occ_id, i::INT AS rank, n[i].other AS other, round(n[i].distance, 6) AS distance
        FROM near, range(1, 11) t(i) WHERE i <= len(n)""",
    "label_runs": f"SELECT vec_id, label, run::BIGINT AS run FROM ({_RUNS})",
    "label_partition": f"""
        SELECT vec_id, label, CASE WHEN run = 0 THEN 0 ELSE 1 END AS part FROM ({_RUNS})""",
}
