"""SQL twins of the registered queries, over the same given tables."""

from __future__ import annotations

_LETTERS = "replace(upper(array_to_string(list_sort(list_distinct(string_split({0}, ''))), '')), 'ẞ', 'SS')"

# Derived inputs as common table expressions; each may use the earlier ones.
_PARTS = {
    "vocab": r"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents)
        GROUP BY word""",
    "words": f"""
        SELECT * FROM (SELECT word, n, {_LETTERS.format('word')} AS letter_set FROM vocab)
        WHERE length(word) >= 4 AND length(letter_set) <= 7""",
    "numbered": """
        SELECT letter_set AS letters, row_number() OVER (ORDER BY letter_set) - 1 AS no
        FROM (SELECT DISTINCT letter_set FROM words WHERE length(letter_set) = 7
              AND len(list_distinct(string_split(letter_set, ''))) = 7)""",
    "puzzles": """
        SELECT DATE '2018-01-01' + CAST(no AS INTEGER) AS puzzle_date,
               substr(letters, CAST(1 + no % 7 AS INTEGER), 1) AS center_letter,
               replace(letters, substr(letters, CAST(1 + no % 7 AS INTEGER), 1), '') AS outer_letters,
               repeat(array_to_string(list_sort(string_split(lower(
                   substr(letters, CAST(1 + no % 7 AS INTEGER), 1)
                   || substr(replace(letters, substr(letters, CAST(1 + no % 7 AS INTEGER), 1), ''), 1, 4)), '')), ''), 2)
                   AS made_up
        FROM numbered""",
    "puzzle_keys": """
        SELECT puzzle_date, center_letter, outer_letters,
               array_to_string(list_sort(list_append(
                   list_filter(string_split(outer_letters, ''), lambda x, i: (m >> (i - 1)) & 1 = 1),
                   center_letter)), '') AS letter_set
        FROM puzzles, generate_series(1, 63) g(m)""",
    "matches": """
        SELECT k.*, w.word, w.n FROM puzzle_keys k JOIN words w USING (letter_set)""",
    "answers": """
        SELECT puzzle_date, center_letter, outer_letters, word FROM matches
        WHERE n >= day(puzzle_date)
        UNION ALL
        SELECT puzzle_date, center_letter, outer_letters, made_up FROM puzzles""",
    "decisions": """
        SELECT word, center_letter, outer_letters, puzzle_date, max(accepted) AS accepted
        FROM (SELECT word, center_letter, outer_letters, puzzle_date, 1.0::DOUBLE AS accepted FROM answers
              UNION ALL
              SELECT r.word, center_letter, outer_letters, puzzle_date, 0.0::DOUBLE
              FROM puzzle_keys JOIN raw_words r USING (letter_set)
              WHERE length(r.word) >= 4 AND length(letter_set) <= 7)
        GROUP BY ALL""",
    "raw_words": f"""
        SELECT word, letter_set, 1::BIGINT AS version FROM words
        UNION ALL
        SELECT word, {_LETTERS.format('word')}, 2::BIGINT
        FROM (SELECT DISTINCT word FROM answers WHERE word NOT IN (SELECT word FROM words))""",
    "vectors": """
        SELECT w.word, e.embedding
        FROM (SELECT word, ('0x' || substr(md5(word), 1, 8))::BIGINT
                  % (SELECT CAST(floor(count(*) * 1.05) AS BIGINT) FROM embeddings) AS vec_id
              FROM raw_words) w
        JOIN embeddings e USING (vec_id)""",
    "frequencies": """
        SELECT word, n::DOUBLE AS frequency FROM words
        UNION ALL
        SELECT word, length(word)::DOUBLE FROM raw_words
        WHERE version = 2 AND ('0x' || substr(md5(word), 1, 8))::BIGINT % 2 = 0""",
    "joined": """
        SELECT r.word, r.letter_set, NULL::VARCHAR AS date_added, r.version,
               f.frequency, v.embedding
        FROM raw_words r LEFT JOIN frequencies f USING (word) LEFT JOIN vectors v USING (word)""",
    "latest": """
        SELECT * FROM decisions
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY puzzle_date DESC, accepted DESC) = 1""",
    "states": """
        SELECT j.word, j.letter_set, l.puzzle_date AS last_seen_on, j.frequency, j.embedding,
               l.accepted AS label,
               CASE WHEN l.word IS NULL THEN 'words_1' ELSE 'puzzles_1' END AS batch_id
        FROM joined j LEFT JOIN latest l USING (word)
        WHERE j.version = 1 OR l.word IS NOT NULL""",
    "probabilities": """
        SELECT word, letter_set, last_seen_on,
               coalesce(label, round(64 / (1 + coalesce(frequency, 0.0))) / 64) AS probability,
               CASE WHEN label IS NULL THEN 'model' ELSE 'truth' END AS source,
               CASE WHEN label IS NULL THEN '1' END AS model_version,
               'puzzles_1' AS batch_id
        FROM states""",
    "training": """
        SELECT vec_id, vec_id::DOUBLE AS frequency, log10(vec_id + 1) AS log_frequency, embedding,
               CASE WHEN label >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
        FROM embeddings""",
    "feature_rows": """
        SELECT vec_id, label, position, value FROM (
            SELECT vec_id, label, 0::BIGINT AS position, log_frequency AS value FROM training
            UNION ALL
            SELECT vec_id, label, generate_subscripts(embedding, 1)::BIGINT, unnest(embedding)::DOUBLE
            FROM training)""",
    "priced": """
        SELECT l_extendedprice AS f,
               CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y
        FROM lineitem""",
    "edges": """
        SELECT generate_subscripts(q, 1) - 1 AS p, unnest(q) AS edge
        FROM (SELECT quantile_cont(f, [0.05 + 0.9 / 19 * x FOR x IN range(20)]) AS q FROM priced)""",
    "pairs": """
        SELECT l.p AS low_i, h.p - 10 AS high_i, l.edge AS low, h.edge AS high
        FROM edges l JOIN edges h ON l.p < 10 AND h.p >= 10 AND l.edge < h.edge""",
    "grid": """
        SELECT low_i, high_i, low, high,
               avg(y) FILTER (WHERE f < low)
               + avg(1 - y) FILTER (WHERE f > high)
               + abs(0.5 - avg(y) FILTER (WHERE f BETWEEN low AND high)) AS score
        FROM pairs, priced
        GROUP BY ALL
        HAVING count(*) FILTER (WHERE f < low) >= 0.1 * count(*)
           AND count(*) FILTER (WHERE f > high) >= 0.1 * count(*)
           AND count(*) FILTER (WHERE f BETWEEN low AND high) > 0""",
    "predictions": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
               CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
               CASE WHEN l_extendedprice >= 50000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
               l_extendedprice AS score
        FROM lineitem""",
    "gated": """
        SELECT offer, count(*) AS n_rows, count(*) FILTER (a) AS a, count(*) FILTER (b) AS b,
               count(*) FILTER (c) AS c, count(*) FILTER (d) AS d, count(*) FILTER (e) AS e,
               count(*) FILTER (a OR b OR c OR d OR e) AS broken
        FROM (SELECT letter_set IS NULL AS a, version IS NULL AS b, frequency IS NULL AS c,
                     embedding IS NULL AS d, embedding IS NOT NULL AND (len(embedding) <> 64
                         OR len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) > 0) AS e
              FROM joined),
             (VALUES ('all'), ('complete')) o(offer)
        WHERE offer = 'all' OR NOT (a OR b OR c OR d OR e)
        GROUP BY offer""",
}

_MATCHES = ["vocab", "words", "numbered", "puzzles", "puzzle_keys", "matches"]
_ANSWERS = [*_MATCHES, "answers"]
_RAW = [*_ANSWERS, "raw_words"]
_DECISIONS = [*_RAW, "decisions"]
_JOINED = [*_RAW, "vectors", "frequencies", "joined"]
_STATES = [*_JOINED, "decisions", "latest", "states"]
_PROBABILITIES = [*_STATES, "probabilities"]
_GRID = ["priced", "edges", "pairs", "grid"]


def _with(parts: list[str], select: str) -> str:
    if not parts:
        return select
    listed = ",\n".join(f"{name} AS ({_PARTS[name]})" for name in parts)
    return f"WITH {listed}\n{select}"


_TRAINABLE = "label IS NOT NULL AND frequency IS NOT NULL AND embedding IS NOT NULL"
# Edges searched on the training rows, and the band of each of these.
_ROUTED = f""", priced AS (SELECT word, log10(frequency + 1) AS f, label AS y FROM states WHERE {_TRAINABLE}),
            edges AS ({_PARTS['edges']}), pairs AS ({_PARTS['pairs']}), grid AS ({_PARTS['grid']}),
            best AS (SELECT low, high FROM grid ORDER BY grid.score, low_i, high_i LIMIT 1),
            chosen AS (SELECT coalesce(min(low), 1.68::DOUBLE) AS low_mid, coalesce(min(high), 4.72::DOUBLE) AS mid_high FROM best),
            routed AS (SELECT word, y, low_mid, mid_high,
                              CASE WHEN f >= mid_high THEN 'high' WHEN f <= low_mid THEN 'low' ELSE 'mid' END AS band
                       FROM priced, chosen)"""
_DAY = "strftime({0}, '%Y-%m-%d') AS {0}"
_VECTOR = (
    "array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 1000000)::BIGINT), ',') AS embedding"
)
_STATE_TEXT = (
    f"word, letter_set, {_DAY.format('last_seen_on')}, frequency, {_VECTOR}, label, batch_id"
)
_DECISION_TEXT = f"word, center_letter, outer_letters, {_DAY.format('puzzle_date')}, accepted"
_PUZZLE_TEXT = """
    strftime(puzzle_date, '%Y-%m-%d') AS "printDate", lower(center_letter) AS "centerLetter",
    lower(outer_letters) AS "outerLetters", string_agg(word, ',' ORDER BY word) AS answers"""
_PUZZLE_GROUP = "GROUP BY puzzle_date, center_letter, outer_letters"

ORACLES: dict[str, str] = {
    "wordlist_scan": r"""
        SELECT DISTINCT word FROM (
            SELECT regexp_replace(regexp_replace(regexp_replace(line, '^\s+|\s+$', '', 'g'),
                   '^[''"]', ''), '[''"]$', '') AS word
            FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
        WHERE word <> ''""",
    "puzzle_scan": _with(_ANSWERS, f"SELECT {_PUZZLE_TEXT} FROM answers {_PUZZLE_GROUP}"),
    "puzzle_month_pruned": _with(
        _ANSWERS,
        f"SELECT {_PUZZLE_TEXT} FROM answers WHERE year(puzzle_date) = 2018"
        f" AND month(puzzle_date) = 3 {_PUZZLE_GROUP}",
    ),
    "puzzle_date_pruned": _with(
        _ANSWERS,
        f"SELECT {_PUZZLE_TEXT} FROM answers WHERE puzzle_date = DATE '2018-01-20' {_PUZZLE_GROUP}",
    ),
    "latest_version": """
        SELECT source || '_' || lang || '_v' || doc_id || '.txt' AS file_name, doc_id AS version
        FROM documents ORDER BY doc_id DESC LIMIT 1""",
    "labeled_scan": """
        SELECT d.doc_id, d.lang, l.quality::BIGINT AS label
        FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL""",
    "page_script_extract": r"""
        SELECT page_id, list_filter(
                   list_transform(regexp_extract_all(html, '(?s)<script[^>]*>(.*?)</script>', 1),
                                  lambda s: regexp_extract(s, 'track\((\d+)\)', 1)),
                   lambda s: s <> '')[1] AS body
        FROM pages""",
    "table_create_once": _with(["vocab", "words"], "SELECT word, n, letter_set FROM words"),
    "table_create_repartitioned": f"""
        SELECT vec_id, label::BIGINT AS label, {_VECTOR} FROM embeddings""",
    "replace_where": _with(
        _DECISIONS,
        f"SELECT {_DECISION_TEXT} FROM decisions"
        " WHERE NOT (puzzle_date = DATE '2018-02-14' AND accepted = 0)",
    ),
    "puzzle_write": _with(
        _ANSWERS,
        "SELECT year(puzzle_date) AS year, month(puzzle_date) AS month, count(*) AS n"
        " FROM puzzles GROUP BY ALL",
    ),
    "wordlist_write": _with(["vocab"], "SELECT word FROM vocab"),
    "export_json_lines": _with(
        _PROBABILITIES,
        """SELECT letter_set, part,
                  '{"' || letter_set || '":[' || string_agg(
                      '{"date":' || CASE WHEN last_seen_on IS NULL THEN 'null'
                          ELSE '"' || strftime(last_seen_on, '%Y-%m-%d') || '"' END
                      || ',"letters":"' || letter_set || '","prob":' || probability::DOUBLE::VARCHAR
                      || ',"word":"' || word || '"}', ',' ORDER BY word) || ']}' AS json
           FROM (SELECT *, (row_number() OVER (PARTITION BY letter_set ORDER BY word) - 1) // 200000 AS part
                 FROM probabilities) GROUP BY letter_set, part""",
    ),
    "latest_snapshot": """
        SELECT strftime(o_orderdate, '%Y-%m') AS logical_date, max(o_orderkey) AS created_ts
        FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
    "letter_set": rf"""
        SELECT word, replace({_LETTERS.format('word')}, 'ẞ', 'SS') AS letter_set
        FROM (SELECT DISTINCT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)""",
    "eligible_words": _with(["vocab", "words"], "SELECT word, n, letter_set FROM words"),
    "letter_set_index": _with(
        ["vocab", "words"],
        "SELECT letter_set, part, string_agg(word || ':' || n, ',' ORDER BY word) AS rows"
        " FROM (SELECT *, (row_number() OVER (PARTITION BY letter_set ORDER BY word) - 1) // 200000 AS part"
        " FROM words) GROUP BY letter_set, part",
    ),
    "puzzle_letter_keys": _with(
        _MATCHES[:-1],
        f"SELECT {_DAY.format('puzzle_date')}, center_letter, outer_letters, letter_set FROM puzzle_keys",
    ),
    "matching_words": _with(
        _MATCHES,
        f"SELECT {_DAY.format('puzzle_date')}, center_letter, outer_letters, letter_set, word, n FROM matches",
    ),
    "match_counts": _with(
        ["vocab", "words", "numbered"],
        """SELECT letters, center_letter,
                  count(*) FILTER (contains(letter_set, center_letter) AND length(letter_set) > 1) AS n_words,
                  count(*) AS n_within
           FROM (SELECT array_to_string(list_sort(string_split(letters, '')), '') AS letters,
                        unnest(string_split(letters, '')) AS center_letter, letter_set
                 FROM (SELECT letters, array_to_string(list_filter(list_sort(string_split(letters, '')),
                                  lambda x, i: (m >> (i - 1)) & 1 = 1), '') AS letter_set
                       FROM numbered, generate_series(1, 127) g(m)) JOIN words USING (letter_set))
           GROUP BY letters, center_letter""",
    ),
    "word_decisions": _with(_DECISIONS, f"SELECT {_DECISION_TEXT} FROM decisions"),
    "decision_dates": _with(
        _DECISIONS,
        f"SELECT word, {_DAY.format('puzzle_date')}, year(puzzle_date) AS year,"
        " month(puzzle_date) AS month, day(puzzle_date) AS day FROM decisions",
    ),
    "backfill_month_counts": _with(
        _DECISIONS,
        """SELECT y.year, m.month, count(d.word) AS n
           FROM (SELECT DISTINCT year(puzzle_date) AS year FROM decisions) y
           CROSS JOIN generate_series(1, 12) m(month)
           LEFT JOIN decisions d ON year(d.puzzle_date) = y.year AND month(d.puzzle_date) = m.month
           GROUP BY ALL""",
    ),
    "backfill": _with(
        _DECISIONS,
        f"SELECT {_DECISION_TEXT} FROM decisions WHERE year(puzzle_date) = 2018 AND month(puzzle_date) <> 2",
    ),
    "raw_words": _with(
        _RAW,
        "SELECT word, letter_set, version, NULL::VARCHAR AS date_added FROM raw_words",
    ),
    "version_counts": _with(
        _RAW, "SELECT version, count(*) AS n FROM raw_words GROUP BY version"
    ),
    "decision_partitions": _with(
        _DECISIONS,
        "SELECT DISTINCT year(puzzle_date) AS year, month(puzzle_date) AS month FROM decisions",
    ),
    "batch_assign": _with(
        ["vocab"],
        """SELECT word, row_number() OVER (ORDER BY word) AS rank,
                  (row_number() OVER (ORDER BY word) - 1) // 100 AS batch_id FROM vocab""",
    ),
    "batched_enrich": _with(
        ["vocab"],
        """SELECT word,
                  (length(regexp_replace(word, '[^aeiou]', '', 'g')) / length(word))::FLOAT::DOUBLE
                      AS frequency,
                  (row_number() OVER (PARTITION BY length(word) % 2 ORDER BY word) - 1) // 1000
                  + CASE WHEN length(word) % 2 = 0 THEN 0
                         ELSE (SELECT (count(*) + 999) // 1000 FROM vocab WHERE length(word) % 2 = 0) END
                      AS batch_id FROM vocab""",
    ),
    "batch_log": _with(
        ["vocab"],
        """SELECT batch_id, min(rank) - 1 AS start_idx, max(rank) AS end_idx,
                  min(word) AS first_word, max(word) AS last_word, count(*) AS n_words
           FROM (SELECT word, row_number() OVER (ORDER BY word) AS rank,
                        (row_number() OVER (ORDER BY word) - 1) // 1000 AS batch_id FROM vocab)
           GROUP BY batch_id""",
    ),
    "latest_frequency": """
        SELECT c_custkey AS word, coalesce(value, 0.0) AS frequency
        FROM customer LEFT JOIN (
            SELECT user_id, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
        ) ON user_id = c_custkey""",
    "frequency_series": """
        SELECT word, chunk, string_agg(printf('%.2f', value), ',' ORDER BY r) AS series
        FROM (SELECT user_id AS word, value,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r,
                     (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 1000 AS chunk
              FROM events)
        GROUP BY word, chunk""",
    "corpus_frequency": _with(["vocab"], "SELECT word, n FROM vocab"),
    "mean_pool": """
        SELECT label::BIGINT AS label, position, round(avg(v), 6) AS mean
        FROM (SELECT label, generate_subscripts(embedding, 1)::BIGINT - 1 AS position,
                     unnest(embedding)::DOUBLE AS v FROM embeddings)
        GROUP BY ALL""",
    "validate_embeddings": """
        SELECT count(*) AS total_rows,
               count(*) FILTER (WHERE ok) AS valid_embeddings,
               count(*) FILTER (WHERE NOT sized) AS wrong_length,
               0::BIGINT AS wrong_type,
               count(*) FILTER (WHERE sized AND NOT ok) AS broken_elements
        FROM (SELECT coalesce(len(embedding) = 64, false) AS sized,
                     coalesce(len(embedding) = 64 AND len(list_filter(embedding,
                         lambda x: x IS NULL OR isnan(x))) = 0, false) AS ok
              FROM embeddings)""",
    "words_joined": _with(
        _JOINED, f"SELECT word, letter_set, date_added, version, frequency, {_VECTOR} FROM joined"
    ),
    "missing_patterns": _with(
        _JOINED,
        """SELECT letter_set IS NULL AS letter_set_missing, version IS NULL AS version_missing,
                  frequency IS NULL AS frequency_missing, embedding IS NULL AS embedding_missing,
                  count(*) AS n FROM joined GROUP BY ALL""",
    ),
    "incomplete_words": _with(
        _JOINED,
        f"""SELECT word, letter_set, frequency, {_VECTOR} FROM joined
           WHERE letter_set IS NULL OR version IS NULL OR frequency IS NULL OR embedding IS NULL""",
    ),
    "gated_publish": _with(
        [*_JOINED, "gated"],
        """SELECT offer, CASE WHEN broken > 0 THEN 0 WHEN offer = 'all' THEN 1
                       ELSE 1 + (SELECT (broken = 0)::BIGINT FROM gated WHERE offer = 'all') END AS table_version,
                  gate, n
           FROM (SELECT offer, broken, unnest(['rows', 'letter_set_missing', 'version_missing',
                            'frequency_missing', 'embedding_missing', 'embedding_broken']) AS gate,
                        unnest([n_rows, a, b, c, d, e]) AS n FROM gated)""",
    ),
    "count_reconcile": _with(
        _JOINED,
        """SELECT source, n, (SELECT count(DISTINCT c) = 1 FROM (
                      SELECT count(*) AS c FROM words UNION ALL SELECT count(*) FROM vectors
                      UNION ALL SELECT count(*) FROM frequencies
                      UNION ALL SELECT count(*) FROM joined)) AS all_equal
           FROM (SELECT 'words' AS source, count(*) AS n FROM words
                 UNION ALL SELECT 'frequencies', count(*) FROM frequencies
                 UNION ALL SELECT 'embeddings', count(*) FROM vectors
                 UNION ALL SELECT 'joined', count(*) FROM joined)""",
    ),
    "init_states": _with(
        _JOINED,
        f"""SELECT word, letter_set, NULL::VARCHAR AS last_seen_on, frequency, {_VECTOR},
                   NULL::DOUBLE AS label, 'words_1' AS batch_id
            FROM joined WHERE version = 1""",
    ),
    "latest_decision": _with([*_DECISIONS, "latest"], f"SELECT {_DECISION_TEXT} FROM latest"),
    "distinct_words": _with(_DECISIONS, "SELECT count(DISTINCT word) AS n FROM decisions"),
    "new_words": _with(
        _DECISIONS,
        "SELECT DISTINCT word FROM decisions WHERE word NOT IN (SELECT word FROM words)",
    ),
    "enrich_new_words": _with(
        [*_JOINED, "decisions", "latest"],
        f"""SELECT l.word, CASE WHEN j.version = 2 THEN j.letter_set END AS letter_set,
                   strftime(puzzle_date, '%Y-%m-%d') AS last_seen_on,
                   CASE WHEN j.version = 2 THEN j.frequency END AS frequency,
                   {_VECTOR.replace('embedding,', 'CASE WHEN j.version = 2 THEN embedding END,', 1)},
                   accepted AS label, 'puzzles_1' AS batch_id
            FROM latest l LEFT JOIN joined j ON j.word = l.word""",
    ),
    "merge_states": _with(
        _STATES,
        f"""SELECT word, letter_set, {_DAY.format('last_seen_on')}, frequency, {_VECTOR}, label,
                   CASE WHEN last_seen_on IS NULL THEN batch_id
                        WHEN last_seen_on <= (
                            SELECT min(puzzle_date) + CAST(floor((max(puzzle_date) - min(puzzle_date)) / 2)
                                AS INTEGER) FROM puzzles) THEN 'late'
                        ELSE 'all' END AS batch_id
            FROM states""",
    ),
    "log_frequency": _with(
        ["vocab"], "SELECT word, round(log10(n + 1), 6) AS log_frequency FROM vocab"
    ),
    "features_v1": _with(
        ["training", "feature_rows"],
        "SELECT vec_id, label, position, round(value, 6) AS value FROM feature_rows",
    ),
    "label_split_counts": _with(
        _STATES,
        "SELECT count(label) AS truth, count(*) FILTER (WHERE label IS NULL) AS model FROM states",
    ),
    "stratified_split": """
        SELECT o_orderkey, o_orderstatus AS label,
               row_number() OVER (PARTITION BY o_orderstatus
                   ORDER BY md5('0:' || o_orderkey), o_orderkey)
               <= round(count(*) OVER (PARTITION BY o_orderstatus) * 0.33::DOUBLE) AS is_test
        FROM orders""",
    "band_candidates": _with(
        ["priced", "edges"],
        """SELECT CASE WHEN p < 10 THEN 'low' ELSE 'high' END AS side, p % 10 AS i,
                  round(edge, 6) AS edge FROM edges""",
    ),
    "threshold_grid": _with(
        _GRID,
        """SELECT low_i, high_i, round(low, 6) AS low, round(high, 6) AS high,
                  round(score, 9) AS score FROM grid""",
    ),
    "best_thresholds": _with(
        _GRID,
        """SELECT round(low, 6) AS low, round(high, 6) AS high, round(score, 6) AS score
           FROM grid ORDER BY grid.score, low_i, high_i LIMIT 1""",
    ),
    "band_route": """
        SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity,
               CASE WHEN l_quantity >= 40 THEN 'high' WHEN l_quantity <= 10 THEN 'low'
                    ELSE 'mid' END AS band
        FROM lineitem""",
    "gnb_stats": _with(
        ["training", "feature_rows"],
        """SELECT label, position AS feature, count(*) AS n, round(avg(value), 6) AS mean,
                  round(var_pop(value), 6) AS variance
           FROM feature_rows GROUP BY ALL""",
    ),
    "gnb_fit": _with(
        ["training", "feature_rows"],
        """, stats AS (SELECT label AS class, position, avg(value) AS m, var_pop(value) AS v
                       FROM feature_rows GROUP BY ALL),
           priors AS (SELECT label AS class, ln(count(*) / (SELECT count(*) FROM training)) AS prior
                      FROM training GROUP BY label),
           scores AS (SELECT vec_id, label, class,
                             sum(-0.5 * ln(2 * pi() * v) - (value - m) * (value - m) / (2 * v)) AS fit
                      FROM feature_rows JOIN stats USING (position) GROUP BY ALL)
           SELECT label, class AS prediction, count(*) AS n
           FROM (SELECT vec_id, label, class FROM scores JOIN priors USING (class)
                 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY fit + prior DESC) = 1)
           GROUP BY ALL""",
    ),
    "svd_project": """
        SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS length
        FROM embeddings""",
    "hybrid_fit": _with(
        _STATES,
        f"""{_ROUTED}
            SELECT count(*) AS n, sum(y) AS positive, true AS above_floor,
                   round(min(low_mid), 6) AS low_mid, round(min(mid_high), 6) AS mid_high,
                   count(*) FILTER (band = 'low') AS n_low, count(*) FILTER (band = 'mid') AS n_mid,
                   count(*) FILTER (band = 'high') AS n_high, sum(y) FILTER (band = 'low') AS positive_low,
                   sum(y) FILTER (band = 'mid') AS positive_mid, sum(y) FILTER (band = 'high') AS positive_high
            FROM routed""",
    ),
    "forest_splits": _with(
        _STATES,
        f""", tenths AS (SELECT round(log10(frequency + 1), 1) AS x, label AS y FROM states WHERE {_TRAINABLE}),
            each AS (SELECT x, count(*) AS n, sum(y) AS p FROM tenths GROUP BY x),
            cuts AS (SELECT sum(n) OVER (ORDER BY x) AS nl, sum(p) OVER (ORDER BY x) AS pl,
                            sum(n) OVER () AS n, sum(p) OVER () AS p FROM each),
            gains AS (SELECT n, 2 * p / n * (n - p) / n AS impurity,
                             2 * pl * (nl - pl) / nl / n
                             + CASE WHEN n > nl THEN 2 * (p - pl) * (n - nl - p + pl) / (n - nl) / n ELSE 0 END AS kept
                      FROM cuts)
            SELECT tree, n::BIGINT AS n, round(impurity, 9) AS impurity,
                   round(impurity - kept, 9) AS gain, round(impurity - kept, 9) AS fitted_gain
            FROM (SELECT n, impurity, min(kept) AS kept FROM gains GROUP BY ALL), range(2) t(tree)
            WHERE impurity > kept""",
    ),
    "hybrid_predict": _with(
        _STATES, f"{_ROUTED} SELECT word, y AS label, band, true AS sound FROM routed"
    ),
    "score_unlabeled": _with(
        _STATES,
        """SELECT word, letter_set, frequency IS NOT NULL AND embedding IS NOT NULL AS scored
           FROM states WHERE label IS NULL""",
    ),
    "score_with_model_object": """
        SELECT vec_id, (0.5 * (embedding[1] > 0)::INTEGER + 0.25 * (vec_id >= 99)::INTEGER)::DOUBLE AS probability
        FROM embeddings""",
    "holdout_evaluation": _with(
        _STATES,
        f"""SELECT label, count(*) AS n, true AS measured FROM (
                SELECT label, row_number() OVER (PARTITION BY label ORDER BY md5('0:' || word), word)
                    <= round(count(*) OVER (PARTITION BY label) * 0.33::DOUBLE) AS is_test
                FROM states WHERE {_TRAINABLE})
            WHERE is_test GROUP BY label""",
    ),
    "model_roundtrip": _with(
        _STATES,
        """SELECT count(*) AS n, 0.0::DOUBLE AS difference FROM states
           WHERE label IS NOT NULL AND frequency IS NOT NULL AND embedding IS NOT NULL""",
    ),
    "class_weights": """
        SELECT l_returnflag, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight
        FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)""",
    "word_probabilities": _with(
        _PROBABILITIES,
        f"""SELECT word, letter_set, {_DAY.format('last_seen_on')}, probability, source,
                   model_version, batch_id FROM probabilities""",
    ),
    "confusion": _with(
        ["predictions"], "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY ALL"
    ),
    "binary_metrics": _with(
        ["predictions"],
        """SELECT count(*) AS n, round(avg((label = prediction)::INTEGER), 9) AS accuracy,
                  round(2 * sum(label * prediction) / (sum(label) + sum(prediction)), 9) AS f1
           FROM predictions""",
    ),
    "roc_auc": _with(
        ["predictions"],
        """SELECT round(sum(p * (before + q / 2)) / (sum(p) * sum(q)), 9) AS auc
           FROM (SELECT p, q, coalesce(sum(q) OVER (ORDER BY score
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                 FROM (SELECT score, sum(label)::DOUBLE AS p, sum(1 - label)::DOUBLE AS q
                       FROM predictions GROUP BY score))""",
    ),
    "error_slices": _with(
        ["predictions"],
        """SELECT CASE WHEN label = 1 AND prediction = 0 THEN 'FN'
                       WHEN label = 0 AND prediction = 0 THEN 'TN'
                       WHEN label = 0 AND prediction = 1 THEN 'FP' ELSE 'TP' END AS slice,
                  row_key, label, prediction, score,
                  row_number() OVER (PARTITION BY label, prediction ORDER BY row_key) AS position
           FROM predictions QUALIFY position <= 5""",
    ),
    "top_probabilities": _with(
        _PROBABILITIES,
        """SELECT word, letter_set, probability, source FROM probabilities
           WHERE source = 'model' ORDER BY probability DESC, word LIMIT 5""",
    ),
    "bottom_probabilities": _with(
        _PROBABILITIES,
        """SELECT word, letter_set, probability, source FROM probabilities
           WHERE source = 'model' ORDER BY probability, word LIMIT 5""",
    ),
    "letter_set_groups": _with(
        _PROBABILITIES,
        """SELECT letter_set, part, string_agg(word, ',' ORDER BY word) AS words, sum(probability) AS total
           FROM (SELECT *, (row_number() OVER (PARTITION BY letter_set ORDER BY word) - 1) // 200000 AS part
                 FROM probabilities) GROUP BY letter_set, part""",
    ),
    "export_rows": _with(
        _PROBABILITIES,
        """SELECT letter_set, strftime(last_seen_on, '%Y-%m-%d') AS date, letter_set AS letters,
                  probability AS prob, word FROM probabilities""",
    ),
    "solve_puzzle": _with(
        _PROBABILITIES,
        f"""SELECT {_DAY.format('k.puzzle_date').replace(' AS k.', ' AS ')}, center_letter,
                   outer_letters, letter_set, word, probability, source
            FROM puzzle_keys k JOIN probabilities p USING (letter_set)""",
    ),
    "incremental_ingest": _with(
        _STATES,
        f"""SELECT * REPLACE (CASE batch_id WHEN 'puzzles_1' THEN 'puzzles_0' ELSE batch_id END
                   AS batch_id) FROM (SELECT {_STATE_TEXT} FROM states)""",
    ),
}
ORACLES["publish_exports"] = f"SELECT json, true AS refused FROM ({ORACLES['export_json_lines']})"
ORACLES["merge_states_rewrite"] = ORACLES["merge_states"]
ORACLES["replace_where_atomic"] = ORACLES["replace_where"]
ORACLES["svd_truncated"] = """
SELECT k, n, squares, k = d AS lossless
FROM (
    SELECT count(*) AS n, max(len(embedding)) AS d,
        round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 2) AS squares
    FROM embeddings
), LATERAL (SELECT unnest([8, 50, d]) AS k)
"""
_BANDED_ROWS = f"""
    routed AS (
        SELECT log10(frequency + 1) AS x, label::DOUBLE AS label,
            CASE WHEN log10(frequency + 1) >= 1.59 THEN 'high' WHEN log10(frequency + 1) <= 0.85 THEN 'low' ELSE 'mid' END AS band
        FROM states WHERE {_TRAINABLE})"""
ORACLES["banded_naive_bayes"] = _with(
    _STATES,
    f""", {_BANDED_ROWS},
    stats AS (SELECT band, label AS class, count(*) AS k, avg(x) AS m, var_pop(x) AS v FROM routed GROUP BY ALL),
    fits AS (
        SELECT r.x, r.label, s.class, count(*) OVER (PARTITION BY r.band, r.x, r.label) AS classes,
            ln(s.k) - 0.5 * ln(2 * pi() * s.v) - (r.x - s.m) * (r.x - s.m) / (2 * s.v) AS fit, r.n
        FROM (SELECT band, x, label, count(*) AS n FROM routed GROUP BY ALL) r JOIN stats s USING (band)),
    chances AS (
        SELECT x, label, n, CASE WHEN max(classes) = 1 THEN max(class)
            ELSE 1 / (1 + exp(max(fit) FILTER (class = 0) - max(fit) FILTER (class = 1))) END AS p
        FROM fits GROUP BY ALL)
    SELECT round(x, 6) AS log_frequency, label, n, (p > 0.5)::INTEGER::DOUBLE AS prediction, round(p, 6) AS probability
    FROM chances""",
)
ORACLES["banded_logistic"] = _with(
    _STATES,
    f""", {_BANDED_ROWS},
    weighed AS (
        SELECT label, sum(1) OVER () / (2.0 * sum(1) OVER (PARTITION BY label)) AS w FROM routed)
    SELECT count(*) AS n, round(sum(w * label) / count(*), 5) AS weighted_chance, 0.0::DOUBLE AS slope FROM weighed""",
)
ORACLES["export_object"] = f"""
SELECT letter_set, part, coalesce(sum(bytes) OVER (ORDER BY letter_set, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    bytes, fragment
FROM (
    SELECT *, strlen(fragment)::BIGINT AS bytes
    FROM (
        SELECT letter_set, part,
            CASE WHEN part > 0 THEN ',' || substr(json, length(to_json(letter_set)) + 4, length(json) - length(to_json(letter_set)) - 5)
                WHEN letter_set = min(letter_set) OVER () THEN substr(json, 1, length(json) - 2)
                ELSE ',' || substr(json, 2, length(json) - 3) END
            || CASE WHEN part < max(part) OVER (PARTITION BY letter_set) THEN ''
                WHEN letter_set = max(letter_set) OVER () THEN ']}}' ELSE ']' END AS fragment
        FROM ({ORACLES['export_json_lines']})))
"""
ORACLES["band_candidates_sketched"] = ORACLES["band_candidates"]
