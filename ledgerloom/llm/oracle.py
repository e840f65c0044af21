"""DuckDB SQL for the queries that SQL can express."""

_WS = "[\\x20\\x09-\\x0D]"


def _divided(level: str, children: str) -> str:
    """Shares of the rows (name, parent, capacity, weight, budget) of ``children``."""
    return f"""
        {level}_levels AS (
          SELECT *, (budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM {children} WINDOW w AS (PARTITION BY parent ORDER BY capacity / weight, name)),
        {level} AS (
          SELECT name, least(capacity, max(level) OVER (PARTITION BY parent) * weight) AS share
          FROM {level}_levels)"""


_DOMAIN = "CASE regexp_extract(source, '([0-9]{1,9})$', 1) WHEN '' THEN 0 ELSE CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) % 3 END"
_AGAIN = "(page_id * 10 + 1 + page_id * 7919 % 1000)"

_RULES = ("short", "repeats", "symbols", "dup_lines")


def _prior(rule: str) -> str:
    """Mean and strength of the beta prior of one rule, over the rows of ``hosts``."""
    mean = f"((sum(f_{rule}) + 0.5::DOUBLE) / (sum(docs) + 1))"
    spread = f"(avg((f_{rule} / docs) ^ 2) - 2 * {mean} * avg(f_{rule} / docs) + {mean} ^ 2)"
    noise = f"({mean} * (1 - {mean}) * avg(1 / docs))"
    most = "greatest(1.0::DOUBLE, sum(docs) / count(*))"
    fitted = f"CASE WHEN {spread} > {noise} THEN {mean} * (1 - {mean}) / ({spread} - {noise}) - 1 ELSE {most} END"
    return f"{mean} AS m_{rule}, least(greatest({fitted}, 1.0::DOUBLE), {most}) AS k_{rule}"


_RATES = ", ".join(f"(f_{r} + m_{r} * k_{r}) / (docs + k_{r})" for r in _RULES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = "[^\\x20\\x09-\\x0D]+"


def _terms(text: str) -> str:
    """Lexical terms of a text: runs of ASCII letters, digits and characters beyond ASCII."""
    small = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({small}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


_VECTORS = """
        v AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

ORACLE = {
    "op1_ngram_join": f"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words
          FROM documents),
        sets AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
            WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
            ELSE list_transform(generate_series(1, len(words) - 2),
                                lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS s
          FROM w),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
          FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * k >= 90 * (p.n + q.n - k)),
        reached AS (
          SELECT doc_id, doc_id AS other FROM documents
          UNION
          SELECT doc_id, y FROM reached JOIN links ON x = other)
        SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM reached r LEFT JOIN sizes z ON z.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op7_host_rules": f"""
        WITH d AS (
          SELECT doc_id, source, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
          FROM documents),
        places AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM d WHERE len(words) > 4),
        twice AS (
          SELECT doc_id, i FROM places
          QUALIFY count(*) OVER (PARTITION BY doc_id, words[i:i + 4]) > 1),
        covered AS (
          SELECT doc_id, count(DISTINCT spot) AS n
          FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS spot FROM twice) GROUP BY doc_id),
        m AS (
          SELECT d.doc_id, source, len(words)::BIGINT AS n_words,
                 length(regexp_replace(text, '{_WS}+', '', 'g')) AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                 coalesce(covered.n, 0) AS n_repeat_words
          FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id),
        judged AS (
          SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
                 100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 50 * n_lines AS dup_lines
          FROM m),
        hosts AS (
          SELECT source, count(*)::DOUBLE AS docs, {", ".join(f"sum({r}::INT)::DOUBLE AS f_{r}" for r in _RULES)}
          FROM judged WHERE source IS NOT NULL GROUP BY source),
        prior AS (SELECT {", ".join(map(_prior, _RULES))} FROM hosts),
        rates AS (SELECT source, greatest({_RATES}) AS rate FROM hosts, prior)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               short OR repeats AS base_failed,
               NOT (short OR repeats OR symbols OR dup_lines OR coalesce(rate > 0.5, FALSE)) AS kept
        FROM judged LEFT JOIN rates ON rates.source = judged.source
    """,
    "op5_revisit": f"""
        WITH pages_ AS (
          SELECT *, md5(coalesce(html, '')) AS tag, regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
        parts AS (
          SELECT *, regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages_),
        keys AS (
          SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)),
                      '^[^@]*@', ''), ':(80|443)?$', ''), '^www[0-9]*[.]', '')
                 || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
                 list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), lambda p:
                   p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)'))) AS kept
          FROM parts),
        named AS (
          SELECT *, place || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS key FROM keys),
        prior AS (
          SELECT v.page_id, arg_max(r.page_id, r.page_id) AS refers_to
          FROM named v LEFT JOIN named r
            ON r.key = v.key AND r.page_id * 10 < v.page_id * 10 + 1 + v.page_id * 7919 % 1000
          GROUP BY v.page_id),
        joined AS (
          SELECT p.page_id, p.refers_to, r.tag AS rtag, length(coalesce(r.html, '')) AS size,
                 CASE WHEN p.page_id % 5 = 0 THEN 'changed' WHEN p.page_id % 7 = 0 OR p.page_id % 11 = 0 THEN NULL
                      ELSE v.tag END AS vtag
          FROM prior p JOIN named v ON v.page_id = p.page_id LEFT JOIN named r ON r.page_id = p.refers_to),
        judged AS (
          SELECT *, CASE
            WHEN refers_to IS NULL THEN 'no_prior'
            WHEN vtag IS NOT NULL THEN CASE WHEN vtag = rtag THEN 'resolved' ELSE 'validator_mismatch' END
            WHEN page_id % 7 = 0 THEN CASE WHEN page_id = refers_to THEN 'resolved' ELSE 'validator_mismatch' END
            ELSE 'no_validator' END AS status
          FROM joined)
        SELECT page_id, refers_to, status, CASE WHEN status = 'resolved' THEN
          'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10)
          || 'content-type: text/html' || chr(10) || 'date: minute ' || {_AGAIN} || chr(10)
          || 'etag: ' || CASE WHEN vtag IS NULL THEN '"' ELSE 'W/"' END || rtag || '"' || chr(10)
          || 'expires: minute ' || ({_AGAIN} + 60) || chr(10)
          || 'last-modified: minute ' || CASE WHEN page_id % 7 = 0 AND page_id % 5 <> 0 THEN page_id ELSE refers_to END
          END AS headers
        FROM judged
    """,
    "op6_mixing": f"""
        WITH d AS (
          SELECT doc_id, lang, source, CAST({_DOMAIN} AS VARCHAR) AS domain,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
          FROM documents),
        leaves AS (
          SELECT domain, lang, source, sum(tokens) AS tokens FROM d GROUP BY ALL),
        n1 AS (
          SELECT domain AS name, '' AS parent, sum(tokens) * 2.0::DOUBLE AS capacity,
                 CASE domain WHEN '0' THEN 0.6::DOUBLE WHEN '1' THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END AS weight,
                 (SELECT sum(tokens) FROM d) * 0.6::DOUBLE AS budget
          FROM leaves GROUP BY domain),
        {_divided("s1", "n1")},
        n2 AS (
          SELECT domain || '/' || lang AS name, domain AS parent, sum(tokens) * 2.0::DOUBLE AS capacity,
                 CASE lang WHEN 'en' THEN 0.55::DOUBLE ELSE 0.15::DOUBLE END AS weight, any_value(s1.share) AS budget
          FROM leaves JOIN s1 ON s1.name = domain GROUP BY domain, lang),
        {_divided("s2", "n2")},
        n3 AS (
          SELECT domain || '/' || lang || '/' || source AS name, domain || '/' || lang AS parent,
                 tokens * 2.0::DOUBLE AS capacity, 1.0::DOUBLE AS weight, s2.share AS budget
          FROM leaves JOIN s2 ON s2.name = domain || '/' || lang),
        {_divided("s3", "n3")},
        plan AS (
          SELECT domain, lang, source, tokens AS all_tokens, floor(s3.share + 1e-6)::BIGINT AS target
          FROM leaves JOIN s3 ON s3.name = domain || '/' || lang || '/' || source),
        tries AS (
          SELECT d.*, unnest([0, 1, 2]) AS epoch, all_tokens, target FROM d JOIN plan USING (domain, lang, source)),
        drawn AS (
          SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch
                      ORDER BY md5('17:' || epoch || ':' || doc_id)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
          FROM tries)
        SELECT doc_id, lang, source, epoch FROM drawn
        WHERE all_tokens = 0 AND epoch = 0 OR epoch < target // all_tokens
           OR epoch = target // all_tokens AND so_far < target - epoch * all_tokens
    """,
    "op8_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
                 unnest(string_split(text, chr(10))) AS line
          FROM documents),
        words AS (
          SELECT doc_id, i, trim(regexp_replace(line, '{_WS}+', ' ', 'g')) AS t FROM lines
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
        windows AS (
          SELECT doc_id, i AS first, lead(i, 2) OVER w AS last,
                 t || chr(10) || lead(t, 1) OVER w || chr(10) || lead(t, 2) OVER w AS passage
          FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, first) AS n
          FROM windows WHERE last IS NOT NULL),
        gone AS (
          SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS i FROM placed WHERE n > 1)
        SELECT l.doc_id, CAST(count(g.i) AS INTEGER) AS n_removed,
               coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text
        FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
    """,
    "op10_exact_dedup": f"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 sha256(regexp_replace(coalesce(text, ''), '{_WS}+', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
    "op11_lexical": f"""
        WITH found AS (SELECT doc_id, unnest({_terms("documents.text")}) AS term FROM documents),
        t AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
        d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
        s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS occurrences FROM d),
        w AS (
          SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
          FROM t, s GROUP BY term, n_docs),
        q AS (SELECT DISTINCT item_id, unnest({_terms("benchmark.text")}) AS term FROM benchmark),
        scored AS (
          SELECT item_id, doc_id,
                 sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // occurrences))))::BIGINT AS score
          FROM q JOIN t USING (term) JOIN w USING (term) JOIN d USING (doc_id), s GROUP BY item_id, doc_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op12_vector_topk": f"""
        WITH {_VECTORS},
        ranked AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
                 row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op13_hard_negatives": f"""
        WITH {_VECTORS},
        l AS (
          SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
          FROM v WHERE label IS NOT NULL),
        pairs AS (
          SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
          FROM l a JOIN l b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
          SELECT * FROM pairs WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
                 n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
          FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
           AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
    """,
}
