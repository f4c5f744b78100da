"""DuckDB twins of those queries that SQL can express, by comparing all with all."""

from stratawell.llm.privacy import IBAN_LENGTHS

_VECTORS = """
    v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label,
               embedding IS NOT NULL AND len(embedding) > 0 AND label IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
        FROM embeddings
    )
"""

_VECTOR_DEDUP = f"""
    WITH RECURSIVE {_VECTORS},
    links AS (
        SELECT a.vec_id AS i, b.vec_id AS j
        FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
        WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.93
    ),
    reach AS (
        SELECT vec_id AS i, vec_id AS j FROM v
        UNION
        SELECT r.i, l.j FROM reach r JOIN links l ON r.j = l.i
    ),
    least AS (SELECT i AS vec_id, min(j) AS component_id FROM reach GROUP BY i)
    SELECT vec_id, (SELECT count(*) FROM links WHERE i = vec_id) AS n_links, component_id,
           vec_id = component_id AS kept
    FROM least
"""

_TOP_PRODUCTS = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    ranked AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS product,
               row_number() OVER (PARTITION BY q.vec_id
                                  ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS r
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, CAST(product AS BIGINT) AS score
    FROM ranked WHERE r <= 10
"""

_REPEATED_PASSAGES = r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    words AS (
        SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM d
    ),
    starts AS (
        SELECT doc_id, unnest(range(1, len(w) - 33)) AS pos, w FROM d WHERE len(w) >= 35
    ),
    windows AS (
        SELECT doc_id, pos, sha256(array_to_string(w[pos:pos + 34], ' ')) AS h FROM starts
    ),
    judged AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY h) > 1 AS again FROM windows),
    covered AS (
        SELECT doc_id, pos, word,
               max(coalesce(again, false)) OVER (PARTITION BY doc_id ORDER BY pos
                                                 ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
        FROM words LEFT JOIN judged USING (doc_id, pos)
    ),
    sums AS (
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
               string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
        FROM covered GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id)
"""

def _luhn(hit: str) -> str:
    digits = f"regexp_replace({hit}, '[^0-9]', '', 'g')"
    digit = f"CAST(reverse({digits})[i] AS INTEGER)"
    return f"""
        length({digits}) BETWEEN 13 AND 19 AND list_sum(list_transform(
            range(1, length({digits}) + 1),
            lambda i: CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN {digit} * 2 - 9
                      ELSE {digit} * 2 END)) % 10 = 0
    """


_PLAIN = "regexp_replace(hit, ' ', '', 'g')"
_REMAINDER = f"""
    list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(
        string_split({_PLAIN}[5:] || {_PLAIN}[1:4], ''),
        lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))),
        lambda rest, n: (rest * CASE WHEN n > 9 THEN 100 ELSE 10 END + n) % 97) = 1
"""
_IBAN_LENGTH = "CASE " + " ".join(
    f"WHEN hit[1:2] IN ({', '.join(repr(c) for c in sorted(countries))}) THEN {length}"
    for length, countries in sorted(
        {n: {c for c, m in IBAN_LENGTHS.items() if m == n} for n in set(IBAN_LENGTHS.values())}.items()
    )
) + f" ELSE length({_PLAIN}) END"

#: Base kinds: pattern and check of a hit.
_BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    (
        "ip",
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "len(list_filter(string_split(hit, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0",
    ),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", _luhn("hit")),
    (
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "length(regexp_replace(hit, '[^0-9]', '', 'g')) BETWEEN 9 AND 15",
    ),
)


def _hits(pattern: str) -> str:
    """(k, i, hit, first) of the matches of a pattern, left to right."""
    return f"""
        SELECT k, i, hit,
               sum(length(gap)) OVER (PARTITION BY k ORDER BY i)
               + sum(length(hit)) OVER (PARTITION BY k ORDER BY i) - length(hit) AS first
        FROM (
            SELECT k, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit,
                   unnest(gaps[1:len(hits)]) AS gap
            FROM (SELECT k, regexp_extract_all(t, '{pattern}') AS hits,
                         string_split_regex(t, '{pattern}') AS gaps FROM d)
        )
    """


def _base(order: int, kind: str, pattern: str, valid: str) -> str:
    return f"""
        SELECT k, {order} AS ord, '{kind}' AS kind, first, first + length(hit) AS past
        FROM ({_hits(pattern)}) WHERE {valid}
    """


def _from_parts(name: str, part: str, start: str, parts: int, valid: str) -> str:
    """The longest valid run of up to some parts of a text from each part that may start one.

    Of those that overlap the first stays.
    """
    return f"""
        {name}_parts AS (SELECT *, first + length(hit) AS past FROM ({_hits(part)})),
        {name}_runs AS (
            SELECT a.k, a.first, b.past, d.t, d.t[a.first + 1:b.past] AS hit
            FROM {name}_parts a JOIN {name}_parts b
              ON a.k = b.k AND b.i BETWEEN a.i AND a.i + {parts - 1} JOIN d ON a.k = d.k
            WHERE regexp_matches(a.hit, '{start}') AND b.past - a.first BETWEEN 13 AND 45
        ),
        {name}_longest AS (
            SELECT k, first, max(past) AS past FROM {name}_runs WHERE {valid} GROUP BY k, first
        ),
        {name}_spans AS (
            SELECT * FROM {name}_longest x WHERE NOT EXISTS (
                SELECT 1 FROM {name}_longest y
                WHERE y.k = x.k AND y.first < x.first AND x.first < y.past)
        )
    """


_IBAN = _from_parts(
    "iban",
    "[A-Za-z0-9]+",
    "^[A-Z]{2}[0-9]{2}",
    10,
    rf"""
        length({_PLAIN}) BETWEEN 15 AND 34 AND length({_PLAIN}) = {_IBAN_LENGTH}
        AND regexp_full_match(hit, '[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?')
        AND {_REMAINDER}
    """,
)
_INNER_CARD = _from_parts(
    "inner",
    "[0-9]+",
    "^[0-9]",
    19,
    rf"""
        regexp_full_match(hit, '[0-9]+(?:[\x20-][0-9]+)*') AND {_luhn("hit")}
        AND (regexp_full_match(hit, '[0-9]{{13,19}}|[0-9]{{4}}(?:[\x20-][0-9]{{4}}){{3}}(?:[\x20-][0-9]{{1,3}})?|[0-9]{{4}}[\x20-][0-9]{{6}}[\x20-][0-9]{{4,5}}')
             OR regexp_matches(t[greatest(first - 39, 1):first], '(?i)\b(card|credit|visa|payment)')
             OR regexp_matches(t[past + 1:past + 40], '(?i)\b(card|credit|visa|payment)'))
    """,
)

_PERSONAL_DATA = f"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({" UNION ALL ".join(_base(i, *kind) for i, kind in enumerate(_BASE))}),
    {_IBAN},
    {_INNER_CARD},
    spans AS (
        SELECT * FROM base
        UNION ALL SELECT k, 4, 'iban', first, past FROM iban_spans
        UNION ALL SELECT k, 5, 'inner_card', first, past FROM inner_spans x WHERE NOT EXISTS (
            SELECT 1 FROM base c WHERE c.k = x.k AND c.kind = 'card'
                                       AND c.first < x.past AND x.first < c.past)
    ),
    sums AS (
        SELECT k,
               {", ".join(f"count(*) FILTER (WHERE kind = '{k[0]}') AS n_{k[0]}" for k in _BASE)},
               string_agg(kind || ':' || first || ':' || past, ',' ORDER BY ord, first) AS spans,
               string_agg(kind || ':' || first || ':' || past, ',' ORDER BY ord, first)
                   FILTER (WHERE ord < 4) AS base
        FROM spans GROUP BY k
    )
    SELECT doc_id,
           {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in _BASE)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN sums USING (k)
"""

_WORDS = r"""
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
"""

_DECONTAMINATION = f"""
    WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS words
        FROM (
            SELECT *, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos
            FROM i WHERE len(w) > 0
        )
    ),
    d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
    places AS (
        SELECT k, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS words
        FROM (
            SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS pos
            FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
        )
    ),
    hits AS (SELECT k, pos, n, item_id FROM places JOIN windows USING (n, words)),
    hit_words AS (SELECT DISTINCT k, unnest(range(pos, pos + n)) AS pos FROM hits),
    counted AS (SELECT k, count(*) AS n_hit FROM hit_words GROUP BY k),
    named AS (
        SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
        GROUP BY k
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN counted USING (k) LEFT JOIN named USING (k)
"""

_FILL_MIDDLE = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
               sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
        FROM documents
    ),
    drawn AS (
        SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x,
               CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                         OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                    WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM d
    ),
    cut AS (
        SELECT *, t[1:least(x, y)] AS prefix, t[least(x, y) + 1:greatest(x, y)] AS middle,
               t[greatest(x, y) + 1:] AS suffix
        FROM drawn
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN greatest(x, y) - least(x, y) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
                            WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM cut
"""

_HARD_NEGATIVES = """
    WITH v AS (
        SELECT row_number() OVER () AS k, vec_id,
               CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    pairs AS (
        SELECT a.k, a.vec_id AS anchor_id, o.k AS other, o.vec_id, a.label = o.label AS same,
               CAST(list_inner_product(a.e, o.e) AS BIGINT) AS score
        FROM v a JOIN v o ON a.k <> o.k AND len(a.e) = len(o.e)
        WHERE a.vec_id % 100 = 0
    ),
    positives AS (
        SELECT * FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id, other) <= 5
    ),
    ranked AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
               p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.k, p.other ORDER BY n.score DESC, n.vec_id, n.other) AS r
        FROM positives p JOIN pairs n ON p.k = n.k AND NOT n.same
        WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    )
    SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM ranked WHERE r <= 5
"""

ORACLES: dict[str, str] = {
    "op4_vector_dedup": _VECTOR_DEDUP,
    "op6_top_products": _TOP_PRODUCTS,
    "op7_repeated_passages": _REPEATED_PASSAGES,
    "op9_personal_data": _PERSONAL_DATA,
    "op11_decontamination": _DECONTAMINATION,
    "op12_fill_middle": _FILL_MIDDLE,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
