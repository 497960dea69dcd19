"""The SQL of this subpackage's queries, where SQL can say what they do."""

from __future__ import annotations

from docketframe.llm import decontaminate, secrets


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secret_kind(n: int, kind: str, pattern: str, least: int) -> str:
    p = _quoted(pattern)
    good = f"length(value) >= {least}"
    if kind == "secret":
        good += " AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')"
    return f"""
      SELECT rid, {n} AS kind, s AS start_, s + hit AS end_ FROM (
        SELECT rid, value, hit, sum(gap + hit) OVER (PARTITION BY rid ORDER BY i) - hit AS s FROM (
          SELECT rid, unnest(range(len(h))) AS i, unnest(list_transform(g[:len(h)], lambda x: length(x))) AS gap,
                 unnest(list_transform(h, lambda x: length(x))) AS hit, unnest(v) AS value
          FROM (SELECT rid, string_split_regex(t, {p}) AS g, regexp_extract_all(t, {p}) AS h,
                       regexp_extract_all(t, {p}, 1) AS v FROM d WHERE regexp_matches(t, {p}))))
      WHERE {good}"""


def _secrets() -> str:
    kinds = secrets.STRONG + secrets.WEAK
    name = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS)) + " END"
    ids = ", ".join(str(secrets.KINDS.index(k)) for k in secrets.IDENTIFIERS)
    keys = ", ".join(str(secrets.KINDS.index(k)) for k in secrets.SECRETS)
    count = ", ".join(
        f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(secrets.KINDS)
    )
    word = f"{name} || ':' || start_ || ':' || end_"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({" UNION ALL ".join(_secret_kind(i, k, p, n) for i, (k, p, n) in enumerate(kinds))}),
    p AS (SELECT * FROM m WHERE kind < {len(secrets.STRONG)} OR NOT EXISTS (
      SELECT 1 FROM m b WHERE b.rid = m.rid AND b.kind < {len(secrets.STRONG)} AND b.start_ <= m.start_ AND m.end_ <= b.end_)),
    n AS (SELECT a.rid, a.kind, a.start_, a.end_, bool_or(b.kind IN ({ids})) AS has_id, bool_or(b.kind IN ({keys})) AS has_key
          FROM p a JOIN p b ON a.rid = b.rid AND abs(a.start_ - b.start_) <= {secrets.SCOPE} GROUP BY ALL),
    k AS (SELECT * FROM n WHERE kind < {len(secrets.STRONG)} OR kind = {secrets.KINDS.index("ident")} AND has_key
          OR kind = {secrets.KINDS.index("secret")} AND has_id OR kind = {secrets.KINDS.index("endpoint")} AND has_id AND has_key),
    g AS (SELECT rid, {count}, string_agg({word}, ',' ORDER BY start_, kind) AS spans,
          string_agg({word}, ',' ORDER BY start_, kind) FILTER (kind < {len(secrets.STRONG)}) AS base FROM k GROUP BY rid)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.KINDS)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (rid)"""


def _contamination() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'), {_quoted(decontaminate.WORD)})"
    n = decontaminate.WINDOW
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
    i AS (SELECT item_id, {words} AS w FROM benchmark),
    r AS (SELECT DISTINCT item_id, {n} AS n, array_to_string(w[s + 1 : s + {n}], ' ') AS run
          FROM (SELECT item_id, w, unnest(range(len(w) - {n - 1})) AS s FROM i WHERE len(w) >= {n})
          UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM i WHERE len(w) BETWEEN 1 AND {n - 1}),
    c AS (SELECT rid, n, s, array_to_string(w[s + 1 : s + n], ' ') AS run
          FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM r) WHERE len(w) >= n)),
    h AS (SELECT rid, n, s, item_id FROM c JOIN r USING (n, run)),
    p AS (SELECT rid, count(DISTINCT s + k) AS n_hit FROM (SELECT DISTINCT rid, s, n FROM h) x, range({n}) t(k) WHERE k < n GROUP BY rid),
    g AS (SELECT rid, count(DISTINCT item_id::VARCHAR) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY rid)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN p USING (rid) LEFT JOIN g USING (rid)"""


ORACLE_SQL = {
    "op2_secret_scan": _secrets(),
    "op5_decontamination": _contamination(),
    "op10_warc": """
    WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM f""",
    "op13_fill_in_middle": r"""
    WITH t AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
      FROM documents),
    h AS (
      SELECT *, len(tokens) AS n, ('0x' || hex[1:8])::UBIGINT AS h1, ('0x' || hex[9:16])::UBIGINT AS h2,
             ('0x' || hex[17:24])::UBIGINT AS h3, ('0x' || hex[25:32])::UBIGINT AS h4
      FROM t),
    c AS (
      SELECT doc_id, text, n, tokens, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM h),
    p AS (
      SELECT doc_id, text, n, form, coalesce(array_to_string(tokens[1:low::BIGINT], ''), '') AS prefix,
             coalesce(array_to_string(tokens[low::BIGINT + 1:high::BIGINT], ''), '') AS middle,
             coalesce(array_to_string(tokens[high::BIGINT + 1:], ''), '') AS suffix
      FROM c)
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p""",
}
