"""DuckDB SQL that states the results of the operators SQL can express."""

from __future__ import annotations


def op3(rules, vocabulary, strict: int, min_soft: int) -> str:
    def terms(want: bool) -> str:
        return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT" for t, w in vocabulary if (w >= strict) == want)

    fits = [(f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r) for r in sorted(rules, key=lambda r: -len(r.name))]
    name = " ".join(f"WHEN {c} THEN '{r.name}'" for c, r in fits)
    action = " ".join(f"WHEN {c} THEN '{r.action}'" for c, r in fits)
    abc = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH a AS (
  SELECT page_id, url, coalesce(instr(url, '://'), 0) AS mark FROM pages
), b AS (
  SELECT page_id, translate(coalesce(url, ''), {abc}) AS u,
    CASE WHEN mark > 0 THEN translate(regexp_extract(substr(url, mark + 3), '^[^/?#]*'), {abc}) ELSE '' END AS host,
    CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM a
), c AS (
  SELECT *, {terms(True)} AS strict_terms, {terms(False)} AS soft_terms FROM b
)
SELECT page_id, host, path, CASE {name} END AS rule,
  CASE {action} WHEN strict_terms >= 1 OR soft_terms >= {min_soft} THEN 'block' ELSE 'allow' END AS verdict,
  strict_terms, soft_terms
FROM c"""


OP4 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keep THEN keep END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes >= 1000"""


OP8 = r"""
WITH d AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), o AS (
  SELECT doc_id, source, pos - 1 AS pos, lines[pos] AS line,
    trim(lines[pos], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k
  FROM d, unnest(range(1, len(lines) + 1)) AS u(pos)
), f AS (
  SELECT k, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
  FROM o WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10
), m AS (
  SELECT o.doc_id, o.pos, o.line, f.k IS NOT NULL AND struct_pack(doc_id := o.doc_id, pos := o.pos) <> f.first AS gone
  FROM o LEFT JOIN f USING (k)
), g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(g.n_lines, 0)::BIGINT AS n_lines, coalesce(g.n_removed, 0)::BIGINT AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE g.text END AS text
FROM d LEFT JOIN g USING (doc_id)"""


def op10(masks, overlap: int, most: int, phrase: int) -> str:
    shortest = min(map(len, masks))
    reach = max(0, overlap - shortest)
    window = reach + max(overlap, *map(len, masks))

    def words(ident: str, source: str) -> str:
        return f"SELECT {ident}, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {source} WHERE text IS NOT NULL"

    def keyed(ident: str, source: str) -> str:
        def one(m: int, mask: str) -> str:
            kept = ", ".join(f"w[pos + {i + 1}]" for i, c in enumerate(mask) if c == "1")
            return f"SELECT {ident}, pos, w, {len(mask)} AS reach, concat_ws(' ', {m}, {kept}) AS key FROM {source} WHERE pos + {len(mask)} <= len(w)"

        return " UNION ALL ".join(one(m, mask) for m, mask in enumerate(masks))

    at = lambda side: f"CASE WHEN {side}.pos + k >= 0 THEN {side}.w[{side}.pos + k + 1] END"
    return f"""
WITH dw AS ({words("doc_id", "documents")}), iw AS ({words("item_id", "benchmark")}),
dp AS (SELECT doc_id, w, pos FROM dw, unnest(range(0, len(w))) AS u(pos)),
ip AS (SELECT item_id, w, pos FROM iw, unnest(range(0, len(w))) AS u(pos)),
d AS ({keyed("doc_id", "dp")}), i AS ({keyed("item_id", "ip")}),
h AS (
  SELECT doc_id, item_id, d.pos AS pos, d.reach AS reach, least({overlap}, len(d.w), len(i.w)) AS need,
    list_transform(range({-reach}, {window - reach}), lambda k: CASE WHEN {at("d")} = {at("i")} THEN 0 WHEN {at("d")} <> {at("i")} THEN 1 ELSE 1000 END) AS z
  FROM d JOIN i ON d.key = i.key
), v AS (
  SELECT doc_id, item_id, pos, reach FROM h
  WHERE len(list_filter(range(0, {reach + 1}), lambda j: j - {reach} + need >= reach AND list_sum(z[j + 1 : j + need]) <= {most})) > 0
  UNION ALL
  SELECT doc_id, item_id, pos, len(iw.w) AS reach FROM dp JOIN iw
    ON len(iw.w) BETWEEN 1 AND {shortest - 1} AND dp.w[pos + 1 : pos + len(iw.w)] = iw.w AND (len(iw.w) >= {phrase} OR len(dp.w) = len(iw.w))
)
SELECT doc_id, item_id, count(*) AS n_hits, min(pos)::BIGINT AS first_word, max(pos + reach - 1)::BIGINT AS last_word
FROM v GROUP BY doc_id, item_id"""
