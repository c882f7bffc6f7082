"""DuckDB counterparts of the operators that SQL can express."""

from __future__ import annotations

from eraloom.llm.secret_scan import KINDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


DECONTAMINATION = f"""
WITH D AS (SELECT doc_id, {_words("text")} AS w FROM documents),
I AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_words("text")} AS w FROM benchmark)),
W AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k+n-1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w)-n+2)) AS k FROM I WHERE n > 0)),
G AS (SELECT doc_id, p, n, array_to_string(w[p:p+n-1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w)-n+2)) AS p FROM D, (SELECT DISTINCT n FROM W))),
H AS (SELECT doc_id, item_id, p, n FROM G JOIN W USING (n, win)),
C AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p+n)) AS q FROM H) GROUP BY 1),
L AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM H GROUP BY 1)
SELECT D.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM D LEFT JOIN C USING (doc_id) LEFT JOIN L USING (doc_id)"""


def _kind(order: int) -> str:
    name, pattern, group, least = KINDS[order]
    p = pattern.replace("'", "''")
    only = " WHERE v SIMILAR TO '.*[0-9].*' AND v SIMILAR TO '.*[A-Za-z].*' AND NOT regexp_full_match(v, '[0-9a-f]+') AND len(list_distinct(string_split(v, ''))) >= 10" if name == "owned" else ""
    return f"""SELECT * FROM (SELECT doc_id, source, '{name}' AS kind, {order} AS k, v, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s, length(f) AS size
      FROM (SELECT *, found[i] AS f, vals[i] AS v FROM (SELECT *, unnest(range(1, len(found)+1)) AS i FROM (SELECT doc_id, source, string_split_regex(text, '{p}') AS pieces, regexp_extract_all(text, '{p}', 0) AS found, regexp_extract_all(text, '{p}', {group}) AS vals FROM documents WHERE regexp_matches(text, '{p}'))))
      WHERE length(v) >= {least}){only}"""


SECRETS = f"""
WITH S AS ({" UNION ALL ".join(map(_kind, range(len(KINDS))))}),
F AS (SELECT v, count(DISTINCT source) <= 1 AND count(DISTINCT (source, doc_id)) <= 10 AS live, count(DISTINCT (source, doc_id)) AS n_repos FROM S GROUP BY 1),
J AS (SELECT * FROM S JOIN F USING (v) WHERE live OR kind <> 'owned'),
A AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || (s+size), ',' ORDER BY s, k) FILTER (kind <> 'owned') AS base, string_agg(kind || ':' || s || ':' || (s+size), ',' ORDER BY s, k) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_shared, max(n_repos) AS most_repos FROM J GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(most_repos, 0) AS most_repos FROM documents LEFT JOIN A USING (doc_id)"""

_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * k + 1}, 5))::BIGINT >> {s}) & 31) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0))
WARC = f"""
WITH P AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
R AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM P)
SELECT page_id, url, strftime(to_timestamp(1704067200 + page_id % 2147483648) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured_at, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to, strlen(html) AS payload_bytes, {_DIGITS} AS payload_digest,
  array_to_string(list_reverse(string_split(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1), '.')), ',') || ')' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS url_key
FROM R"""



def _codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Every part against every entry; a squared distance less the part's own square decides, ties by index."""

    def nearest(book: str, extra: str = "") -> str:
        d = "list_dot_product(c, c) - 2 * list_dot_product(v, c)"
        return f"SELECT vec_id, p, v{extra}, min(struct_pack(d := {d}, k := k)).k AS k FROM P JOIN {book} USING (p) GROUP BY vec_id, p, v{extra}"

    steps = [
        "V AS MATERIALIZED (SELECT vec_id, label, embedding AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"P AS MATERIALIZED (SELECT vec_id, label, p, list_transform(e[p*len(e)//{parts}+1:(p+1)*len(e)//{parts}], lambda x: floor(1024*x::DOUBLE)) AS v FROM V, range({parts}) r(p))",
        f"B0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, v AS c FROM P QUALIFY k < {entries})",
    ]
    for r in range(rounds):
        steps.append(f"A{r} AS MATERIALIZED ({nearest(f'B{r}')})")
        means = f"SELECT p, k, list(m ORDER BY j) AS m FROM (SELECT p, k, j, floor(sum(x)/count(*)) AS m FROM (SELECT p, k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM A{r}) GROUP BY p, k, j) GROUP BY p, k"
        steps.append(f"B{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m, c) AS c FROM B{r} LEFT JOIN ({means}) USING (p, k))")
    steps.append(f"Z AS ({nearest(f'B{rounds}', ', label')})")
    steps.append(f"E AS (SELECT vec_id, label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(list_sum(list_transform(list_zip(v, c), lambda z: pow(z[1]-z[2], 2)))) AS BIGINT) AS error FROM Z JOIN B{rounds} USING (p, k) GROUP BY vec_id, label)")
    steps.append(f"H AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM B{rounds})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM E, H"


ORACLES = {"op11_vector_codes": _codes(), "op1_secret_scan": SECRETS, "op3_decontaminate": DECONTAMINATION, "op10_warc": WARC}
