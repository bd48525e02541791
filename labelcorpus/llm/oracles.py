"""DuckDB SQL for the registered queries of the subpackage that SQL can express."""

from __future__ import annotations

from .quality import BOILERPLATE

_WORD = r"[^\x20\x09-\x0D]+"


def _quality_sql() -> str:
    count = "len(regexp_extract_all({x}, '{p}'))"
    word = count.replace("{p}", _WORD)
    phrase = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    return (
        "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
        f"w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d), "
        "win AS (SELECT rid, i, ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] AS k FROM "
        "(SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)), "
        "rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1), "
        "pos AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid), "
        "ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d), "
        f"lf AS (SELECT rid, line, {word.format(x='line')} AS n, "
        "length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols, "
        f"{count.format(x='line', p='[!?]{2,}')} AS shouts, "
        r"len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x IN ('|', '»', '·', '>'))) AS bars, "
        + count.format(x="line", p=r"\p{Lu}{2,}") + " AS caps FROM ln), "
        "lb AS (SELECT *, (n > 2 AND (symbols * 100 > n * 30 OR shouts * 100 > n * 30 OR bars * 100 > n * 30)) "
        f"OR (n > 4 AND caps * 100 > n * 60) OR (n > 0 AND ({phrase})) AS bad FROM lf), "
        "ls AS (SELECT rid, count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS dup, "
        "count(*) FILTER (WHERE bad) AS nb, coalesce(sum(n) FILTER (WHERE bad), 0) AS wb, sum(symbols) AS sy "
        "FROM lb GROUP BY rid), "
        "r AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, "
        "CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, "
        "CAST(sy AS BIGINT) AS n_symbols, CAST(dup AS BIGINT) AS n_dup_lines, "
        "CAST(coalesce(pos.n, 0) AS BIGINT) AS n_repeat_words, CAST(nb AS BIGINT) AS n_failed_lines, "
        "CAST(wb AS BIGINT) AS n_failed_words FROM w JOIN ls USING (rid) LEFT JOIN pos USING (rid)), "
        "b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM r) "
        "SELECT *, NOT base_failed AND n_failed_words * 100 <= n_words * 30 AS kept FROM b")


def _top_k_sql() -> str:
    return (
        "WITH e AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, "
        "lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE vec_id IS NOT NULL "
        "AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0), "
        "s AS (SELECT q.rid AS qr, q.vec_id AS query_id, x.rid, x.vec_id, CAST(list_inner_product("
        "list_transform(q.v, lambda a: CAST(a AS DOUBLE)), list_transform(x.v, lambda a: CAST(a AS DOUBLE))) AS BIGINT) AS score "
        "FROM e q JOIN e x ON q.rid <> x.rid WHERE q.vec_id % 50 = 0) "
        "SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER "
        "(PARTITION BY qr ORDER BY score DESC, vec_id, rid) AS rank FROM s) WHERE rank <= 5")


def _jaccard_sql() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (
        "WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, "
        f"regexp_extract_all({low}, '{_WORD}') AS w FROM documents), "
        "sh AS MATERIALIZED (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM "
        "(SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0))), "
        "n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), "
        "o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k "
        "AND a.doc_id < b.doc_id GROUP BY ALL), "
        "l AS MATERIALIZED (SELECT x, y FROM o JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y "
        "WHERE 100 * c >= 80 * (na.n + nb.n - c)), "
        "e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l), "
        "reach AS (SELECT DISTINCT x AS s, x AS v FROM e UNION SELECT s, y FROM reach JOIN e ON e.x = v), "
        "m AS (SELECT s, min(v) AS component FROM reach GROUP BY s) "
        "SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component, d.doc_id) AS component_id "
        "FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.s = d.doc_id")


ORACLE: dict[str, str] = {
    "op3_voronoi_top_k": _top_k_sql(),
    "op9_quality_rules": _quality_sql(),
    "op10_ngram_jaccard": _jaccard_sql(),
}
