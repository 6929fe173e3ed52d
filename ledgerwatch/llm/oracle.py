"""DuckDB SQL for the operators that SQL can express, except the mixing."""

from __future__ import annotations


def merkle_sql() -> str:
    """Trees level by level, then each leaf's way up to the root."""

    def leaf(n_chars: str) -> str:
        texts = [f"CAST({v} AS VARCHAR)" for v in ("doc_id", "source", "lang", n_chars, "text")]
        parts = " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts)
        return f"sha256({parts})"

    # A step is a byte to take in, or one of its eight bits to shift out.
    steps = """flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"""
    crc = f"""xor(4294967295, list_reduce({steps}, lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
        WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END, CAST(4294967295 AS BIGINT)))"""

    def levels(name: str, leaves: str) -> str:
        return f"""{name}(tree, level, rank, digest, n) AS (
            SELECT tree, 0, rank, digest, n FROM {leaves}
            UNION ALL
            SELECT tree, level + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (n + 1) // 2
            FROM {name} WHERE n > 1 GROUP BY tree, level, rank // 2, n)"""

    def walk(name: str, start: str, levels: str) -> str:
        beside = "coalesce(beside.digest, '')"
        return f"""{name}(id, tree, level, rank, n, folded, proof) AS (
            {start}
            UNION ALL
            SELECT id, w.tree, w.level + 1, w.rank // 2, (w.n + 1) // 2,
                sha256(CASE WHEN w.rank % 2 = 1 THEN {beside} || folded ELSE folded || {beside} END),
                proof || {beside}
            FROM {name} w LEFT JOIN {levels} beside
                ON beside.tree = w.tree AND beside.level = w.level AND beside.rank = xor(w.rank, 1)
            WHERE w.n > 1)"""

    climbed = walk("climbed", "SELECT id, tree, 0, rank, n, altered, '' FROM leaves", "below")
    subroots = "SELECT id, '', 0, s.rank, s.n, folded, proof FROM climbed c JOIN subroots s ON s.name = c.tree WHERE c.n = 1"
    return f"""WITH RECURSIVE rows_read AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS tree, {leaf("n_chars")} AS digest,
                CASE WHEN n_chars IS NOT NULL AND {crc} % 7 = 0 THEN {leaf("n_chars + 1")} ELSE digest END AS altered
            FROM documents),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, id) - 1 AS rank,
            count(*) OVER (PARTITION BY tree) AS n FROM rows_read),
        {levels("below", "leaves")},
        subroots AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS rank, digest,
            count(*) OVER () AS n FROM below WHERE n = 1),
        {levels("above", "subroots")},
        {climbed},
        {walk("arrived", subroots, "above")}
        SELECT doc_id, l.digest AS leaf, s.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256,
            folded AS folded_root, folded = top.digest AS verified
        FROM leaves l JOIN arrived a ON a.id = l.id AND a.n = 1 JOIN subroots s ON s.name = l.tree
            JOIN above top ON top.n = 1"""


def divergence_sql() -> str:
    """Every term counted, and every kept term given a figure by every source."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
        found AS (SELECT id, lang, source,
            unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM found GROUP BY ALL),
        kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT id) >= 10),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        cells AS (SELECT lang, source, term, coalesce(n, 0) AS n,
                sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
                sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS lang_n,
                sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS v
            FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
        shares AS (SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (total + 2 * v) AS p,
                1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (lang_total + 2 * v) AS q
            FROM cells),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
            FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
            UNION ALL
            SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b USING (lang)
            WHERE a.source <> b.source AND a.lang NOT IN (SELECT lang FROM kept)),
        term AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
            FROM shares WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
