"""SQL fragments (DuckDB dialect) for the independent oracle queries.

These mirror the *semantics* of the Spark column functions, written from
the specification (Python string rules), not generated from the Spark plan.
"""

from __future__ import annotations

from quire.functions.text import PY_SPACE_CLASS, ZERO_WIDTH_CLASS

WS = PY_SPACE_CLASS
PREFIX_SQL = "('Ispovest:' || chr(10))"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def collapse(e: str) -> str:
    return f"regexp_replace({e}, {q(WS + '+')}, ' ', 'g')"


def normalize_key(e: str) -> str:
    inner = f"lower(replace(coalesce({e}, ''), {PREFIX_SQL}, ''))"
    return f"nfc_normalize({collapse(strip(inner))})"


def normalize_light(e: str) -> str:
    inner = f"replace({e}, {PREFIX_SQL}, '')"
    return f"lower({strip(inner)})"


def content_hash(e: str) -> str:
    return f"sha256({collapse(strip(f'lower({e})'))})"


def parse_int(e: str) -> str:
    s = f"CAST({e} AS VARCHAR)"
    return (f"COALESCE(CASE WHEN regexp_full_match({s}, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*') "
            f"THEN TRY_CAST(replace(trim({s}), '_', '') AS BIGINT) END, 0)")


def engagement_score(a: str, d: str, digits: int = 4) -> str:
    ai, di = f"CAST({parse_int(a)} AS DOUBLE)", f"CAST({parse_int(d)} AS DOUBLE)"
    return f"round_even(({ai} - {di}) / ({ai} + {di} + 1.0), {digits})"


def clean_text_nfc_free(e: str) -> str:
    """clean_text without NFKC (DuckDB lacks it; the fixtures contain no
    text NFKC would change — checked in the tests)."""
    t = f"replace(coalesce({e}, ''), chr(160), ' ')"
    t = f"regexp_replace({t}, {q(ZERO_WIDTH_CLASS)}, '', 'g')"
    return strip(collapse(t))


def sample_key(id_expr: str, seed: int = 42) -> str:
    return f"sha256({q(str(seed) + '|')} || CAST({id_expr} AS VARCHAR))"


# ---- fixture bindings, as CTE bodies ----
CLUSTERED = """
SELECT d.doc_id, d.text, d.source,
       CAST(CASE WHEN e.label IS NOT NULL THEN e.label
                 WHEN length(d.text) >= 40 THEN coalesce(TRY_CAST(regexp_extract(d.source, '[0-9]+$') AS INTEGER) + 10, -1)
                 ELSE -1 END AS INTEGER) AS cluster_id
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id
"""

TOPIC_CORPUS = """
SELECT doc_id, text,
       CAST(CASE WHEN cluster_id = -1 THEN -999 ELSE cluster_id END AS INTEGER) AS cluster,
       CASE WHEN cluster_id = -1 THEN 'razno' ELSE source END AS cluster_topic
FROM clustered
"""

VOTES = """
SELECT user_id,
       CAST(count(*) FILTER (WHERE event_type IN ('click','purchase','signup')) AS VARCHAR) AS approve,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) AS disapprove
FROM events GROUP BY user_id
"""

VOTES_BY_TEXT = """
SELECT d.text, v.approve, v.disapprove, v.user_id AS ord
FROM votes v JOIN documents d ON v.user_id = d.doc_id
"""

SEEN = f"""
SELECT DISTINCT {content_hash('d.text')} AS hash
FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)
"""

TOPIC_LINES = """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS line_no,
       CAST(n_regionkey AS VARCHAR) || ' ' || n_name || ' (' || CAST(n_nationkey AS VARCHAR) || ')' AS line
FROM nation
"""

ANCHORED = """
SELECT vec_id, label,
       list_transform(x, lambda z: z / sqrt(list_sum(list_transform(x, lambda w: w * w)))) AS v
FROM (SELECT vec_id, label,
             list_transform(embedding, lambda z, i: CAST(z AS DOUBLE)
                            + CASE WHEN i - 1 = label AND vec_id % 7 <> 0 THEN 2.0 ELSE 0.0 END) AS x
      FROM embeddings)
"""

BINDINGS = {
    "clustered": CLUSTERED,
    "topic_corpus": TOPIC_CORPUS,
    "votes": VOTES,
    "votes_by_text": VOTES_BY_TEXT,
    "seen": SEEN,
    "topic_lines": TOPIC_LINES,
    "anchored": ANCHORED,
}
DEPENDS = {"topic_corpus": ["clustered"], "votes_by_text": ["votes"]}


def with_bindings(names: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def add(n):
        for dep in DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({BINDINGS[n].strip()})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
