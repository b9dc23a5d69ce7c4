"""DuckDB SQL for the queries that SQL expresses."""

from __future__ import annotations

from tripmart.llm.common import LOWER, UPPER
from tripmart.llm.decontamination import WINDOW_WORDS
from tripmart.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, needed

# Every ASCII character that is no digit or lower-case letter, for use after lower-casing.
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_sql(text: str) -> str:
    """Words of a text expression, as a list."""
    return (
        f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'),"
        f" '{_NO_WORD}'), lambda w: w <> '')"
    )


def licenses_sql() -> str:
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(
        f"({sorted(set(t.split()))!r}, '{label}', {needed(len(set(t.split())), THRESHOLD)})"
        for t, label in TEMPLATES.items()
    )
    return f"""
    WITH words AS (SELECT doc_id, text, {words_sql('text')} AS w FROM documents),
    phrases(p, label) AS (VALUES {phrases}),
    templates(t, label, k) AS (VALUES {templates}),
    places AS (
        SELECT doc_id, label, s.i - 1 AS pos
        FROM words, phrases, unnest(range(1, len(w) - len(p) + 2)) AS s(i)
        WHERE list_slice(w, s.i, s.i + len(p) - 1) = p
    ),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
               list_distinct(list(label)) AS found
        FROM places GROUP BY doc_id
    ),
    blocks AS (
        SELECT doc_id, list_distinct({words_sql('b.line')}) AS b
        FROM words, unnest(string_split(coalesce(text, ''), chr(10))) AS b(line)
    ),
    held AS (
        SELECT doc_id, label, len(list_intersect(b, t)) AS n, len(t) AS m, k
        FROM blocks, templates WHERE len(b) >= k
    ),
    added AS (
        SELECT doc_id, list_distinct(list(label)) AS found, max(n / m) AS share
        FROM held WHERE n >= k GROUP BY doc_id
    )
    SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
           CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(
               list_concat(coalesce(base.found, []), coalesce(added.found, [])))), ','), '') AS labels,
           CASE WHEN base.found IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
    FROM words LEFT JOIN base ON words.doc_id = base.doc_id LEFT JOIN added ON words.doc_id = added.doc_id
    """


def decontamination_sql(result: str = "") -> str:
    """Windows of items against windows of documents, and the words under any of them."""
    body = result or """
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
    FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN held ON d.doc_id = held.doc_id
    """
    return f"""
    WITH d AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
    items AS (SELECT item_id, {words_sql('text')} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, list_slice(w, s.i, s.i + least(len(w), {WINDOW_WORDS}) - 1) AS win
        FROM items, unnest(range(1, greatest(len(w) - {WINDOW_WORDS}, 0) + 2)) AS s(i) WHERE len(w) > 0
    ),
    lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
    runs AS (
        SELECT doc_id, s.i AS pos, n, list_slice(w, s.i, s.i + n - 1) AS win
        FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS s(i)
    ),
    found AS (SELECT doc_id, pos, n, item_id FROM runs JOIN windows USING (win)),
    covered AS (SELECT DISTINCT doc_id, p.i AS place FROM found, unnest(range(pos, pos + n)) AS p(i)),
    hits AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
    held AS (
        SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS ids
        FROM found GROUP BY doc_id
    )
    {body}
    """


ORACLE: dict[str, str] = {
    "op4_license_scans": licenses_sql(),
    "op8_decontamination": decontamination_sql(),
}
