"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from quayside.llm import byte_bpe, chat_windows, cross_parsing, dart_minhash, decontaminate, html_text, periodic_runs, posting_ann, shallot, sharding, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_sharding": sharding.op1,
    "op2_dart_minhash": dart_minhash.op2,
    "op3_posting_ann": posting_ann.op3,
    "op4_warc": warc.op4,
    "op5_html_text": html_text.op5,
    "op6_suffix_dedup": suffix_dedup.op6,
    "op7_toxicity": toxicity.op7,
    "op8_cross_parsing": cross_parsing.op8,
    "op9_aho_corasick": decontaminate.op9,
    "op10_byte_bpe": byte_bpe.op10,
    "op11_shallot": shallot.op11,
    "op12_chat_windows": chat_windows.op12,
    "op13_periodic_runs": periodic_runs.op13,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: For operators that SQL can express; the others are held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS m, count(*) OVER (PARTITION BY d) AS c FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
FROM q""",
    "op9_aho_corasick": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     win AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
             FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
     sizes AS (SELECT DISTINCT n FROM win),
     runs AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
     hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN win USING (n, k)),
     words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
     items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_shallot": shallot.oracle(),
}
