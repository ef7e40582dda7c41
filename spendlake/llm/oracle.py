"""DuckDB SQL for the operators that SQL can express, over the same tables.

The rule values (phrases, limits) come from the operator; the evaluation is
written anew.  The other operators need XXH64, zlib's CRC-32, BPE, zstandard,
gradient updates or Smith-Waterman, which DuckDB's SQL lacks; their tests hold
them against brute force.
"""

from __future__ import annotations

from spendlake.llm.quality_rules import CLOSING, LINE_SYMBOLS, PHRASES, SEPARATORS, SYMBOLS, Rules

_WHITE = r"[\x20\x09-\x0D]"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _words(column: str) -> str:
    return f"list_filter(string_split_regex({column}, '{_WHITE}+'), lambda x: x <> '')"


def _quality_rules(r: Rules) -> str:
    phrases = "[" + ", ".join(map(_text, PHRASES)) + "]"
    closing = "[" + ", ".join(map(_text, CLOSING)) + "]"
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
    SELECT rid, doc_id, text, {_words('text')} AS words FROM docs),
windows AS (
    SELECT rid, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS body
    FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM worded)),
repeated AS (
    SELECT rid, p FROM windows QUALIFY count(*) OVER (PARTITION BY rid, body) > 1),
covered AS (
    SELECT rid, count(DISTINCT spot) AS n_repeat_words
    FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS spot FROM repeated) GROUP BY rid),
cut AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs),
lines AS (
    SELECT rid, line, {_words('line')} AS words,
           length(regexp_replace(line, '{_WHITE}', '', 'g')) AS chars,
           length(line) - length(regexp_replace(line, {_text(LINE_SYMBOLS)}, '', 'g')) AS symbols,
           len(regexp_extract_all(line, '[!?][!?]({_WHITE}|$)')) AS loud,
           length(line) - length(regexp_replace(line, {_text(SEPARATORS)}, '', 'g')) AS gaps
    FROM cut WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
ruled AS (
    SELECT rid, line, chars,
           CASE WHEN gaps >= {r.nav_separators} AND len(words) <= {r.nav_words} * (gaps + 1) THEN 'navigation'
                WHEN 100 * symbols > {r.symbol_percent} * chars OR 2 * loud > len(words)
                  OR (len(words) < {r.fragment_words} AND NOT list_contains({closing}, right(words[-1], 1)))
                THEN 'punctuation'
                WHEN len(words) <= {r.boilerplate_words}
                 AND len(list_filter({phrases}, lambda f: contains(lower(line), f))) > 0 THEN 'boilerplate' END AS rule
    FROM lines),
per_doc AS (
    SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
           coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS lost_chars,
           count(*) FILTER (rule = 'punctuation') AS punctuation_lines,
           count(*) FILTER (rule = 'navigation') AS navigation_lines,
           count(*) FILTER (rule = 'boilerplate') AS boilerplate_lines
    FROM ruled GROUP BY rid),
counted AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '{_WHITE}', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(lost_chars, 0)::BIGINT AS lost_chars,
           coalesce(punctuation_lines, 0)::BIGINT AS punctuation_lines,
           coalesce(navigation_lines, 0)::BIGINT AS navigation_lines,
           coalesce(boilerplate_lines, 0)::BIGINT AS boilerplate_lines
    FROM worded LEFT JOIN covered USING (rid) LEFT JOIN per_doc USING (rid)),
judged AS (
    SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed
    FROM counted)
SELECT *, NOT base_failed AND 100 * lost_chars <= {r.max_lost_percent} * word_chars AS kept FROM judged
"""


_WARC = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
           sha1(coalesce(html, '')) AS hex
    FROM pages),
digests AS (  -- base32: five hex digits are four letters
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::BIGINT >> (5 * (3 - k % 4))) & 31) + 1)::BIGINT, 1)),
               'string_agg', '') AS payload_digest
    FROM payloads),
firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END
           AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM firsts
"""

_FIM = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
    FROM documents),
drawn AS (
    SELECT doc_id, text, units, len(units)::BIGINT AS n,
           list_transform([0, 1, 2, 3], lambda k: ('0x' || substr(hex, 8 * k + 1, 8))::BIGINT) AS h
    FROM cut),
placed AS (
    SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
           units,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
           array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
    FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLE: dict[str, str] = {
    "op11_fill_in_middle": _FIM,
    "op3_quality_rules": _quality_rules(Rules()),
    "op9_warc_zip": _WARC,
}
