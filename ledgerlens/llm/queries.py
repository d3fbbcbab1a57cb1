"""Registered queries of the text operators; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    conversation_repair,
    conversation_trie,
    decontaminate,
    fingerprints,
    html_text,
    maxent_lm,
    ngram_join,
    pieces,
    quality,
    substring_dedup,
    token_files,
    toxicity,
    url_rules,
)
from ledgerlens.llm.common import read
from ledgerlens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op1_ngram_jaccard_join(spark, d):
    return ngram_join.jaccard_components(read(spark, d, "documents"))


_WORDS = r"[^\x20\x09-\x0D]+"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_FOLDED}, '{_WORDS}') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least AS (
    SELECT a AS doc_id, min(b) AS b FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""


@query
def op2_token_files(spark, d):
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(read(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.read_tokens(spark, folder)


@query
def op3_toxicity(spark, d):
    return toxicity.toxicity(read(spark, d, "documents"), read(spark, d, "labels"))


@query
def op4_benchmark_decontamination(spark, d):
    """One row per contaminated document and item that it has."""
    found = decontaminate.benchmark_hits(read(spark, d, "documents"), read(spark, d, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", "hit.item_id", "hit.distance", F.col("hit.begin").alias("begin_char"), F.col("hit.end").alias("end_char")
    )


@query
def op5_quality(spark, d):
    return quality.quality(read(spark, d, "documents"), read(spark, d, "labels"))


@query
def op6_substring_dedup(spark, d):
    out = substring_dedup.substring_dedup(read(spark, d, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL["op6_substring_dedup"] = rf"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM worded WHERE len(w) >= 13)
), first AS (
    SELECT k, min(doc_id) AS least FROM windows GROUP BY k
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM windows JOIN first USING (k) WHERE least < doc_id
), marked AS (
    SELECT x.doc_id, x.place, x.word, gone.place IS NULL AS stays
    FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM worded) x
    LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.place = x.place
)
SELECT d.doc_id, count(place) AS n_words, count(place) FILTER (WHERE NOT stays) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (WHERE stays), '')) AS kept_sha256
FROM documents d LEFT JOIN marked ON marked.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op7_sentence_pieces(spark, d):
    """Per document: its ids' count and checksum, the digest of the decoded text, and whether that is the text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    tokens = pieces.encode_pieces(read(spark, d, "documents").select("doc_id", "text"), model, checksum=True)
    return pieces.decode_pieces(tokens, model).select(
        "doc_id",
        F.size("token_ids").alias("n_tokens"),
        "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query
def op8_lm_scoring(spark, d):
    return maxent_lm.lm_scores(read(spark, d, "documents"))


@query
def op9_html_extraction(spark, d):
    return html_text.main_texts(read(spark, d, "pages"))


@query
def op10_document_fingerprints(spark, d):
    return fingerprints.beside_next(read(spark, d, "documents"))


@query
def op11_url_filters(spark, d):
    judged = url_rules.judge_urls(read(spark, d, "pages"), url_rules.ADDRESSES, url_rules.UNWANTED)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op11_url_filters"] = r"""
WITH split AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND prefix(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/') THEN 'org/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/de/') THEN 'com/de/'
    END AS rule
    FROM split
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.])(adult|ads|casino|spam)-') OR regexp_matches(host, '-(bets|pills)[.]') THEN 'block'
    ELSE 'allow'
END AS verdict
FROM ruled
"""


@query
def op12_conversation_prefix_trie(spark, d):
    return conversation_trie.prefix_trie(read(spark, d, "conversations"))


#: crc32 of ASCII text, from the polynomial alone.
_CRC32 = """
    SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
"""


def _crc32_sql(text: str) -> str:
    octets = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


ORACLE_SQL["op12_conversation_prefix_trie"] = f"""
WITH crc AS ({_CRC32}),
convs AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT conv_id, own, {_crc32_sql('conv_id::VARCHAR')} % 9 AS h FROM convs, crc
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
    SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY ALL
), kids AS (
    SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), known AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN nodes.depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(prefix[nodes.depth].t)) END AS saved
    FROM nodes LEFT JOIN kids USING (depth, prefix)
), below AS (
    SELECT v.depth, v.prefix, sum(u.saved) AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
    FROM (SELECT saved, n_children, prefix, unnest(range(0, depth + 1)) AS at FROM known) u
    JOIN known v ON v.depth = u.at AND v.prefix = u.prefix[1:u.at] GROUP BY ALL
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves,
    b.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (depth, prefix)
LEFT JOIN known p ON p.depth = k.depth - 1 AND p.prefix = k.prefix[1:k.depth - 1]
"""


@query
def op13_conversation_repair(spark, d):
    return conversation_repair.repair_conversations(conversation_repair.damaged(read(spark, d, "conversations")))


def _cheapest(*candidates: str) -> str:
    """The least of some (cost, audit, lines); what cannot be reached costs a million or more."""
    return f"list_min([{', '.join(candidates)}])"


def _edited(state: str, cost: str, edit: str, line: str | None = None) -> str:
    lines = f"{state}.l" if line is None else f"list_append({state}.l, {line})"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'l': {lines}}}"


def _row_states() -> str:
    keep = "(CASE WHEN gone OR initial != '{}' THEN 1000000 WHEN cut THEN 5 ELSE 0 END)"
    other = "(CASE WHEN gone THEN 1000000 WHEN cut THEN 6 ELSE 1 END)"
    own = "role || ':' || text"
    into_u = [_edited(s, keep.format("u"), "K", own) for s in ("n", "s", "w")]
    into_u += [_edited(s, other, "R", "'user:' || text") for s in ("n", "s", "w")]
    into_a = [_edited("v", keep.format("a"), "K", own), _edited("v", other, "R", "'assistant:' || text")]
    return f"""
        {_edited('n', '2', 'D')} AS n,
        {_cheapest(_edited('s', '2', 'D'), _edited('n', keep.format('s'), 'K', own))} AS s,
        {_cheapest(_edited('v', '2', 'D'), *into_u)} AS u,
        {_cheapest(_edited('w', '2', 'D'), *into_a)} AS a"""


_TO_U = _cheapest("u", *[_edited(s, "5", "I", "'user:'") for s in ("n", "s", "a")])
_TO_A = _cheapest("a", _edited("u", "5", "I", "'assistant:'"))
_NOWHERE = "{'c': 1000000::BIGINT, 'a': '', 'l': []::VARCHAR[]}"

ORACLE_SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE crc AS ({_CRC32}),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(0, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM given WHERE kind > 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged
), flagged AS (
    SELECT *, body = '' AS blank, body != '' AND i > min(i) OVER (PARTITION BY conv_id, role, text) AS again, left(role, 1) AS initial
    FROM placed
), marked AS (
    SELECT *, blank OR again AS gone, NOT blank AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM flagged
), states AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} AS n,
        {_NOWHERE} AS s, {_NOWHERE} AS u, {_NOWHERE} AS a FROM conversations
    UNION ALL
    SELECT conv_id, i, {_row_states()}
    FROM (
        SELECT x.conv_id, m.i, m.role, m.text, m.initial, m.gone, m.cut, x.n, x.s, {_TO_U} AS v, {_TO_A} AS w
        FROM states x JOIN marked m ON m.conv_id IS NOT DISTINCT FROM x.conv_id AND m.i = x.i + 1
    )
), ends AS (
    SELECT conv_id, {_cheapest('n', 'a', _edited('u', '5', 'I', "'assistant:'"))} AS best
    FROM states QUALIFY i = max(i) OVER (PARTITION BY conv_id)
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
        count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
    sha256(array_to_string(best.l, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
