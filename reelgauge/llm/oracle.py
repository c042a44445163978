"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

import re

from reelgauge.llm import chat_format, license_scan, mixing, quality_rules, url_filter

_W = r"[\x20\x09-\x0D]"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_EXACT = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_W}', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS n, max(chars) AS top FROM d GROUP BY norm),
k AS (SELECT d.norm, min(doc_id) AS keep_id FROM d JOIN g ON d.norm = g.norm AND d.chars = g.top GROUP BY d.norm)
SELECT d.doc_id, k.keep_id, g.n AS group_size, d.doc_id = k.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm JOIN k ON d.norm = k.norm
"""

_STOPS = ", ".join(_quoted(w) for w in sorted(set(" ".join(quality_rules.STOP_WORDS.values()).split())))
_BROKEN = ", ".join(
    f"CASE WHEN {' OR '.join(x for x in (f'{r.measure} < {r.low}' if r.low is not None else '', f'{r.measure} > {r.high}' if r.high is not None else '') if x)} THEN '{r.name}' END"
    for r in quality_rules.RULES
)
_QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_W}+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
twice AS (SELECT k, g FROM win GROUP BY k, g HAVING count(*) > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT win.k, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (k, g)) GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS word_chars0,
    CAST(length(t) - length(regexp_replace(t, '[{quality_rules.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, CAST(len(list_intersect(list_distinct(w), [{_STOPS}])) AS INTEGER) AS n_stop_words
  FROM d LEFT JOIN rep USING (k)),
r AS (
  SELECT *, coalesce(word_chars0, 0) AS word_chars,
    CASE WHEN n_words = 0 THEN 0 ELSE coalesce(word_chars0, 0) / n_words END AS mean_word_chars,
    CASE WHEN n_words = 0 THEN 0 ELSE n_symbols / n_words END AS symbols_per_word,
    CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines / n_lines END AS dup_line_share,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, list_filter([{_BROKEN}], lambda x: x IS NOT NULL) AS broken FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, base_failed,
  array_to_string(broken, ' ') AS failed, NOT base_failed AND len(broken) = 0 AS kept FROM f
"""

_RULE_ROWS = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in url_filter.RULES)
_URLS = f"""
WITH rules(rh, rp, rv) AS (VALUES {_RULE_ROWS}),
u AS (SELECT row_number() OVER () AS k, page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
p AS (
  SELECT k, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM h),
hit AS (
  SELECT k, rh || rp AS rule, rv, row_number() OVER (PARTITION BY k ORDER BY length(rh || rp) DESC) AS place
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM p LEFT JOIN (FROM hit WHERE place = 1) USING (k)
"""

_SENTENCE_ROWS = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in license_scan.SENTENCES.items())
_marks: dict[str, str] = {}
_matched = "ids"
for _name, _sequence in license_scan.RULES:
    _mark = "" if _name is None else " " + _marks.setdefault(_name, f"@{len(_marks)}@") + " "
    _matched = f"replace({_matched}, ' {'  '.join(_sequence)} ', '{_mark}')"
_MARK_ROWS = ", ".join(f"({_quoted(m)}, {_quoted(n)})" for n, m in _marks.items())
# Every line stands between \x01 and \x02, and \x03 between sentences, so a known sentence is whole lines by one pattern.
_KNOWN = "|".join(s.replace(" ", "(?: |\x02\x01)") for s in sorted(license_scan.SENTENCES, key=lambda x: (-len(x), x)))
_LICENSES = rf"""
WITH known(s, id) AS (VALUES {_SENTENCE_ROWS}), marks(m, name) AS (VALUES {_MARK_ROWS}),
c AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '(?m)^[ \t]*[#*/;!%''|>-]+', '', 'g'), '(?m)^[ \t]*(?:dnl|rem)([ \t])', '\1', 'g'), 'spdx-license-identifier *:', 'spdx license identifier ', 'g') AS t FROM documents),
d AS (
  SELECT k, doc_id, regexp_replace(regexp_replace(
    regexp_replace(t, '[.;:!?]+([\x20\x09-\x0D]|$)', chr(10) || chr(10) || '\1', 'g'), '[^\n\p{{L}}\p{{N}}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g') AS t FROM c),
b AS (SELECT k, doc_id, chr(1) || replace(regexp_replace(trim(t, ' '), '\n\n+', chr(2) || chr(3) || chr(1), 'g'), chr(10), chr(2) || chr(1)) || chr(2) AS t FROM d),
h AS (SELECT k, regexp_extract_all(t, '\x01(?:{_KNOWN})\x02') AS hits FROM b),
u AS (SELECT k, unnest(hits) AS s, generate_subscripts(hits, 1) AS i FROM h),
f AS (
  SELECT k, string_agg(' ' || id || ' ', '' ORDER BY i) AS ids, string_agg(id, ' ' ORDER BY i) AS sentence_ids
  FROM u JOIN known ON replace(replace(replace(u.s, chr(2) || chr(1), ' '), chr(1), ''), chr(2), '') = known.s GROUP BY k),
tok AS (SELECT k, sentence_ids, list_filter(regexp_split_to_array({_matched}, ' +'), lambda x: x <> '') AS ts FROM f),
e AS (SELECT k, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM tok),
n AS (SELECT k, i, coalesce(name, 'UNKNOWN') AS name FROM e LEFT JOIN marks ON t = m),
o AS (SELECT k, name, min(i) AS i, count(*) AS c FROM n GROUP BY k, name),
l AS (SELECT k, string_agg(name, ' ' ORDER BY i) AS licenses, CAST(coalesce(sum(c) FILTER (WHERE name = 'UNKNOWN'), 0) AS BIGINT) AS n_unmatched FROM o GROUP BY k)
SELECT d.doc_id, coalesce(tok.sentence_ids, '') AS sentence_ids, coalesce(l.licenses, '') AS licenses, coalesce(l.n_unmatched, 0) AS n_unmatched
FROM d LEFT JOIN tok ON d.k = tok.k LEFT JOIN l ON d.k = l.k
"""

_T = chat_format.Template()
_ESCAPED = _quoted("|".join([r"\\", *(re.escape(c) for c in sorted(_T.controls, key=len, reverse=True))]).replace(r"\<", "<").replace(r"\>", ">"))
_SAID = "</s>[INST] ok [/INST]"
_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_SAID}' UNION ALL SELECT -7, 1, 'assistant', '{_SAID}'),
n AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (
  SELECT *, CASE before WHEN 'system' THEN 'briefed' WHEN 'user' THEN 'asked' WHEN 'assistant' THEN 'answered' ELSE 'start' END AS stood,
    CASE role WHEN 'system' THEN 'briefed' WHEN 'user' THEN 'asked' ELSE 'answered' END AS after FROM n),
f AS (
  SELECT *, CASE WHEN (stood = 'start' AND role IN ('system', 'user')) OR (stood IN ('briefed', 'answered') AND role = 'user') OR (stood = 'asked' AND role = 'assistant')
    THEN NULL ELSE CASE WHEN role = '' THEN 'no role' ELSE role END || ' after ' || stood END AS bad FROM s),
g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum({len(_T.opening + _T.after_role + _T.closing)} + length(role) + length(text) + len(regexp_extract_all(text, {_ESCAPED}))
      + len(regexp_extract_all(role, {_ESCAPED})) + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars,
    arg_min(bad, i) FILTER (WHERE bad IS NOT NULL) AS bad, arg_max(after, i) AS ended
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, bad IS NULL AND ended = 'answered' AS valid,
  coalesce(bad, CASE WHEN ended <> 'answered' THEN 'ends after ' || ended END) AS fault FROM g
"""


def _case(column: str, level, default: int) -> str:
    return "CASE " + column + "".join(f" WHEN {_quoted(k)} THEN {v}" for k, v in level.items()) + f" ELSE {default} END" if level else str(default)


def _dealt(level: int, parent: str, own: str) -> str:
    """CTEs that deal b{level - 1} to the nodes of c{level}."""
    by = f"PARTITION BY {parent}" if parent else ""
    join = f"JOIN b{level - 1} USING ({parent})" if parent else f", b{level - 1}"
    order = f"{by} ORDER BY CASE WHEN weight > 0 THEN CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) ELSE 0 END, {own}"
    keys = f"{parent}, {own}" if parent else own
    return f"""
x{level} AS (SELECT c{level}.*, budget FROM c{level} {join}),
y{level} AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM x{level}),
z{level} AS (SELECT *, cap * weights <= (budget - before) * weight AS filled FROM y{level}),
u{level} AS (SELECT *, budget - coalesce(sum(cap) FILTER (WHERE filled) OVER ({by}), 0) AS rest, sum(weight) FILTER (WHERE NOT filled) OVER ({by}) AS open FROM z{level}),
b{level} AS (SELECT {keys}, CASE WHEN filled THEN CAST(cap AS HUGEINT) ELSE CAST(rest AS HUGEINT) * weight // CAST(open AS HUGEINT) END AS budget FROM u{level})"""


_M = mixing.MIX
_DOMAIN = "CASE" + "".join(f" WHEN source IN ({', '.join(map(_quoted, v))}) THEN {_quoted(k)}" for k, v in mixing.DOMAINS.items()) + " ELSE 'other' END"
_MIXING = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, {_DOMAIN} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_W}+'), lambda x: x <> '')) AS BIGINT) AS n_tokens,
    coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
v3 AS (SELECT *, {_case("source", _M.weights[2], _M.default)} AS weight FROM leaf),
c3 AS (SELECT * EXCLUDE (tokens), CASE WHEN weight > 0 THEN tokens * {_M.max_epochs} ELSE 0 END AS cap FROM v3),
v2 AS (SELECT domain, lang, sum(cap) AS s, {_case("lang", _M.weights[1], _M.default)} AS weight FROM c3 GROUP BY domain, lang),
c2 AS (SELECT domain, lang, weight, CASE WHEN weight > 0 THEN s ELSE 0 END AS cap FROM v2),
v1 AS (SELECT domain, sum(cap) AS s, {_case("domain", _M.weights[0], _M.default)} AS weight FROM c2 GROUP BY domain),
c1 AS (SELECT domain, weight, CASE WHEN weight > 0 THEN s ELSE 0 END AS cap FROM v1),
b0 AS (SELECT least((SELECT sum(tokens) FROM leaf) * {_M.percent} // 100, (SELECT sum(cap) FROM c1)) AS budget),{_dealt(1, "", "domain")},{_dealt(2, "domain", "lang")},{_dealt(3, "domain, lang", "source")},
plan AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS remainder
  FROM leaf JOIN b3 USING (domain, lang, source)),
keyed AS (SELECT d.*, tokens, budget, epochs, remainder, md5('{_M.seed}:' || CAST(epochs AS VARCHAR) || ':' || name) AS key FROM d JOIN plan USING (domain, lang, source)),
sums AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(tokens AS BIGINT) AS leaf_tokens, CAST(budget AS BIGINT) AS leaf_budget,
  CAST(epochs AS BIGINT) + CASE WHEN remainder > 0 AND upto <= remainder THEN 1 ELSE 0 END AS copies FROM sums
"""

_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.k AS anchor, a.vec_id AS anchor_id, v.k, v.vec_id, v.label = a.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.k <> v.k),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(text: str) -> str:
    values = [f"CAST({f} AS VARCHAR)" for f in _FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


def _merkle(levels: int) -> str:
    """Trees of up to 8 ** levels leaves, and as many groups; a level is a pair of tables."""
    # The checksum byte by byte: a step xors a byte, eight shift.
    crc = (
        "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda r, x: CASE WHEN x >= 0 THEN xor(r, x)"
        " ELSE xor(r >> 1, (r & 1) * 3988292384) END), 4294967295::BIGINT)"
    )
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""d AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {_leaf(lowered)} END AS shown FROM documents),
w0 AS (
  SELECT row_number() OVER () AS k, doc_id, lang, leaf, coalesce(shown, leaf) AS folded, '' AS proof,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
n0 AS (SELECT lang, pos, n, leaf AS hash FROM w0)"""
    ]

    def climb(at: int, group: str) -> str:
        """Nodes and ways of the next level; ``group`` names the tree."""
        same = f"r.{group} IS NOT DISTINCT FROM w.{group}"
        return f"""
r{at} AS (SELECT {group}, pos // 8 AS up, max(n) AS n, array_agg(hash ORDER BY pos) AS hashes FROM n{at - 1} GROUP BY ALL),
n{at} AS (SELECT {group}, up AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hashes, '')) ELSE hashes[1] END AS hash FROM r{at}),
w{at} AS (
  SELECT w.* EXCLUDE (folded, proof, pos, n), w.pos // 8 AS pos, (w.n + 7) // 8 AS n,
    CASE WHEN w.n > 1 THEN sha256(array_to_string(hashes[:w.pos % 8], '') || folded || array_to_string(hashes[w.pos % 8 + 2:], '')) ELSE folded END AS folded,
    CASE WHEN w.n > 1 THEN proof || array_to_string(hashes[:w.pos % 8], '') || array_to_string(hashes[w.pos % 8 + 2:], '') ELSE proof END AS proof
  FROM w{at - 1} AS w JOIN r{at} AS r ON {same} AND r.up = w.pos // 8)"""

    parts += [climb(at, "lang") for at in range(1, levels + 1)]
    top = levels + 1
    parts.append(
        f"""
t AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM n{levels}),
n{top} AS (SELECT 0 AS tree, pos, n, hash FROM t),
w{top} AS (SELECT w.k, w.doc_id, w.leaf, t.hash AS subroot, 0 AS tree, w.folded, w.proof, t.pos, t.n FROM w{levels} AS w JOIN t ON w.lang IS NOT DISTINCT FROM t.lang)"""
    )
    parts += [climb(at, "tree") for at in range(top + 1, top + levels + 1)]
    last = top + levels
    return (
        "WITH "
        + ",".join(parts)
        + f"""
SELECT doc_id, leaf, subroot, hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = hash AS verified
FROM w{last} AS w JOIN n{last} AS n ON n.pos = w.pos
"""
    )


ORACLE = {
    "op3_chat_format": _CHAT,
    "op4_source_mixing": _MIXING,
    "op6_exact_dedup": _EXACT,
    "op7_license_scan": _LICENSES,
    "op8_quality_rules": _QUALITY,
    "op9_url_filter": _URLS,
    "op11_hard_negatives": _NEGATIVES,
    "op12_merkle_manifest": _merkle(7),
}
