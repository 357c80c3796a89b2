"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, divergence, embeddings, langid, license_texts, licenses, mixing, neardup, quality, repair, repeats, sharding, urls
from .common import table

#: Rules of the URL query (host, path, verdict): fixed values.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: A conversation that the chat query adds: its id and what both sides say.
EXTRA_CONVERSATION, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.collect_samples(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(EXTRA_CONVERSATION, 0, "user", EXTRA_TEXT), (EXTRA_CONVERSATION, 1, "assistant", EXTRA_TEXT)], "conv_id long, turn long, role string, text string")
    log = chat.events_of(rows.unionByName(extra))
    return chat.digests(chat.format_conversations(log, F.floor(F.col("seq.turn") / chat.PIECE)))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    slim = docs.select("doc_id", size.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), sharding.text_key(F.col("text")).alias("key"))
    slim = sharding.materialize(slim, "slim")
    out = sharding.shard_documents(slim, size=F.col("size"), key=F.col("key"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find_repeats(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = licenses.known_digests(spark, license_texts.LICENSES, license_texts.DIGESTS)
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), known)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.with_all(repair.repair(repair.damage(rows)), rows)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    found = [op1_language_id, op2_decontamination, op3_chat_formatting, op4_sharding, op5_mixing, op6_url_filters, op7_suffix_array_dedup, op8_minhash_near_dedup, op9_license_scan, op10_quality_rules]
    found += [op11_source_divergence, op12_conversation_repair, op13_embedding_near_dedup]
    return {f.__name__: f for f in found}


_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
p AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, lengths WHERE len(w) >= n)),
h AS (SELECT g.doc_id, g.s, g.n, p.item_id FROM g JOIN p ON g.g = p.g AND g.n = p.n),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS x FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP3 = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({EXTRA_CONVERSATION}, 0, 'user', '{EXTRA_TEXT}'), ({EXTRA_CONVERSATION}, 1, 'assistant', '{EXTRA_TEXT}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('{chat.OPEN}') + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&nl;')) + 1 + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

_OP6_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_OP6 = rf"""
WITH u AS (SELECT page_id, row_number() OVER () AS k,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES {_OP6_RULES}),
m AS (SELECT k, h || p AS rule, v, row_number() OVER (PARTITION BY k ORDER BY length(h) + length(p) DESC, length(h) DESC, h DESC, p DESC) AS n
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, '{urls.DEFAULT}') AS verdict FROM u LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (k)
"""

_OP8 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, g, count(*) AS c FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)) GROUP BY ALL),
n AS MATERIALIZED (SELECT doc_id, sum(c) AS n FROM s GROUP BY 1),
o AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE o >= {neardup.SIMILARITY} * (x.n + y.n - o)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id FROM documents LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON a = doc_id
"""


def _canonical_sql(text: str) -> str:
    """The canonical form of a licence in DuckDB's SQL, by its own statement of the rules."""
    gap, year = r"[\t\n\x0B\f\r #*/;:-]{1,20}", r"[\[<{(]?((19|20)[0-9y][0-9y]|yyyy|year)"
    blank = "chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8239) || chr(8287) || chr(12288) || chr(2) || chr(5) || chr(6)"
    dash = "chr(8208) || chr(8209) || chr(8210) || chr(8211) || chr(8212) || chr(8213) || chr(8722) || chr(65112) || chr(65123) || chr(65293)"
    bullet = "chr(183) || chr(8226) || chr(8227) || chr(8259) || chr(9642) || chr(9679) || chr(9702) || chr(61623)"
    line = "chr(133) || chr(8232) || chr(8233)"
    gone = "chr(173) || chr(8203) || chr(8204) || chr(8205) || chr(8206) || chr(8207) || chr(8288) || chr(65279)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    out = f"translate({text}, '{upper}' || {blank} || {dash} || {bullet} || {line} || {gone}, '{lower}' || repeat(' ', 19) || repeat('-', 10) || repeat('*', 8) || repeat(chr(10), 3))"
    out = f"chr(10) || replace({out}, chr(169), '(c)')"
    opening = """permission is hereby granted;permission is granted;permission to use;redistribution and use;this software is provided;this is free and unencumbered software;
        this program is free software;this library is free software;this program comes with;gnomovision comes with;everyone is permitted;licensed under;released under;this work is licensed;
        boost software license;mit license;mit licence;the mit license;the mit licence;mit no attribution;isc license;isc licence;bsd zero clause;bsd 2-clause;bsd 3-clause;zlib license;zlib licence"""
    opening = "|".join(" ".join(x.split()).replace("-", " ").replace(" ", gap) for x in opening.split(";"))
    mark = rf"copyright({gap})?(\(c\)|{year})|\(c\)({gap})?(copyright({gap})?)?{year}"
    for pattern, by in (
        (rf"([^a-z0-9])all{gap}rights{gap}reserved", r"'\1' || chr(6)"),
        (rf"([^a-z0-9])({mark})", r"'\1' || chr(6) || chr(2) || '\2'"),
        (rf"([^a-z0-9])({opening})", r"'\1' || chr(6) || '\2'"),
        (r"\n[ \t\r#*/;-]*\n", "chr(10) || chr(5) || chr(10)"),
        (r"\x02[^\x02\x05\x06]{0,160}?(\n?)[\x05\t\n\x0B\f\r #*/;-]{0,40}\x06", r"' \1'"),
        (r"\n[ \t#*/;-]{0,40}\x06?\x02[^\n\x02\x05\x06]{0,160}(\n|\z)", "chr(10)"),
        (
            r"[\x00-\x2F\x3A-\x60\x7B-\xA9\xAB-\xB1\xB4\xB6-\xB8\xBB\xBF\xD7\xF7\x{1680}\x{180E}\x{2000}-\x{206F}\x{20A0}-\x{20CF}\x{2117}\x{2120}\x{2122}\x{2190}-\x{245F}\x{2500}-\x{2BFF}\x{2E00}-\x{2E7F}"
            r"\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{30FB}\x{F000}-\x{F0FF}\x{FE10}-\x{FE1F}\x{FE30}-\x{FE6B}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}\x{FFFD}]+",
            "'  '",
        ),
    ):
        out = f"regexp_replace({out}, '{pattern}', {by}, 'g')"
    out = f"' ' || trim({out}) || ' '"
    for pattern, by in (
        ("(re|sub|un|)licenc(e|es|ed|ing|ee|ees|or|ors)", r"\1licens\2"),
        ("sub  licens(e|es|ed|ing|able)", r"sublicens\1"),
        ("(abridgement|acknowledgement|judgement)(s|)", r"\1#\2"),
        ("(analog|catalog)ue(s|)", r"\1\2"),
        ("(author|custom|emphas|initial|maxim|minim|organ|real|recogn|special|util)is(e|es|ed|er|ers|ing|ation|ations)", r"\1iz\2"),
        ("analys(e|es|ed|ing)", r"analyz\1"),
        ("artefact(s|)", r"artifact\1"),
        ("(calib|cent)re(s|)", r"\1er\2"),
        ("(cancel|label)l(ed|ing)", r"\1\2"),
        ("copyright  holder(s|)", r"copyright  owner\1"),
        ("(behavi|endeav|fav|hon)our(s|ed|ing|able|ably|)", r"\1or\2"),
        ("fulfil(s|ment|)", r"fulfill\1"),
        ("merchantib(le|ility)", r"merchantab\1"),
        ("non  commercial(ly|)", r"noncommercial\1"),
        ("percent", "per  cent"),
        ("practis(e|es|ed|ing)", r"practic\1"),
        ("programme(s|)", r"program\1"),
        ("whilst", "while"),
        ("wilful(ly|)", r"willful\1"),
        ("https", "http"),
    ):
        out = f"regexp_replace({out}, ' {pattern} ', ' {by} ', 'g')"
    return f"trim(replace(replace({out}, 'ement#', 'ment'), '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_OP9 = f"""
WITH k AS (SELECT digest, min(license_id) AS license_id FROM (
    SELECT license_id, sha256({_canonical_sql("text")}) AS digest FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in license_texts.LICENSES)}) AS t(license_id, text)
    UNION ALL VALUES {", ".join(f"('{a}', '{b}')" for a, b in license_texts.DIGESTS)}) GROUP BY 1)
SELECT doc_id, text_digest, license_id FROM (SELECT doc_id, sha256({_canonical_sql("text")}) AS text_digest FROM documents) LEFT JOIN k ON digest = text_digest
"""


_OP11 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS MATERIALIZED (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT k) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
ln AS (SELECT lang, sum(n) AS n FROM n GROUP BY 1),
p AS MATERIALIZED (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + {divergence.ONE}::HUGEINT * (coalesce(c.n, 0) + {divergence.EXTRA}) // (n.n + {divergence.EXTRA} * v.v) AS p
    FROM g JOIN kept USING (lang) JOIN v USING (lang) JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS MATERIALIZED (SELECT p.lang, p.term, 1 + {divergence.ONE}::HUGEINT * (sum(p.n) + {divergence.EXTRA}) // (any_value(ln.n) + {divergence.EXTRA} * any_value(v.v)) AS q FROM p JOIN ln USING (lang) JOIN v USING (lang) GROUP BY 1, 2),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, (a.p - b.p) * (a.p - b.p) // (a.p + b.p) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(sum(f), 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN pair ON pair.lang = g.lang AND pair.source = g.source AND pair.item = h.source GROUP BY 1, 2, 4),
terms AS (SELECT p.lang, p.source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""

#: CRC-32 in SQL: its table by eight halvings of each byte, then a fold over the bytes of an ASCII string.
_CRC = "SELECT list(c ORDER BY b) AS crc FROM (SELECT b, {} AS c FROM (SELECT unnest(generate_series(0, 255)) AS b))"
_HALF = "b::BIGINT"
for _ in range(8):
    _HALF = f"(SELECT CASE x & 1 WHEN 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM (SELECT {_HALF} AS x))"
_CRC = _CRC.format(_HALF)

_OP12 = rf"""
WITH RECURSIVE t AS MATERIALIZED ({_CRC}),
r AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: xor(a >> 8, crc[(xor(a, c) & 255) + 1]))) % {repair.FATES} AS fate FROM conversations, t),
m AS MATERIALIZED (SELECT conv_id, turn, CASE fate WHEN {repair.TO_USER} THEN 'user' ELSE role END AS role,
    CASE fate WHEN {repair.EMPTY} THEN '' WHEN {repair.UNSTOP} THEN regexp_replace(text, '[{repair.STOPS}]', '', 'g') ELSE text END AS text
  FROM r, generate_series(1, 2) AS x(copy) WHERE fate <> {repair.DROP} AND (copy = 1 OR fate = {repair.TWICE})),
s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM m),
k AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS c, CASE WHEN NOT regexp_matches(text, '{repair.INK}') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN NOT regexp_matches(text, '[{repair.STOPS}][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault FROM s),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, max(i) AS n FROM k GROUP BY 1),
bad AS (SELECT conv_id, count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, c, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM k) GROUP BY 1),
-- what stands so far ends in: '' nothing, s, u or a; up to two turns may be inserted before a row or the end
ins(a, b, w, lines) AS (SELECT * FROM (VALUES ('', '', '', []::VARCHAR[]), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []), ('', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']),
    ('a', 'u', 'I', ['user:']), ('', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:']), ('u', 'u', 'II', ['assistant:', 'user:']), ('a', 'a', 'II', ['user:', 'assistant:'])) AS z(a, b, w, l)),
dp(conv_id, i, q, cost, audit, lines) AS (
  SELECT conv_id, 0::BIGINT, '', 0::BIGINT, '', []::VARCHAR[] FROM stats
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT dp.conv_id, k.i, CASE e WHEN 'D' THEN ins.b WHEN 'R' THEN CASE ins.b WHEN 'u' THEN 'a' ELSE 'u' END ELSE k.c END AS q,
      dp.cost + {repair.INSERT} * length(ins.w) + CASE e WHEN 'D' THEN {repair.DELETE} WHEN 'R' THEN {repair.RETITLE} ELSE 0 END + CASE WHEN e <> 'D' AND fault = 't' THEN {repair.TRUNCATED} ELSE 0 END AS cost,
      dp.audit || ins.w || e AS audit,
      dp.lines || ins.lines || CASE e WHEN 'D' THEN []::VARCHAR[] WHEN 'R' THEN [CASE ins.b WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || text] ELSE [role || ':' || text] END AS lines,
    FROM dp JOIN k ON k.conv_id IS NOT DISTINCT FROM dp.conv_id AND k.i = dp.i + 1 JOIN ins ON ins.a = dp.q, (VALUES ('D'), ('R'), ('K')) AS edits(e)
    WHERE e = 'D' OR fault NOT IN ('b', 'd') AND (e = 'R' OR (ins.b = '' AND k.c = 's') OR ins.b || '-' || k.c IN ('-u', 's-u', 'u-a', 'a-u'))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, q ORDER BY cost, audit) = 1),
best AS (SELECT dp.conv_id, cost + {repair.INSERT} * length(ins.w) AS cost, audit || ins.w AS audit, dp.lines || ins.lines AS lines
  FROM dp JOIN stats ON stats.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n JOIN ins ON ins.a = dp.q WHERE ins.b = 'a' OR ins.b = ''
  QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost + {repair.INSERT} * length(ins.w), audit || ins.w) = 1)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN bad ON bad.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""

_OP13 = f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.k AS a, b.k AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.k <> b.k WHERE list_cosine_similarity(a.e, b.e) >= {embeddings.SIMILARITY}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
n AS (SELECT a AS k, count(*) AS n_links FROM link GROUP BY 1),
c AS (SELECT a AS k, min(vec_id) AS least FROM reach JOIN v ON v.k = b GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, CASE WHEN c.k IS NULL THEN vec_id ELSE least END AS component_id, CASE WHEN c.k IS NULL THEN vec_id ELSE least END IS NOT DISTINCT FROM vec_id AS kept
FROM v LEFT JOIN n USING (k) LEFT JOIN c USING (k)
"""


def oracle_sql() -> dict[str, str]:
    """Queries that learn, draw lots or search for a capacity have none: tests hold them against brute force."""
    return {"op2_decontamination": _OP2, "op3_chat_formatting": _OP3, "op6_url_filters": _OP6, "op8_minhash_near_dedup": _OP8, "op9_license_scan": _OP9, "op11_source_divergence": _OP11, "op12_conversation_repair": _OP12, "op13_embedding_near_dedup": _OP13}
