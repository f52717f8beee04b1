"""The corpus queries: each operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import divergence, fingerprints, language, licenses, lines, mixing, packing, quality, sharding, simhash, tokens, warc, whitening
from assayer.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


# --- 1: sharding ---------------------------------------------------------------------------------


@query
def op1_hash_tree_shards(spark, sf_dir):
    return sharding.sharded(documents(spark, sf_dir), sharding.even_tree(8))


def _tree_sql(tree: sharding.Tree) -> str:
    """The descent as nested CASEs."""

    def draw(level, children):
        if len(children) == 1:
            return children[0][2]
        score = [
            f"-ln((CAST('0x' || substr(md5(k || '|{level}|{name}'), 1, 13) AS BIGINT)::DOUBLE + 0.5) / {1 << 52}.0) / {w}::DOUBLE"
            for name, w, _ in children
        ]
        whens = " ".join(f"WHEN {s} = least({', '.join(score)}) THEN {c[2]}" for s, c in zip(score, children, strict=True))
        return f"CASE {whens} END"

    regions = []
    for region, racks in tree.items():
        inner = []
        for rack, shards in racks.items():
            leaves = [(s, w, str(s)) for s, w in shards.items()]
            inner.append((rack, sum(w for _, w, _ in leaves), draw(f"{region}/{rack}", leaves)))
        regions.append((region, sum(w for _, w, _ in inner), draw(region, inner)))
    return draw("", regions)


def _crc_table() -> list[int]:
    """Checksum steps of the 256 bytes by the reversed polynomial."""
    table = []
    for crc in range(256):
        for _ in range(8):
            crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
        table.append(crc)
    return table


ORACLE["op1_hash_tree_shards"] = f"""
WITH d AS (
    SELECT doc_id, coalesce('k' || doc_id, 'null') AS k, hex(encode(coalesce(text, ''))) AS digits FROM documents),
b AS (
    SELECT *, list_transform(range(length(digits) // 2),
                             lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS UBIGINT)) AS bytes
    FROM d),
s AS (
    SELECT doc_id, len(bytes)::BIGINT + 1 AS size,
           xor(4294967295::UBIGINT, list_reduce(
               bytes, lambda crc, byte: xor(crc >> 8, list_extract({_crc_table()}::UBIGINT[], (xor(crc & 255, byte) + 1)::BIGINT)),
               4294967295::UBIGINT))::BIGINT AS text_crc32,
           'key' AS law,
           ({_tree_sql(sharding.even_tree(8))})::INTEGER AS shard,
           ({_tree_sql(sharding.grown(sharding.even_tree(8)))})::INTEGER AS grown_shard
    FROM b)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot FROM s"""

# --- 2: packing ----------------------------------------------------------------------------------


@query
def op2_packed_windows(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), with_ids=False)


# --- 3: quality rules ----------------------------------------------------------------------------


@query
def op3_adaptive_quality(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return quality.judged(docs, with_text=False).select("row.doc_id", *quality.STATS, "base_failed", "kept")


def _quality_sql() -> str:
    metrics = ", ".join(
        f"{{'metric': '{m}', 'x': {n} * {scale} // n_words, 'centred': {str(centred).lower()}}}"
        for m, (n, scale, centred) in quality.METRICS.items()
    )
    word = "[^\\x20\\x09-\\x0D]"
    levels = " UNION ALL ".join(
        f"SELECT {i} AS level, {lang} AS lang, {source} AS source, metric, bin, count(*) AS n FROM b GROUP BY ALL"
        for i, lang, source in ((2, "lang", "source"), (1, "lang", "NULL"), (0, "NULL", "NULL"))
    )
    same = "q.metric = m.metric AND q.level = {} AND q.total >= {}"
    return f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}+') AS ws
           FROM documents),
t AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS three
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT doc_id, i FROM t QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
c AS (SELECT doc_id, count(DISTINCT place)::BIGINT AS n
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, count(*)::BIGINT AS n
      FROM (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
            WHERE regexp_matches(line, '{word}')
            QUALIFY row_number() OVER (PARTITION BY doc_id, line) > 1) GROUP BY doc_id),
s AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id LEFT JOIN c ON w.doc_id = c.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
m AS (SELECT doc_id, lang, source, unnest([{metrics}], recursive := true) FROM f WHERE NOT base_failed),
b AS (SELECT lang, source, metric, shift * 32 + (x >> shift) AS bin
      FROM (SELECT *, greatest(length(bin(x)) - 5, 0) AS shift FROM m)),
v AS ({levels}),
u AS (SELECT *, (bin & 31) << (bin >> 5) AS low, (((bin & 31) + 1) << (bin >> 5)) - 1 AS high, sum(n) OVER g AS total,
             sum(n) OVER (g ORDER BY bin) AS upto, lead((bin & 31) << (bin >> 5)) OVER (g ORDER BY bin) AS up
      FROM v WINDOW g AS (PARTITION BY level, lang, source, metric)),
q AS (SELECT level, lang, source, metric, max(total) AS total,
             min(low) FILTER (WHERE upto * 4 >= total) AS q1,
             min(high) FILTER (WHERE upto * 4 >= total * 3) AS q3,
             coalesce(min(high) FILTER (WHERE upto * 2 >= total AND up + {quality.STEP} >= {quality.VALLEY} * (high + {quality.STEP})),
                      {quality.UNBOUNDED}) AS last
      FROM u GROUP BY level, lang, source, metric),
j AS (SELECT m.*, coalesce(o.q1, g.q1, e.q1) AS q1, coalesce(o.q3, g.q3, e.q3) AS q3,
             coalesce(o.last, g.last, e.last) AS last
      FROM m LEFT JOIN q o ON {same.format(2, quality.LEAST_ROWS).replace("q.", "o.")}
                          AND o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source
             LEFT JOIN q g ON {same.format(1, quality.LEAST_ROWS).replace("q.", "g.")} AND g.lang IS NOT DISTINCT FROM m.lang
             LEFT JOIN q e ON {same.format(0, 0).replace("q.", "e.")}),
k AS (SELECT doc_id, bool_and(CASE WHEN centred THEN x BETWEEN q1 - {quality.FENCE} * (q3 - q1) AND q3 + {quality.FENCE} * (q3 - q1)
                              ELSE x <= last END) AS fine
      FROM j GROUP BY doc_id)
SELECT f.doc_id, {", ".join(quality.STATS)}, base_failed, coalesce(fine, false) AS kept
FROM f LEFT JOIN k ON f.doc_id = k.doc_id"""


ORACLE["op3_adaptive_quality"] = _quality_sql()

# --- 6: near-duplicates --------------------------------------------------------------------------


@query
def op6_simhash_groups(spark, sf_dir):
    groups = simhash.grouped(documents(spark, sf_dir))
    return groups.withColumn("fingerprint", simhash.hex_fingerprint("fingerprint"))


# --- 10: line dedup ------------------------------------------------------------------------------


@query
def op10_line_dedup(spark, sf_dir):
    return lines.digest(lines.deduplicated(documents(spark, sf_dir).select("doc_id", "text")))


ORACLE["op10_line_dedup"] = """
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents),
k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
    SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key AND k.doc_id <> c.owner
GROUP BY doc_id"""

# --- 4: WARC -------------------------------------------------------------------------------------


@query
def op4_warc_round_trip(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.round_trip(pages, with_payload=False).drop("url")


ORACLE["op4_warc_round_trip"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > least THEN least END AS refers_to
FROM f"""

# --- 5: fingerprints -----------------------------------------------------------------------------


@query
def op5_bottom_k(spark, sf_dir):
    compared = fingerprints.compared_with_edited(documents(spark, sf_dir))
    return compared.withColumns(
        {
            "fingerprint": fingerprints.text_form(F.col("sketch")),
            "edited_fingerprint": fingerprints.text_form(F.col("edited_sketch")),
        }
    ).drop("sketch", "edited_sketch")


# --- 9: mixing -----------------------------------------------------------------------------------


@query
def op9_source_mix(spark, sf_dir):
    return mixing.mixed(documents(spark, sf_dir), mixing.DEFAULT, mixing.source_domain())


def _mix_sql(mix: mixing.Mix) -> str:
    def weight(level: int) -> str:
        name = " || '/' || ".join(f"coalesce({c}, '')" for c in mixing.LEVELS[: level + 1])
        own = {k: v for k, v in mix.weights.items() if k.count("/") == level}
        whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in own.items())
        return f"(CASE {name} {whens} ELSE 1 END)" if own else "1"

    def shared(level: int, nodes: str) -> str:
        parent = f"PARTITION BY {', '.join(mixing.LEVELS[:level])}" if level else ""
        order = f"{parent} ORDER BY capacity::DOUBLE / greatest(weight, 1), {mixing.LEVELS[level]}"
        before = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        upto = f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return f"""(
    SELECT *, CASE WHEN filled THEN capacity
                   ELSE part + (sum(CASE WHEN filled THEN 0 ELSE 1 END) OVER {upto}
                                <= lft - sum(part) OVER ({parent}))::INTEGER END::BIGINT AS budget
    FROM (
      SELECT *, CASE WHEN NOT filled THEN (lft * weight) // weights END AS part
      FROM (
        SELECT *, above - coalesce(sum(CASE WHEN filled THEN capacity END) OVER ({parent}), 0) AS lft,
               sum(CASE WHEN NOT filled THEN weight END) OVER ({parent}) AS weights
        FROM (
          SELECT *, min(fits) OVER {upto} AS filled
          FROM (
            SELECT *, capacity::HUGEINT * (sum(weight) OVER ({parent}) - coalesce(sum(weight) OVER {before}, 0))
                      <= (above - coalesce(sum(capacity) OVER {before}, 0)) * weight AS fits
            FROM ({nodes}))))))"""

    hash_ = f"md5('{mix.seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null'))"
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    domains = ", ".join(f"'{d}'" for d in mixing.DOMAINS)
    names = ", ".join(mixing.LEVELS)
    table = f"{_crc_table()}::UBIGINT[]"
    return f"""
WITH sources AS (
    SELECT source, list_extract([{domains}], (xor(4294967295::UBIGINT, list_reduce(
        list_transform(range(length(digits) // 2), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS UBIGINT)),
        lambda crc, byte: xor(crc >> 8, list_extract({table}, (xor(crc & 255, byte) + 1)::BIGINT)),
        4294967295::UBIGINT)) % {len(mixing.DOMAINS)} + 1)::BIGINT) AS domain
    FROM (SELECT DISTINCT source, hex(encode(coalesce(source, ''))) AS digits FROM documents)),
t AS (
    SELECT doc_id, domain, lang, d.source,
           CASE WHEN trim(coalesce(text, ''), {space}) = '' THEN 0
                ELSE len(regexp_split_to_array(trim(text, {space}), '[\\x20\\x09-\\x0D]+')) END::BIGINT AS tokens
    FROM documents d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
leaves AS (SELECT {names}, sum(tokens)::BIGINT AS tokens FROM t GROUP BY ALL),
n2 AS (SELECT *, {weight(2)} AS weight, CASE WHEN {weight(2)} > 0 THEN tokens * {mix.epochs} ELSE 0 END AS capacity FROM leaves),
n1 AS (SELECT domain, lang, {weight(1)} AS weight,
              CASE WHEN {weight(1)} > 0 THEN sum(capacity) ELSE 0 END::BIGINT AS capacity FROM n2 GROUP BY domain, lang),
n0 AS (SELECT domain, {weight(0)} AS weight,
              CASE WHEN {weight(0)} > 0 THEN sum(capacity) ELSE 0 END::BIGINT AS capacity FROM n1 GROUP BY domain),
root AS (SELECT least((SELECT sum(tokens) FROM t) * {mix.share[0]} // {mix.share[1]}, (SELECT sum(capacity) FROM n0))::BIGINT AS above),
b0 AS (SELECT domain, budget FROM {shared(0, "SELECT n0.*, above FROM n0, root")}),
b1 AS (SELECT domain, lang, budget
       FROM {shared(1, "SELECT n1.*, budget AS above FROM n1 JOIN b0 ON n1.domain IS NOT DISTINCT FROM b0.domain")}),
b2 AS (SELECT {names}, tokens AS of, budget
       FROM {shared(2, "SELECT n2.*, budget AS above FROM n2 JOIN b1 ON n2.domain IS NOT DISTINCT FROM b1.domain AND n2.lang IS NOT DISTINCT FROM b1.lang")}),
w AS (SELECT *, CASE WHEN of > 0 THEN budget // of ELSE 0 END AS whole, CASE WHEN of > 0 THEN budget % of ELSE 0 END AS rest FROM b2),
h AS (SELECT t.*, whole, rest, {hash_} AS draw
      FROM t JOIN w ON t.domain IS NOT DISTINCT FROM w.domain AND t.lang IS NOT DISTINCT FROM w.lang
                   AND t.source IS NOT DISTINCT FROM w.source),
u AS (SELECT *, sum(tokens) OVER (PARTITION BY {names} ORDER BY draw) AS upto FROM h),
k AS (SELECT *, min(CASE WHEN upto >= rest THEN draw END) OVER (PARTITION BY {names}) AS cut FROM u),
c AS (SELECT *, whole + CASE WHEN rest > 0 AND draw <= cut THEN 1 ELSE 0 END AS copies FROM k)
SELECT doc_id, {names}, tokens, unnest(range(copies))::INTEGER AS epoch FROM c WHERE copies > 0"""


ORACLE["op9_source_mix"] = _mix_sql(mixing.DEFAULT)

# --- 7: licences ---------------------------------------------------------------------------------


@query
def op7_license_scan(spark, sf_dir):
    return licenses.scanned(documents(spark, sf_dir))


# --- 8: language ---------------------------------------------------------------------------------


@query
def op8_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language.identified(docs, language.fitted(docs))

# --- 11: whitening -------------------------------------------------------------------------------


@query
def op11_embedding_whitening(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whitened(vectors, "vec_id", "embedding")
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


# --- 12: token counts ----------------------------------------------------------------------------


@query
def op12_token_counts(spark, sf_dir):
    return tokens.counted(documents(spark, sf_dir))

# --- 13: divergence of sources -------------------------------------------------------------------


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.audited(documents(spark, sf_dir))


ORACLE["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
o AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v::HUGEINT AS v
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT *, (1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v))::HUGEINT AS p FROM p),
l AS (SELECT lang, term, (1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v))::HUGEINT AS q
      FROM (SELECT lang, term, sum(n)::HUGEINT AS n, any_value(v) AS v FROM p GROUP BY lang, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN s x ON x.lang = a.lang AND x.source = a.source
               LEFT JOIN s y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
          GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
          FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10"""
