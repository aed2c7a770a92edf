"""The operators of this package as queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.archive import REVISIT_PROFILE, read_archive, write_archive
from shelfcast.llm.fingerprints import fingerprints
from shelfcast.llm.mixing import mix
from shelfcast.llm.near_texts import near_classes
from shelfcast.llm.near_vectors import near_links
from shelfcast.llm.packing import pack, with_checksum
from shelfcast.llm.perspectives import mask_text, rotate
from shelfcast.llm.prefix_trie import family_trie
from shelfcast.llm.quality_model import held_out, score, train
from shelfcast.llm.quality_rules import RepetitionRules, repetition
from shelfcast.llm.sharding import shard_documents
from shelfcast.llm.url_filter import judge_urls, parse_rules
from shelfcast.llm.whitening import whiten
from shelfcast.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition(docs).drop("text")


def _gram_sql(n: int, name: str, first_too: bool) -> str:
    """Words of each text inside n-word windows that repeat (an earlier one, or any other)."""
    parts = " || ' ' || ".join(["w", *(f"lead(w, {k}) OVER o" for k in range(1, n))])
    which = "count(*) OVER (PARTITION BY doc_id, g) > 1" if first_too else "row_number() OVER (PARTITION BY doc_id, g ORDER BY i) > 1"
    what = "count(*)" if first_too else "sum(c)"
    return f"""g{n} AS (SELECT doc_id, i, {parts} AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m{n} AS (SELECT doc_id, i, {which} AS hit FROM g{n} WHERE g IS NOT NULL),
v{n} AS (SELECT doc_id, w, length(w) AS c, max(CASE WHEN hit THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS inside
  FROM words LEFT JOIN m{n} USING (doc_id, i)),
r{n} AS (SELECT doc_id, CAST({what} AS bigint) AS {name} FROM v{n} WHERE inside = 1 GROUP BY doc_id)"""


def _repetition_sql(rules: RepetitionRules) -> str:
    names = [f"dup_{n}gram_chars" for n, _ in rules.gram_limits]
    grams = [_gram_sql(rules.base_gram, "n_repeat_words", True)]
    grams += [_gram_sql(n, name, False) for (n, _), name in zip(rules.gram_limits, names, strict=True)]
    joins = " ".join(f"LEFT JOIN r{n} USING (doc_id)" for n in (rules.base_gram, *(n for n, _ in rules.gram_limits)))
    size = "CAST(greatest(word_chars, 1) AS double)"
    over = " OR ".join(f"{name} / {size} > {limit}" for name, (_, limit) in zip(names, rules.gram_limits, strict=True))
    return rf"""WITH words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents)),
lines AS (SELECT doc_id, l, i, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) > 1 AS again
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) AS n_dup_lines,
    CAST(sum(length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))) AS bigint) AS dup_line_chars
  FROM lines WHERE again GROUP BY doc_id),
base AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS bigint) AS word_chars FROM words GROUP BY doc_id),
{", ".join(grams)},
measured AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(dup_line_chars, 0) AS dup_line_chars, {", ".join(f"coalesce({n}, 0) AS {n}" for n in names)}
  FROM documents d LEFT JOIN base USING (doc_id) LEFT JOIN dl USING (doc_id) {joins}),
judged AS (SELECT *, n_words < {rules.min_words}
    OR 100 * n_repeat_words > {rules.max_repeat_words_pct} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND NOT (dup_line_chars / {size} > {rules.line_limit} OR {over}) AS kept FROM judged"""


ORACLES["op1_repetition"] = _repetition_sql(RepetitionRules())


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksum(pack(_table(spark, sf_dir, "documents")))


#: Large sources are held back in the mixture: weights are rows to this power.
TEMPERATURE = 0.5


@_query
def op3_lattice_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_links(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


@_query
def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), temperature=TEMPERATURE)
    return mixed


@_query
def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and size and SHA-256 of every record as it is rebuilt from headers and payload."""
    folder = write_archive(_table(spark, sf_dir, "pages"))
    records = read_archive(spark, folder)
    return records.select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"),
    )


def _one_line_sql(text: str) -> str:
    codes = (*range(1, 33), 127)
    clean = reduce(lambda done, code: f"replace({done}, chr({code}), '%{code:02X}')", codes, text)
    return f"CASE WHEN regexp_matches({text}, '[\x01-\x20\x7F]') THEN {clean} ELSE {text} END"


def _record_sql() -> str:
    """A whole record, line by line."""
    revisit = "record_type = 'revisit'"
    lines = [
        "'WARC/1.1'",
        "'WARC-Type: ' || record_type",
        "'WARC-Record-ID: <urn:page:' || page_id || '>'",
        "'WARC-Date: 2024-01-01T00:00:00Z'",
        "'WARC-Target-URI: ' || target",
        "'WARC-Payload-Digest: sha1:' || payload_digest",
        f"CASE WHEN {revisit} THEN 'WARC-Profile: {REVISIT_PROFILE}' || nl || 'WARC-Refers-To: <urn:page:' || refers_to || '>' || nl ELSE '' END "
        "|| 'Content-Type: application/http; msgtype=response'",
        f"'Content-Length: ' || (strlen(http) + CASE WHEN {revisit} THEN 0 ELSE payload_bytes END)",
    ]
    return " || nl || ".join(lines) + f" || nl || nl || http || CASE WHEN {revisit} THEN '' ELSE body END || nl || nl"


ORACLES["op5_warc_archive"] = f"""WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS bigint) AS payload_bytes, chr(13) || chr(10) AS nl FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY sha256(body)) AS owner, {_one_line_sql("url")} AS target,
    'HTTP/1.1 200 OK' || nl || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || payload_bytes || nl || nl AS http FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to FROM q),
w AS (SELECT *, {_record_sql()} AS record FROM r)
SELECT page_id, payload_bytes, payload_digest, record_type, refers_to, CAST(strlen(record) AS bigint) AS record_bytes, sha256(record) AS record_sha256 FROM w"""


@_query
def op6_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


BLOCK_RULES = ("net/", "example.com/de/")
ALLOW_RULES = ("example.net/en/", "org/fr/")
#: Hosts that are blocked, with their subdomains, where no rule decides.
BLOCKED_HOSTS = tuple(
    f"{name}.example.{end}"
    for name in ("casino-win", "free-bets", "cheap-pills", "ads-track", "spam-farm", "adult-x")
    for end in ("com", "net", "org")
)


@_query
def op7_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, parse_rules(BLOCK_RULES, ALLOW_RULES), BLOCKED_HOSTS).drop("url")


def _url_sql() -> str:
    rules = parse_rules(BLOCK_RULES, ALLOW_RULES)
    values = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    hosts = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
    return f"""WITH rules(rh, rp, rv) AS (VALUES {values}), listed(lh) AS (VALUES {hosts}),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
hits AS (SELECT page_id, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS n
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
known AS (SELECT DISTINCT page_id FROM parts JOIN listed ON host = lh OR ends_with(host, '.' || lh))
SELECT p.page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN rv WHEN k.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM parts p LEFT JOIN (SELECT * FROM hits WHERE n = 1) h USING (page_id) LEFT JOIN known k ON p.page_id = k.page_id"""


ORACLES["op7_filter_cascade"] = _url_sql()


@_query
def op8_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = train(docs, _table(spark, sf_dir, "labels"))
    return score(docs, machine).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@_query
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@_query
def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(_table(spark, sf_dir, "conversations")).withColumn("mask", mask_text())


ORACLES["op10_perspectives"] = """WITH t AS (SELECT DISTINCT conv_id, turn, role, replace(text, '<|', '<\\|') AS said FROM conversations),
people AS (SELECT DISTINCT conv_id, role AS assistant FROM t WHERE role <> 'system'),
pieces AS (SELECT conv_id, assistant, turn, role = assistant AS own, said || '<|end|>' || chr(10) AS body,
    CASE WHEN role = assistant THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
      ELSE '<|user name=' || role || '|>' END || chr(10) AS head FROM t JOIN people USING (conv_id)),
placed AS (SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, assistant ORDER BY turn) AS bigint) AS stop FROM pieces)
SELECT conv_id, CAST(0 AS bigint) AS segment, CAST(0 AS bigint) AS sub_segment, assistant, count(*) AS n_turns,
  count(*) FILTER (WHERE own) AS n_masked, string_agg(head || body, '' ORDER BY turn) AS text,
  coalesce(string_agg(CASE WHEN own THEN (stop - length(body)) || '-' || stop END, ',' ORDER BY turn), '') AS mask
FROM placed GROUP BY conv_id, assistant"""


@_query
def op11_order_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family_trie(_table(spark, sf_dir, "conversations"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the ASCII characters of a SQL text, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [CAST(ord(ch) AS bigint), 0, 0, 0, 0, 0, 0, 0]))"
    step = "(xor(acc, x) >> 1)"
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS bigint), {steps}),
    lambda acc, x: xor({step}, (xor(acc, x) & 1) * 3988292384)), 4294967295)"""


ORACLES["op13_prefix_trie"] = rf"""WITH t AS (SELECT conv_id AS c, dense_rank() OVER (ORDER BY r, x) AS code,
    len(regexp_extract_all(x, '[^ 	-
]+')) AS w,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) - 1 AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
words AS (SELECT code, max(w) AS w FROM t GROUP BY code),
convs AS (SELECT c, c - c % 20 AS b, {_crc32_sql("CAST(c AS varchar)")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (SELECT convs.c, 0 AS own, p, code FROM convs JOIN t ON t.c = b WHERE p < h
  UNION ALL SELECT convs.c, 1, p, code FROM convs JOIN t ON t.c = convs.c WHERE p >= h),
seqs AS (SELECT convs.c, coalesce(codes, []) AS codes
  FROM convs LEFT JOIN (SELECT c, list(code ORDER BY own, p) AS codes FROM rebuilt GROUP BY c) s USING (c)),
members AS (SELECT c, codes, unnest(range(0, len(codes) + 1)) AS d FROM seqs),
nodes AS (SELECT codes[1:d] AS path, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(codes) = d THEN CAST(c AS varchar) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM members GROUP BY ALL),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children, coalesce((n_convs - 1) * w, 0) AS saved
  FROM nodes n LEFT JOIN kids USING (path) LEFT JOIN words ON code = path[depth]),
steps AS (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS k FROM full_nodes),
sums AS (SELECT path[1:k] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS bigint) AS saved_tokens
  FROM steps GROUP BY ALL)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (path) LEFT JOIN nodes u ON f.depth > 0 AND u.path = f.path[1:f.depth - 1]"""
