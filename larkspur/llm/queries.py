"""One registered query per operator, over its whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, exact, jaccard, ledger, lines, prefixes, quotes, spans, spelling, suffixes, toxicity, urls, warc
from larkspur.session import shared_dir, tune

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def token_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of texts encoded and decoded again."""
    path = public_tokenizers.path(TOKENIZER)
    return bpe.round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out() -> Column:
    """The fifth of the ids that no label is learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def toxic_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """Scores by a model learnt by doc_id; rows are named by the column ``id``."""
    model = toxicity.train(docs, labels, where=~held_out())
    return toxicity.scores(docs, model, id=id)


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(_table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return spans.remove_repeats(_table(spark, folder, "documents"), long_words=spans.LONG_WORDS)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.drop("longest")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.deduplicate(_table(spark, folder, "documents"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(_table(spark, folder, "pages")).drop("path", "offset", "length")


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.without_repeats(_table(spark, folder, "documents"))


#: Rules of the url query: host, path, verdict.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op8_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS r(host, path, verdict)")
    return urls.verdicts(_table(spark, folder, "pages"), rules)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxic_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted", "spans")


def op10_quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.reply_ordered(_table(spark, folder, "conversations"))


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """All blobs are new to a ledger of its own."""
    found = ledger.scan(_table(spark, folder, "documents"), f"{shared_dir(spark)}/ledgers/{uuid.uuid4()}")
    return ledger.digests(found).withColumnRenamed("id", "doc_id")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_table(spark, folder, "documents"), slips=31))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(*prefixes.shared_heads(prefixes.numbered_turns(_table(spark, folder, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe, op2_substring_dedup, op3_decontamination, op4_exact_dedup, op5_warc, op6_ngram_jaccard, op7_line_dedup, op8_url_rules,
        op9_toxicity, op10_quotations, op11_secrets, op12_spelling, op13_prefix_trie,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Kind and pattern of the secrets; group 1 is what decides, with so many characters at least.
_SECRETS = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    ("access", "(AKIA[A-Z0-9]+)", 18), ("hex", "([0-9a-f]+)", 16),
    ("key", "(-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----)", 1), ("signed", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1),
)


def _secret_matches(rank: int, kind: str, pattern: str, least: int) -> str:
    """SQL of all matches of a kind: each with what stands between it and the one before, so that lengths add up to places."""
    quoted = pattern.replace("'", "''")
    parts = ", ".join(f"regexp_extract_all(x, '(?s)(.*?)({quoted})', {g}) AS {n}" for g, n in ((1, "gap"), (2, "hit"), (3, "told")))
    return f"""
        SELECT doc_id, {rank} AS rank, '{kind}' AS kind, upto - length(hit) AS first, upto AS last
        FROM (SELECT doc_id, hit, told, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS upto
              FROM (SELECT doc_id, unnest(gap) AS gap, unnest(hit) AS hit, unnest(told) AS told, unnest(range(len(hit))) AS i FROM (SELECT doc_id, {parts} FROM d)))
        WHERE length(told) >= {least}"""


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8, byte by byte and bit by bit."""
    digit = lambda at: f"instr('123456789ABCDEF', substr(hex(encode({text})), CAST({at} AS INTEGER), 1))"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST(16 * {digit('2 * i + 1')} + {digit('2 * i + 2')} AS BIGINT))"
    bits = "list_reduce([xor(c, o), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {octets}), lambda c, o: {bits}))"


SQL: dict[str, str] = {
    "op13_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id AS c, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM t)
        ), parts AS (
            SELECT convs.c, 0 AS part, k, said FROM convs JOIN t ON t.c = convs.c - convs.c % 100 AND k <= h
            UNION ALL SELECT convs.c, 1, k, said FROM convs JOIN t ON t.c = convs.c AND k > h
        ), seqs AS (
            SELECT convs.c, coalesce(s, []) AS s FROM convs LEFT JOIN (SELECT c, list(said ORDER BY part, k) AS s FROM parts GROUP BY c) USING (c)
        ), prefixes AS (
            SELECT c, len(s) AS total, d, list_slice(s, 1, d) AS p, length(s[d].text) AS size FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM seqs)
        ), members AS (
            SELECT c, d, total, size, min(c) OVER (PARTITION BY p) AS conv_id FROM prefixes
        ), nodes AS (
            SELECT conv_id, d, count(*) AS n_convs, coalesce(any_value(size), 0) AS size, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (total = d) AS ends FROM members GROUP BY conv_id, d
        ), linked AS (
            SELECT nodes.*, above.conv_id AS parent_conv_id FROM nodes LEFT JOIN members above ON above.c = nodes.conv_id AND above.d = nodes.d - 1
        ), children AS (
            SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL
        ), full_nodes AS (
            SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN children USING (conv_id, d)
        ), sums AS (
            SELECT up.conv_id, up.d, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens
            FROM full_nodes n JOIN members up ON up.c = n.conv_id AND up.d <= n.d GROUP BY ALL
        )
        SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256 FROM full_nodes JOIN sums USING (conv_id, d)
    """,
    "op12_spelling": f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL
        ), hashed AS (
            SELECT run, n, {_crc32("concat(doc_id, ':', run)")} AS h FROM runs
        ), slipped AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), cuts AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT cuts.word, words.word, words.n FROM cuts JOIN words ON words.word = cuts.rest
            UNION SELECT words.word, cuts.word, cuts.n FROM cuts JOIN words ON words.word = cuts.rest
        ), best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS form_n, arg_min(other, (-other_n, encode(other))) AS form FROM near GROUP BY word
        ), told AS (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * words.n THEN form END AS form, CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS root FROM told UNION ALL SELECT chain.word, told.form FROM chain JOIN told ON told.word = chain.root WHERE told.form IS NOT NULL
        )
        SELECT told.*, root FROM told JOIN (SELECT chain.word, chain.root FROM chain JOIN told ON told.word = chain.root WHERE told.form IS NULL) USING (word)
    """,
    "op11_secrets": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS x FROM documents
        ), found AS ({" UNION ALL ".join(_secret_matches(i, *s) for i, s in enumerate(_SECRETS))}
        ), told AS (
            SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank) AS spans
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN told USING (doc_id)
    """,
    "op3_decontamination": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), items AS (
            SELECT item_id, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos, w FROM b WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS x FROM items
        ), places AS (
            SELECT doc_id, s.size, unnest(range(1, len(w) - s.size + 2)) AS pos, w FROM d, (SELECT DISTINCT size FROM windows) s WHERE len(w) >= s.size
        ), hits AS (
            SELECT p.doc_id, p.pos, p.size, windows.item_id
            FROM (SELECT doc_id, size, pos, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS x FROM places) p JOIN windows ON p.size = windows.size AND p.x = windows.x
        ), words AS (
            SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS i FROM hits) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(x) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY x)
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages
        )
        SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN octet_length(body) >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN octet_length(body) >= 1000 AND last <> page_id THEN last END AS refers_to
        FROM p
    """,
    "op6_ngram_jaccard": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 4), ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM d WHERE len(w) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS pos FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.pos = links.a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least_at AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(pos) AS least_at FROM reach GROUP BY doc_id) USING (doc_id)
    """,
    "op8_url_rules": rf"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
        ), r(host, path, verdict) AS (
            VALUES {", ".join(map(str, URL_RULES))}
        ), fits AS (
            SELECT page_id, max_by(r.host || r.path, length(r.host) * 100 + length(r.path)) AS rule, max_by(r.verdict, length(r.host) * 100 + length(r.path)) AS verdict
            FROM p JOIN r ON ends_with('.' || p.host, '.' || r.host) AND starts_with(p.path, r.path) GROUP BY page_id
        )
        SELECT p.page_id, p.host, p.path, fits.rule, coalesce(fits.verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (page_id)
    """,
}
