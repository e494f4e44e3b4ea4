"""Scalar functions: text, hashes, numbers, JSON, arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.functions import nested, numbers, text


def initcap_sql(expression: str) -> str:
    return f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split({expression}, ' ')], ' ')"


@query(f"""
SELECT c_custkey, upper(trim(c_mktsegment)) AS up, lower(trim(c_mktsegment)) AS low,
  {initcap_sql("trim(' ' || c_mktsegment || ' oF ' || c_name)")} AS title FROM customer
""")
def str_trim_case(t):
    padded = F.concat(F.lit(" "), "c_mktsegment", F.lit(" oF "), "c_name")
    return t.customer.select(
        "c_custkey", F.upper(F.trim("c_mktsegment")).alias("up"), text.lower_trim("c_mktsegment").alias("low"),
        text.title_trim(padded).alias("title"),
    )


@query("SELECT c_custkey, c_name || ' ' || nullif(c_mktsegment, 'MACHINERY') AS full_name FROM customer")
def str_concat(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return t.customer.select("c_custkey", F.concat("c_name", F.lit(" "), segment).alias("full_name"))


@query("SELECT page_id, substr(url, strpos(url, '?') + 1) AS tail FROM pages")
def str_after(t):
    return t.pages.select("page_id", text.after("url", "?").alias("tail"))


@query(f"SELECT p_partkey, {initcap_sql('''replace(trim(lower(p_type) || '_' || p_name), '_', ' ')''')} AS label FROM part")
def str_replace_display(t):
    code = F.concat(F.lower("p_type"), F.lit("_"), "p_name")
    return t.part.select("p_partkey", text.display_name(code).alias("label"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def str_length(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("SELECT p_partkey, p_name LIKE '%ring' AS is_ring, p_name NOT LIKE 'small%' AS not_small FROM part")
def str_like(t):
    name = F.col("p_name")
    return t.part.select("p_partkey", name.like("%ring").alias("is_ring"), (~name.like("small%")).alias("not_small"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]+') THEN CAST(strpos(text, regexp_extract(text, '[0-9]+')) AS INTEGER) ELSE 0 END AS first_number,
  CASE WHEN regexp_matches(text, '(?i)the') THEN CAST(strpos(lower(text), 'the') AS INTEGER) ELSE 0 END AS first_the FROM documents
""")
def str_regex_position(t):
    return t.documents.select(
        "doc_id", text.regex_position("text", "[0-9]+").alias("first_number"),
        text.regex_position("text", "the", flags="i").alias("first_the"),
    )


@query("""
SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host FROM pages
""")
def url_host(t):
    return t.pages.select("page_id", text.url_host("url").alias("host"))


@query("""
WITH s AS (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages)
SELECT page_id, split_part(right(u, CAST(length(u) - coalesce(nullif(strpos(u, '/'), 0), strpos(u, '?') - 1) AS BIGINT)), '?', 1) AS path FROM s
""")
def url_path(t):
    return t.pages.select("page_id", text.url_path("url").alias("path"))


@query("""
SELECT page_id, nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
  nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source FROM pages
""")
def url_parameter(t):
    return t.pages.select(
        "page_id", text.url_parameter("url", "ref").alias("ref"), text.url_parameter("url", "utm_source").alias("utm_source")
    )


@query(f"""
SELECT doc_id, md5(concat_ws('-', coalesce(CAST(doc_id AS VARCHAR), '{text.NULL_KEY_TEXT}'), coalesce(lang, '{text.NULL_KEY_TEXT}'),
  coalesce(CAST(quality AS VARCHAR), '{text.NULL_KEY_TEXT}'))) AS key FROM documents LEFT JOIN labels USING (doc_id)
""")
def hash_surrogate_key(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", text.surrogate_key("doc_id", "lang", "quality").alias("key"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def hash_md5(t):
    return t.documents.select("doc_id", F.md5("text").alias("digest"))


@query("SELECT c_custkey, upper(substr(sha256('pepper_' || CAST(c_custkey AS VARCHAR)), 1, 12)) AS masked FROM customer")
def hash_mask_pii(t):
    return t.customer.select("c_custkey", text.masked_id("c_custkey", "pepper_").alias("masked"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem")
def math_safe_divide(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.safe_divide("l_extendedprice", "l_discount").alias("ratio")
    )


@query("SELECT doc_id, coalesce(quality, 0) + coalesce(toxic, 0) + coalesce(n_chars, 0) AS total FROM documents LEFT JOIN labels USING (doc_id)")
def math_safe_add(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", numbers.safe_add("quality", "toxic", "n_chars").cast("long").alias("total"))


@query("SELECT doc_id, coalesce(n_chars, 0) - coalesce(quality, 0) - coalesce(toxic, 0) AS rest FROM documents LEFT JOIN labels USING (doc_id)")
def math_safe_subtract(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", numbers.safe_subtract("n_chars", "quality", "toxic").cast("long").alias("rest"))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 400000 THEN 8
  ELSE CAST(floor((o_totalprice - 50000) / (400000 - 50000) * 7) AS BIGINT) + 1 END AS bucket FROM orders
""")
def math_width_bucket(t):
    bucket = F.width_bucket("o_totalprice", F.lit(50000.0), F.lit(400000.0), F.lit(7))
    return t.orders.select("o_orderkey", bucket.alias("bucket"))


def haversine_sql(unit: str) -> str:
    lat1, lon1, lat2, lon2 = "c_acctbal / 150", "(c_nationkey * 7 - 80)", "(n_nationkey * 3 - 30)", "(n_regionkey * 30)"
    miles = (
        f"2 * 3961 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"
    )
    return rounded(miles if unit == "mi" else f"1.60934 * {miles}", 3)


@query(f"SELECT c_custkey, {haversine_sql('mi')} AS miles, {haversine_sql('km')} AS km FROM customer JOIN nation ON c_nationkey = n_nationkey")
def math_haversine(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", (F.col("c_acctbal") / 150).alias("lat1"), (F.col("c_nationkey") * 7 - 80).alias("lon1"),
        (F.col("n_nationkey") * 3 - 30).alias("lat2"), (F.col("n_regionkey") * 30).alias("lon2"),
    )
    place = ("lat1", "lon1", "lat2", "lon2")
    return rows.select(
        "c_custkey", F.round(numbers.haversine(*place), 3).alias("miles"),
        F.round(numbers.haversine(*place, unit="km"), 3).alias("km"),
    )


@query(f"SELECT o_orderkey, {rounded('ln(o_totalprice)', 8, 14)} AS log_price FROM orders")
def math_log_natural(t):
    return t.orders.select("o_orderkey", F.round(F.ln("o_totalprice"), 8).alias("log_price"))


@query("SELECT c_custkey, greatest(c_acctbal, 0) AS positive_balance, greatest(c_nationkey, 1) AS at_least_one FROM customer")
def math_greatest(t):
    return t.customer.select(
        "c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("positive_balance"),
        F.greatest("c_nationkey", F.lit(1)).alias("at_least_one"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS whole FROM events")
def json_scalar(t):
    return t.events.select(
        "event_id", nested.json_scalar("props", "$.k").cast("long").alias("k"), nested.json_scalar("props", "$").alias("whole")
    )


def order_payloads(t):
    """One JSON text per part, with its name words as an array."""
    items = F.concat(F.lit('{"items":["'), F.replace("p_name", F.lit(" "), F.lit('","')), F.lit('"]}'))
    return t.part.select("p_partkey", items.alias("payload"))


@query("SELECT p_partkey, replace(p_name, ' ', '|') AS words, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n FROM part")
def json_array(t):
    found = order_payloads(t).select("p_partkey", nested.json_array("payload", "$.items").alias("items"))
    return found.select("p_partkey", F.array_join("items", "|").alias("words"), F.size("items").alias("n"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item FROM part")
def array_explode(t):
    return order_payloads(t).select("p_partkey", F.explode(nested.json_array("payload", "$.items")).alias("item"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[3] AS third_word FROM part")
def array_element(t):
    words = F.split("p_name", " ")
    return t.part.select("p_partkey", F.get(words, 0).alias("first_word"), F.get(words, 2).alias("third_word"))


@query("SELECT user_id, max(value) AS best_value FROM events GROUP BY 1")
def struct_field(t):
    best = t.events.groupBy("user_id").agg(F.max(F.struct("value", "event_id")).alias("best"))
    return best.select("user_id", F.col("best.value").alias("best_value"))
