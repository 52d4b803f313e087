"""Registered queries of the subpackage and their DuckDB statements.

Every query reads whole tables. ``ORACLE`` holds the statements SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.bpe import codec, decode_ids, encode_texts, tokenizer_path
from firmlens.llm.collocations import mine_collocations
from firmlens.llm.common import read
from firmlens.llm.decontaminate import mark_contamination
from firmlens.llm.language_id import held_out, identify, learn_profiles
from firmlens.llm.lexical_search import rank_documents
from firmlens.llm.license_scan import scan_licenses
from firmlens.llm.line_chunks import remove_repeated_chunks
from firmlens.llm.near_dup import near_duplicates
from firmlens.llm.pii import personal_data
from firmlens.llm.secret_ledger import RULES, scan_versions
from firmlens.llm.topk_search import top_k_search
from firmlens.llm.training_order import cut_sequences, write_training_order
from firmlens.llm.url_rules import judge_urls
from firmlens.session import run_dir


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ranked = learn_profiles(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    found = identify(docs.select("doc_id", "text"), ranked)
    return found.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), min_support=0.01, min_confidence=0.9)
    return judged.select("doc.page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH listed(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), parts AS (
  SELECT row_number() OVER () AS n, page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), judged AS MATERIALIZED (
  SELECT n, any_value(page_id) AS page_id, any_value(url) AS url, any_value(host) AS host, any_value(path) AS path,
    arg_max(l.h || l.p, length(l.h || l.p)) AS rule, arg_max(l.verdict, length(l.h || l.p)) AS label
  FROM parts LEFT JOIN listed l ON (host = l.h OR ends_with(host, '.' || l.h)) AND starts_with(path, l.p) GROUP BY n
), words AS (
  SELECT DISTINCT n, label, t FROM (
    SELECT n, label, 'h:' || unnest(string_split(host, '.')) AS t FROM judged WHERE url IS NOT NULL
    UNION ALL SELECT n, label, 'p:' || unnest(string_split(path, '/')) FROM judged WHERE url IS NOT NULL
    UNION ALL SELECT n, label, 'q:' || string_split(unnest(string_split(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '&')), '=')[1]
      FROM judged WHERE url IS NOT NULL) WHERE length(t) > 2
), least_count AS (SELECT ceil(0.01 * count(*)) AS c, count(*) AS pages FROM judged WHERE label IS NOT NULL),
frequent AS (SELECT t FROM words WHERE label IS NOT NULL GROUP BY t HAVING count(*) >= (SELECT c FROM least_count)),
lists AS (SELECT n, list(t ORDER BY t) AS ts FROM words JOIN frequent USING (t) GROUP BY n),
subsets AS MATERIALIZED (
  SELECT n, list_filter(ts, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS needs FROM (SELECT n, ts, unnest(range(1, 1 << len(ts))) AS mask FROM lists)
), counted AS (
  SELECT needs, count(*) AS a, count(*) FILTER (label = 'allow') AS allow, count(*) FILTER (label = 'block') AS block
  FROM subsets JOIN judged USING (n) WHERE label IS NOT NULL GROUP BY needs
), rules AS (
  SELECT needs, verdict, k / a AS confidence, k / (SELECT pages FROM least_count) AS support
  FROM (SELECT needs, a, 'allow' AS verdict, allow AS k FROM counted UNION ALL SELECT needs, a, 'block', block FROM counted)
  WHERE k >= (SELECT c FROM least_count) AND k / a >= 0.9
), mined AS (
  SELECT n, arg_max(verdict, (confidence, support, len(needs), verdict)) AS mined FROM subsets JOIN rules USING (needs) GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(label, mined, 'allow') AS verdict FROM judged LEFT JOIN mined USING (n)
"""


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k_search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


OP3_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_contamination(docs, read(spark, sf_dir, "benchmark"), window=10)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.select(
        "doc.doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.size("hit_items") > 0).alias("contaminated"),
    )


OP4_SQL = """
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), items AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS m FROM (SELECT item_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL
), windows AS MATERIALIZED (
  SELECT DISTINCT item, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS g
  FROM items
), grams AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2),
    lambda i: array_to_string(w[i : i + m - 1], ' '))) AS g
  FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
), hits AS MATERIALIZED (SELECT doc_id, i, m, item FROM grams JOIN windows USING (m, g)),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_items, sha256(coalesce(k.ids, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN places p ON p.doc_id = d.doc_id LEFT JOIN named k ON k.doc_id = d.doc_id
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_chunks(read(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.transform("removed", lambda r: F.concat_ws(":", r["start"].cast("string"), r["size"].cast("string")))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["size"])
    return found.select(
        "doc.doc_id", "n_lines", n_removed.alias("n_removed"), F.array_join(spans, ",").alias("removed"),
        F.sha2("clean", 256).alias("text_sha256"),
    )


OP5_SQL = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS l FROM split),
hashed AS (SELECT *, CAST('0x' || substr(md5(l), 1, 8) AS BIGINT) AS h FROM lines),
rolled AS (SELECT *, (coalesce(lag(h) OVER w * 1000003, 0) + h) % 4294967296 AS r FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ends AS (SELECT *, coalesce(r < lag(r) OVER w AND r < lead(r) OVER w AND lead(r, 2) OVER w IS NOT NULL, false) AS cut FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(CAST(cut AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ends),
chunks AS MATERIALIZED (SELECT doc_id, k, min(i) AS start, count(*) AS size, string_agg(l, chr(10) ORDER BY i) AS chunk FROM numbered GROUP BY doc_id, k),
removed AS (SELECT doc_id, k, start, size FROM (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, start) AS n
  FROM chunks WHERE size > 1 AND regexp_matches(chunk, '[^ \t\r\n\f\x0B]')) WHERE n > 1)
SELECT d.doc_id, coalesce(max(n.n_lines), 0) AS n_lines, CAST(coalesce(max(g.n_removed), 0) AS BIGINT) AS n_removed,
  coalesce(max(g.removed), '') AS removed, CASE WHEN any_value(d.text) IS NOT NULL THEN sha256(coalesce(max(n.clean), '')) END AS text_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, sum(size) AS n_removed, string_agg(start || ':' || size, ',' ORDER BY start) AS removed FROM removed GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT c.doc_id, CAST(sum(c.size) AS BIGINT) AS n_lines, string_agg(c.chunk, chr(10) ORDER BY c.start) FILTER (WHERE r.k IS NULL) AS clean
  FROM chunks c LEFT JOIN removed r ON r.doc_id = c.doc_id AND r.k = c.k GROUP BY c.doc_id) n USING (doc_id)
GROUP BY d.doc_id
"""


def _joined_spans(spans):
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), count("email"), count("ip"), count("card"), count("phone"),
        F.sha2(_joined_spans("base"), 256).alias("base_sha256"), _joined_spans(F.concat("base", "added")).alias("spans"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_versions(docs, run_dir(spark, "secret_ledger"), path="doc_id")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    text = _joined_spans("spans")
    return found.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(text, 256).alias("base_sha256"),
        text.alias("spans"),
    )


def _op7_spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {order} AS k, m[i] AS m, c[i] AS c,
    coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS m,
    regexp_extract_all(text, '{p}', {group}) AS c, string_split_regex(text, '{p}') AS g FROM documents WHERE text IS NOT NULL))
  WHERE length(c[i]) >= {least}"""


OP7_SQL = (
    "WITH found AS MATERIALIZED ("
    + " UNION ALL ".join(_op7_spans(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(RULES))
    + """), grouped AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(m) AS BIGINT), ',' ORDER BY start, k) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN grouped g ON g.doc_id = d.doc_id
"""
)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), n=5, threshold=0.75)


OP8_SQL = """
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM words
), grams AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)
), reach AS (
  SELECT doc_id AS node, doc_id AS low FROM sets
  UNION SELECT l.y, r.low FROM reach r JOIN links l ON l.x = r.node WHERE r.low < l.y
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT node, min(low) AS component_id FROM reach GROUP BY node) ON node = doc_id
"""

def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = codec(tokenizer_path()).special["<|endoftext|>"]
    ids = encode_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    sequences = cut_sequences(ids.select("doc.doc_id", "ids"), length=512, end_id=end)
    shards = write_training_order(sequences, key=20240607, length=512, pad_id=end)
    return shards.read(spark).select("doc_id", "seq_no", "n_tokens", "slot", "shard", F.sha2("tokens", 256).alias("tokens_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents").select("doc_id", "text"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = tokenizer_path()
    ids = encode_texts(docs, path).select("doc.doc_id", "n_tokens", "ids")
    back = decode_ids(ids, path)
    return back.select(
        "doc.doc_id", "doc.n_tokens", F.sha2("doc.ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), corpus AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM docs WHERE len(w) > 0),
counts AS MATERIALIZED (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM docs) GROUP BY d, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counts, corpus GROUP BY t
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL
), sizes AS (SELECT d, doc_id, 100 - 50 + ((50 * CAST(len(w) AS BIGINT) * nn) // ll) AS m FROM docs, corpus WHERE len(w) > 0),
scored AS (
  SELECT item_id, d, any_value(doc_id) AS doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (t) JOIN weights USING (t) JOIN sizes USING (d) GROUP BY item_id, d
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(read(spark, sf_dir, "documents"), k=2000).drop("cut")


OP12_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
counts AS MATERIALIZED (
  SELECT lang, m, g, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS g
    FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, g, f, string_split(g, ' ') AS w, unnest(range(1, m)) AS k FROM counts WHERE m > 1
), scored AS (
  SELECT c.lang, c.m, c.g, c.f AS a, k, x.f AS l, y.f AS r, n, CAST((1000 * CAST(c.f AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.g = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.g = array_to_string(w[k + 1:], ' ') JOIN sizes s ON s.lang = c.lang
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT lang, part, f FROM (SELECT lang, f, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:], ' ')]) AS part
    FROM (SELECT *, string_split(g, ' ') AS w FROM counts WHERE m > 2))
), kept AS (SELECT * FROM lowest b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.part = b.g AND i.f >= b.a))
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept) WHERE rank <= 2000
"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, own = F.transform("places", lambda p: p["label"]), F.transform("spans", lambda s: s["label"])
    return found.select(
        "doc.doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"), joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        # a phrase that stands inside a longer run has no span, but is there in full
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))).alias("score"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_topk_search": op3_topk_search,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_pii": op6_pii,
    "op7_secret_scan": op7_secret_scan,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_training_order": op9_training_order,
    "op10_bpe": op10_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_license_scan": op13_license_scan,
}

ORACLE: dict[str, str] = {
    "op2_url_filter": OP2_SQL,
    "op3_topk_search": OP3_SQL,
    "op4_benchmark_decontamination": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op7_secret_scan": OP7_SQL,
    "op8_minhash_near_dedup": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
}
