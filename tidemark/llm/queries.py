"""The registered queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment, bpe, chat, forest, graph, language, lines, merkle, mixing, pages, simhash, topk, url_lists)
from tidemark.llm.common import fraction
from tidemark.session import inline_rows, ship_package

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public tokenizer file lies; the library never copies it."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_mix(spark, d):
    return mixing.mixed(table(spark, d, "documents"))


@query
def op2_graph_dedup(spark, d):
    found = graph.near_duplicates(table(spark, d, "embeddings"), 0.9)
    return found.select("vec_id", "n_links", "component_id", "kept")


ORACLES["op2_graph_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v),
k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id
  AND list_dot_product(a.e, b.e) / (a.l * b.l) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS root FROM n
  UNION SELECT k.b, r.root FROM r JOIN k ON k.a = r.node),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node),
d AS (SELECT a, count(*) AS links FROM k GROUP BY a)
SELECT vec_id, coalesce(links, 0) AS n_links, coalesce(root, vec_id) AS component_id,
  vec_id = coalesce(root, vec_id) AS kept
FROM embeddings LEFT JOIN c ON node = vec_id LEFT JOIN d ON a = vec_id"""


@query
def planted_links(spark, d):
    """Near-duplicates after a disturbed copy of every twentieth vector was added."""
    rows = table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    noise = F.transform("embedding", lambda x, i: x + 0.01 * (1 + F.col("vec_id") % 7) * (
        (F.col("vec_id") * 31 + i * 17) % 11 - 5) / 5)
    copies = rows.where("vec_id % 20 = 0").select((F.col("vec_id") + 1_000_000_000).alias("vec_id"),
                                                  noise.alias("embedding"))
    found = graph.near_duplicates(rows.union(copies), 0.9)
    return found.select("vec_id", "n_links", "component_id", "kept")


ORACLES["planted_links"] = ORACLES["op2_graph_dedup"].replace("FROM embeddings", "FROM p").replace(
    "WITH RECURSIVE", """WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding FROM embeddings),
p AS (SELECT * FROM e UNION ALL
  SELECT vec_id + 1000000000, list_transform(embedding, lambda x, i: x + 0.01 * (1 + vec_id % 7)
    * ((vec_id * 31 + (i - 1) * 17) % 11 - 5) / 5) FROM e WHERE vec_id % 20 = 0),""")


@query
def op5_forest(spark, d):
    return forest.nearest(table(spark, d, "embeddings"), every=20, k=20)


@query
def op3_lines(spark, d):
    return lines.line_report(table(spark, d, "documents"))


@query
def op4_bpe(spark, d):
    return bpe.digests(table(spark, d, "documents"), tokenizer_path())


@query
def op6_pages(spark, d):
    return pages.main_text(table(spark, d, "pages"))


@query
def op9_language(spark, d):
    return language.identify(table(spark, d, "documents"))


@query
def op8_simhash(spark, d):
    return simhash.simhash_clusters(table(spark, d, "documents"), 3, 2)


@query
def op11_topk(spark, d):
    return topk.search(table(spark, d, "embeddings"), every=20, k=20)


ORACLES["op11_topk"] = topk.ORACLE


@query
def op12_merkle(spark, d):
    return merkle.manifest(table(spark, d, "documents"))


ORACLES["op12_merkle"] = merkle.oracle()


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op13_alignment(spark, d):
    return alignment.report(table(spark, d, "documents"), tokenizer_path(), piece_path())


PROBE = "</s>[INST] ok [/INST]"


@query
def op7_chat(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = inline_rows(spark, dict(rows.dtypes), [(-7, 0, "user", PROBE),
                                                   (-7, 1, "assistant", PROBE)])
    return chat.digests(rows.union(probe))


ORACLES["op7_chat"] = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(text, '\\', '\\\\'), '[INST]', '[\\INST]'),
    '[/INST]', '[\\/INST]'), '</s>', '<\\/s>') AS esc FROM r),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                        ORDER BY turn, role, text), '') AS loss,
    sum(length(role) + length(esc) + 17) AS chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g"""


FIRST_DAY, DAYS = "2023-01-01", 730


def captures_of(web: DataFrame) -> DataFrame:
    """Pages with a day of fetching that follows from id and URL, as the table has none."""
    at = F.floor(fraction(F.col("page_id"), F.col("url"), F.lit("fetch")) * DAYS).cast("int")
    return web.select("page_id", "url", F.date_add(F.to_date(F.lit(FIRST_DAY)), at)
                        .alias("fetch_day"))


def dated_entries(web: DataFrame) -> DataFrame:
    """Filter lists derived from the pages' own keys: three lists, added and removed over time.

    Every key is on a list with a chance by its kind; half of the entries are removed after a
    while and half of those come back.
    """
    keys = web.select(F.explode(url_lists.keys_of(F.col("url"))).alias("key")).distinct()
    kind = F.substring_index("key", " ", 1)
    chance = F.when(kind == "domain", 0.2).when(kind == "path", 0.05).otherwise(0.02)

    def u(name):
        return fraction(F.col("key"), F.lit(name))

    def days(name):
        return F.floor(u(name) * DAYS / 3).cast("int")

    picked = keys.where(u("listed") < chance).select(
        "key", F.element_at(F.array(*map(F.lit, ["adult", "malware", "spam"])),
                            F.floor(u("list") * 3).cast("int") + 1).alias("list"),
        days("add").alias("a"), (days("add") + 1 + days("remove")).alias("b"),
        (days("add") + 2 + days("remove") + days("again")).alias("c"), u("keep").alias("keep"))
    steps = F.array(
        F.struct(F.col("a").alias("at"), F.lit("add").alias("action")),
        F.struct(F.when(F.col("keep") >= 0.5, F.col("b")).alias("at"), F.lit("remove").alias("action")),
        F.struct(F.when(F.col("keep") >= 0.75, F.col("c")).alias("at"), F.lit("add").alias("action")))
    return (picked.select("list", "key", F.explode(steps).alias("s")).where("s.at is not null")
            .select("list", "key", F.date_add(F.to_date(F.lit(FIRST_DAY)), F.col("s.at")).alias("day"),
                    F.col("s.action").alias("action")))


@query
def op10_url_lists(spark, d):
    web = table(spark, d, "pages").select("page_id", "url")
    return url_lists.listed(captures_of(web), dated_entries(web))


def _u(*parts: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0)"


ORACLES["op10_url_lists"] = f"""
WITH RECURSIVE p AS (
  SELECT page_id, url, DATE '{FIRST_DAY}'
    + CAST(floor({_u("page_id", "url", "'fetch'")} * {DAYS}) AS INTEGER) AS fetch_day,
    lower(split_part(split_part(split_part(split_part(split_part(url, '//', 2), '/', 1), '?', 1),
      '#', 1), ':', 1)) AS host,
    regexp_extract(url, '^[^/]*//[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '^[^?#]*([?][^#]*)', 1) AS query
  FROM pages),
l AS (SELECT DISTINCT url, host, path, query, string_split(host, '.') AS labels,
  string_split(trim(path, '/'), '/') AS parts FROM p WHERE host <> ''),
keys AS (
  SELECT DISTINCT url, 'domain ' || array_to_string(labels[i:], '.') AS key
  FROM l, LATERAL (SELECT unnest(range(1, len(labels) + 1)) AS i)
  UNION SELECT url, 'path ' || host || '/' || array_to_string(parts[1:i], '/')
  FROM l, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) WHERE replace(path, '/', '') <> ''
  UNION SELECT url, 'url ' || host || path || query FROM l),
k AS (
  SELECT key, split_part(key, ' ', 1) AS kind,
    ['adult', 'malware', 'spam'][CAST(floor({_u("key", "'list'")} * 3) AS INTEGER) + 1] AS list,
    CAST(floor({_u("key", "'add'")} * {DAYS} / 3) AS INTEGER) AS a,
    CAST(floor({_u("key", "'remove'")} * {DAYS} / 3) AS INTEGER) AS r,
    CAST(floor({_u("key", "'again'")} * {DAYS} / 3) AS INTEGER) AS g,
    {_u("key", "'keep'")} AS keep, {_u("key", "'listed'")} AS chance
  FROM (SELECT DISTINCT key FROM keys)),
spans AS (
  SELECT key, kind, list, a AS f, CASE WHEN keep >= 0.5 THEN a + 1 + r END AS t FROM k
  WHERE chance < CASE kind WHEN 'domain' THEN 0.2 WHEN 'path' THEN 0.05 ELSE 0.02 END
  UNION ALL
  SELECT key, kind, list, a + 2 + r + g, NULL FROM k
  WHERE keep >= 0.75
    AND chance < CASE kind WHEN 'domain' THEN 0.2 WHEN 'path' THEN 0.05 ELSE 0.02 END),
hits AS (
  SELECT c.url, c.fetch_day, s.list, s.kind
  FROM (SELECT DISTINCT url, fetch_day FROM p) c JOIN keys USING (url) JOIN spans s USING (key)
  WHERE c.fetch_day >= DATE '{FIRST_DAY}' + s.f
    AND (s.t IS NULL OR c.fetch_day < DATE '{FIRST_DAY}' + s.t)),
found AS (
  SELECT url, fetch_day, count(*) AS n_entries,
    array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
    CASE min(CASE kind WHEN 'url' THEN 1 WHEN 'path' THEN 2 ELSE 3 END)
      WHEN 1 THEN 'url' WHEN 2 THEN 'path' ELSE 'domain' END AS nearest
  FROM hits GROUP BY url, fetch_day)
SELECT p.page_id, p.url, p.fetch_day, coalesce(n_entries, 0) AS n_entries,
  coalesce(lists, '') AS lists, nearest
FROM p LEFT JOIN found USING (url, fetch_day)"""
