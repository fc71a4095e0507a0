"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm.chat import as_records, format_records, read_back
from corvane.llm.decontam import contaminated
from corvane.llm.divergence import source_divergence
from corvane.llm.html import extract_main_text
from corvane.llm.langid import identify
from corvane.llm.media import image_copies, pictures_of
from corvane.llm.minhash import near_duplicates
from corvane.llm.mixing import mix_sources
from corvane.llm.quality import quality_scores
from corvane.llm.resampling import importance_resample
from corvane.llm.substring import substring_dedup
from corvane.llm.urls import judge_urls
from corvane.llm.warc import archived_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"), keep_fixed=True)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_copies(pictures_of(_table(spark, sf_dir, "embeddings")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(_table(spark, sf_dir, "pages"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", told), (-1, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return read_back(format_records(as_records(turns, varied=True)))


#: The listed rules of the query, as verdict and host with path.
LISTED = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), LISTED)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_media": op2_media,
    "op3_mixing": op3_mixing,
    "op4_decontam": op4_decontam,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_substring": op7_substring,
    "op8_minhash": op8_minhash,
    "op9_langid": op9_langid,
    "op10_chat": op10_chat,
    "op11_urls": op11_urls,
    "op12_resampling": op12_resampling,
    "op13_divergence": op13_divergence,
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op3_mixing": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, CAST(len({_WORDS.format(text="coalesce(text, '')")}) AS BIGINT) AS size FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
l AS (
  SELECT *, (sum(n) OVER ()::BIGINT - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY 3 * n / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM r
),
t AS (SELECT source, n, least(3e0 * n, max(level) OVER () * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN n > 0 THEN least(floor(target / n), 3)::BIGINT ELSE 0 END AS epochs FROM t),
b AS (SELECT *, floor(target - epochs * n + 0.5e0)::BIGINT AS budget FROM p),
k AS (
  SELECT d.*, b.n, b.target, b.epochs, b.budget,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':7'), 1, 13))::BIGINT + 0.5e0) / 4503599627370496e0)
      / CASE WHEN size > 0 THEN 1e0 / (1e0 + (length(t) - length(translate(t, '#$%&*|!<>{{}}@', ''))) / size) ELSE 1e0 END AS key
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
),
c AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS before FROM k
)
SELECT doc_id, size, n AS source_size, target, size * epochs + greatest(0, least(size, budget - before)) AS taken FROM c
""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS stored FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN stored < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN stored < page_id THEN stored END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
""",
    "op7_substring": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)
),
firsts AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT win.doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN firsts USING (h) WHERE win.doc_id > f)
),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (
  SELECT each.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY each.p) FILTER (gone.p IS NULL) AS t
  FROM each LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.p = each.p GROUP BY each.doc_id
)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op8_minhash": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp ON comp.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op10_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, concat(role, chr(10), text) AS said FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, length(said) - length(replace(said, '\', '')) + (length(said) - length(replace(said, '<|', ''))) / 2 + (length(said) - length(replace(said, '|>', ''))) / 2
    + (length(said) - length(replace(said, '<s>', ''))) / 3 + (length(said) - length(replace(said, '</s>', ''))) / 4 + (length(said) - length(replace(said, '[INST]', ''))) / 6
    + (length(said) - length(replace(said, '[/INST]', ''))) / 7 + (length(said) - length(replace(said, '<<SYS>>', ''))) / 7 + (length(said) - length(replace(said, '<</SYS>>', ''))) / 8 AS escapes
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(text) + escapes + 23)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op12_resampling": r"""
WITH steps AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
own AS (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY r, x),
words AS (SELECT DISTINCT x FROM (SELECT x FROM own UNION ALL SELECT x FROM b)),
crc AS (
  SELECT x, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(x))), lambda i: ('0x' || substr(hex(encode(x)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
    lambda c, z: xor(c >> 8, t[(xor(c, z) & 255) + 1])), 4294967295) % 10000 AS k
  FROM words, steps
),
s AS (SELECT k, sum(n)::BIGINT AS s FROM own JOIN crc USING (x) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN crc USING (x) GROUP BY k),
g AS (
  SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (k)
),
w AS (SELECT r, sum(n * gain)::BIGINT AS weight FROM own JOIN crc USING (x) JOIN g USING (k) GROUP BY r),
z AS (
  SELECT doc_id, len(w.w) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5e0) / 4294967296e0)))::BIGINT AS score
  FROM d w LEFT JOIN w v USING (r)
),
p AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM p
""",
    "op13_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
k AS (SELECT lang, term, count(DISTINCT r) AS docs, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS n FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY lang),
g AS (
  SELECT d.lang, d.source, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN (SELECT c.* FROM c JOIN k USING (lang, term)) c ON c.lang = d.lang AND c.source = d.source GROUP BY ALL
),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.n + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000 * (k.n + 5)::HUGEINT) // (l.n + 5 * l.v)::HUGEINT AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
v AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM v) WHERE part = 'pair' OR rank <= 50
""",
}
