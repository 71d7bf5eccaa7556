"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle.llm import (
    embedding_dedup,
    fill_in_middle,
    jaccard_join,
    license_scan,
    mixing,
    periodic_runs,
    quality,
    quality_rules,
    search,
    substring_dedup,
    suffix_dedup,
    url_rules,
    word_bpe,
)
from hemicycle.llm.registry import CHECKS, QUERIES, query, table

__all__ = ["CHECKS", "QUERIES"]

OP2_SQL = r"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM s),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, i + o AS p FROM h JOIN r USING (k), unnest(range(0, 35)) AS t(o)),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
f AS (SELECT doc_id, len(w) AS n, coalesce(len(gone), 0) AS x,
      CASE WHEN gone IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p))) END AS kept
      FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(x AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM f
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 2), ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n u ON x = u.doc_id JOIN n v ON y = v.doc_id WHERE 100 * c >= 90 * (u.n + v.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)
"""


@query("op3_jaccard_join", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    _, found = jaccard_join.near_groups(docs, jaccard_join.Similarity(words=3, percent=90))
    return found.select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
s AS (SELECT doc_id, x, unnest(range(0, CAST(octet_length(x) - 399 AS BIGINT))) AS i FROM d WHERE octet_length(x) >= 400),
h AS (SELECT doc_id, i, md5(x[i + 1:i + 400]) AS k FROM s),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
m AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM h SEMI JOIN r USING (k)),
b AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS z FROM m GROUP BY doc_id, g),
o AS (SELECT *, max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM b),
q AS (SELECT *, sum(CASE WHEN p >= a THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a) AS grp FROM o),
u AS (SELECT doc_id, min(a) AS a, max(z) AS z FROM q GROUP BY doc_id, grp),
l AS (SELECT doc_id, list(a ORDER BY a) AS las, list(z ORDER BY a) AS lzs, sum(z - a) AS gone, count(*) AS n FROM u GROUP BY doc_id),
e AS (SELECT doc_id, x, gone, n, list_prepend(0, lzs) AS starts, list_append(las, octet_length(x)) AS ends FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       CAST(octet_length(x) - coalesce(gone, 0) AS BIGINT) AS n_kept, sha256(CASE WHEN gone IS NULL THEN x ELSE list_reduce(list_transform(range(1, CAST(n + 2 AS BIGINT)),
         lambda j: CASE WHEN ends[j] > starts[j] THEN x[starts[j] + 1:ends[j]] ELSE ''::BLOB END), lambda left_, right_: left_ || right_) END) AS kept_sha256
FROM e
"""


@query("op1_suffix_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"), "kept_sha256")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][r % 3 + 1] AS w, sum(n) OVER () AS total FROM s),
o AS (SELECT *, coalesce(sum(2 * n) OVER (ORDER BY 2 * n / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
             sum(w) OVER (ORDER BY 2 * n / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM w),
l AS (SELECT max(CAST(3 * total - 2 * full_ AS DOUBLE) / (2.0::DOUBLE * free)) AS part FROM o),
t AS (SELECT source, n, CASE WHEN 2 * n < w * part THEN CAST(2 * n AS DOUBLE) ELSE w * part END AS target FROM w, l),
p AS (SELECT doc_id, size, n, target, floor(target) AS words,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, target,
       CAST(greatest(least(a + size, words) - a, 0) + greatest(least(a + n + size, words) - a - n, 0) AS BIGINT) AS taken FROM p
"""


@query("op8_mix_sources", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


UNWANTED_SQL = "|".join(r.pattern for r in url_rules.WORDS)
OP10_SQL = rf"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (SELECT *, '.' || host AS d FROM h),
g AS (SELECT *, CASE WHEN d LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
                     WHEN d LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
                     WHEN d LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
                     WHEN d LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
                     WHEN d LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule FROM f)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN regexp_matches(lower(host || path), '{UNWANTED_SQL}') THEN 'block' ELSE 'allow' END AS verdict FROM g
"""


@query("op10_url_filter", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


#: Name of the vocabulary file among the public ones; its place is a parameter of the operator.
VOCABULARY = "word_bpe_49k.json"


@query("op7_bpe_codec")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return word_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), digests=True)


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
g AS (SELECT * FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


@query("op5_embedding_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w FROM documents),
s AS (SELECT count(*) AS rows_, CAST(sum(len(w)) AS DOUBLE) / count(*) AS mean FROM d),
t AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL),
n AS (SELECT word, count(*) AS n FROM t GROUP BY word),
q AS (SELECT doc_id AS query_id, word, ln(1 + (rows_ - n + 0.5::DOUBLE) / (n + 0.5::DOUBLE)) AS idf, tf FROM t JOIN n USING (word), s WHERE doc_id % 20 = 0),
c AS (SELECT query_id, t.doc_id, sum(CAST(floor(tf_ * 2.2::DOUBLE / (tf_ + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(w) / mean)) * idf * 1000000 + 0.5::DOUBLE) AS BIGINT)) AS score
      FROM q JOIN (SELECT doc_id, word, tf AS tf_ FROM t) t USING (word) JOIN d ON d.doc_id = t.doc_id, s GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM c QUALIFY rank <= 10
"""


@query("op6_topk_search", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query("whole_topk_search", OP6_SQL)
def whole_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows under the name that the search for whole queries had."""
    return op6(spark, sf_dir)


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("detections")


def crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII or UTF-8, by a step a byte with the table of all byte values."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    bytes_ = f"list_transform(range(1, CAST(octet_length(encode({text})) AS BIGINT) + 1), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))"
    step = f"lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), {step}), 4294967295)"


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^ 	-
]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS ls FROM d),
x AS (SELECT rid, i, w[i:i + 2] AS k FROM w, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS u(i)),
r AS (SELECT rid, i FROM x QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
c AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, unnest(range(0, 3)) AS u(o) GROUP BY rid),
tok AS (SELECT rid, doc_id, regexp_extract_all(t, '{quality_rules.TOKEN}') AS k FROM d),
k AS (SELECT rid, doc_id, k[i] AS s, k[i + 1] AS s2, FROM tok, unnest(range(1, CAST(len(k) AS BIGINT) + 1)) AS u(i)),
v AS (SELECT s, {crc32_sql("s")} AS h FROM (SELECT DISTINCT s FROM k)),
g AS (SELECT rid, doc_id, h % 8192 AS b FROM k JOIN v USING (s)
      UNION ALL SELECT rid, doc_id, (x.h * 31 + y.h) % 8192 FROM k JOIN v x USING (s) JOIN v y ON y.s = s2),
good AS (SELECT DISTINCT doc_id, 1 AS one FROM labels WHERE quality = 1 AND {crc32_sql("CAST(doc_id AS VARCHAR)")} % 4 <> 2),
m AS (SELECT b, count(*) AS n, count(one) AS t FROM g LEFT JOIN good USING (doc_id) GROUP BY b),
z AS (SELECT sum(n) + 8192 AS ns, sum(t) + 8192 AS ts FROM m),
q AS (SELECT b, CAST(floor(1000000 * (ln((t + 1) / ts::DOUBLE) - ln((n + 1) / ns::DOUBLE)) + 0.5) AS BIGINT) AS ratio FROM m, z),
s AS (SELECT rid, CAST(sum(ratio) AS BIGINT) AS total, count(*) AS n FROM g JOIN q USING (b) GROUP BY rid),
f AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{quality_rules.SIGNS}', '')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, coalesce(s.total, 0) AS total, coalesce(s.n, 0) AS n
      FROM w LEFT JOIN c USING (rid) LEFT JOIN s USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND total >= -300000 * n AS kept,
       CASE WHEN n > 0 THEN CAST(total AS DOUBLE) / CAST(1000000 * n AS DOUBLE) ELSE 0::DOUBLE END AS log_ratio FROM f
"""


@query("op11_quality_rules", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels"))))


_DRAW = ", ".join(f"CAST('0x' || substr(d, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
OP12_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, {_DRAW} FROM t),
n AS (SELECT *, CAST(len(u) AS BIGINT) AS n FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:z], '') AS middle, array_to_string(u[z + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^ 	-
]+') END AS w,
             {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h FROM documents),
n AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
o AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) END AS w FROM p),
k AS (SELECT rid, n, i, w[i + 1:i + 5] AS k FROM o, unnest(range(0, n - 4)) AS u(i) WHERE n >= 6),
m AS (SELECT rid, n, i, k FROM k QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
e AS (SELECT x.rid, x.i, y.i - x.i AS q FROM m x JOIN m y ON x.rid = y.rid AND x.k = y.k AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e),
r AS (SELECT rid, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY rid, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
l AS (SELECT rid, start, length, min(q) AS period FROM r GROUP BY rid, start, length),
b AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
             arg_min({{'s': start, 'l': length, 'p': period}}, [-length, start, period]) AS best FROM l GROUP BY rid),
g AS (SELECT DISTINCT rid, x FROM l, unnest(range(start + period, start + length)) AS u(x)),
f AS (SELECT rid, list(x) AS gone FROM g GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period,
       CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_where(w, list_transform(range(0, n), lambda x: NOT list_contains(gone, x))) END, ' ')) AS collapsed_sha256
FROM o LEFT JOIN b USING (rid) LEFT JOIN f USING (rid)
"""


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents, one in ten of which goes on in a period from some word, by a checksum of its id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def going_on(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        repeated = lambda at: F.transform(words, lambda w, i: F.when(i < at["a"], w).otherwise(F.get(words, at["a"] + (i - at["a"]) % at["p"])))
        return F.array_join(quality_rules.let(F.struct(a.alias("a"), p.alias("p")), repeated), " ")

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.when(h % 10 == 0, quality_rules.let(quality_rules.words_of(text), going_on)).otherwise(text).alias("text"))


@query("op13_periodic_runs", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.l") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
