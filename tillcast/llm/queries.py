"""The registered queries of this subpackage, over the whole tables of a folder, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    cotrain,
    decontaminate,
    language_model,
    licenses,
    mixing,
    near_dup,
    packing,
    periodic,
    pii,
    quality_rules,
    toxicity,
    url_filter,
    whitening,
)

#: The rules that pages are judged by.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of at most 4096 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"), packing.tokenizer_path())


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, with the item and the edits between them."""
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected severity of every document, by a model of its labelled ones."""
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _read(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document, and whether the rules keep it."""
    judged = quality_rules.judge(_read(spark, sf_dir, "documents"))
    return judged.drop("n_lines", "n_ellipsis_lines", "n_bullet_lines")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, by two views that train each other."""
    docs = _read(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.train(docs, _read(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own or inherited licence of every document; sources and languages are directories, and a document lies
    the deeper in them the less round its id is."""
    bucket = F.floor(F.col("doc_id") / 100).cast("string")
    path = (
        F.when(F.col("doc_id") % 100 == 0, F.concat_ws("/", "source", F.col("doc_id").cast("string")))
        .when(F.col("doc_id") % 10 == 0, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
        .otherwise(F.concat_ws("/", "source", "lang", bucket, F.col("doc_id").cast("string")))
    )
    return licenses.scan(_read(spark, sf_dir, "documents").withColumn("path", path))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document by words alone and by the bigram model of the training documents."""
    return language_model.score(_read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(_read(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents"), size=2)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, else by the list: URLs of pages whose document is labelled poor or toxic."""
    pages = _read(spark, sf_dir, "pages")
    poor = _read(spark, sf_dir, "labels").where("quality = 0 OR toxic = 1").select("doc_id").distinct()
    number = F.regexp_extract(url_filter.path(F.col("url")), r"^/[a-z]+/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number).cast("long").alias("doc_id"))
    listed = numbered.join(poor, "doc_id", "left_semi").select("url")
    return url_filter.judge(pages, listed, URL_RULES)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with periodic ends: with h the CRC-32 of the id, every text of n words with h % 10 = 0
    repeats, from word a on, the words of a first period; both follow from h. Texts without an id stay."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        tail = n - a
        period = 1 + F.floor(tail / (3 + g % 8))
        times = F.ceil(tail / period).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), period.cast("int")), times))
        whole = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), tail.cast("int")))
        return F.when(n > 0, F.array_join(whole, " ")).otherwise("")

    text = F.col("text").cast("string")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    # A lambda's variable holds the words, so that they are split off once.
    ended = F.get(F.transform(F.array(words), planted), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, ended).otherwise(text).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document's words, a tenth of the documents with periodic ends."""
    return periodic.report(with_planted_runs(_read(spark, sf_dir, "documents")))


def op12_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a mix of all sources takes from every document."""
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding along the first 16 principal components, at unit variance."""
    points = whitening.points(_read(spark, sf_dir, "embeddings"))
    return whitening.whiten(points, whitening.fit(points))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_license_scan": op6_license_scan,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_pii": op8_pii,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_mixing_weights": op12_mixing_weights,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_STOPS = ", ".join(f"'{word}'" for word in quality_rules.STOP_WORDS)

_OP4 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
  SELECT k, doc_id, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), windows AS (
  SELECT k, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM parts WHERE len(w) >= 5)
), repeated AS (
  SELECT DISTINCT k, i + unnest([0, 1, 2, 3, 4]) AS place
  FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(*) AS n FROM repeated GROUP BY k
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words,
    len(list_filter(l, lambda x: suffix(x, '...') OR suffix(x, '…')))::BIGINT AS n_ellipsis_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]\x20')))::BIGINT AS n_bullet_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letter_words
  FROM parts LEFT JOIN covered USING (k)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_letter_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 100 * n_symbols <= 30 * n_words
  AND (n_words < 50 OR 100 * n_stop_words >= 2 * n_words) AND 100 * n_dup_lines <= 40 * n_lines
  AND 100 * n_ellipsis_lines <= 50 * n_lines AND 100 * n_bullet_lines <= 90 * n_lines
  AND 100 * n_letter_words >= 70 * n_words AS kept
FROM judged
"""

_OP10 = r"""
WITH rests AS (
  SELECT page_id, url, strpos(url, '://') > 0 AS ok, substr(url, strpos(url, '://') + 3) AS rest FROM pages
), parts AS (
  SELECT page_id,
    CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN ok THEN list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)='))) ELSE [] END AS own
  FROM rests
), pages_seen AS (
  SELECT page_id, host, path, host || regexp_replace(path, '/+$', '')
    || CASE WHEN len(own) > 0 THEN '?' || array_to_string(own, '&') ELSE '' END AS canonical,
    TRY_CAST(nullif(regexp_extract(path, '^/[a-z]+/([0-9]{1,18})', 1), '') AS BIGINT) AS number
  FROM parts
), listed_urls AS (
  SELECT DISTINCT canonical FROM pages_seen
  WHERE number IN (SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1) AND canonical <> ''
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/')
        THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/' END AS rule,
    EXISTS (SELECT 1 FROM listed_urls l WHERE l.canonical = pages_seen.canonical) AS listed
  FROM pages_seen
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM ruled
"""

_OP9 = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT k, doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM texts
), members AS (
  SELECT k, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.k AS a, b.k AS b FROM members a JOIN members b ON a.shingle = b.shingle AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT k, k AS other FROM sets
  UNION
  SELECT reached.k, b FROM reached JOIN links ON a = other
), components AS (
  SELECT reached.k, min(doc_id) AS component_id FROM reached JOIN sets ON sets.k = other GROUP BY reached.k
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components USING (k)
"""

_OP11 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, c:
      list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, c)), 4294967295::BIGINT) AS crc
  FROM documents
), numbers AS (
  SELECT *, xor(crc, 4294967295) // 10 AS g, xor(crc, 4294967295) % 10 = 0 AS planted, len(w) AS n FROM texts
), tails AS (
  SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM numbers
), periods AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM tails
), final AS (
  SELECT k, doc_id, n, CASE WHEN planted AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM periods
), grams AS (
  SELECT k, n, unnest(range(n - 4)) AS i, unnest(list_transform(range(n - 4), lambda i:
    array_to_string(list_slice(w, i + 1, i + 5), ' '))) AS gram
  FROM final WHERE n >= 6
), cells AS (
  SELECT a.k, a.i, a.i - b.i AS q
  FROM grams a JOIN grams b ON a.k = b.k AND a.gram = b.gram AND b.i < a.i AND 4 * (a.i - b.i) <= a.n
), stretches AS (
  SELECT k, q, min(i) - q AS s, max(i) + 5 - min(i) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM cells)
  GROUP BY k, q, island
), long AS (
  SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)
), runs AS (
  SELECT * FROM long l WHERE NOT EXISTS (SELECT 1 FROM long o
    WHERE o.k = l.k AND o.q < l.q AND o.s <= l.s AND o.s + o.length >= l.s + l.length)
), dropped AS (
  SELECT DISTINCT k, unnest(range(s + q, s + length)) AS i FROM runs
), found AS (
  SELECT k, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    first(struct_pack(s := s, l := length, q := q) ORDER BY length DESC, s, q) AS best
  FROM runs GROUP BY k
), gone AS (
  SELECT k, list(i) AS places FROM dropped GROUP BY k
)
SELECT doc_id, n::BIGINT AS n_words, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
  best.q::BIGINT AS period, (1000 * best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ') ELSE
    coalesce((SELECT string_agg(word, ' ' ORDER BY i) FROM (SELECT unnest(w) AS word, unnest(range(n)) AS i)
      WHERE NOT list_contains(places, i)), '') END) AS collapsed_sha256
FROM final LEFT JOIN found USING (k) LEFT JOIN gone USING (k)
"""

_OP12 = r"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS k, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', 'mix', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place, sum(weight) OVER () AS weights,
    sum(source_size) OVER () AS total
  FROM sources
), capped AS (  -- as if the sources up to this one stood at three times their size
  SELECT place AS upto, total - coalesce(3 * sum(source_size) OVER w, 0) AS spare,
    weights - coalesce(sum(weight) OVER w, 0) AS share, 3 * source_size / weight AS ratio
  FROM ranked WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), cut AS (
  SELECT min(upto) AS upto, arg_min(spare, upto) AS spare, arg_min(share, upto) AS share FROM capped WHERE ratio > spare / share
), targets AS (
  SELECT source, source_size, CASE WHEN cut.upto IS NULL OR place < cut.upto THEN (3 * source_size)::DOUBLE
    ELSE (weight * cut.spare)::DOUBLE / cut.share::DOUBLE END AS target
  FROM ranked, cut
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END AS passes FROM targets
), in_order AS (
  SELECT s.*, source_size, target, passes::BIGINT AS passes, floor(target - passes * source_size)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, s.k) AS upto
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
), ends AS (  -- the first row that does not fit
  SELECT source, min(key) AS hit FROM in_order WHERE budget > 0 AND upto > budget GROUP BY source
), prefixes AS (
  SELECT e.source, hit, max(shift) FILTER (WHERE m <= 64 OR shift = 0) AS shift
  FROM (SELECT e.source, hit, shift, count(*) AS m
    FROM ends e, (SELECT unnest(range(61)) AS shift), sized s
    WHERE s.source IS NOT DISTINCT FROM e.source AND s.key >> shift = e.hit >> shift GROUP BY ALL) e
  GROUP BY e.source, hit
), few AS (
  SELECT i.k, i.source, i.size, i.budget - coalesce(sum(i2.size), 0) AS rest,
    row_number() OVER (PARTITION BY i.source ORDER BY i.size DESC, i.key, i.k) AS place
  FROM in_order i JOIN prefixes p ON i.source IS NOT DISTINCT FROM p.source AND i.key >> p.shift = p.hit >> p.shift
  LEFT JOIN in_order i2 ON i2.source IS NOT DISTINCT FROM p.source AND i2.key >> p.shift < p.hit >> p.shift
  GROUP BY i.k, i.source, i.size, i.budget, i.key
), filled AS (
  SELECT source, place, k, size <= rest AS fits, rest - CASE WHEN size <= rest THEN size ELSE 0 END AS rest
  FROM few WHERE place = 1
  UNION ALL
  SELECT f.source, f.place, f.k, f.size <= r.rest, r.rest - CASE WHEN f.size <= r.rest THEN f.size ELSE 0 END
  FROM filled r JOIN few f ON f.source IS NOT DISTINCT FROM r.source AND f.place = r.place + 1
), taken AS (
  SELECT i.*, passes + (coalesce(f.fits, p.hit IS NOT NULL AND i.key >> p.shift < p.hit >> p.shift))::BIGINT AS copies
  FROM in_order i LEFT JOIN prefixes p ON i.source IS NOT DISTINCT FROM p.source LEFT JOIN filled f ON f.k = i.k
)
SELECT doc_id, size, source_size, target, copies, (copies * size)::BIGINT AS taken FROM taken
"""

ORACLE: dict[str, str] = {
    "op4_quality_rules": _OP4,
    "op9_minhash_near_dedup": _OP9,
    "op10_url_filter": _OP10,
    "op11_periodic_runs": _OP11,
    "op12_mixing_weights": _OP12,
}
