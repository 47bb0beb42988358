"""One registered query for each operator of this subpackage: production parameters, whole tables."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.align import link_counts
from fareloom.llm.decontaminate import contaminated
from fareloom.llm.language import identify
from fareloom.llm.lines import dedup_lines
from fareloom.llm.mixing import mixing_table
from fareloom.llm.near_dup import near_duplicates
from fareloom.llm.rules import CUTOFFS, RULES, quality
from fareloom.llm.search import ranked_search
from fareloom.llm.set_join import similar_documents
from fareloom.llm.shards import assign_shards
from fareloom.llm.suffixes import repeated_passages
from fareloom.llm.token_files import token_table
from fareloom.llm.toxicity import toxicity

QUERIES: dict = {}

TOKENIZER = corpus_pipeline.TOKENIZER
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bitmask_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


@query
def op2_stratified_interleaving(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), shards=8, by="source")


@query
def op3_pu_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_difference_cover_dedup(spark, sf_dir):
    found = repeated_passages(table(spark, sf_dir, "documents"), size=50)
    return found.select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_pfair_mixing(spark, sf_dir):
    return mixing_table(table(spark, sf_dir, "documents"), power=0.5)


@query
def op6_line_dedup(spark, sf_dir):
    lines = dedup_lines(table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_simhash_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=80).drop("text_key")


@query
def op8_huffman_token_files(spark, sf_dir):
    return token_table(table(spark, sf_dir, "documents"), TOKENIZER, end_id=0)


@query
def op9_risk_controlled_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), by="lang", risk=0.05, confidence=0.95)


@query
def op10_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85)


@query
def op11_dictionary_alignment(spark, sf_dir):
    return link_counts(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


@query
def op12_document_tree_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op13_token_group_join(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents"), size=4, percent=85)


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


ORACLES: dict = {"pipeline": corpus_pipeline.ORACLE_SQL}

ORACLES["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
), common AS (
  SELECT line_key FROM keyed WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.line_key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.line_key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.line_key = c.line_key GROUP BY doc_id
"""

ORACLES["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS id, b AS r FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a
), components AS (SELECT id, least(id, min(r)) AS component_id FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN components ON id = doc_id
"""

ORACLES["op13_token_group_join"] = (
    ORACLES["op10_minhash_near_dedup"].replace("len(w) >= 5", "len(w) >= 4").replace("len(w) - 3", "len(w) - 2").replace("i + 4", "i + 3")
    .replace("""component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
""", """component_id
""")
)

_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""
_SHINGLES = """CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN ['whole ' || len(w) || ' ' || array_to_string(w, ' ')] ELSE [] END"""

ORACLES["op7_simhash_decontamination"] = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
bw AS (SELECT item_id, {_WORDS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
dl AS (SELECT doc_id, {_SHINGLES} AS s FROM dw),
ds AS MATERIALIZED (SELECT doc_id, len(s) AS size, unnest(s) AS shingle, unnest(range(len(s))) AS p FROM dl),
bl AS (SELECT item_id, len(w) AS item_words, {_SHINGLES} AS s FROM bw),
bs AS (SELECT item_id, item_words, m, shingle, count(*) AS c
  FROM (SELECT item_id, item_words, len(s) AS m, unnest(s) AS shingle FROM bl) GROUP BY ALL),
starts AS (SELECT DISTINCT doc_id, item_id, item_words, m, least(m, size) AS v, least(p, greatest(size - m, 0)) AS start
  FROM ds JOIN bs USING (shingle)),
wc AS (SELECT s.doc_id, s.item_id, s.item_words, s.m, s.v, s.start, ds.shingle, count(*) AS c
  FROM starts s JOIN ds ON ds.doc_id = s.doc_id AND ds.p >= s.start AND ds.p < s.start + s.m GROUP BY ALL),
sims AS (SELECT doc_id, item_id, wc.item_words, v, start, sum(least(wc.c, bs.c)) AS common, v + wc.m AS together
  FROM wc JOIN bs USING (item_id, shingle) GROUP BY doc_id, item_id, wc.item_words, v, start, wc.m)
SELECT doc_id, item_id, CAST(common AS DOUBLE) / CAST(together - common AS DOUBLE) AS similarity, CAST(start AS BIGINT) AS start_word,
  CAST(CASE WHEN item_words < 5 THEN item_words ELSE v + 4 END AS BIGINT) AS n_words
FROM sims WHERE 100 * common >= 80 * (together - common)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

_RULE_ROWS = " UNION ALL ".join(
    f"SELECT doc_id, stratum, '{rule}' AS rule, CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) AS ratio FROM base WHERE NOT base_failed"
    for rule, (part, whole) in ((r, e.split(" / ")) for r, e in RULES.items())
)

ORACLES["op9_risk_controlled_rules"] = f"""
WITH words AS (
  SELECT doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i:i + 2], ' '))) AS g,
      unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM words)
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM grams, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY doc_id
), base AS (
  SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals, length(t) - length(replace(t, '!', '')) AS n_exclamations,
    len(lines) AS n_full_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
  FROM words LEFT JOIN repeated USING (doc_id)
), ratios AS ({_RULE_ROWS}),
labelled AS (SELECT stratum, rule, min(ratio) AS ratio, min(quality) AS quality FROM ratios JOIN words USING (doc_id, stratum)
  JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id) USING (doc_id) GROUP BY stratum, rule, t),
cuts AS (SELECT unnest([{', '.join(map(str, CUTOFFS))}]::DOUBLE[]) AS cutoff),
tests AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 1 AND coalesce(ratio, 0) > cutoff) AS k,
    count(*) FILTER (quality = 0 AND coalesce(ratio, 0) > cutoff) AS bad FROM labelled, cuts GROUP BY ALL
), proved AS (
  SELECT *, list_sum(list_transform(range(CAST(k AS BIGINT) + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
    + j * ln(0.05 / {len(RULES)}) + (n - j) * ln(1 - 0.05 / {len(RULES)})))) AS p_value FROM tests
), used AS (
  SELECT stratum, rule, cutoff FROM proved
  WHERE k < n * 0.05 / {len(RULES)} AND p_value <= 0.05 / ((SELECT count(DISTINCT stratum) FROM tests) * {len(RULES)}) AND bad - 20 * k > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY bad - 20 * k DESC, cutoff DESC) = 1
), broken AS (
  SELECT doc_id, string_agg(rule, ',' ORDER BY list_position([{', '.join(repr(r) for r in RULES)}], rule)) AS broken_rules
  FROM ratios JOIN used USING (stratum, rule) WHERE ratio > cutoff GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND broken_rules IS NULL AS kept, coalesce(broken_rules, '') AS broken_rules
FROM base LEFT JOIN broken USING (doc_id)
"""

ORACLES["op4_difference_cover_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
windows AS MATERIALIZED (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM d WHERE n >= 50)),
smallest AS (SELECT s, min(doc_id) AS m FROM windows GROUP BY s),
hits AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM windows JOIN smallest USING (s) WHERE m < doc_id),
runs AS (SELECT doc_id, p, sum(CASE WHEN step IS NULL OR step > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM hits),
spans AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, k),
parts AS (
  SELECT doc_id, a, b, k, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), kept AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) || substr(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS rest
  FROM parts JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op2_stratified_interleaving"] = """
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), sized AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h,
    ('0x' || substr(md5('17:' || coalesce('=' || doc_id, '')), 1, 13))::BIGINT / 4503599627370496.0 AS unit FROM documents
), summed AS (
  SELECT doc_id, stratum, CAST(size AS BIGINT) AS size, unit, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(size - 1), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM sized, crc
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY unit, doc_id, text_crc32, size) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS m FROM summed
), spread AS (
  SELECT *, (r + ('0x' || substr(md5('phase:=' || stratum), 1, 13))::BIGINT / 4503599627370496.0) / m AS fraction FROM ranked
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, doc_id, text_crc32, size) - 1 AS position, count(*) OVER () AS n FROM spread
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST((8 * (position + 1) - 1) // n AS INTEGER) AS shard,
  position - ((8 * (position + 1) - 1) // n) * n // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard, position, fraction
FROM placed
"""

ORACLES["op12_document_tree_search"] = r"""
WITH dt AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS row, * FROM documents)
), tf AS MATERIALIZED (SELECT row, doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
ms AS (SELECT row, 100 - 90 + (90 * n * docs) // total AS m FROM sizes, whole),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY term, docs
), scores AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN ms USING (row) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
