"""The registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES["op7_packing"] = op7_packing


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op9_exact_dedup"] = op9_exact_dedup
ORACLES["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


QUERIES["op4_toxicity"] = op4_toxicity


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES["op10_near_dedup"] = op10_near_dedup
ORACLES["op10_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE
           WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3),
                lambda k: array_to_string(words[k:k + 4], ' '))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_sides AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM both_sides JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.pii import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents"))


QUERIES["op6_pii"] = op6_pii


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.sentencepiece import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES["op2_sentencepiece"] = op2_sentencepiece


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.lm import score_documents

    scored = score_documents(table(spark, sf_dir, "documents"))
    # sums of doubles depend on their order in the last digits
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def _crc_table() -> str:
    """The 256 steps of the crc32 of one byte, as an SQL list."""
    steps = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        steps.append(str(value))
    return "[" + ", ".join(steps) + "]"


QUERIES["op5_lm_scoring"] = op5_lm_scoring
ORACLES["op5_lm_scoring"] = rf"""
WITH t AS (
  SELECT doc_id, list_append(list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> ''), chr(10)) AS w,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: xor(crc >> 8, ({_crc_table()}::BIGINT[])[1 + (xor(crc, b) & 255)]))) % 10 = 0 AS held_out
  FROM documents
), u AS (
  SELECT doc_id, held_out, unnest(w) AS word, unnest(list_prepend('', w[:-2])) AS state FROM t
), c AS (
  SELECT word, count(*) AS c FROM u WHERE NOT held_out GROUP BY word
), p AS (
  SELECT state, word, count(*) AS c FROM u WHERE NOT held_out GROUP BY state, word
), n AS (
  SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c
), h AS (
  SELECT word AS state, c FROM c UNION ALL SELECT '', count(*) FROM t WHERE NOT held_out
), s AS (
  SELECT u.doc_id, u.held_out, c.c IS NOT NULL AS known,
         (coalesce(c.c, 0) + 0.1::DOUBLE) / (n.n + 0.1::DOUBLE * (n.v + 1)) AS unigram,
         coalesce(p.c, 0) AS arc, coalesce(h.c, 0) AS history, n.n
  FROM u CROSS JOIN n LEFT JOIN c ON c.word = u.word
  LEFT JOIN p ON p.state = u.state AND p.word = u.word LEFT JOIN h ON h.state = u.state
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE known) AS n_known,
       any_value(n) AS train_tokens, round(sum(log10(unigram)), 6) AS base_score,
       round(sum(log10((arc + 200 * unigram) / (history + 200))), 6) AS score
FROM s GROUP BY doc_id, held_out
"""


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.topk import top_products

    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


QUERIES["op1_topk"] = op1_topk
ORACLES["op1_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    from loomcast.llm import licenses as lic

    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    whole = [(name, x) for name, text in lic.LICENSES.items() for x in (text, f"{lic.TITLES[name]}\n\n{text}")]
    rows = lambda pairs: ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in pairs)
    spell = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in lic.SPELLINGS.items()) + "}"

    def form(text: str) -> str:
        lines = f"list_filter(string_split(coalesce({text}, ''), chr(10)), lambda l: NOT regexp_matches(l, {quoted(lic.COPYRIGHT_LINE)}))"
        bare = f"trim(regexp_replace(lower(array_to_string({lines}, chr(10))), {quoted(lic.BETWEEN_WORDS)}, ' ', 'g'))"
        return f"array_to_string(list_transform(string_split({bare}, ' '), lambda w: coalesce({spell}[w], w)), ' ')"

    return f"""
WITH whole AS (
  SELECT DISTINCT name, {form('text')} AS form FROM (VALUES {rows(whole)}) AS t(name, text)
), notice AS (
  SELECT DISTINCT name, {form('text')} AS form FROM (VALUES {rows([(b, a) for a, b in lic.NOTICES.items()])}) AS t(name, text)
), line AS (
  SELECT DISTINCT doc_id, {form('line')} AS form
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
), hit AS (
  SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM line JOIN notice USING (form) GROUP BY doc_id
)
SELECT d.doc_id, w.name AS license, coalesce(hit.notices, '') AS notices
FROM (SELECT doc_id, {form('text')} AS form FROM documents) d
LEFT JOIN whole w USING (form) LEFT JOIN hit USING (doc_id)
"""


QUERIES["op3_licenses"] = op3_licenses
ORACLES["op3_licenses"] = _license_sql()


def op8_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.chats import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


QUERIES["op8_chats"] = op8_chats
ORACLES["op8_chats"] = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), p AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place,
         '<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || chr(10) || '<|end|>' || chr(10) AS line
  FROM t
), w AS (
  SELECT conv_id, place, string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY place) AS upto,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM p
), m AS (
  SELECT min(conv_id) AS conv_id, n_turns FROM w
  WHERE place = n_turns AND NOT EXISTS (SELECT 1 FROM w x WHERE x.place < x.n_turns AND x.upto = w.upto)
  GROUP BY upto, n_turns
)
SELECT conv_id, (place - 1) // 64 AS segment, any_value(n_turns) AS n_turns, string_agg(line, '' ORDER BY place) AS rendered
FROM m JOIN p USING (conv_id) GROUP BY conv_id, (place - 1) // 64
"""


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.alignment import align_documents

    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), *paths, digest=True)


QUERIES["op11_align"] = op11_align


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES["op12_whitening"] = op12_whitening


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loomcast.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


QUERIES["op13_quality"] = op13_quality
