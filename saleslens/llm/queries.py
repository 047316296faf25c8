"""The queries of the operators over their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        return run
    return deco


@register("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    from saleslens.llm.html_extract import extract
    return extract(table(spark, sf_dir, "pages"))


@register("op2_embedding_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    from saleslens.llm.embeddings import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@register("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences of 2048 ids."""
    from saleslens.llm.packing import pack
    from saleslens.llm.tokens import tokenizer_path
    placed, _ = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1, length=2048)
    return placed.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")


@register("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    from saleslens.llm.tokenfile import read_tokens, write_tokens
    from saleslens.llm.tokens import tokenizer_path
    from saleslens.session import fresh_dir
    folder = fresh_dir(spark, "tokens")
    manifest = write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, folder=folder)
    return read_tokens(manifest, folder, keep_ids=False).drop("ids")


@register("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that contaminate them."""
    from saleslens.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labels of two folds of three."""
    from saleslens.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_simhash_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents: 4-word shingles, 4 bits."""
    from saleslens.llm.simhash import simhash_dedup
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@register("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a repeated window of 35 words covers, in all documents."""
    from saleslens.llm.substrings import word_digests
    return word_digests(table(spark, sf_dir, "documents"))


@register("op9_hmm_scores")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden Markov and unigram scores of all documents."""
    from saleslens.llm.hmm import score_texts
    return score_texts(table(spark, sf_dir, "documents"))


@register("op10_warc")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, written and read back."""
    from saleslens.llm.warc import read_archives, write_archives
    from saleslens.session import fresh_dir
    folder = fresh_dir(spark, "warc")
    found = read_archives(write_archives(table(spark, sf_dir, "pages"), folder), folder, whole=True)
    return found.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op11_line_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share, in all documents."""
    from saleslens.llm.lines import line_digests
    return line_digests(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


@register("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the forms that they are spelling variants of."""
    from saleslens.llm.variants import spelling_variants
    return spelling_variants(table(spark, sf_dir, "documents"), least=7, every=31, min_count=2, ratio=10)


@register("op13_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of all documents."""
    from saleslens.llm.phrases import collocations
    return collocations(table(spark, sf_dir, "documents"), longest=5, least=100, top=2000, within=100)


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last > page_id THEN last END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
ORACLES["op2_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a AS node, b AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS least FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON a = vec_id LEFT JOIN c ON node = vec_id
"""


ORACLES["op5_decontamination"] = r"""
WITH i AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
si AS (SELECT item_id, len(w) AS m, q, list_slice(w, q + 1, q + 5) AS s FROM i, unnest(range(greatest(len(w) - 4, 1))) u(q) WHERE len(w) > 0),
sd AS (SELECT doc_id, len(w) AS n, p, list_slice(w, p + 1, p + 5) AS s FROM d, unnest(range(greatest(len(w) - 4, 1))) u(p) WHERE len(w) > 0),
win AS (SELECT DISTINCT doc_id, item_id, m, n, greatest(0, least(p - q, n - m)) AS start FROM sd JOIN si USING (s)),
ws AS (SELECT win.doc_id, item_id, start, s, count(*) AS c FROM win JOIN sd ON sd.doc_id = win.doc_id AND p >= start AND (p + 5 <= start + m OR p = 0 AND win.n < 5 OR m < 5 AND FALSE)
       GROUP BY ALL),
ic AS (SELECT item_id, s, count(*) AS c FROM si GROUP BY ALL),
tw AS (SELECT doc_id, item_id, start, sum(c) AS total FROM ws GROUP BY ALL),
ti AS (SELECT item_id, sum(c) AS total FROM ic GROUP BY ALL),
sh AS (SELECT doc_id, item_id, start, sum(least(ws.c, ic.c)) AS common FROM ws JOIN ic USING (item_id, s) GROUP BY ALL)
SELECT doc_id, item_id, max(common::DOUBLE / (tw.total + ti.total - common)::DOUBLE) AS similarity
FROM sh JOIN tw USING (doc_id, item_id, start) JOIN ti USING (item_id)
WHERE common::DOUBLE / (tw.total + ti.total - common)::DOUBLE >= 0.8 GROUP BY doc_id, item_id
"""


ORACLES["op11_line_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, text, pos, lines[pos] AS line,
             translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos FROM d) s),
g AS (SELECT key FROM (SELECT DISTINCT key, doc_id, text FROM l WHERE key <> '') s GROUP BY key HAVING count(*) >= 10),
k AS (SELECT l.*, g.key IS NOT NULL AS gone FROM l LEFT JOIN g ON l.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM k GROUP BY doc_id, text
"""


ORACLES["op13_collocations"] = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM t),
n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, list_slice(w, i, i + k - 1) AS ws FROM p, unnest(range(1, len(w) + 1)) a(i), range(1, 6) b(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, ws, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
e AS (SELECT lang, ws[1:len(ws) - 1] AS ws, f FROM f WHERE len(ws) > 2 UNION ALL SELECT lang, ws[2:], f FROM f WHERE len(ws) > 2),
c AS (SELECT f.lang, f.ws, f.f AS a FROM f LEFT JOIN (SELECT lang, ws, max(f) AS b FROM e GROUP BY ALL) m USING (lang, ws)
      WHERE len(f.ws) > 1 AND (b IS NULL OR 100 * b < 100 * f.f)),
k AS (SELECT c.lang, c.ws, a, k, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
      FROM c JOIN n ON n.lang = c.lang, range(1, 5) j(k), f x, f y
      WHERE k < len(c.ws) AND x.lang = c.lang AND y.lang = c.lang AND x.ws = c.ws[1:k] AND y.ws = c.ws[k + 1:]),
s AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, n, l, r, score FROM k QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s) z WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
