"""The registered queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (alignment, decontaminate, langid, lines, minhash, mixing, ngramjoin, quality, secretscan,
                          spelling, suffixes, tokenfiles, wrappers)
from tidemark.session import prepare

QUERIES = {}
ORACLES = {}

UPPER, LOWER = lines.UPPER, lines.LOWER


def vocabulary(name: str) -> str:
    """Path of a public vocabulary; the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return run

    return register


def _read(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


SQL_WORDS = (r"coalesce(regexp_extract_all(translate(text, '" + UPPER + "', '" + LOWER
             + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])")


@query(rf"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {SQL_WORDS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n,
         unnest(list_transform(range(0, greatest(len(ws) - 9, 1)),
                               lambda i: array_to_string(ws[i + 1:i + 10], ' '))) AS w
       FROM b WHERE len(ws) > 0),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, unnest(range(0, len(ws) - n + 1)) AS i, ws FROM d, ns WHERE len(ws) >= n),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND array_to_string(ws[i + 1:i + dw.n], ' ') = w),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits)
          GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
          string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
        FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op1_decontaminate(spark, sf_dir):
    """Words of each document that a 10-word window of a benchmark item covers."""
    found = decontaminate.contamination(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                        _read(spark, sf_dir, "benchmark", "item_id", "text"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"),
                        "contaminated")


@query()
def op2_mix(spark, sf_dir):
    """Words that a mix by source weight takes of each document."""
    plan = mixing.planned(_read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op3_language(spark, sf_dir):
    """Language of each document, learned from four fifths of the labelled ones."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


@query()
def op4_secrets(spark, sf_dir):
    """Secrets in each document: pattern spans, and spans that the network adds."""
    found = secretscan.scan(_read(spark, sf_dir, "documents", "doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in secretscan.KINDS])

    def joined(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
            ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


@query()
def op5_token_files(spark, sf_dir):
    """Token files of all documents, and what they say about each document."""
    files = tokenfiles.write_tokens(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                    vocabulary("word_bpe_49k.json"))
    return tokenfiles.read_documents(files).withColumnRenamed("id", "doc_id")


@query()
def op6_repeated_bytes(spark, sf_dir):
    """Bytes that repeated 200-byte strings cover."""
    return suffixes.removed_counts(_read(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed(
        "id", "doc_id")


SQL_KEY = (r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '" + UPPER + "', '"
           + LOWER + "')")


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, {SQL_KEY} AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, i, line, f.key IS NOT NULL AND k.doc_id <> keeper AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op7_lines(spark, sf_dir):
    """Lines that five documents share, kept in the last one only."""
    found = lines.drop_repeated_lines(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op8_quality(spark, sf_dir):
    """Counts for the base rules, and the verdict with the bands of token fertility."""
    found = quality.quality(_read(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                            vocabulary("piece_bpe_32k.model"), keep_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "chars_per_token", "byte_share", "token_entropy")


@query()
def op9_main_text(spark, sf_dir):
    """Main text of each page."""
    return wrappers.main_text(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


SQL_SHINGLES = r"""
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '""" + UPPER + "', '" + LOWER + r"""'),
        '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(0, greatest(len(ws) - 2, 1)),
        lambda i: array_to_string(ws[i + 1:i + 3], ' ')))) AS sh FROM d WHERE len(ws) > 0),
c AS (SELECT sh, min(doc_id) AS rep, len(sh) AS n FROM s GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS t FROM c),
f AS (SELECT t, count(*) AS df FROM e GROUP BY t HAVING count(*) > 1),
ef AS (SELECT rep, n, e.t, row_number() OVER (PARTITION BY rep ORDER BY df, e.t) AS i,
         count(*) OVER (PARTITION BY rep) AS shared FROM e JOIN f USING (t)),
p AS (SELECT * FROM ef WHERE 10 * (n - shared + i - 1) <= n),
cand AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b ON a.t = b.t AND a.rep < b.rep
         AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n),
links AS (SELECT a, b FROM cand JOIN c x ON x.rep = a JOIN c y ON y.rep = b
          WHERE 100 * len(list_intersect(x.sh, y.sh)) >= 90 * (x.n + y.n - len(list_intersect(x.sh, y.sh)))),
both_ AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT rep, rep FROM c),
r(node, root) AS (SELECT b, a FROM both_ UNION SELECT both_.b, r.root FROM r JOIN both_ ON both_.a = r.node
                  WHERE r.root < both_.b),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node)"""


@query("WITH RECURSIVE" + SQL_SHINGLES + """
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN c ON s.sh = c.sh LEFT JOIN m ON m.node = c.rep""")
def op10_ngram_join(spark, sf_dir):
    """Documents linked by a Jaccard of 0.9 of their 3-word shingles, as components."""
    return ngramjoin.jaccard_components(_read(spark, sf_dir, "documents", "doc_id", "text"))


CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


@query(rf"""
WITH RECURSIVE bits(i, step, c) AS (
  SELECT range, 0, range FROM range(256) UNION ALL SELECT i, step + 1, {CRC_BIT} FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
r AS (SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all(
        translate(text, '{UPPER}', '{LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
u AS (SELECT id, run, count(*) AS times FROM r GROUP BY id, run),
h AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(
          range(0, octet_length(encode(id || ':' || run))),
          lambda k: CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * k + 1, 2) AS BIGINT))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM u, crc),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
        ELSE run END AS word, times FROM h),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
v AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
e AS (SELECT DISTINCT v.word AS a, words.word AS b FROM v JOIN words ON words.word = v.rest),
near AS (SELECT a, b FROM e UNION SELECT b, a FROM e
         UNION SELECT x.word, y.word FROM v x JOIN v y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY m.n DESC, encode(b)) AS form, max(m.n) AS form_n
         FROM near JOIN words m ON m.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
        CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM words LEFT JOIN best ON a = word),
up(word, root, form) AS (SELECT word, word, form FROM f
  UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.form)
SELECT f.word, f.form, root, n, n_near, form_n FROM f JOIN up ON up.word = f.word AND up.form IS NULL""")
def op11_spelling(spark, sf_dir):
    """Words of all documents, those one edit apart, and the form that each is a variant of."""
    return spelling.variants(_read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def _at_85(sql: str) -> str:
    """The shingle SQL for 85 hundredths of the union instead of 90."""
    for ninety, lower in (("10 * (n - shared + i - 1) <= n", "100 * (n - shared + i - 1) <= 15 * n"),
                          ("10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n", "100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n"),
                          (">= 90 *", ">= 85 *")):
        assert sql.count(ninety) == 1
        sql = sql.replace(ninety, lower)
    return sql


@query("WITH RECURSIVE" + _at_85(SQL_SHINGLES) + """
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id,
  coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN c ON s.sh = c.sh LEFT JOIN m ON m.node = c.rep""")
def op12_minhash(spark, sf_dir):
    """Documents linked by a Jaccard of 0.85 of their 3-word shingles, as components."""
    found = minhash.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), n=3, percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query()
def op13_alignment(spark, sf_dir):
    """Alignment of each document's tokens in two public vocabularies."""
    return alignment.align(_read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_50k.json"),
                           vocabulary("piece_bpe_32k.model"))
