"""The named queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (exact, hamming, infill, jaccard, lines, mixing, packing, phrases, pii, quality, repeats, toxicity,
                          warc)
from quayside.llm.common import table
from quayside.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


@query("op1_crf_toxicity")
def op1(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, row=F.struct("doc_id"))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), toxicity.held_out(doc_id).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


@query("op2_distribution_divergence")
def op2(spark, sf_dir):
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@query("op3_pack_sum_of_squares")
def op3(spark, sf_dir):
    import public_tokenizers
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


_SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, {_SPACES_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20
             GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.doc_id, k.line, k.pos, coalesce(k.doc_id <> f.keep_id, false) AS dropped
           FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op4_suffix_tree_dedup")
def op4(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN f.first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first < page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


@query("op5_zip_warc", OP5_SQL)
def op5(spark, sf_dir):
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).drop("url", "payload")


@query("op6_line_dedup", OP6_SQL)
def op6(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# Water filling in closed form: with sources ordered by cap / weight, the first k are capped for
# the smallest k whose remaining share per weight reaches no further cap.
OP7_SQL = r"""
WITH sizes AS (SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM sizes GROUP BY source),
named AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
          2 * source_size AS cap FROM totals),
ranked AS (SELECT *, row_number() OVER (ORDER BY cap / w, source ASC NULLS LAST) AS k FROM named),
running AS (SELECT k, cap / w AS ratio,
    1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS over_w FROM ranked
    WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, over_w FROM running WHERE rest / over_w <= ratio ORDER BY k LIMIT 1),
targets AS (SELECT source, source_size, least(w * rest / over_w, cap) AS target FROM named, level),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
drawn AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.rate,
    CAST('0x' || substr(md5(concat_ws(':', '7', d.doc_id::VARCHAR, d.size::VARCHAR)), 1, 13) AS BIGINT)::DOUBLE
        / 4503599627370496.0 AS draw
    FROM sizes d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn
"""


@query("op7_mix_sources", OP7_SQL)
def op7(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_weak_supervision_pii")
def op8(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda c: F.concat_ws(
            ":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


@query("op9_jaccard_join")
def op9(spark, sf_dir):
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), size=4, percent=85)


OP10_SQL = """
WITH groups AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
                FROM documents GROUP BY coalesce(text, ''))
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
FROM documents d JOIN groups g ON coalesce(d.text, '') = g.t
"""


@query("op10_exact_dedup", OP10_SQL)
def op10(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op11_multi_index_hashing")
def op11(spark, sf_dir):
    return hamming.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
c AS (SELECT doc_id, t, string_split(t, chr(10)) AS ls,
             length(t) - length(replace(t, chr(10), '')) + (t <> '' AND right(t, 1) <> chr(10))::INT AS n,
             ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
             ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN t ELSE array_to_string(ls[1:a], chr(10)) || chr(10) END AS head,
             CASE WHEN b = 0 THEN '' WHEN b = n THEN t ELSE array_to_string(ls[1:b], chr(10)) || chr(10) END AS upto FROM k),
o AS (SELECT *, substr(upto, length(head) + 1) AS middle, substr(t, length(upto) + 1) AS suffix FROM p)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(head)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark, sf_dir):
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"), unit="lines")
    again = infill.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(again.cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
spans AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' ')))
          AS phrase FROM runs, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM spans GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS b WHERE b.lang = c.lang AND b.k > c.k AND b.f >= c.f
         AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT *, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS ws FROM kept),
scored AS (SELECT c.lang, c.phrase, c.f AS a, c.cut, l.f AS l, r.f AS r, n.n,
           (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
           JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:], ' ') JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank::INT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


@query("op13_phrase_collocations", OP13_SQL)
def op13(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=5, least=100, top=2000)


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
