"""One query for each operator, with production parameters over whole tables; and SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fim, licenses, lines, mixing, quality, recompression, secrets, simhash, substrings, tokens, toxicity, vectors
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("h", "slots")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a directory, and a language one below it."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    found = licenses.scan_licenses(docs.select(path.alias("path"), "text"))
    doc_id = F.try_element_at(F.split("path", "/"), F.lit(-1)).try_cast("long")
    return found.select(doc_id.alias("doc_id"), "own_license", "score", "n_headers", "license", "whence")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_output(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(read_table(spark, sf_dir, "documents")).drop("starts", "ends")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, keep=["doc_id"], words=secrets.frequent_words(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *decontaminate.digest())


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.drop_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectors.encode(read_table(spark, sf_dir, "embeddings"))
    code = F.lower(F.concat(*[F.substring(F.hex("codes"), 4 * i + 1, 2) for i in range(vectors.PARTS)]))
    digest = hashlib.sha256(vectors.codebook_text(books).encode()).hexdigest()
    return vectors.label_errors(coded).select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = F.sha2(fim.restored(F.col("output"), F.col("form")), 256)
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), back.alias("restored_sha256"))


def queries() -> dict[str, Query]:
    return {"op1_simhash": op1_simhash, "op2_mixing": op2_mixing, "op3_licenses": op3_licenses, "op4_tokens": op4_tokens, "op5_substrings": op5_substrings, "op6_quality": op6_quality, "op7_secrets": op7_secrets, "op8_toxicity": op8_toxicity, "op9_decontamination": op9_decontamination, "op10_lines": op10_lines, "op11_recompression": op11_recompression, "op12_vectors": op12_vectors, "op13_fim": op13_fim}


#: The tree of line templates; tokens are parted by ASCII white space, as the operator parts them.
OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos, trim(regexp_replace(line, '[\x09-\x0D\x20]+', ' ', 'g')) AS raw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
), masks AS (
  SELECT *, string_split(regexp_replace(raw, '[^ ]*[0-9][^ ]*', '<*>', 'g'), ' ') AS ts FROM lines WHERE raw <> ''
), tokens AS (
  SELECT *, len(ts) AS n, array_to_string(ts, ' ') AS masked, 2 * len(list_filter(ts, lambda t: t <> '<*>')) >= len(ts) AS fixed FROM masks
), kinds AS (
  SELECT DISTINCT masked, ts, n, array_to_string(ts[1:3], ' ') AS lead FROM tokens WHERE fixed AND n > 3
), crowded AS (
  SELECT n, lead FROM kinds GROUP BY n, lead HAVING count(*) > 8
), places AS (
  SELECT masked, n, lead, unnest(ts) AS t, unnest(range(n)) AS pos FROM kinds SEMI JOIN crowded USING (n, lead)
), slots AS (
  SELECT n, lead, pos, t, count(*) AS c FROM places WHERE pos >= 3 AND t <> '<*>' GROUP BY n, lead, pos, t HAVING count(*) > 8
), counted AS (
  SELECT p.masked, p.n, p.pos, p.t, coalesce(s.c, 1) AS c FROM places p LEFT JOIN slots s ON s.n = p.n AND s.lead = p.lead AND s.pos = p.pos AND s.t = p.t
), sorted AS (
  SELECT masked, any_value(n) AS n, count(*) FILTER (pos < 3 AND t <> '<*>') AS lead_n, list(c ORDER BY c DESC) FILTER (pos >= 3) AS s FROM counted GROUP BY masked
), gaps AS (
  SELECT masked, s[k] AS least, s[k] / s[k + 1] AS ratio FROM (SELECT *, unnest(range(1, len(s))) AS k FROM sorted) WHERE 2 * (lead_n + k) >= n AND s[k] > 8
  QUALIFY row_number() OVER (PARTITION BY masked ORDER BY s[k] / s[k + 1] DESC, k) = 1
), held AS (
  SELECT masked, any_value(least) AS least, string_agg(CASE WHEN pos < 3 OR c >= least THEN t ELSE '<*>' END, ' ' ORDER BY pos) AS template
  FROM counted JOIN gaps USING (masked) WHERE ratio >= 2 GROUP BY masked
), general AS (
  SELECT masked, 't ' || template AS template FROM held SEMI JOIN (SELECT template FROM held GROUP BY template HAVING count(*) > 8 AND 2 * count(*) >= min(least)) USING (template)
), named AS (
  SELECT doc_id, pos, coalesce(template, CASE WHEN fixed THEN 'm ' || tokens.masked ELSE 'r ' || raw END) AS template, template IS NULL AND n >= 20 AS own
  FROM tokens LEFT JOIN general ON fixed AND general.masked = tokens.masked
), bad AS (
  SELECT template, own, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first FROM named GROUP BY template, own
  HAVING count(DISTINCT doc_id) >= 10 OR own AND count(DISTINCT doc_id) > 1
), dropped AS (
  SELECT doc_id, pos FROM named JOIN bad USING (template, own) WHERE n_docs >= 10 OR doc_id <> first
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM lines l ANTI JOIN dropped d ON d.doc_id = l.doc_id AND d.pos = l.pos GROUP BY l.doc_id
), n_lines AS (SELECT doc_id, count(*) AS n_lines FROM tokens GROUP BY doc_id), n_dropped AS (SELECT doc_id, count(*) AS n_dropped FROM dropped GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN n_lines a ON a.doc_id = d.doc_id LEFT JOIN n_dropped b ON b.doc_id = d.doc_id
"""


#: The schedule's points and blocks, in integers; the hash that orders documents is MD5.
OP2_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('17 ' || coalesce(doc_id::VARCHAR, '-') || ' ' || coalesce(text, '')) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][place % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS bound FROM s
), u AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(weight) OVER () AS sum_w, sum(bound) OVER upto AS bounds, sum(weight) OVER upto AS weights
  FROM w WINDOW upto AS (ORDER BY bound / weight, place ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT *, (total - bounds + bound) / (sum_w - weights + weight) AS level FROM u
), t AS (
  SELECT source, place, source_size, least(bound, (SELECT level FROM l WHERE bound / weight >= level - 1e-9 ORDER BY bound / weight, place LIMIT 1) * weight) AS target FROM l
), b AS (
  SELECT sum(target) AS words, count(*) AS sources, greatest(1, least({mixing.BLOCK_WORDS}, floor(sum(target) / {mixing.LEAST_SLOTS})))::BIGINT AS block FROM t
), k AS (
  SELECT *, greatest(least({mixing.PATTERN}, length(bin((words::BIGINT + block - 1) // block))), length(bin(64 * sources)))::BIGINT AS bits FROM b
), part AS (
  SELECT *, coalesce(lag(high) OVER (ORDER BY place), 0) AS low FROM (
    SELECT t.*, block, bits, (round(sum(target) OVER (ORDER BY place) / sum(target) OVER () * ((1::BIGINT << bits) - count(*) OVER ())) + row_number() OVER (ORDER BY place))::BIGINT AS high,
      ceil(source_size / block)::BIGINT AS rounds, floor(target / source_size) AS times
    FROM t, k WHERE target >= 0.5)
), points AS (
  SELECT place, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank, slot FROM (
    SELECT place, list_sum([((point >> i) & 1) << (bits - 1 - i) for i in range(bits)])::BIGINT AS slot
    FROM (SELECT place, bits, unnest(range(low, high)) AS point FROM part))
), ranks AS (
  SELECT *, unnest(range((times * rounds + ceil((target - times * source_size) / block))::BIGINT)) AS rank FROM part
), takes AS (
  SELECT * FROM (
    SELECT r.place, r.rank % rounds AS block_no, r.rank // (high - low) * (1::BIGINT << bits) + p.slot AS slot,
      least(block, source_size - r.rank % rounds * block, round(target)::BIGINT - r.rank // rounds * source_size - r.rank % rounds * block) AS take
    FROM ranks r JOIN points p ON p.place = r.place AND p.rank = r.rank % (high - low)) WHERE take > 0
), placed AS (
  SELECT doc_id, size, source_size, target, t.place, (sum(size) OVER (PARTITION BY t.place ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized JOIN t ON t.source IS NOT DISTINCT FROM sized.source
), pieces AS (
  SELECT place, start, size, block, unnest(range(start // block, (start + size - 1) // block + 1)) AS block_no FROM placed, k WHERE size > 0
), got AS (
  SELECT p.place, start, slot, least(start + size - p.block_no * block, block, take) - greatest(start - p.block_no * block, 0) AS got
  FROM pieces p JOIN takes x ON x.place = p.place AND x.block_no = p.block_no
), taken AS (SELECT place, start, sum(got)::BIGINT AS taken, min(slot) AS first_slot FROM got WHERE got > 0 GROUP BY place, start)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot
FROM placed p LEFT JOIN taken x ON x.place = p.place AND x.start = p.start AND size > 0
"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Windows of items against windows of documents, word by word.
OP9_SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw JOIN sizes ON len(w) >= size)
), found AS (SELECT doc_id, i, places.size AS size, item_id FROM places JOIN phrases USING (phrase, size)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN items ON items.doc_id = dw.doc_id
"""


_TEMPLATES = ", ".join("('{}', {}, '{}')".format(name, k, t.replace("'", "''")) for name, texts in licenses.tagged(licenses.TEMPLATES).items() for k, t in enumerate(texts))
_TERMS = r"regexp_extract_all(lower({}), '(?:[\p{{L}}\p{{N}}]|\.\p{{N}})+')"
_CUED = "regexp_matches({}, '" + licenses.CUE + "')"
#: Licence headers and files by cosine, and the licence files of directories.
OP3_SQL = rf"""
WITH tpl AS (SELECT * FROM (VALUES {_TEMPLATES}) v(license, variant, template)),
tterm AS (SELECT license, variant, unnest({_TERMS.format("template")}) AS w FROM tpl),
known AS (SELECT DISTINCT w FROM tterm),
n AS (SELECT count(*) AS n FROM documents),
freq AS (SELECT w, count(*) AS df FROM (SELECT DISTINCT k, w FROM (SELECT row_number() OVER () AS k, unnest({_TERMS.format("text")}) AS w FROM documents)) SEMI JOIN known USING (w) GROUP BY w),
idf AS (SELECT w, 1 + ln((n + 1)::DOUBLE / (coalesce(df, 0) + 1)) AS idf FROM known CROSS JOIN n LEFT JOIN freq USING (w)),
tvec AS (SELECT license, variant, w, count(*) * any_value(idf) AS x FROM tterm JOIN idf USING (w) GROUP BY 1, 2, 3),
tnorm AS (SELECT license, variant, sqrt(sum(x * x)) AS tnorm FROM tvec GROUP BY 1, 2),
cued AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: {_CUED.format("x")}) AS lines FROM documents WHERE {_CUED.format("text")}),
unit AS (
  SELECT doc_id, lines, true AS whole, text AS unit FROM cued
  UNION ALL SELECT DISTINCT doc_id, lines, false, unit FROM (
    SELECT doc_id, lines, unnest(list_concat(lines,
      list_filter(flatten(list_transform(lines, lambda x: string_split(regexp_replace(x, '{licenses.SENTENCE}', '\1' || chr(10), 'g'), chr(10)))), lambda x: {_CUED.format("x")}),
      list_filter(string_split_regex(text, '{licenses.PARAGRAPH}'), lambda x: {_CUED.format("x")}))) AS unit FROM cued)
),
uterm AS (SELECT unit, unnest({_TERMS.format("unit")}) AS w FROM (SELECT DISTINCT unit FROM unit)),
uvec AS (SELECT unit, u.w AS w, count(*) * coalesce(any_value(idf), 1 + ln((any_value(n) + 1)::DOUBLE)) AS x FROM uterm u CROSS JOIN n LEFT JOIN idf k ON k.w = u.w GROUP BY 1, 2),
unorm AS (SELECT unit, sqrt(sum(x * x)) AS unorm FROM uvec GROUP BY 1),
dots AS (SELECT unit, license, variant, sum(uvec.x * tvec.x) AS d FROM uvec JOIN tvec USING (w) GROUP BY 1, 2, 3),
cosine AS (SELECT unit, license, round(d / (unorm * tnorm), 6) AS score FROM dots JOIN unorm USING (unit) JOIN tnorm USING (license, variant)),
best AS (SELECT unit, license, score FROM cosine QUALIFY row_number() OVER (PARTITION BY unit ORDER BY score DESC, license) = 1),
scored AS (SELECT doc_id, len(lines) AS n_headers, whole, license, score FROM unit JOIN best USING (unit) WHERE score >= 0.7),
own AS (SELECT doc_id, n_headers, license AS own_license, score FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
place AS (SELECT doc_id, coalesce(source, '-') || '/' || coalesce(lang, '-') AS dir FROM documents),
dirs AS (SELECT dir, license AS dir_license FROM scored JOIN place USING (doc_id) WHERE whole QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1)
SELECT p.doc_id, own_license, score, coalesce(n_headers, 0)::INTEGER AS n_headers, coalesce(own_license, dir_license) AS license,
  CASE WHEN own_license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'dir:' || p.dir END AS whence
FROM place p LEFT JOIN own USING (doc_id) LEFT JOIN dirs ON dirs.dir = p.dir
"""


#: Windows of 50 words as texts; a word goes if one of the 50 windows over it starts in an earlier document, too.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT windows.doc_id, i FROM windows JOIN firsts USING (s) WHERE windows.doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
marked AS (
  SELECT doc_id, i, word, max(hit.i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN hit USING (doc_id, i)
), sums AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN sums USING (doc_id)
"""


def _assigned(k: int) -> str:
    return f"""a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x, min(d) // 256 AS d, min(d) % 256 AS k FROM (
    SELECT vec_id, label, p, x, (list_inner_product(x, x) - 2 * list_inner_product(x, e) + list_inner_product(e, e))::BIGINT * 256 + k AS d FROM parts JOIN b{k} USING (p)
  ) GROUP BY vec_id, p
)"""


def _moved(k: int) -> str:
    return f"""m{k} AS (
  SELECT p, k, list(e ORDER BY i) AS e FROM (
    SELECT p, k, i, floor(sum(v) / count(*)) AS e FROM (SELECT p, k, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{k}) GROUP BY p, k, i
  ) GROUP BY p, k
), b{k + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{k}.e, b{k}.e) AS e FROM b{k} LEFT JOIN m{k} USING (p, k))"""


#: Product codes, each part against all entries: four rounds, then the codes. All numbers are integers below 2^53.
OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM (SELECT *, unnest(range(4)) AS p FROM kept)
), b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS e FROM parts SEMI JOIN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256) USING (vec_id)
), {", ".join(f"{_assigned(k)}, {_moved(k)}" for k in range(4))}, {_assigned(4)},
coded AS (SELECT vec_id, any_value(label) AS label, string_agg(lower(format('{{:02x}}', k)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY p, k, i)) AS codebooks_sha256 FROM (SELECT p, k, unnest(e) AS v, unnest(range(len(e))) AS i FROM b4))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, book
"""


#: Cuts at code points from the hash of the id; the text is rebuilt from the three parts.
OP13_SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), k AS (
  SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM h
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k
), p AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2_SQL, "op3_licenses": OP3_SQL, "op9_decontamination": OP9_SQL, "op10_lines": OP10_SQL, "op11_recompression": OP11_SQL, "op12_vectors": OP12_SQL, "op13_fim": OP13_SQL}
