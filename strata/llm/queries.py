"""The numbered queries on the test tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import byte_bpe, phrases, prefix_trie
from strata.llm.decontaminate import find_leaks
from strata.llm.disclosure import KINDS, personal_data
from strata.llm.html_blocks import extract_main_text
from strata.llm.jaccard_join import similarity_components
from strata.llm.ngram_ratio import score_documents
from strata.llm.packing import pack_documents
from strata.llm.passages import repeated_passages
from strata.llm.site_quality import judge
from strata.llm.snapshots import collapse_and_render
from strata.llm.token_counts import count_tokens
from strata.sources import catalog


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer file lies on this machine (every executor has the package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.load(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = catalog.load(spark, sf_dir, "documents"), catalog.load(spark, sf_dir, "benchmark")
    items = F.array_sort(F.coalesce(F.col("leak.items.item"), F.array().cast("array<string>")))
    return find_leaks(docs, benchmark, keep=["doc_id"]).select(
        "doc_id", "leak.n_words", "leak.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.load(spark, sf_dir, "documents")
    return similarity_components(docs).select("doc_id", "n_shingles", "component_id")


def op1_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(catalog.load(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    short = lambda name: F.transform(name, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, "term")) for x in (k, i)])
    every = F.array_sort(F.transform(F.concat(short("spans"), short("terms")), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select("doc_id", *counts,
                        F.sha2(F.array_join(F.transform("spans", line), ","), 256).alias("base_sha256"),
                        F.array_join(F.transform(every, line), ",").alias("spans"))


def trusted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.load(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op2_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(catalog.load(spark, sf_dir, "documents"), trusted_labels(spark, sf_dir))


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(catalog.load(spark, sf_dir, "documents"))
    line = F.transform("passages", lambda s: F.concat_ws(":", s["first"].cast("string"), s["last"].cast("string")))
    return found.select("doc_id", "n_passages", "n_dup_words", F.array_join(line, ",").alias("spans"), "partners", "component_id")


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(catalog.load(spark, sf_dir, "pages"))


def unwanted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents; unwanted are those of low quality and toxic ones."""
    return catalog.load(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("unwanted"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.load(spark, sf_dir, "documents")
    return judge(docs, unwanted_labels(spark, sf_dir), host=F.col("source"), path=F.col("lang")).select(
        F.col("k0").alias("doc_id"), "host", "path", "log_odds", "host_rate", "path_rate", "p_unwanted", "kept")


def op6_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(catalog.load(spark, sf_dir, "conversations"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(catalog.load(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = prefix_trie.turn_units(catalog.load(spark, sf_dir, "conversations"))
    ends = F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256))
    return prefix_trie.trie(prefix_trie.spliced(units)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(catalog.load(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    bpe = byte_bpe.load(tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode_documents(catalog.load(spark, sf_dir, "documents"), bpe)
    return byte_bpe.decode_documents(encoded, bpe).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_disclosure, op2_ngram_ratio, op3_passages, op4_html_blocks, op5_site_quality, op6_snapshots, op7_pack,
                                   op8_jaccard, op9_decontaminate, op10_token_counts, op11_prefix_trie, op12_collocations, op13_byte_bpe)}

ORACLE: dict[str, str] = {
    "op6_snapshots": """
WITH lines AS (
  SELECT DISTINCT conv_id, turn, role, text,
         '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS line FROM conversations),
states AS (
  SELECT conv_id, turn, count(*) OVER w AS n,
         string_agg(turn || chr(31) || coalesce(role, chr(29)) || chr(31) || coalesce(text, chr(29)), chr(30)) OVER w AS state
  FROM lines WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
ends AS (SELECT conv_id, max(n) AS n FROM states GROUP BY conv_id),
finals AS (SELECT s.state, s.n, min(s.conv_id) AS conv_id, count(*) AS n_same
           FROM states s JOIN ends e ON s.conv_id = e.conv_id AND s.n = e.n GROUP BY s.state, s.n),
earlier AS (SELECT DISTINCT s.state FROM states s JOIN ends e ON s.conv_id = e.conv_id AND s.n < e.n),
kept AS (SELECT * FROM finals f WHERE NOT EXISTS (SELECT 1 FROM earlier x WHERE x.state = f.state))
SELECT k.conv_id, k.n AS n_turns, k.n_same, string_agg(l.line, '' ORDER BY l.turn, l.role, l.text) AS rendered
FROM kept k JOIN lines l ON l.conv_id = k.conv_id GROUP BY k.conv_id, k.n, k.n_same
""",
    "op8_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[i:i + least(5, len(w)) - 1] AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.least_other, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least_other FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
""",
    "op9_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, w[i:i + least(10, len(w)) - 1] AS words
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, i, w[i:i + size - 1] AS words
           FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT p.doc_id, p.i, p.size, x.item_id FROM places p JOIN windows x ON x.size = p.size AND x.words = p.words),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id
""",
    "op11_prefix_trie": r"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS unit FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(unit ORDER BY place) AS u FROM o GROUP BY conv_id),
heads AS (
  SELECT conv_id, u, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda crc, b: list_reduce([xor(crc, b), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[],
          lambda x, one: xor(x >> 1, (x & one) * 3988292384))), 4294967295::BIGINT) % 9 AS h FROM own),
built AS (
  SELECT c.conv_id, list_concat(coalesce(p.u[1:c.h], []), coalesce(c.u[c.h + 1:], [])) AS u
  FROM heads c LEFT JOIN own p ON p.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (SELECT conv_id, len(u) AS n, d, u[1:d] AS p FROM (SELECT conv_id, u, unnest(range(len(u) + 1)) AS d FROM built)),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM prefixes GROUP BY p, d),
own_values AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.p[n.d].text) END AS saved
  FROM nodes n LEFT JOIN (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) k ON k.p = n.p AND k.d = n.d),
below AS (SELECT p[1:a] AS p, a AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT p, saved, n_children, unnest(range(d + 1)) AS a FROM own_values) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM own_values n JOIN below b ON b.p = n.p AND b.d = n.d LEFT JOIN nodes up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS (SELECT lang, k, p, count(*) AS f
      FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k))
      GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, p, string_split(p, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
longer AS (SELECT lang, p, max(a) AS a
           FROM (SELECT lang, w[1] || ' ' || w[2] AS p, a FROM cand WHERE k = 3 UNION ALL
                 SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.p, c.k, c.a, cut, x.f AS l, y.f AS r, CAST(c.a AS HUGEINT) * c.a * 1000000 // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.k = cut AND x.p = array_to_string(c.w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.p = array_to_string(c.w[cut + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.p) AS rank
  FROM weakest c LEFT JOIN longer g ON g.lang = c.lang AND g.p = c.p AND c.k = 2
  WHERE g.a IS NULL OR 100 * g.a < 50 * c.a)
SELECT r.lang, r.rank, r.p AS phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
""",
}
