"""The registered queries of this package: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, mixing, packing, prefix_trie, quality, repetition, shards, simhash, suffixes, toxicity, warc
from .common import staged, table


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# fixed values: the vocabulary's split pattern and its free id
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_ID = 50256


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, PATTERN, END_ID)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


OP2_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to, true AS intact
FROM o
"""

# said by a user and an assistant who quote a template's control strings
QUOTING = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.formatted_conversations(rows.unionByName(spark.createDataFrame(QUOTING, rows.schema)))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(CONTROLS)', '\1\\\2\3', 'g') AS et,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
                        '([<\[])(\\*)(CONTROLS)', '\1\\\2\3', 'g') AS er
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(3 + length(er) + 1 + length(et) + 4)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""".replace("CONTROLS", r"s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(rows)


OP4_SQL = f"""
WITH RECURSIVE tot AS (
  SELECT CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS src, count(*) AS n_rows
  FROM documents GROUP BY 1),
sz AS (SELECT greatest({mixing.CYCLE}, 4 * count(*)) AS q, count(*) AS k, sum(pow(n_rows::DOUBLE, {mixing.TEMPERATURE})) AS w FROM tot),
ex AS (SELECT src, n_rows, q, k, pow(n_rows::DOUBLE, {mixing.TEMPERATURE}) / w * (q - k) AS e FROM tot, sz),
parts AS (
  SELECT src, n_rows, q,
         (1 + floor(e) + CASE WHEN row_number() OVER (ORDER BY e - floor(e) DESC, src)
                                   <= q - k - sum(floor(e)) OVER () THEN 1 ELSE 0 END)::BIGINT AS p
  FROM ex),
num AS (SELECT *, row_number() OVER (ORDER BY src) - 1 AS i FROM parts),
one AS (SELECT q, list(p ORDER BY src) AS ps FROM parts GROUP BY q),
edf AS (
  SELECT -1::BIGINT AS t, -1::BIGINT AS i, list_transform(ps, lambda x: 0::BIGINT) AS done FROM one
  UNION ALL
  SELECT t, pick, list_transform(done, lambda d, j: d + CASE WHEN j = pick + 1 THEN 1 ELSE 0 END) FROM (
    SELECT edf.t + 1 AS t, done, list_min(list_transform(
      list_filter(range(len(ps)), lambda x: done[x + 1] < ps[x + 1] AND done[x + 1] * q // ps[x + 1] <= edf.t + 1),
      lambda x: ((done[x + 1] + 1) * q + ps[x + 1] - 1) // ps[x + 1] * 1000000 + x)) % 1000000 AS pick
    FROM edf, one WHERE edf.t + 1 < q)),
cyc AS (
  SELECT num.src, num.p, num.q, edf.t AS place, row_number() OVER (PARTITION BY num.src ORDER BY edf.t) - 1 AS turn
  FROM edf JOIN num USING (i) WHERE edf.t >= 0),
ends AS (
  SELECT min(ceil(n_rows / {mixing.BLOCK_ROWS}.0)::BIGINT // cyc.p * cyc.q + place) AS stop
  FROM cyc JOIN tot USING (src) WHERE turn = ceil(n_rows / {mixing.BLOCK_ROWS}.0)::BIGINT % cyc.p),
d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS src,
         (row_number() OVER (PARTITION BY source ORDER BY coalesce(doc_id, 0) % {mixing.BUCKETS}, doc_id) - 1)
         // {mixing.BLOCK_ROWS} AS block
  FROM documents)
SELECT doc_id, source, block, block * q // p AS release, ((block + 1) * q + p - 1) // p AS due,
       block // p * q + place AS slot, block // p * q + place < stop AS in_mix
FROM d JOIN (SELECT DISTINCT src AS s2, p AS p2 FROM cyc) ON src = s2
JOIN cyc ON cyc.src = d.src AND turn = block % p2, ends
"""


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.verdicts(repetition.repetition_stats(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words")


_WORD = r"'[^\x20\x09-\x0D]+'"


def _covered_sql(k: int) -> str:
    """Per document, the words in windows of k words that occur twice or more in it."""
    return f"""
    SELECT doc_id, count(DISTINCT i + j) AS n FROM (
      SELECT doc_id, i, unnest(range({k})) AS j FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, md5(array_to_string(words[i:i + {k - 1}], ' '))) AS c
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {k} + 2)) AS i FROM w)) WHERE c > 1)
    GROUP BY doc_id"""


# no repeat is longer than the limit: no window of one word more occurs twice
OP5_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
c3 AS ({_covered_sql(repetition.WINDOW)}),
cm AS ({_covered_sql(repetition.MIN_REPEAT)}),
cl AS ({_covered_sql(repetition.MAX_LONGEST + 1)}),
b AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD})) AS lines
  FROM w),
r AS (
  SELECT b.doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c3.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(cm.n, 0) AS BIGINT) AS n_covered_words,
         cl.n IS NOT NULL AS too_long
  FROM b LEFT JOIN c3 USING (doc_id) LEFT JOIN cm USING (doc_id) LEFT JOIN cl USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND n_covered_words <= {repetition.MAX_COVERED}::DOUBLE * n_words AND NOT too_long AS kept, n_covered_words
FROM r
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copy_groups(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_table(table(spark, sf_dir, "documents"))


# CRC32 byte by byte, from the table of its polynomial
OP8_SQL = """
WITH t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
b AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)) AS bytes
  FROM documents),
p AS (
  SELECT doc_id, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
         sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id) AS rn
  FROM b, t),
s AS (SELECT *, CAST(least(39, (2 * before + size) * 40 // (2 * total)) AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(rn - min(rn) OVER (PARTITION BY shard) AS BIGINT) AS slot,
       CAST(NULL AS INT) AS grown_shard
FROM s
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' source is the host, and their language in it the path."""
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                    F.col("source"), F.col("lang"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "start_word", "end_word", "later_copy")


OP10_SQL = f"""
WITH w AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS nr, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
g AS (
  SELECT doc_id, nr, i, md5(array_to_string(words[i + 1:i + {suffixes.MIN_WORDS}], ' ')) AS h
  FROM (SELECT doc_id, nr, words, unnest(range(0, len(words) - {suffixes.MIN_WORDS} + 1)) AS i FROM w)),
r AS (
  SELECT doc_id, nr, i, count(*) OVER (PARTITION BY h) AS c,
         row_number() OVER (PARTITION BY h ORDER BY nr, i) > 1 AS later FROM g),
m AS (
  SELECT doc_id, nr, later, i, coalesce(i <= lag(i) OVER p + {suffixes.MIN_WORDS}, false) AS joins FROM r WHERE c > 1
  WINDOW p AS (PARTITION BY nr, later ORDER BY i)),
n AS (
  SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY nr, later ORDER BY i ROWS UNBOUNDED PRECEDING) AS k
  FROM m)
SELECT any_value(doc_id) AS doc_id, CAST(min(i) AS INT) AS start_word, CAST(max(i) + {suffixes.MIN_WORDS} AS INT) AS end_word, later AS later_copy
FROM n GROUP BY nr, later, k
"""


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def shared_beginnings(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation begins with up to three turns of the one whose id is a multiple of 20 below its own."""
    own = ids.select("conv_id", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).alias("h"),
                     (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    first = turns.where("pos <= 3").select(F.col("conv_id").alias("base"), "pos", "hash", "words")
    taken = own.join(first, "base").where("pos <= h").select("conv_id", "pos", "hash", "words")
    size = first.groupBy("base").agg(F.max("pos").alias("size"))
    rest = turns.join(own.join(size, "base", "left"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("size", F.lit(0)))).alias("pos"), "hash", "words")
    return taken.unionByName(rest)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    turns = staged(prefix_trie.turns_in_order(rows), "turns")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    return prefix_trie.trie_nodes(shared_beginnings(turns, ids), ids)


# a node's ancestors are the prefixes, down to its depth, of its smallest member
OP12_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), t),
size AS (SELECT conv_id AS base, count(*) AS n FROM o GROUP BY 1),
r AS (
  SELECT i.conv_id, o.pos, role, text FROM i JOIN o ON o.conv_id = base WHERE pos <= h
  UNION ALL
  SELECT i.conv_id, pos - h + least(h, coalesce(n, 0)), role, text
  FROM i JOIN o ON o.conv_id = i.conv_id LEFT JOIN size USING (base) WHERE pos > h),
p AS (
  SELECT conv_id, pos AS depth, CAST(len(regexp_extract_all(text, {_WORD})) AS BIGINT) AS words,
         md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS key
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM i),
q AS (
  SELECT *, lag(key) OVER c AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM p
  WINDOW c AS (PARTITION BY conv_id ORDER BY depth)),
v AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(up) AS up,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM q GROUP BY depth, key),
k AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL),
n AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k USING (depth, key)),
s AS (
  SELECT p.depth, p.key, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s USING (depth, key) LEFT JOIN n AS a ON a.depth = n.depth - 1 AND a.key = n.up
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


QUERIES = {
    "op1_packing": (op1_packing, None),
    "op2_warc": (op2_warc, OP2_SQL),
    "op3_chat": (op3_chat, OP3_SQL),
    "op4_mixing": (op4_mixing, OP4_SQL),
    "op5_repetition": (op5_repetition, OP5_SQL),
    "op6_simhash": (op6_simhash, None),
    "op7_decontamination": (op7_decontamination, None),
    "op8_shards": (op8_shards, OP8_SQL),
    "op9_quality": (op9_quality, None),
    "op10_suffixes": (op10_suffixes, OP10_SQL),
    "op11_toxicity": (op11_toxicity, None),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_alignment": (op13_alignment, None),
}
