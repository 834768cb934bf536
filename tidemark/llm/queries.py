"""Registered queries of the text operators, over the whole tables, and their SQL.

Each query applies its operator with production settings and reduces its output to the columns
that are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe, chat, divergence, lbl, nbsvm, near, packing, rabitq, repair, repeats, revisits, runs, simhash
from tidemark.session import join_on, ship_with_tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, decoded again; digests of both."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded.select("doc_id", "ids"), ranks)

    def digests(batches):
        for batch in batches:
            ids = batch.column(1)
            bounds, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            of_ids = [hashlib.sha256(values[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(of_ids, pa.string()), batch.column(2)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded"],
            )

    made = decoded.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")
    return made.withColumn("decoded", F.sha2("decoded", 256)).withColumnRenamed("decoded", "decoded_sha256")


def op1_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rabitq.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_inner_product(v.x, q.x) / (sqrt(list_inner_product(v.x, v.x)) * sqrt(list_inner_product(q.x, q.x))) AS score
  FROM v JOIN v AS q ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target examples of all conversations, and what can be read back from them."""
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    examples = chat.chat_examples(rows).select(
        "conv_id", "example", "turns", F.length("formatted").alias("chars"), chat.loss_text().alias("loss"),
        F.when(F.col("is_last"), chat.read_turns(F.col("formatted"))).alias("read"),
    )
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    examples = examples.select("conv_id", "example", "chars", "loss", F.size("read").alias("n"), F.sha2(said, 256).alias("turns_sha256"))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda e: e["loss"]), "")
    return examples.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        loss.alias("loss"), F.sum("chars").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(text, '(\\*)(</?s>|\[/?INST\]|\[/?SYS\]|\[OUT\]|\[ROLE=|\[/ROLE\])', '\1\1\\\2', 'g'))
      + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 11 ELSE 16 + length(url_encode(role)) END AS chars
  FROM rows
),
e AS (SELECT *, 3 + sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR i = n THEN upto END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear log10 probabilities of every text, learned from four of five folds."""
    held = nbsvm.held_out(F.col("doc_id"), 5, 1)
    scored = lbl.lm_scores(table(spark, sf_dir, "documents"), "doc_id", "text", ~held)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every text once repeated 35-word windows are removed."""
    kept = repeats.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + k AS p FROM rep, range(35) AS r(k)),
words AS (SELECT rid, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
stay AS (
  SELECT words.rid, string_agg(word, ' ' ORDER BY words.p) AS kept, count(*) AS n
  FROM words ANTI JOIN gone ON words.rid = gone.rid AND words.p = gone.p GROUP BY words.rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stay ON d.rid = stay.rid
"""

def op10_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links at 0.8 or more, its links to different texts and its copies."""
    marked = near.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    marked = marked.select("doc_id", "class_no", "n_links", "n_copies")
    classes = marked.groupBy("class_no").agg(F.min("doc_id").alias("class_id"))
    return marked.join(classes, "class_no").select("doc_id", "class_id", "n_links", "n_copies")


OP10_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
sh AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0
),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rid <> b.rid GROUP BY 1, 2),
link AS (
  SELECT x, y, c = nx.n AND c = ny.n AS same FROM p JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y
  WHERE 5 * c >= 4 * (nx.n + ny.n - c)
),
sets AS (
  SELECT d.rid, least(d.rid, min(y)) AS set_id, count(y) + 1 AS n_copies
  FROM d LEFT JOIN link ON link.x = d.rid AND same GROUP BY d.rid
),
links AS (SELECT x, count(DISTINCT set_id) AS n_links FROM link JOIN sets ON sets.rid = y WHERE NOT same GROUP BY x),
reach AS (SELECT rid AS x, rid AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
class AS (SELECT reach.x, min(d.doc_id) AS class_id FROM reach JOIN d ON d.rid = reach.y GROUP BY reach.x)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, n_copies::BIGINT AS n_copies
FROM d JOIN sets ON sets.rid = d.rid JOIN class ON class.x = d.rid LEFT JOIN links ON links.x = d.rid
"""

def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every text by a classifier that saw three of four labelled folds."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = nbsvm.held_out(F.col("doc_id"), 4, 2)
    model = nbsvm.fit(nbsvm.labelled_rows(docs.where(~held), labels))
    return nbsvm.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Every page as a full response, and as the answer to a check of its own version a day later.

    Page n is captured n minutes after the start of 2024 and checked 1,440 minutes later, with its
    ETag, with its Last-Modified alone (even digest), or, where its digest begins with f, with neither.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(page_id AS INT), 0)")
    tag, modified = F.concat(F.lit("ETag: \""), digest, F.lit("\"")), F.concat(F.lit("Last-Modified: "), F.col("at").cast("string"))
    made = pages.withColumn("at", at).withColumn("last", F.substring(digest, 32, 1))
    length = F.coalesce(F.length("html"), F.lit(0)).cast("string")
    response = made.select(
        (2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("at").alias("date"), F.lit(200).alias("status"),
        F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), tag, modified, F.concat(F.lit("Content-Length: "), length), F.lit("Cache-Control: no-cache")).alias("headers"),
        F.col("html").alias("payload"),
    )
    validators = F.when(digest.startswith("f"), F.lit("Age: 1")).when(F.col("last").isin(*"02468ace"), modified).otherwise(F.concat(F.lit("etag: W/"), F.substring(tag, 7, 40)))
    revisit = made.select(
        (2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        (F.col("at") + F.expr("INTERVAL 1440 MINUTES")).alias("date"), F.lit(304).alias("status"),
        F.concat_ws("\r\n", F.lit("HTTP/1.1 304 Not Modified"), validators, F.lit("Content-Length: 0"), F.lit("Cache-Control: max-age=60")).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return response.unionByName(revisit)


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the check of every page resolves to."""
    found = revisits.resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\n"))))
    return found.select(
        F.expr("(record_id - 1) div 2").alias("page_id"), "outcome", F.expr("response_id div 2").alias("response_page"),
        F.array_join(lines, "").alias("header_text"), F.sha2("payload", 256).alias("payload_sha256"),
    )


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, html, md5(coalesce(html, '')) AS digest,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(page_id), '%Y-%m-%d %H:%M:%S') AS seen
  FROM pages
),
c AS (
  SELECT *,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
      lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)'))), '&'), ''), '') AS canonical,
    CASE WHEN digest LIKE 'f%' THEN 'none' WHEN digest[32] IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 'date' ELSE 'tag' END AS how
  FROM p
),
j AS (
  SELECT r.*, s.page_id AS response_page, s.html AS body, s.digest AS body_digest, s.seen AS body_seen
  FROM c AS r LEFT JOIN c AS s ON s.canonical = r.canonical AND s.html IS NOT NULL AND s.page_id < r.page_id + 1440
  QUALIFY row_number() OVER (PARTITION BY r.page_id ORDER BY s.page_id DESC NULLS LAST) = 1
),
o AS (
  SELECT *, CASE WHEN response_page IS NULL THEN 'no_response' WHEN how = 'none' THEN 'unverifiable'
    WHEN how = 'tag' AND digest = body_digest OR how = 'date' AND seen = body_seen THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM j
)
SELECT page_id, outcome, response_page,
  CASE WHEN outcome = 'resolved' THEN
    'cache-control: max-age=60' || chr(10) || 'content-length: ' || length(body) || chr(10)
    || 'etag: ' || CASE WHEN how = 'tag' THEN 'W/' ELSE '' END || '"' || body_digest || '"' || chr(10) || 'last-modified: ' || body_seen || chr(10)
  ELSE
    CASE WHEN how = 'none' THEN 'age: 1' || chr(10) ELSE '' END || 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10)
    || CASE how WHEN 'tag' THEN 'etag: W/"' || digest || '"' || chr(10) WHEN 'date' THEN 'last-modified: ' || seen || chr(10) ELSE '' END
  END AS header_text,
  CASE WHEN outcome = 'resolved' THEN sha256(body) END AS payload_sha256
FROM o
"""


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every word of every text goes, in sequences of four permitted lengths."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances to the language's reference and the verdict on every document."""
    judged = divergence.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.drop("lang", "text")


def _crc_sql(said: str) -> str:
    """CRC-32 of an ASCII text in SQL: bit by bit with the reflected polynomial 0xEDB88320."""
    shifts = "list_reduce([xor(c, b)] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)"
    steps = f"[4294967295::BIGINT] || list_transform(string_split({said}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(4294967295, list_reduce({steps}, lambda c, b: {shifts}))"


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth of the turns lost, emptied, unfinished, repeated or said by the user; nulls are one space."""
    space = F.lit(" ")
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(said.cast("binary")) % 20
    rows = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")
    ).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    found = repair.summaries(repair.repair_turns(damaged(rows)))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    whole = join_on(rows.select("conv_id").distinct(), found, ["conv_id"], "left")
    return whole.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        *[F.coalesce(c, F.lit(v)).alias(c) for c, v in texts.items()],
    )


def _step_sql(state: str, cost: str, letter: str) -> str:
    """A state of the repair, six digits of cost and the audit, after one more edit."""
    return f"lpad((left({state}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({state}, 7) || '{letter}'"


def _repair_sql() -> str:
    drop, late = "4", "CASE WHEN truncated THEN 3 ELSE 0 END"
    after = {"b": _step_sql("b", drop, "D")}
    stays = {}
    for to, sources in (("s", "b"), ("u", "bsa"), ("a", "u")):
        ways = [_step_sql(to, drop, "D")]
        for source in sources:
            kept = f"CASE WHEN NOT gone AND initial = '{to}' THEN {_step_sql(source, late, 'K')} END"
            ways.append(kept if to == "s" else f"{kept}, CASE WHEN NOT gone AND initial <> '{to}' THEN {_step_sql(source, '3 + ' + late, 'R')} END")
        stays[to] = f"least({', '.join(ways)})"
    after |= stays
    insert = {x: _step_sql(x, "3", "I") for x in ("b", "s", "u", "a")}
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM given WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS initial,
    left(lag(role) OVER w, 1) || left(role, 1) AS step,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
judged AS (
  SELECT *, final = '' AS blank, final <> '' AND nth > 1 AS twice, final = '' OR nth > 1 AS gone,
    nth = 1 AND final NOT IN ('', '.', '!', '?') AS truncated
  FROM placed
),
dp AS (
  SELECT DISTINCT conv_id, n, 0 AS i, '000000' AS b, NULL::VARCHAR AS s, '000003I' AS u, '000006II' AS a FROM placed
  UNION ALL
  SELECT conv_id, n, i, b, s, u, least(a, {insert["u"]}) FROM (
    SELECT conv_id, n, i, b, s, least(u, {insert["b"]}, {insert["s"]}, {insert["a"]}) AS u, a FROM (
      SELECT dp.conv_id, dp.n, j.i, {after["b"]} AS b, {after["s"]} AS s, {after["u"]} AS u, {after["a"]} AS a
      FROM dp JOIN judged j ON j.conv_id IS NOT DISTINCT FROM dp.conv_id AND j.i = dp.i + 1
    )
  )
),
best AS (SELECT conv_id, least(b, a) AS won FROM dp WHERE i = n),
audits AS (SELECT conv_id, left(won, 6)::BIGINT AS cost, substr(won, 7) AS audit FROM best),
letters AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM audits),
edits AS (
  SELECT *, substr(audit, k, 1) AS edit, len(replace(left(audit, k), 'I', '')) AS i,
    len(replace(left(audit, k), 'D', '')) AS o, len(replace(audit, 'D', '')) % 2 AS odd
  FROM letters
),
repaired AS (
  SELECT e.conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN j.role WHEN (o + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN edit = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY k)) AS repaired_sha256
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i
  WHERE edit <> 'D' GROUP BY e.conv_id
),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (twice) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (i > 1 AND step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP11_SQL = _repair_sql()


def op12_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and the smallest document that its links reach."""
    return simhash.near_components(table(spark, sf_dir, "documents"))


def looped(docs: DataFrame) -> DataFrame:
    """A tenth of the texts with a tail of their words repeated periodically, by the CRC-32 of the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    chosen = chosen.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    tail = F.transform(F.sequence(F.lit(0), n - F.col("a") - 1), lambda i: F.get("w", (F.col("a") + i % F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return chosen.select("doc_id", F.when(n > 0, made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, the strongest one, and the text with each run cut to its first period."""
    found = runs.collapse_runs(looped(table(spark, sf_dir, "documents")))
    best = runs.strongest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", "n_runs", best.alias("best"), F.array_join(line, "").alias("line"), "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("line", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP13_SQL = f"""
WITH given AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w, {_crc_sql("doc_id::VARCHAR")} AS h FROM documents),
planned AS (SELECT *, h // 10 AS g, len(w) AS n FROM given),
planned2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM planned),
d AS (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    w[1:a] || list_transform(range(n - a), lambda i: w[a + 1 + i % (1 + (n - a) // (3 + g % 8))]) END AS w
  FROM planned2
),
grams AS (SELECT rid, n, i, hash(w[i]) AS one, hash(w[i - 4:i]) AS five FROM d, unnest(range(5, n + 1)) AS t(i)),
pairs AS (
  SELECT y.rid, y.i, y.i - x.i AS q FROM grams x JOIN grams y
  ON x.rid = y.rid AND x.five = y.five AND x.i < y.i AND 4 * (y.i - x.i) <= y.n
),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT rid, q, min(i) - 5 - q AS start, count(*) + 4 + q AS length FROM islands GROUP BY rid, q, island),
found AS (
  SELECT rid, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length
),
listed AS (
  SELECT rid, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM found GROUP BY rid
),
best AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length::DOUBLE / period DESC, start, period) = 1
),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM found),
stay AS (
  SELECT x.rid, string_agg(x.word, ' ' ORDER BY x.i) AS kept
  FROM (SELECT rid, i, w[i + 1] AS word FROM d, unnest(range(0, n)) AS t(i)) x ANTI JOIN gone ON gone.rid = x.rid AND gone.i = x.i GROUP BY x.rid
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN listed ON listed.rid = d.rid LEFT JOIN best ON best.rid = d.rid LEFT JOIN stay ON stay.rid = d.rid
"""


LLM_QUERIES = {
    "op1_one_bit_search": op1_one_bit_search,
    "op2_chat_format": op2_chat_format,
    "op10_near_join": op10_near_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op3_lm_scores": op3_lm_scores,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op11_structure_repair": op11_structure_repair,
    "op12_simhash_components": op12_simhash_components,
    "op13_periodic_runs": op13_periodic_runs,
}
LLM_ORACLES: dict[str, str] = {
    "op1_one_bit_search": OP1_SQL,
    "op2_chat_format": OP2_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op10_near_join": OP10_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op11_structure_repair": OP11_SQL,
    "op13_periodic_runs": OP13_SQL,
}

ship_with_tasks(__name__)
