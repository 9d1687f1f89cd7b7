"""The queries opN_<name> and the SQL that checks them.

Each applies its operator, with production parameters, to the whole of its table; the
columns its contract asks for are derived here from what the operator returns.
"""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe, dialogue, packing
from clickloom.llm.decontaminate import contamination
from clickloom.llm.html_text import with_text
from clickloom.llm.lexical import search
from clickloom.llm.licenses import license_scan
from clickloom.llm.line_dedup import dedup_lines, reassembled
from clickloom.llm.near_dedup import near_duplicates
from clickloom.llm.personal_data import KINDS as PERSONAL_KINDS
from clickloom.llm.personal_data import personal_data
from clickloom.llm.quality import quality
from clickloom.llm.secrets import KINDS as SECRET_KINDS
from clickloom.llm.secrets import secrets
from clickloom.llm.token_counts import read_tokenizer, token_counts
from clickloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    signed = F.transform("hits", lambda at, k: F.when(k % 2 == 1, at).otherwise(-at))
    n_hit = F.aggregate(signed, F.lit(0).cast("bigint"), lambda n, at: n + at)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        (F.size("items") + F.col("unnamed").cast("int")).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "row.doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.sha2(reassembled(), 256).alias("kept_sha256"),
    )


def op4_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per packed row, as written and read again; documents end with the id that the vocabulary leaves free."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = packing.library_ids(F.col("text"), ranks, public_tokenizers.PATTERN)
    path = scratch_path(spark, "packed")
    packing.write_packed(packing.pack(_table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids")), end_id=50256), path)
    return packing.read_packed(spark, path).select(
        "doc_ids",
        "doc_offsets",
        "cu_seqlens",
        F.element_at("cu_seqlens", -1).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    done = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts(_table(spark, sf_dir, "documents"), tokenizer, limit=1024)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min("phrase_at").cast("bigint").alias("first_word"),
        F.array_max("phrase_at").cast("bigint").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct("phrases"))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("phrases", "labels"))).alias("labels"),
        "score",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def _spans_text(spans) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _base_of(spans: str, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


def _counts_of(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    return [F.size(_base_of(spans, (k,))).cast("bigint").alias(f"n_{k}") for k in kinds]


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *_counts_of("spans", SECRET_KINDS),
        F.sha2(_spans_text(_base_of("spans", SECRET_KINDS)), 256).alias("base_sha256"),
        _spans_text("spans").alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *_counts_of("spans", PERSONAL_KINDS),
        F.sha2(_spans_text(_base_of("spans", PERSONAL_KINDS)), 256).alias("base_sha256"),
        _spans_text("spans").alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def _damaged(conversations: DataFrame) -> DataFrame:
    """What op13 does to the rows before they are repaired; ``copies`` says how often one stands there."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.concat_ws(":", conv, turn)) % 20).alias("harm"))
    harm = F.col("harm")
    return rows.filter(harm != 0).select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(harm == 3, 2).otherwise(1).alias("copies"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs are found once, written below the shared folder, and read for the rows and for the result."""
    conversations = _table(spark, sf_dir, "conversations")
    rows, copies = _damaged(conversations), F.col("copies")
    path = scratch_path(spark, "repairs")
    dialogue.repair(rows, copies=copies).write.parquet(path)
    found = spark.read.parquet(path)
    hashes = dialogue.digests(dialogue.repaired(rows, found, copies=copies))
    ids, a, b = conversations.select("conv_id").distinct().alias("i"), found.alias("a"), hashes.alias("b")
    every = ids.join(a, F.col("i.conv_id").eqNullSafe(F.col("a.conv_id")), "left").join(
        b, F.col("i.conv_id").eqNullSafe(F.col("b.conv_id")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        "i.conv_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_secret_scan,
        op3_line_dedup,
        op4_token_packing,
        op5_byte_bpe,
        op6_token_counts,
        op7_license_scan,
        op8_quality_rules,
        op9_near_dedup,
        op10_personal_data,
        op11_lexical_search,
        op12_html_extraction,
        op13_conversation_repair,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    "op1_decontaminate": f"""
        WITH items AS (
          SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark),
        windows AS (
          SELECT DISTINCT item, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS string,
                 least(10, len(w)) AS size
          FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
        docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
        places AS (
          SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS string
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
        found AS (
          SELECT doc_id, i, p.size, item FROM places p JOIN windows USING (string)),
        hit AS (
          SELECT doc_id, count(DISTINCT k) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id),
        item_lists AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN item_lists USING (doc_id)""",
    "op11_lexical_search": f"""
        WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
        sized AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM docs WHERE len(w) > 0),
        whole AS (SELECT count(*) AS docs_n, CAST(sum(n) AS BIGINT) AS terms_n FROM sized),
        wanted AS (
          SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest({_WORDS.format("text")}) AS term FROM benchmark) GROUP BY 1, 2),
        counted AS (
          SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM sized)
          WHERE term IN (SELECT term FROM wanted) GROUP BY 1, 2, 3),
        weighed AS (
          SELECT term, CAST(floor(1000 * ln((2 * docs_n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM counted, whole GROUP BY term, docs_n),
        scored AS (
          SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf)
                 // (1000 * tf + 12 * (75 + (25 * n * docs_n) // terms_n)))) AS BIGINT) AS score
          FROM counted JOIN weighed USING (term) JOIN wanted USING (term), whole GROUP BY 1, 2),
        ranked AS (
          SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                 doc_id, score FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 20""",
    "op13_conversation_repair": r"""
        WITH RECURSIVE table_of AS (
          SELECT list(c ORDER BY i) AS t
          FROM (SELECT i, list_reduce(range(8), lambda acc, k: CASE WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END, i) AS c
                FROM range(256) r(i))),
        harmed AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                                lambda x: ord(x)::BIGINT),
                                 lambda acc, b: xor(t[CAST(xor(acc, b) & 255 AS BIGINT) + 1], acc // 256), 4294967295), 4294967295) % 20 AS harm
          FROM conversations, table_of),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                 CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
          FROM harmed WHERE harm <> 0),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                 rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
        told AS (
          SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, bare = '' AS blank,
                 bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
                 right(bare, 1) NOT IN ('.', '!', '?') AS open,
                 lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
        counted AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                 count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (open AND NOT blank AND NOT duplicate) AS truncated,
                 count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
          FROM told GROUP BY conv_id),
        ways AS (
          SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM counted
          UNION ALL
          SELECT conv_id, i, q, min(best) FROM (
            SELECT e.conv_id, e.i, e.q2 AS q, {'cost': e.best.cost + 2 * e.inserts + e.more, 'audit': e.best.audit || repeat('I', e.inserts) || e.letter,
                   'lines': list_concat(list_concat(e.best.lines, e.made[: e.inserts]), e.line)} AS best
            FROM (
              SELECT w.conv_id, r.i, w.best, w.inserts, w.made, x.o.letter AS letter, x.o.more AS more, x.o.q2 AS q2, x.o.line AS line
              FROM (
                SELECT conv_id, i, best, inserts, [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END, CASE WHEN q = 2 THEN 'user:' ELSE 'assistant:' END] AS made,
                       CASE WHEN inserts = 0 THEN q WHEN inserts = 1 THEN CASE WHEN q = 2 THEN 3 ELSE 2 END ELSE CASE WHEN q = 2 THEN 2 ELSE 3 END END AS s
                FROM (SELECT *, unnest([0, 1, 2]) AS inserts FROM ways)) w
              JOIN told r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1,
              LATERAL (SELECT unnest([
                {'letter': 'D', 'more': 3, 'q2': w.s, 'line': CAST([] AS VARCHAR[])},
                {'letter': 'K', 'more': CAST(r.open AS INTEGER), 'line': [r.role || ':' || r.text],
                 'q2': CASE WHEN r.blank OR r.duplicate THEN -1 WHEN r.initial = 's' AND w.s = 0 THEN 1 WHEN r.initial = 'u' AND w.s <> 2 THEN 2
                            WHEN r.initial = 'a' AND w.s = 2 THEN 3 ELSE -1 END},
                {'letter': 'R', 'more': 2 + CAST(r.open AS INTEGER), 'line': [CASE WHEN w.s = 2 THEN 'assistant:' ELSE 'user:' END || r.text],
                 'q2': CASE WHEN r.blank OR r.duplicate THEN -1 WHEN w.s = 2 THEN 3 ELSE 2 END}]) AS o) x
              WHERE x.o.q2 >= 0) e)
          GROUP BY conv_id, i, q),
        ended AS (
          SELECT w.conv_id, min({'cost': best.cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
                                 'audit': best.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                                 'lines': list_concat(best.lines, CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END)}) AS best
          FROM ways w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n GROUP BY w.conv_id)
        SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) k
        LEFT JOIN counted c ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON k.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op3_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, pos, line,
                 translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
                FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
        shared AS (
          SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
          GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        marked AS (
          SELECT lines.*, coalesce(lines.doc_id <> first_id, false) AS gone FROM lines LEFT JOIN shared USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op9_near_dedup": r"""
        WITH RECURSIVE docs AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
        ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (
          SELECT doc_id, doc_id AS other FROM docs
          UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON w.x = r.other)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM docs d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)""",
}
