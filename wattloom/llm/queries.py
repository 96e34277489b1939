"""The registered queries of this subpackage and their SQL.

Each opN query applies operator N to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_onebit, bpe, common, conversations, decontam, divergence, lines, minhash, packing, phrases, quality, suffix_repeats, token_files, urls

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.repeated_bytes(_table(spark, sf_dir, "documents"), size=200).drop("spans")


def op2_onebit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_onebit.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    judged = quality.judge(docs, _table(spark, sf_dir, "labels"), with_text=False)
    return judged.select("doc_id", F.col("__host").alias("host"), F.col("__path").alias("path"), F.round("__low", 6).alias("p_low_quality"), F.round("__toxic", 6).alias("p_toxic"), F.col("__keep").alias("kept"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packing.best_fit(pieces, capacity=1024)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.repeated_phrases(_table(spark, sf_dir, "documents"), size=50).drop("spans")


def op7_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_folder(spark, "tokens")
    manifest = token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(manifest)


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.make_rules(spark, URL_RULES)
    return urls.filter_urls(_table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of `conv_id:turn`."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("kind"))
    damage = F.col("kind")
    texts = F.when(damage == 1, "").when(damage == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(damage != 0).select("conv_id", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"), texts.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    repair = conversations.repair(damaged_conversations(rows), every=rows)
    digests = conversations.digests(repair.rows).alias("d")
    joined = repair.report.alias("r").join(digests, F.col("r.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return joined.select("r.*", F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def _repair_sql() -> str:
    """The least edits by a sweep over each conversation's rows: for each state the least of ten digits of cost and the audit."""

    def plus(v: str, cost: str, edit: str) -> str:
        return f"lpad((left({v}, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({v}, 11) || '{edit}'"

    def ways(states: list[str], edit: str) -> str:
        return ", ".join(plus(v, {"K": "cut", "R": "2 + cut"}[edit], edit) for v in states)

    return f"""
        WITH RECURSIVE src AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
        ), crc AS (
          SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT)),
            lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
              lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS d FROM src
        ), dam AS (
          SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, unnest(CASE d WHEN 3 THEN [0, 1] ELSE [0] END) AS copy,
            CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM crc WHERE d <> 0
        ), num AS (
          SELECT conv_id, turn, role, text, left(role, 1) AS f,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
            regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS final FROM dam
        ), flt AS (
          SELECT *, final = '' AS blank, final <> '' AND again AS duplicate, final NOT IN ('', '.', '!', '?') AND NOT again AS truncated,
            i > 1 AND coalesce(lag(f) OVER (PARTITION BY conv_id ORDER BY i) || f, '') NOT IN ('su', 'ua', 'au') AS illegal FROM num
        ), dp AS (
          SELECT conv_id, 0::BIGINT AS i, '0000000000' AS v0, NULL::VARCHAR AS v1, '0000000002I' AS v2, '0000000004II' AS v3 FROM (SELECT DISTINCT conv_id FROM flt)
          UNION ALL
          SELECT conv_id, i, t0, t1, c2, least(t3, {plus("c2", "2", "I")}) FROM (
            SELECT *, least(t2, {plus("t0", "2", "I")}, {plus("t1", "2", "I")}, {plus("t3", "2", "I")}) AS c2 FROM (
              SELECT conv_id, i, {plus("v0", "3", "D")} AS t0,
                least({plus("v1", "3", "D")}, CASE WHEN ok AND f = 's' THEN {ways(["v0"], "K")} END) AS t1,
                least({plus("v2", "3", "D")}, CASE WHEN ok AND f = 'u' THEN least({ways(["v0", "v1", "v3"], "K")}) END, CASE WHEN ok THEN least({ways(["v0", "v1", "v3"], "R")}) END) AS t2,
                least({plus("v3", "3", "D")}, CASE WHEN ok AND f = 'a' THEN {ways(["v2"], "K")} END, CASE WHEN ok THEN {ways(["v2"], "R")} END) AS t3
              FROM (SELECT dp.*, flt.f, NOT blank AND NOT duplicate AS ok, truncated::BIGINT AS cut, flt.i AS i2 FROM dp JOIN flt ON flt.conv_id IS NOT DISTINCT FROM dp.conv_id AND flt.i = dp.i + 1) AS x(conv_id, i0, v0, v1, v2, v3, f, ok, cut, i)
            )
          )
        ), ends AS (
          SELECT conv_id, least(arg_max(v0, i), arg_max(v3, i)) AS v FROM dp GROUP BY conv_id
        ), best AS (
          SELECT conv_id, left(v, 10)::BIGINT AS cost, substr(v, 11) AS audit FROM ends
        ), edits AS (
          SELECT conv_id, p, substr(audit, p, 1) AS e,
            sum((substr(audit, p, 1) <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS i,
            sum((substr(audit, p, 1) <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY p) AS item
          FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)
        ), kept AS (
          SELECT edits.conv_id, p, e, role, CASE e WHEN 'I' THEN '' ELSE text END AS text, item,
            max((e = 'K' AND item = 1 AND f = 's')::INT) OVER (PARTITION BY edits.conv_id) AS system
          FROM edits LEFT JOIN num ON num.conv_id IS NOT DISTINCT FROM edits.conv_id AND num.i = edits.i
        ), texts AS (
          SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (item - 1 - system) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS repaired_sha256
          FROM kept WHERE e <> 'D' GROUP BY conv_id
        ), facts AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal
          FROM flt GROUP BY conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
          coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o
        LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM o.conv_id
    """


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, ranks=ranks, pattern=public_tokenizers.PATTERN, as_bytes=True, drop_text=True)
    decoded = bpe.decode(ids, ranks=ranks)
    return decoded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least=10, top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_onebit_ann": op2_onebit_ann,
    "op3_site_quality": op3_site_quality,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_minhash": op5_minhash,
    "op6_repeated_phrases": op6_repeated_phrases,
    "op7_line_winnowing": op7_line_winnowing,
    "op8_token_files": op8_token_files,
    "op9_url_rules": op9_url_rules,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op11_conversation_repair": _repair_sql(),
    "op13_source_divergence": """
        WITH d AS (
          SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
        ), w AS (
          SELECT id, lang, source, unnest(terms) AS term FROM d
        ), kept AS (
          SELECT lang, term FROM (SELECT DISTINCT id, lang, term FROM w) GROUP BY lang, term HAVING count(*) >= 10
        ), c AS (
          SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), v AS (
          SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), g AS (
          SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
          FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) USING (lang, source)
        ), p AS (
          SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
          FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
        ), q AS (
          SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q
          FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN (SELECT lang, any_value(v) AS v, sum(total) AS total FROM g GROUP BY lang) USING (lang)
        ), s AS (
          SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
        ), r AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 10
    """,
    "op1_suffix_repeats": """
        WITH d AS (
          SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), p AS (
          SELECT doc_id, unnest(range(0, len(h) // 2 - 199)) AS i, h FROM d WHERE len(h) >= 400
        ), k AS (
          SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS t FROM p
        ), r AS (
          SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS n FROM k) WHERE n > 1
        ), b AS (
          SELECT doc_id, i, coalesce((i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200)::INT, 1) AS fresh FROM r
        ), g AS (
          SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b
        ), runs AS (
          SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM g GROUP BY doc_id, run
        ), gaps AS (
          SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS x, s AS y FROM runs
          UNION ALL SELECT d.doc_id, coalesce(max(e), 0), any_value(len(h)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
        ), kept AS (
          SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x))) AS kept_sha256 FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
        ), n AS (
          SELECT doc_id, sum(e - s) AS removed, count(*) AS spans FROM runs GROUP BY doc_id
        )
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, kept_sha256
        FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
    "op2_onebit_ann": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
          WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / sqrt(list_dot_product(q.e, q.e)) / sqrt(list_dot_product(c.e, c.e)) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op5_minhash": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
        ), n AS (
          SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), inter AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
          SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
        ), e AS (
          SELECT a, b FROM links UNION SELECT b, a FROM links
        ), reach(doc_id, r) AS (
          SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.r = e.a
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
        FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
    """,
    "op6_repeated_phrases": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), p AS (
          SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50
        ), k AS (
          SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS t FROM p
        ), o AS (
          SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS m FROM k) WHERE m < doc_id
        ), gone AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM o
        ), words AS (
          SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d
        ), kept AS (
          SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op7_line_winnowing": r"""
        WITH l AS (
          SELECT doc_id, string_split(text, chr(10)) AS w FROM documents WHERE text <> ''
        ), p AS (
          SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM l WHERE len(w) >= 3
        ), k AS (
          SELECT doc_id, i, array_to_string(w[i:i + 2], chr(10)) AS t FROM p
        ), later AS (
          SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS r FROM k) WHERE r > 1
        ), gone AS (
          SELECT doc_id, list(DISTINCT j) AS g FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM later) GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_removed,
               sha256(CASE WHEN g IS NULL THEN coalesce(d.text, '') ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(g, x)), lambda x: w[x]), chr(10)) END) AS kept_sha256
        FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN gone USING (doc_id)
    """,
    "op9_url_rules": r"""
        WITH p AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), h AS (
          SELECT page_id,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM p
        ), r(verdict, rule, rh, rp) AS (
          VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
                 ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
        ), m AS (
          SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
          FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
        )
        SELECT h.page_id, coalesce(h.host, '') AS host, coalesce(h.path, '') AS path, m.rule, coalesce(m.verdict, 'allow') AS verdict
        FROM h LEFT JOIN m USING (page_id)
    """,
    "op10_decontamination": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
          SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), bi AS (
          SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
        ), win AS (
          SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS t FROM bi
        ), sizes AS (SELECT DISTINCT size FROM win),
        dp AS (
          SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= size
        ), hits AS (
          SELECT dp.doc_id, dp.i, dp.size, win.item_id FROM dp JOIN win ON dp.size = win.size AND array_to_string(dp.w[dp.i:dp.i + dp.size - 1], ' ') = win.t
        ), hw AS (
          SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
        ), it AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
    """,
}
