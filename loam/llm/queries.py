"""The registered queries of this subpackage, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import chat, docdigest, htmltext, langid, linededup, mixing, phrases, pieces, simhash, topk, urlfilter, warc, whitening
from loam.llm.shared import new_path

#: A SentencePiece model file with byte pieces; its scores are used as log scores.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

HOST_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Hosts that are blocked where no host rule decides.
BLOCKED_GLOBS = ("*spam-farm**", "*cheap-pills**")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.simhash_classes(docs, words=4, radius=4)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    found = chat.read_back(chat.prefix_examples(turns.unionByName(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urlfilter.host_rule(*r) for r in HOST_RULES]
    judge = urlfilter.judged([*rules, *(urlfilter.Rule(g, "block") for g in BLOCKED_GLOBS)])
    url = F.col("url")
    rows = table(spark, sf_dir, "pages").select("page_id", urlfilter.host_of(url).alias("host"), urlfilter.path_of(url).alias("path"), judge(urlfilter.canonical(url)).alias("j"))
    named = F.when(F.col("j.rule").isin([r.name for r in rules]), F.col("j.rule"))
    return rows.select("page_id", "host", "path", named.alias("rule"), F.col("j.verdict").alias("verdict"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.PieceModel.load(PIECE_MODEL)
    rows = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    rows = rows.select("row.doc_id", "ids", F.sha2("row.text", 256).alias("own"), F.sha2(pieces.decoder(model)("ids"), 256).alias("decoded_sha256"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256", F.col("own").eqNullSafe(F.col("decoded_sha256")).alias("round_trip"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.exact_top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_docdigest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docdigest.edit_comparison(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.repetition_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = langid.identified(docs.select("doc_id", "text"), docs.filter(rest != 2))
    return found.select("row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "accepted")


def op10_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=16, scale=64)


def op12_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), longest=3, least=10, most=2000)


def queries() -> dict:
    ops = (op1_simhash, op2_chat, op3_urlfilter, op4_sentencepiece, op5_topk, op6_warc, op7_docdigest, op8_mixing, op9_langid, op10_htmltext, op11_whitening, op12_linededup, op13_phrases)
    return {f.__name__: f for f in ops}


_ESCAPED = r"regexp_replace({}, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules_case(pick) -> str:
    ordered = sorted(HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    return " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick(h, p, v)}'" for h, p, v in ordered)


def oracle_sql() -> dict[str, str]:
    role = "replace(replace(coalesce(role, ''), '%', '%25'), chr(10), '%0A')"
    return {
        "op2_chat": f"""
            WITH t AS (
              SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
              UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
            n AS (
              SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
                     count(*) OVER (PARTITION BY conv_id) AS c,
                     8 + length({_ESCAPED.format(role)}) + 1 + length({_ESCAPED.format("text")}) + 8 AS chars
              FROM t),
            s AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS so_far FROM n)
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
                   CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
                   sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
                   CAST(sum(so_far) FILTER (role = 'assistant' OR k = c) AS BIGINT) AS formatted_chars
            FROM s GROUP BY conv_id""",
        "op3_urlfilter": rf"""
            WITH u AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
            SELECT page_id, host, path, CASE {_rules_case(lambda h, p, v: h + p)} END AS rule,
                   CASE {_rules_case(lambda h, p, v: v)}
                        WHEN {" OR ".join(f"contains(host, '{g.strip('*')}')" for g in BLOCKED_GLOBS)} THEN 'block' ELSE 'allow' END AS verdict
            FROM u""",
        "op5_topk": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
            p AS (
              SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
        "op6_warc": """
            WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
            m AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
            SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN top > page_id THEN top END AS refers_to
            FROM p LEFT JOIN m USING (payload_digest)""",
        "op8_mixing": r"""
            WITH d AS (
              SELECT doc_id, source, text, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
            s AS (
              SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
            w AS (SELECT *, [5, 2, 1][(k - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
            o AS (
              SELECT *, row_number() OVER (ORDER BY cap * (10 // weight), k) AS place, sum(source_size) OVER () AS total,
                     coalesce(sum(cap) OVER (ORDER BY cap * (10 // weight), k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                     sum(weight) OVER (ORDER BY cap * (10 // weight), k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
              FROM w),
            f AS (SELECT min(place) AS first FROM o WHERE (total - capped) * weight <= cap * open),
            g AS (SELECT capped AS c, open AS o FROM o WHERE place = (SELECT first FROM f)),
            t AS (
              SELECT source, source_size,
                     CASE WHEN (SELECT first FROM f) IS NULL OR place < (SELECT first FROM f) THEN CAST(cap AS DOUBLE)
                          ELSE CAST(total - (SELECT c FROM g) AS DOUBLE) * weight / CAST((SELECT o FROM g) AS DOUBLE) END AS target
              FROM o),
            r AS (
              SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                     CAST(CAST('0x' || substr(md5('1|' || coalesce(CAST(d.doc_id AS VARCHAR), '~') || '|' || coalesce(md5(d.text), '~')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
            SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
            FROM r""",
        "op12_linededup": f"""
            WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
            l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS k FROM d),
            t AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
            r AS (SELECT key, min(doc_id) AS first FROM t WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
            FROM t LEFT JOIN r USING (key) GROUP BY doc_id""",
        "op13_phrases": rf"""
            WITH p AS (
              SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
            w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
            g AS (
              SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
              UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
              UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
            f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY lang, words, phrase),
            s AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
            c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
            k AS (
              SELECT *, w[1] AS head, array_to_string(w[2:], ' ') AS rest, 1 AS k FROM c
              UNION ALL SELECT *, array_to_string(w[:2], ' '), w[3], 2 FROM c WHERE words = 3),
            m AS (
              SELECT k.lang, k.words, k.phrase, a, l.f AS l, r.f AS r, (1000000 * CAST(a AS HUGEINT) * a) // (CAST(l.f AS HUGEINT) * r.f) AS score, k
              FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.head JOIN f r ON r.lang = k.lang AND r.phrase = k.rest),
            b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
            i AS (
              SELECT lang, phrase, max(a) AS a FROM (
                SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE words = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE words = 3)
              GROUP BY lang, phrase),
            o AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE i.a IS NULL OR 100 * i.a < 50 * b.a),
            t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
            SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM t JOIN s USING (lang) WHERE rank <= 2000""",
    }
