"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.llm.contamination import find_items
from ratewell.llm.dialogue import damage, digests, repair
from ratewell.llm.jaccard import link_sets
from ratewell.llm.langid import identify
from ratewell.llm.licenses import scan_licenses
from ratewell.llm.lines import dedup_lines
from ratewell.llm.mixing import score_texts
from ratewell.llm.packing import pack
from ratewell.llm.secrets import BASE, scan_secrets
from ratewell.llm.sharding import kd_shards
from ratewell.llm.substrings import remove_repeats
from ratewell.llm.topk import scaled, top_k
from ratewell.llm.whitening import as_longs, usable, whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary; it is installed on every machine."""
    import public_tokenizers

    return os.environ.get("RATEWELL_TOKENIZER") or public_tokenizers.path(name)


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))

    def of_kind(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of_kind(*BASE)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_sets(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("doc.text", 256).alias("kept_sha256"))


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(documents(spark, sf_dir), benchmark(spark, sf_dir))
    return found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", scaled().alias("vector"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path())


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    covered = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_words", covered.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(usable()).select("vec_id", as_longs().alias("x"))
    rows, fit = whiten(vectors)
    shares = F.array(*map(F.lit, (fit.values / fit.trace).tolist() if fit and len(fit.values) else [0.0]))
    return rows.select(
        "vec_id",
        "component",
        F.lit(fit.n if fit else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(fit.identity_error if fit else 0.0).alias("identity_error"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir))
    phrases = F.filter("spans", lambda s: s["how"] == "phrase")

    def labels(spans: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    places = F.transform(phrases, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(phrases).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(phrases).alias("base_labels"),
        labels("spans").alias("labels"),
        F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(0.0).alias("score"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = digests(repair(damage(turns), turns.select("conv_id")))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select("conv_id", *counts, "audit", "repaired_sha256")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_kd_sharding": op5_kd_sharding,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}

_SHINGLES = """
    SELECT DISTINCT {id}, array_to_string(CASE WHEN len(w) < 5 THEN w ELSE w[p:p + 4] END, ' ') AS s
    FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM (
        SELECT {id}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}) WHERE len(w) > 0)"""

_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({key}) + 1), lambda i: ascii({key}[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _repair_sql() -> str:
    """Walks every conversation from its end and keeps, for each state, the least (cost, audit) and the text it leaves."""
    leads = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
    wanted, names = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}

    def after(state: str, cost: str, letter: str, line: str | None) -> str:
        kept = f"list_prepend({line}, ({state}).t)" if line else f"({state}).t"
        return f"{{c: ({state}).c + {cost}, a: '{letter}' || ({state}).a, t: {kept}}}"

    plain = []
    for q in range(4):
        keep = " ".join(
            f"WHEN i = '{x}' THEN {after(f's{to[q]}', 'x', 'K', line='line')}" for x, to in leads.items() if q in to
        )
        rename = f"role_{wanted[q]}"
        options = [
            after(f"s{q}", "4", "D", None),
            f"CASE WHEN fault > 1 THEN NULL {keep} END",
            f"CASE WHEN fault > 1 THEN NULL ELSE {after(f's{wanted[q]}', '3 + x', 'R', rename)} END",
        ]
        plain.append(f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL)) AS b{q}")
    closed = []
    for q in range(4):
        chain, at, options = f"b{q}", q, [f"b{q}"]
        steps: list[int] = []
        for _ in range(3):
            at = wanted[at]
            steps.append(at)
            chain = f"b{at}"
            for to in reversed(steps):
                chain = after(chain, "3", "I", f"'{names[to]}:'")
            options.append(chain)
        closed.append(f"list_min([{', '.join(options)}]) AS s{q}")
    return f"""
        WITH RECURSIVE raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        lots AS (SELECT *, {_CRC.format(key="key")} % 20 AS lot FROM raw),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
                CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy FROM lots WHERE lot <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p,
                regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare, left(role, 1) AS i FROM hurt),
        rows AS (
            SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS before, CASE WHEN bare = '' THEN 2
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 3
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault FROM placed),
        counts AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
                count(*) FILTER (fault = 2)::BIGINT AS blank, count(*) FILTER (fault = 3)::BIGINT AS duplicate,
                count(*) FILTER (fault = 1)::BIGINT AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
            FROM rows GROUP BY conv_id),
        walk AS (
            SELECT conv_id, n + 1 AS p, {{c: 0, a: '', t: []::VARCHAR[]}} AS s0, {{c: 6, a: 'II', t: ['user:', 'assistant:']}} AS s1,
                {{c: 3, a: 'I', t: ['assistant:']}} AS s2, {{c: 0, a: '', t: []::VARCHAR[]}} AS s3 FROM counts
            UNION ALL
            SELECT conv_id, p, {', '.join(closed)} FROM (
                SELECT conv_id, q AS p, {', '.join(plain)} FROM (
                    SELECT w.*, rows.p AS q, i, fault, CASE WHEN fault = 1 THEN 3 ELSE 0 END AS x, role || ':' || text AS line,
                        'user:' || text AS role_2, 'assistant:' || text AS role_3
                    FROM walk w JOIN rows ON rows.conv_id IS NOT DISTINCT FROM w.conv_id AND rows.p = w.p - 1
                )))
        SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce((s0).c, 0)::BIGINT AS cost,
            coalesce((s0).a, '') AS audit, sha256(coalesce(array_to_string((s0).t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) ids
        LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM ids.conv_id AND walk.p = 1"""


ORACLE = {
    "op2_jaccard_join": f"""
        WITH RECURSIVE sh AS ({_SHINGLES.format(id="doc_id", table="documents")}),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        link AS (
            SELECT a.doc_id AS u, b.doc_id AS v FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
        reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
        c AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)""",
    "op7_benchmark_decontamination": f"""
        WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}), b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
        n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
        SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, any_value(n_item)::BIGINT AS n_item,
            count(*) / any_value(n_item)::DOUBLE AS containment
        FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n_item) * 80""",
    "op4_line_dedup": """
        WITH l AS (
            SELECT doc_id, pos, line, lower_az(line) AS key FROM (
                SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos
                FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
        first AS (SELECT key, min(doc_id) AS f FROM l WHERE length(key) >= 10 GROUP BY key)
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (coalesce(l.doc_id > f, false))::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(l.doc_id > f, false)), '')) AS kept_sha256
        FROM l LEFT JOIN first USING (key) GROUP BY doc_id""".replace(
        "lower_az(line)",
        "translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
    ),
    "op10_substring_dedup": """
        WITH t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM t WHERE len(w) >= 13),
        win AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM pos),
        first AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
        hit AS (SELECT win.doc_id, list(p) AS ps FROM win JOIN first USING (s) WHERE win.doc_id > f GROUP BY win.doc_id),
        gone AS (SELECT doc_id, list_sort(list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 13))))) AS g FROM hit),
        word AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM t),
        kept AS (SELECT word.doc_id, count(*) AS n, string_agg(w[p], ' ' ORDER BY p) AS s
            FROM word LEFT JOIN (SELECT doc_id, unnest(g) AS p, 1 AS x FROM gone) d USING (doc_id, p)
            WHERE x IS NULL GROUP BY word.doc_id)
        SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(s, '')) AS kept_sha256
        FROM t LEFT JOIN kept USING (doc_id)""",
    "op8_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_conversation_repair": _repair_sql(),
}
