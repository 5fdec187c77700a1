"""One query per corpus operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlake.llm import bpe, chat, classifier, contamination, licenses, lines, middle, mixing, near, personal, phrases, quality_rules, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rated(labels: DataFrame) -> DataFrame:
    """Grades of labelled documents: toxic 0, else junk 1, else good 2."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
    WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d)),
    r AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
    c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM s SEMI JOIN r USING (k)) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p))), lambda p: w[p]) END, ' ')) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id)"""


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
    s AS (SELECT doc_id, i, array_to_string(l[i:i + 2], chr(10)) AS k
          FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 1, 1))) AS i FROM d)),
    p AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM s WHERE regexp_matches(k, '[^\x20\x09-\x0D]')),
    c AS (SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM p WHERE n > 1) GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
           sha256(CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda j: NOT list_contains(gone, j)), lambda j: l[j]), chr(10)), '') END) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id)"""


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


@query
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near.group(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


ORACLES["op5_decontamination"] = r"""
    WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
    b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
           FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
    dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
           FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, (SELECT DISTINCT n FROM bw))),
    h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
    c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
    t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = rated(table(spark, sf_dir, "labels")).groupBy("doc_id").agg(F.min("grade").alias("grade")).filter("grade = 2")
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return out.withColumns(joined).drop("spans")


@query
def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.read_back(chat.format_windows(turns.unionByName(more)))


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal.find(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*personal.BASE)
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in personal.BASE]
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, rated(table(spark, sf_dir, "labels")))
    out = classifier.grade(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.col("_grade.expected").alias("expected_grade"), F.col("_grade.tail").alias("tail"), (F.col("_grade.tail") >= 0.5).alias("kept"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, packed=True)
    count = F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens")
    return bpe.decode(encoded, ranks).select("doc_id", count, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = middle.transform(table(spark, sf_dir, "documents"))
    again = F.sha2(middle.restore(F.col("form"), F.col("output")), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), again)


ORACLES["op12_fill_in_middle"] = r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                      regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
    r AS (SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                 CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT doc_id, text, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM r),
    p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1:b], '') AS y, array_to_string(u[b + 1:], '') AS z FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p"""


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


ORACLES["op13_phrase_mining"] = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
          FROM (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 5)) AS n FROM w) WHERE len(w) >= n)),
    c AS (SELECT lang, n, phrase, count(*) AS f FROM g GROUP BY lang, n, phrase),
    t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE n = 1 GROUP BY lang),
    k AS (SELECT lang, n, phrase, f, string_split(phrase, ' ') AS w FROM c WHERE n > 1 AND f >= 30),
    x AS (SELECT lang, n, phrase, f AS a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, n)) AS j FROM k)),
    s AS (SELECT x.lang, x.phrase, a, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (l.f + r.f) AS BIGINT) AS score, j
          FROM x JOIN c AS l ON l.lang = x.lang AND l.phrase = x.x JOIN c AS r ON r.lang = x.lang AND r.phrase = x.y),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    i AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f
          FROM (SELECT lang, w, f, m, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM k)) GROUP BY ALL),
    o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.f IS NULL OR CAST(100 AS HUGEINT) * i.f < CAST(80 AS HUGEINT) * b.a)
    SELECT * FROM (SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score FROM o JOIN t ON t.lang = o.lang) WHERE rank <= 2000"""
