"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    conversation_repair,
    language_ecoc,
    mixing,
    multi_index,
    packing,
    pii_spans,
    probminhash,
    product_quantised,
    ptolemaic_clusters,
    quality_cnn,
    sharding,
    suffix_radix,
    superkmer,
)
from siltstone.llm.common import one_row_each, read
from siltstone.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
# The table that a query reads, where not the documents, and the bytes that its widest shuffle
# writes for a byte of it, where more than one.
_TABLE = {"op9": "embeddings", "op10": "embeddings", "op11": "conversations", "op13": "embeddings"}
_SHUFFLED = {"op2": 4, "op3": 5, "op5": 4, "op9": 32, "op10": 32, "op11": 2}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        number = fn.__name__.partition("_")[0]
        table = f"{sf_dir}/{_TABLE.get(number, 'documents')}.parquet"
        configure(spark, table, factor=_SHUFFLED.get(number, 1))
        # whole texts can be long, so few of them travel to Python at a time
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def held_out(modulus: int, remainder: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@query
def op1_packing(spark, sf):
    pieces = packing.pack_texts(read(spark, sf, "documents"))
    return pieces.select(
        F.col("row_id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "loss_tokens",
    )


@query
def op6_language(spark, sf):
    docs = read(spark, sf, "documents")
    codes = language_ecoc.fit(docs.where(~held_out(4, 2)))
    out = language_ecoc.predict(docs.withColumn("held_out", held_out(4, 2)), codes, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op8_quality(spark, sf):
    docs = read(spark, sf, "documents")
    network = quality_cnn.fit(docs, read(spark, sf, "labels").where(~held_out(3, 1)))
    out = quality_cnn.score(docs.withColumn("held_out", held_out(3, 1)), network, ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op2_superkmer(spark, sf):
    out = superkmer.remove_repeated_windows(read(spark, sf, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.col("sha").alias("kept_sha256"), "n_spans")


@query
def op3_suffix(spark, sf):
    out = suffix_radix.remove_repeated_bytes(read(spark, sf, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.col("sha").alias("kept_sha256"))


@query
def op4_mixing(spark, sf):
    docs = read(spark, sf, "documents")
    taken, sources = mixing.mix(docs, "doc_id", F.array("source"))
    rows = one_row_each(taken, "rows")
    return rows.join(sources, F.col("sources")[0].eqNullSafe(F.col("source"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


@query
def op5_probminhash(spark, sf):
    out = probminhash.near_duplicates(read(spark, sf, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("tid") == F.col("kept_tid"))
    return out.select("doc_id", "component_id", kept.alias("kept"), "n_class")


@query
def op7_sharding(spark, sf):
    out = sharding.shard_by_bytes(read(spark, sf, "documents"))
    return out.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_product_quantised(spark, sf):
    out = product_quantised.near_links(read(spark, sf, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept.alias("kept"))


@query
def op10_multi_index(spark, sf):
    out = multi_index.search(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op11_hirschberg(spark, sf):
    rows = conversation_repair.damaged(read(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return conversation_repair.repair(rows).withColumnRenamed("conv", "conv_id")


@query
def op12_pii(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    found = pii_spans.personal_data(docs, "text").select("doc_id", "pii")

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in ("email", "ip", "card", "phone")),
        F.sha2(pii_spans.listed(F.filter("pii", pii_spans.is_base)).cast("binary"), 256).alias("base_sha256"),
        pii_spans.listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


@query
def op13_ptolemaic(spark, sf):
    out, _ = ptolemaic_clusters.cluster_vectors(read(spark, sf, "embeddings"), "vec_id", "embedding")
    return out.withColumnRenamed("id", "vec_id")


# Words by RE2 as by Java; sources by code point as bytes of UTF-8; levels by the order in
# which sources fill up; documents in the order of the seeded digest.
_SQL["op4_mixing"] = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest
  FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         (ARRAY[3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2 * source_size / w, source IS NULL, encode(source)) AS place,
         (SELECT 1.5 * sum(source_size) FROM s) - coalesce(sum(2 * source_size) OVER before, 0) AS rest,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS remaining
  FROM s
  WINDOW before AS (ORDER BY 2 * source_size / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min(rest / remaining, place) AS level, min(place) AS filled FROM f WHERE cap * remaining > rest * w
), t AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR place < filled THEN cap ELSE level * w END AS target FROM f, l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round_even(t.target, 0) AS flow,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       CASE WHEN size > 0 THEN size * ((2 * upto - size <= 2 * flow)::BIGINT + (2 * (source_size + upto) - size <= 2 * flow)::BIGINT)
            ELSE 0 END::BIGINT AS taken
FROM p
"""


def _clusters_sql(k: int, rounds: int, length: int, scale: int, seed: int) -> str:
    """Whole numbers throughout; a round is one step that assigns and one that moves centroids."""
    parts = [
        f"""
v AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: isfinite(x))) = {length}
), x AS (
  SELECT row_id, unnest(range({length})) AS i, unnest(v) AS x FROM v
), c0 AS (
  SELECT cluster, unnest(range({length})) AS i, unnest(v) AS c FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS cluster FROM v
    QUALIFY cluster < {k})
)"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (
  SELECT row_id, cluster, distance FROM (
    SELECT row_id, cluster, sum((x - c) * (x - c)) AS distance FROM x JOIN c{r} USING (i) GROUP BY row_id, cluster)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) = 1
), m{r} AS (
  SELECT cluster, i, sum(x) AS total, count(*) AS n FROM a{r} JOIN x USING (row_id) GROUP BY cluster, i
), c{r + 1} AS (
  SELECT cluster, i, CASE WHEN n IS NULL THEN c
    ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS c
  FROM c{r} LEFT JOIN m{r} USING (cluster, i)
)"""
        )
    return f"""
WITH {", ".join(parts)}, s AS (
  SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
)
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (row_id) JOIN s USING (cluster)
"""


_SQL["op13_ptolemaic"] = _clusters_sql(k=40, rounds=5, length=64, scale=256, seed=2)


# The same patterns without the guards against slow matching, which RE2 neither has nor needs.
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "mail|email|contact|write|correo|courriel|kontakt", 60, 30, "true"),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "ip|host|server|address|login|serveur|adresse",
        60,
        30,
        "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 OR ('0' || ltrim(x, '0'))[-4:]::INT > 255)) = 0",
    ),
    (
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        "card|visa|mastercard|credit|debit|payment|carte|karte|tarjeta",
        80,
        20,
        "len(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(len(d)), lambda i: "
        "CASE WHEN i % 2 = 0 THEN d[len(d) - i]::INT ELSE 2 * d[len(d) - i]::INT - CASE WHEN d[len(d) - i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    ),
    ("phone", _PHONE, "tel|phone|call|fax|mobile|telefon|telefono", 60, 30, "len(d) BETWEEN 10 AND 15"),
    (
        "iban",
        r"[A-Z]{2}[0-9]{2}((\x20[A-Z0-9]{4}){2,7}(\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})",
        "iban|account|bank|konto|compte|cuenta|transfer",
        80,
        20,
        "NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(a, '^[A-Za-z0-9]') AND list_reduce("
        "list_transform(string_split(replace(m, ' ', '')[5:] || m[1:4], ''), lambda x: CASE WHEN ascii(x) < 65 THEN ascii(x) - 48 ELSE 1000 + ascii(x) - 55 END), "
        "lambda l, x: CASE WHEN x < 10 THEN (l * 10 + x) % 97 ELSE (l * 100 + x - 1000) % 97 END, 0) = 1",
    ),
    *(
        (
            kind,
            pattern,
            words,
            30,
            40,
            "m[1] <> '+' AND NOT regexp_matches(b, '[A-Za-z0-9.+-]$|[0-9][\\x20]$') "
            "AND NOT regexp_matches(a, '^[A-Za-z0-9]|^[\\x20.-][0-9]')",
        )
        for kind, pattern, words in (
            (
                "tel",
                _PHONE + r"|[0-9]{2,4}[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}",
                "tel|phone|call|fax|mobile|telefon|telefono",
            ),
            ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ssn|social|security|taxpayer"),
        )
    ),
)


def _pii_sql() -> str:
    kinds = []
    for rank, (kind, pattern, words, score, context, valid) in enumerate(_PII):
        near = f"(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"
        kinds.append(
            f"""
  SELECT row_id, start, {rank} AS rank, '{kind}' AS kind, start + len(m) AS stop,
         {score} + CASE WHEN regexp_matches(b, '{near}') OR regexp_matches(a, '{near}') THEN {context} ELSE 0 END AS score
  FROM (
    SELECT row_id, m[i] AS m, regexp_replace(m[i], '[^0-9]', '', 'g') AS d,
           right(coalesce(m[i - 1], '') || g[i], 48) AS b, left(g[i + 1] || coalesce(m[i + 1], ''), 48) AS a,
           (sum(len(g[i]) + len(m[i])) OVER (PARTITION BY row_id ORDER BY i) - len(m[i]))::BIGINT AS start
    FROM (SELECT row_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT row_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM t))
  ) WHERE {valid}"""
        )
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents
), s AS ({" UNION ALL ".join(kinds)}
), k AS (
  SELECT row_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         string_agg(score::VARCHAR, ',' ORDER BY start, rank) AS scores
  FROM s WHERE rank < 4 OR score >= 60 GROUP BY row_id
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores
FROM t LEFT JOIN k USING (row_id)
"""


_SQL["op12_pii"] = _pii_sql()


def _repair_sql() -> str:
    """Every state's cheapest edits turn by turn, with their initials and lines written out."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}
    inserts = []
    for state in range(4):
        now, lines = state, ""
        for n in range(3):
            inserts.append(f"({state}, {now}, {3 * n}, '{'I' * n}', '{lines}')")
            now, lines = due[now], f"{lines}{name[due[now]]}:" + "\\n"
    inserts = ", ".join(inserts).replace("\\n", "' || chr(10) || '")
    crc = (
        "xor(4294967295::UBIGINT, list_reduce(list_transform(string_split({s}, ''), lambda x: ascii(x)::UBIGINT), "
        "lambda c, b: list_reduce([0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384::UBIGINT), xor(c, b)), "
        "4294967295::UBIGINT))"
    ).format(s="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE f AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS fault,
         row_number() OVER () AS row_id FROM conversations
), h AS (
  SELECT conv_id, turn, row_id, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM f
), o AS (
  SELECT *, rtrim(text, {spaces}) AS cut, row_number() OVER w AS place,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, row_id, copy) AS seen,
         left(lag(role) OVER w, 1) || left(role, 1) AS pair, lag(role) OVER w IS NOT NULL AS follows
  FROM h WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), md5(text), row_id, copy)
), r AS (
  SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), i(before, state, cost, audit, lines) AS (VALUES {inserts}
), s AS (
  SELECT conv_id, 0 AS place, 0 AS state, 0 AS cost, '' AS audit, '' AS lines FROM c
  UNION ALL
  SELECT conv_id, place, state, (best).cost, (best).audit, (best).lines FROM (
    SELECT conv_id, place, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM (
      SELECT s.conv_id, r.place, e.state, s.cost + i.cost + e.cost AS cost, s.audit || i.audit || e.audit AS audit,
             s.lines || i.lines || CASE e.audit WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10)
               ELSE CASE e.state WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text || chr(10) END AS lines
      FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.place = s.place + 1
      JOIN i ON i.before = s.state
      JOIN (VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 2, 'R', ''), (1, 2, 'R', ''),
                   (3, 2, 'R', ''), (2, 3, 'R', ''), (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'),
                   (2, 3, 'K', 'a')) t(before, state, audit, initial) ON t.before = i.state
      JOIN LATERAL (SELECT t.state, t.audit, CASE t.audit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                           + CASE WHEN t.audit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost) e ON true
      WHERE t.audit = 'D' OR r.fault NOT IN ('blank', 'duplicate') AND (t.audit = 'R' OR t.initial = left(r.role, 1))
    ) GROUP BY conv_id, place, state
  )
), e AS (
  SELECT conv_id, (best).cost AS cost, (best).audit AS audit, (best).lines AS lines FROM (
    SELECT s.conv_id, min({{'cost': s.cost + i.cost, 'audit': s.audit || i.audit, 'lines': s.lines || i.lines}}) AS best
    FROM s JOIN c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.place = c.n
    JOIN i ON i.before = s.state AND i.state IN (0, 3) GROUP BY s.conv_id)
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(CASE WHEN lines = '' THEN '' ELSE lines[:-2] END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""


_SQL["op11_hirschberg"] = _repair_sql()
