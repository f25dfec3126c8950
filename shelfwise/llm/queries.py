"""The registered queries: each operator over its whole table with production parameters, in its contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import exactdup, langid, merkle, mixing, negatives, neighbours, packing, piececode, secrets, simjoin, suffixdup, tokencount, toxicity
from shelfwise.llm.common import crc_mod, keyed, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = toxicity.training_rows(docs, table(spark, folder, "labels"), crc_mod(F.col("id"), 5) != 0)
    scored = toxicity.score(docs, toxicity.fit(rows))
    held = crc_mod(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_language")
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = keyed(docs, id="doc_id", text="text", lang="lang").where(crc_mod(F.col("id"), 4) != 2)
    found = langid.predict(docs, langid.fit(rows))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pieces_of(docs: DataFrame) -> DataFrame:
    """2048-token pieces of ``documents``, by the ranks file of the byte-level vocabulary; its one special string is token 50256."""
    return packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


@register("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pieces_of(table(spark, folder, "documents"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@register(
    "op1_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents),
         g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)""",
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exactdup.exact_groups(table(spark, folder, "documents"), digests="all")
    return groups.withColumnRenamed("digest", "text_sha256")


@register(
    "op6_mixing",
    """
    WITH n AS (SELECT source, sum(strlen(coalesce(text, ''))) AS bytes FROM documents GROUP BY source),
         r AS (SELECT source, CASE WHEN bytes > 0 THEN pow(CAST(bytes AS DOUBLE), 0.5) / sum(CASE WHEN bytes > 0 THEN pow(CAST(bytes AS DOUBLE), 0.5) ELSE 0 END) OVER ()
                              * CAST(sum(bytes) OVER () AS DOUBLE) / bytes ELSE 0 END AS rate FROM n),
         k AS (SELECT source, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT))) AS k FROM r WHERE rate > 0),
         c AS (SELECT source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM k),
         s AS (SELECT source, list(c ORDER BY c) AS steps FROM c GROUP BY source),
         d AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, s.steps,
                      CAST('0x' || substr(md5(concat('17|', d.doc_id)), 1, 13) AS BIGINT) / pow(16, 13) AS u
               FROM documents d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
         m AS (SELECT * EXCLUDE (steps, u), unnest(generate_series(1, len(list_filter(steps, lambda x: x <= u)))) AS copy FROM d)
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
           CAST('0x' || substr(md5(concat('18|', doc_id, '|', copy)), 1, 13) AS BIGINT) AS order_key FROM m""",
)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), numbers=True)


@register("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return simjoin.components(table(spark, folder, "documents"))


@register("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixdup.remove_repeats(table(spark, folder, "documents"), 400, "none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_nearest")
def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@register("op9_secrets")
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find(table(spark, folder, "documents"))
    counts = [secrets.count_of("base", kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    every = secrets.written(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), every.alias("spans"))


@register(
    "op11_hard_negatives",
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
               FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
         p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label)


def _merkle_sql() -> str:
    """The manifest in SQL: trees by recursion, a node's siblings by its run, crc32 bit by bit over the id's digits."""

    def leaf(text: str) -> str:
        fields = {"doc_id": "doc_id", "source": "source", "lang": "lang", "n_chars": "n_chars", "text": text}
        return "sha256(concat(" + ", ".join(f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', {c}), '-')" for c in fields.values()) + "))"

    def rise(name: str, start: str) -> str:
        return f"""{name} AS ({start}
            UNION ALL SELECT tree, level + 1, place // 3, (width + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
            FROM {name} WHERE width > 1 GROUP BY tree, level, place // 3, width)"""

    step = "list_reduce(list_prepend(xor(c, b), [CAST(k AS UBIGINT) for k in range(8)]), lambda v, k: xor(v >> 1, (v & 1) * 3988292384))"
    crc = f"list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(x) AS UBIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, b: {step})"
    return f"""
    WITH RECURSIVE d AS (
            SELECT doc_id, source, {leaf('text')} AS leaf,
                   CASE WHEN {crc} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS other FROM documents),
         p AS (SELECT d.*, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS width FROM d),
         {rise('low', "SELECT tree, 0 AS level, place, width, leaf AS hash FROM p")},
         s AS (SELECT tree, level AS depth, hash FROM low WHERE width = 1),
         {rise('high', "SELECT 0 AS tree, 0 AS level, tree AS place, count(*) OVER () AS width, hash FROM s")},
         r AS (SELECT hash AS root, level AS depth FROM high WHERE width = 1),
         n AS (SELECT tree, level, place, hash FROM low WHERE width > 1 UNION ALL SELECT -1, level, place, hash FROM high WHERE width > 1),
         w AS (SELECT p.tree, p.place, p.leaf, p.other, p.doc_id, s.hash AS subroot, r.root, unnest(generate_series(0, s.depth + r.depth - 1)) AS step, s.depth
               FROM p JOIN s USING (tree) CROSS JOIN r),
         k AS (SELECT tree, place, step, CASE WHEN step < depth THEN tree ELSE -1 END AS node_tree, CASE WHEN step < depth THEN step ELSE step - depth END AS node_level,
                      CASE WHEN step < depth THEN place // CAST(pow(3, step) AS BIGINT) ELSE tree // CAST(pow(3, step - depth) AS BIGINT) END AS node_place FROM w),
         g AS (SELECT k.tree, k.place, k.step, coalesce(string_agg(n.hash, '' ORDER BY n.place) FILTER (n.place < k.node_place), '') AS before,
                      coalesce(string_agg(n.hash, '' ORDER BY n.place) FILTER (n.place > k.node_place), '') AS after
               FROM k JOIN n ON n.tree = k.node_tree AND n.level = k.node_level AND n.place // 3 = k.node_place // 3 GROUP BY k.tree, k.place, k.step),
         f AS (SELECT tree, place, list(before ORDER BY step) AS befores, list(after ORDER BY step) AS afters FROM g GROUP BY tree, place),
         o AS (SELECT p.doc_id, p.leaf, s.hash AS subroot, r.root, sha256(coalesce(list_aggregate(list_transform(befores, lambda x, i: concat(x, afters[i])), 'string_agg', ''), '')) AS proof_sha256,
                      CASE WHEN befores IS NULL THEN p.other
                           ELSE list_reduce(list_prepend(p.other, list_transform(befores, lambda x, i: concat(x, '|', afters[i]))),
                                            lambda h, x: sha256(concat(split_part(x, '|', 1), h, split_part(x, '|', 2)))) END AS folded_root
               FROM p JOIN s USING (tree) CROSS JOIN r LEFT JOIN f ON f.tree = p.tree AND f.place = p.place)
    SELECT *, folded_root = root AS verified FROM o"""


@register("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    docs = table(spark, folder, "documents")
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": F.coalesce(tampered, "text")})


@register("op13_pieces")
def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piececode.decode(piececode.encode(table(spark, folder, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register(
    "op11_hard_negatives",
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
               FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
         p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label)


def _merkle_sql() -> str:
    """The manifest in SQL: trees by recursion, a node's siblings by its run, crc32 bit by bit over the id's digits."""

    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(concat(" + ", ".join(f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', {c}), '-')" for c in fields) + "))"

    def rise(name: str, start: str) -> str:
        return f"""{name} AS ({start}
            UNION ALL SELECT tree, level + 1, place // 3, (width + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
            FROM {name} WHERE width > 1 GROUP BY tree, level, place // 3, width)"""

    step = "list_reduce(list_prepend(xor(c, b), [CAST(k AS UBIGINT) for k in range(8)]), lambda v, k: xor(v >> 1, (v & 1) * 3988292384))"
    crc = f"list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(x) AS UBIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, b: {step})"
    return f"""
    WITH RECURSIVE d AS (
            SELECT doc_id, source, {leaf('text')} AS leaf,
                   CASE WHEN {crc} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS other FROM documents),
         p AS (SELECT d.*, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS width FROM d),
         {rise('low', "SELECT tree, 0 AS level, place, width, leaf AS hash FROM p")},
         s AS (SELECT tree, level AS depth, hash FROM low WHERE width = 1),
         {rise('high', "SELECT 0 AS tree, 0 AS level, tree AS place, count(*) OVER () AS width, hash FROM s")},
         r AS (SELECT hash AS root, level AS depth FROM high WHERE width = 1),
         n AS (SELECT tree, level, place, hash FROM low WHERE width > 1 UNION ALL SELECT -1, level, place, hash FROM high WHERE width > 1),
         w AS (SELECT p.tree, p.place, s.depth, unnest(generate_series(0, s.depth + r.depth - 1)) AS step FROM p JOIN s USING (tree) CROSS JOIN r),
         k AS (SELECT tree, place, step, CASE WHEN step < depth THEN tree ELSE -1 END AS node_tree, CASE WHEN step < depth THEN step ELSE step - depth END AS node_level,
                      CASE WHEN step < depth THEN place // CAST(pow(3, step) AS BIGINT) ELSE tree // CAST(pow(3, step - depth) AS BIGINT) END AS node_place FROM w),
         g AS (SELECT k.tree, k.place, k.step, coalesce(string_agg(n.hash, '' ORDER BY n.place) FILTER (n.place < k.node_place), '') AS before,
                      coalesce(string_agg(n.hash, '' ORDER BY n.place) FILTER (n.place > k.node_place), '') AS after
               FROM k JOIN n ON n.tree = k.node_tree AND n.level = k.node_level AND n.place // 3 = k.node_place // 3 GROUP BY k.tree, k.place, k.step),
         f AS (SELECT tree, place, string_agg(concat(before, after), '' ORDER BY step) AS siblings, list(concat(before, '|', after) ORDER BY step) AS ways FROM g GROUP BY tree, place),
         o AS (SELECT p.doc_id, p.leaf, s.hash AS subroot, r.root, sha256(coalesce(siblings, '')) AS proof_sha256,
                      list_reduce(list_prepend(p.other, coalesce(ways, [])), lambda h, x: sha256(concat(split_part(x, '|', 1), h, split_part(x, '|', 2)))) AS folded_root
               FROM p JOIN s USING (tree) CROSS JOIN r LEFT JOIN f ON f.tree = p.tree AND f.place = p.place)
    SELECT *, folded_root = root AS verified FROM o"""


@register("op12_merkle", _merkle_sql())
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": tampered})


@register("op13_pieces")
def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piececode.decode(piececode.encode(table(spark, folder, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
