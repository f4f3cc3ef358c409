"""The operators of this package over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    ann,
    chat,
    decontaminate,
    jaccard_join,
    language,
    lm,
    merkle,
    packing,
    secret_scan,
    topk,
    toxicity,
    url_rules,
    whitening,
)
from millrace.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def fold(doc_id: str, parts: int):
    """The number of the fold of a document."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


@query("op3_packing")
def packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and where they are packed."""
    pieces = packing.pack(
        read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_length",
    )


URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@query(
    "op4_url_rules",
    """
    WITH parts AS (
        SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
        FROM pages),
    hosts AS (
        SELECT page_id,
            translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
        FROM parts),
    judged AS (
        SELECT *,
            ('.' || host) LIKE '%.net' AND starts_with(path, '/') AS net,
            ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') AS en,
            ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') AS de,
            ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') AS fr
        FROM hosts)
    SELECT page_id, host, path,
        CASE WHEN en THEN 'example.net/en/' WHEN net THEN 'net/'
            WHEN de THEN 'example.com/de/' WHEN fr THEN 'org/fr/' END AS rule,
        CASE WHEN en THEN 'allow' WHEN net OR de THEN 'block' ELSE 'allow' END AS verdict
    FROM judged
    """,
)
def judged_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(read(spark, folder, "pages"), rules)


@query(
    "op5_chat",
    r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    sized AS (
        SELECT *,
            len(regexp_extract_all(role, '<\\*\||<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>'))
            + len(regexp_extract_all(text, '<\\*\||<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>'))
                AS escapes
        FROM rows)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), ''
            ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length(role) + length(text) + escapes + 23) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def formatted_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what the formatted conversations say, read back from them."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_conversations(rows.unionByName(more))
    newline = F.lit("\n")
    turns = chat.parsed(F.col("text"))
    masked = F.transform(
        "loss_spans",
        lambda s: chat.unescaped(
            F.col("text").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return chats.withColumns({"turns": turns, "loss": F.array_join(masked, "")}).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline)), ""
            ).cast("binary"),
            256,
        ).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


@query("op10_language")
def identified(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from four of five folds."""
    docs = read(spark, folder, "documents")
    models = language.train(docs.where(fold("doc_id", 5) != 0))
    found = language.identify(docs, models)
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query("op1_decontamination")
def leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with the items."""
    return decontaminate.overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def secrets_sql() -> str:
    """Spans of every rule by splitting texts at its matches."""
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        regex = rule.regex.replace("'", "''")
        # RE2 has no upper bound over 1000, and takes the same syntax otherwise
        parts.append(
            f"""SELECT key, doc_id, {rank} AS rank, '{rule.kind}' AS kind,
                string_split_regex(text, '{regex}') AS gaps,
                regexp_extract_all(text, '{regex}', 0) AS whole,
                regexp_extract_all(text, '{regex}', {rule.group}) AS measured,
                {rule.least} AS least
            FROM docs"""
        )
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS key, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    placed AS (
        SELECT key, rank, kind, least, gaps, whole, measured, unnest(range(1, len(whole) + 1)) AS n
        FROM found),
    spans AS (
        SELECT key, rank, kind,
            CAST(list_sum([length(g) FOR g IN gaps[1:n]])
                + coalesce(list_sum([length(w) FOR w IN whole[1:n - 1]]), 0) AS BIGINT) AS start,
            length(whole[n]) AS size
        FROM placed WHERE length(measured[n]) >= least),
    joined AS (
        SELECT key,
            count(*) FILTER (kind = 'assign') AS n_assign,
            count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rank)
                FILTER (rank < {len(secret_scan.BASE)}) AS base,
            string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, rank)
                AS spans
        FROM spans GROUP BY key)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
        coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
        coalesce(spans, '') AS spans
    FROM docs LEFT JOIN joined USING (key)
    """


@query("op6_secrets", secrets_sql())
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, spans="found").select("doc_id", "found")

    def of_rank(number: int):
        return F.size(F.filter("found", lambda s: s["rank"] == number)).cast("long")

    count = {f"n_{rule.kind}": of_rank(n) for n, rule in enumerate(secret_scan.BASE)}
    base = F.filter("found", lambda s: s["rank"] < len(secret_scan.BASE))
    return found.select(
        "doc_id",
        *(column.alias(name) for name, column in count.items()),
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"),
    )


@query(
    "op2_jaccard",
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, coalesce(CASE
            WHEN len(w) >= 5 THEN
                list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END, []) AS s
        FROM words),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT doc_id, y FROM reached JOIN links ON x = other)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
    FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        USING (doc_id)
    """,
)
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_join.components(read(spark, folder, "documents"))


@query("op7_lm")
def lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log probability, learned from nine of ten folds."""
    docs = read(spark, folder, "documents")
    model = lm.train(docs.where(fold("doc_id", 10) != 0))
    return lm.score(docs, model).select(
        "doc_id",
        (fold("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query("op9_toxicity")
def toxic(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learned from three of four folds."""
    docs = read(spark, folder, "documents")
    labels = read(spark, folder, "labels").select("doc_id", "toxic").where(fold("doc_id", 4) != 2)
    found = toxicity.score(docs, toxicity.train(docs, labels))
    return found.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "passages",
    )


@query("op8_neighbours")
def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest neighbours found of every hundredth vector."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query("op11_whitening")
def whitened(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector in the directions of most variance of the distinct ones."""
    return whitening.whiten(read(spark, folder, "embeddings").select("vec_id", "embedding"))


@query(
    "op12_topk",
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
    queries AS (SELECT vec_id, min(x) AS x FROM vectors WHERE vec_id % 100 = 0 GROUP BY vec_id),
    scored AS (
        SELECT q.vec_id AS query_id, r.vec_id,
            CAST(list_sum(list_transform(list_zip(q.x, r.x),
                lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
        FROM queries q JOIN vectors r ON r.vec_id IS DISTINCT FROM q.vec_id),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS n
        FROM scored)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
    """,
)
def best_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The ten rows of the highest inner product with every hundredth vector."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    found = topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
    return found.withColumn("score", F.expr("try_cast(score AS long)"))


MERKLE_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


#: The CRC-32 of a short text, bit by bit, from its published polynomial.
CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, 1 + length(CAST(doc_id AS VARCHAR))),
        lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""


def merkle_sql() -> str:
    """Whole levels one after the other, then each leaf's siblings by their places."""

    def leaf(n_chars: str) -> str:
        values = [n_chars if c == "n_chars" else f"CAST({c} AS VARCHAR)" for c in MERKLE_FIELDS]
        fields = (f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)
        return f"sha256({' || '.join(fields)})"

    def levels(name: str, leaves: str) -> str:
        # a level's nodes in pairs, as long as a tree has more than one
        return f"""
        {name} AS (
            SELECT tree, 0 AS level, pos, digest, many FROM {leaves}
            UNION ALL
            SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (many + 1) // 2
            FROM {name} WHERE many > 1 GROUP BY tree, level, pos // 2, many)"""

    return f"""
    WITH RECURSIVE hashed AS (
        SELECT doc_id, lang, {leaf("CAST(n_chars AS VARCHAR)")} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND crc32_of % 7 = 0
                THEN {leaf("CAST(n_chars + 1 AS VARCHAR)")} END AS tampered
        FROM (SELECT *, {CRC32_SQL} AS crc32_of FROM documents)),
    leaves AS (
        SELECT *, coalesce('=' || lang, '') AS tree, leaf AS digest, count(*) OVER (PARTITION BY lang) AS many,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM hashed),
    {levels("nodes", "leaves")},
    tops AS (
        SELECT '' AS tree, tree AS own, digest, count(*) OVER () AS many,
            row_number() OVER (ORDER BY encode(tree)) - 1 AS pos
        FROM nodes WHERE many = 1),
    {levels("above", "tops")},
    siblings AS (
        SELECT l.tree, l.pos, 0 AS part, n.level, n.pos % 2 = 0 AS on_left, n.digest
        FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.pos = xor(l.pos >> n.level, 1) AND n.many > 1
        UNION ALL
        SELECT l.tree, l.pos, 1, n.level, n.pos % 2 = 0, n.digest
        FROM leaves l JOIN tops t ON t.own = l.tree
            JOIN above n ON n.pos = xor(t.pos >> n.level, 1) AND n.many > 1),
    paths AS (
        SELECT tree, pos, string_agg(digest, '' ORDER BY part, level) AS proof FROM siblings GROUP BY tree, pos),
    steps AS (
        SELECT l.tree, l.pos, n.part, n.level, row_number() OVER (PARTITION BY l.tree, l.pos ORDER BY n.part, n.level) AS step
        FROM leaves l JOIN (
            SELECT DISTINCT tree, 0 AS part, level FROM nodes WHERE many > 1
            UNION ALL SELECT DISTINCT t.own, 1, a.level FROM above a, tops t WHERE a.many > 1) n ON n.tree = l.tree),
    folds AS (
        SELECT tree, pos, 0::BIGINT AS step, coalesce(tampered, leaf) AS digest FROM leaves
        UNION ALL
        SELECT f.tree, f.pos, s.step, sha256(CASE WHEN b.on_left THEN b.digest ELSE '' END || f.digest
            || CASE WHEN NOT b.on_left THEN b.digest ELSE '' END)
        FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step + 1
            LEFT JOIN siblings b ON b.tree = f.tree AND b.pos = f.pos AND b.part = s.part AND b.level = s.level),
    ends AS (SELECT tree, pos, arg_max(digest, step) AS folded_root FROM folds GROUP BY tree, pos),
    root AS (SELECT digest AS root FROM above WHERE many = 1)
    SELECT l.doc_id, l.leaf, t.digest AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
        folded_root, folded_root = root AS verified
    FROM leaves l JOIN tops t ON t.own = l.tree CROSS JOIN root
        LEFT JOIN paths p ON p.tree = l.tree AND p.pos = l.pos
        JOIN ends e ON e.tree = l.tree AND e.pos = l.pos
    """


@query("op13_merkle", merkle_sql())
def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's Merkle proof, folded again from a tampered leaf for a seventh of them."""
    docs = read(spark, folder, "documents")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = merkle.leaf(*[more if c == "n_chars" else F.col(c) for c in MERKLE_FIELDS])
    manifest = merkle.build(
        docs, [F.col(c) for c in MERKLE_FIELDS], group="lang", order="doc_id",
        kept=[F.col("doc_id"), F.when(fold("doc_id", 7) == 0, tampered).alias("tampered")],
    )
    start = F.coalesce("kept.tampered", "leaf")
    found = manifest.prove().withColumn("folded_root", merkle.folded(start, F.col("path")))
    return found.select(
        "kept.doc_id", "leaf", "subroot", "root",
        merkle.path_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
