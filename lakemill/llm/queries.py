"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import chat, exact_dedup, fim, html_extract, language_id, licenses, merkle, mixing, near_dedup, packing, pieces, quality, toxicity
from lakemill.llm.common import table

#: The vocabulary file that op10 and the pipeline encode with, unless the session's setting lakemill.pieces.model names one.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def piece_model(spark: SparkSession) -> pieces.PieceModel:
    return pieces.PieceModel.read(spark.conf.get("lakemill.pieces.model", PIECE_MODEL))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: A conversation whose texts hold the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, as read back from the formatted text and its loss mask."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    probe = probe.select(*[F.col(c).cast(turns.schema[c].dataType).alias(c) for c in turns.columns])
    convs = chat.formatted(turns.union(probe))
    convs = convs.withColumns({"turns": chat.read_back("formatted"), "loss": F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: chat.unescape(x["text"]))})
    written = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return convs.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(written, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learned_and_predicted(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many places speak of licences, the families they name, in order, and the surest place's probability."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    sure = F.filter("findings", lambda x: x["family"] != "unknown")
    families = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(sure, lambda x: F.concat(F.array(x["family"]), x["others"]))))), ",")
    return found.select(
        "doc_id", "n_paragraphs", families.alias("families"), F.size(sure).cast("long").alias("n_confirmed"),
        F.round(F.array_max(F.transform("findings", lambda x: x["probability"])), 6).alias("probability"),
    )


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.learned_and_scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "clauses")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), width=4)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether decoding gives its text back."""
    model = piece_model(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.decode(pieces.encode(docs, model), model)
    same = F.col("decoded").eqNullSafe(F.replace(F.col("text"), F.lit(pieces.BLANK), F.lit(" ")))
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))


#: What a leaf of op11's manifest holds, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and where the proof leads when the text of every third document is lower-cased."""
    docs = table(spark, sf_dir, "documents")
    # The translation goes by code points, so a text without capitals, even one that is not valid UTF-8, is left alone.
    lower = F.when(F.col("text").rlike("[A-Z]"), F.translate("text", CAPITALS, CAPITALS.lower())).otherwise(F.col("text"))
    tampered = F.when(merkle_third("doc_id"), merkle.leaf(*[lower if c == "text" else F.col(c) for c in LEAF]))
    found = merkle.proofs(merkle.manifest(docs, LEAF, tampered=tampered))
    reached = found.withColumns({"proof_sha256": merkle.proof_digest(), "folded_root": merkle.folded(F.coalesce("tampered", "leaf"))})
    return reached.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def merkle_third(id_col: str) -> Column:
    """Whether 3 divides the crc32 of the decimal id; not of a null one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 0, F.lit(False))


#: The tokenizer that op12 packs with, unless the session's setting lakemill.packing.tokenizer names another file.
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place; the tokenizer's file is read once, by the driver."""
    tokenizer = Path(spark.conf.get("lakemill.packing.tokenizer", TOKENIZER)).read_text(encoding="utf-8")
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document is cut, and digests of its output and of the text that the output gives back."""
    found = fim.transform(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    stop_words = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    return {
        "op1_quality_rules": rf"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
            w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
            places AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
            windows AS (SELECT doc_id, i, w[i:i+4] AS five FROM places),
            twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows),
            covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
            s AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
                         len(list_filter(w, lambda x: list_contains([{stop_words}], lower(x)))) AS n_stop_words,
                         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_adjacent
                  FROM w d LEFT JOIN covered c USING (doc_id)),
            b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                   NOT base_failed AND 100 * word_chars BETWEEN 100 * n_words AND 2500 * n_words AND 100 * n_symbols <= 25 * n_words
                   AND 100 * n_adjacent <= 20 * n_words AND (n_words < 100 OR 100 * n_stop_words >= n_words) AND 100 * n_dup_lines <= 60 * n_lines AS kept
            FROM b""",
        "op2_chat_format": """
            WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
            escaped AS (SELECT *, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS safe,
                               lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                               lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after FROM turns)
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                   coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
                   sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
                   sum(12 + length(role) + 1 + length(safe) + 11)::BIGINT AS formatted_chars,
                   bool_and(CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                                      WHEN 'assistant' THEN before = 'user' AND before IS NOT NULL ELSE false END
                            AND (after IS NOT NULL OR role = 'assistant')) AS valid
            FROM escaped GROUP BY conv_id""",
        "op8_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op11_merkle_manifest": merkle_sql(),
        "op13_fill_in_middle": r"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
            u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                         list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM d),
            k AS (SELECT *, len(u)::BIGINT AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS i, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS j,
                         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
            c AS (SELECT doc_id, text, n, form, array_to_string(u[1:i], '') AS p, array_to_string(u[i + 1:j], '') AS m, array_to_string(u[j + 1:], '') AS s FROM k)
            SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
                   sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
                   sha256(text) AS restored_sha256
            FROM c""",
    }


def merkle_sql(levels: int = 12) -> str:
    """SQL for op11, level by level, for up to 8 ** levels documents of a language and as many languages."""
    item = lambda c, v: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v})::VARCHAR || ':' || {v} END"
    leaf = lambda text: "sha256(" + " || ".join(item(c, text if c == "text" else f"{c}::VARCHAR") for c in LEAF) + ")"

    def climb(name: str) -> str:
        """From name0(tree, i, h): the runs of each level, in order, with the level's size, and the next level."""
        return "".join(
            f"""
            {name}{k}n AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}),
            {name}{k}r AS (SELECT tree, i // 8 AS i, list(h ORDER BY i) AS run, max(n) AS n FROM {name}{k}n GROUP BY tree, i // 8),
            {name}{k + 1} AS (SELECT tree, i, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM {name}{k}r),"""
            for k in range(levels)
        )

    def walk(name: str, way: str) -> str:
        """From way0(doc_id, leaf, subroot, tree, i, f, proof): a level up, folding f and gathering what stands beside it."""
        left, right = "array_to_string(run[1:w.i % 8], '')", "array_to_string(run[w.i % 8 + 2:], '')"
        return "".join(
            f"""
            {way}{k + 1} AS (SELECT doc_id, leaf, subroot, w.tree, w.i // 8 AS i, CASE WHEN n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f, proof || {left} || {right} AS proof
                             FROM {way}{k} w JOIN {name}{k}r r ON r.tree = w.tree AND r.i = w.i // 8),"""
            for k in range(levels)
        )

    lower = f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')"
    # The crc32 of an id's digits, bit by bit.
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {bits}), 4294967295)"
    return f"""
            WITH leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS leaf, {leaf(lower)} AS lowered, {crc} AS crc FROM documents),
            placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
            g0 AS (SELECT tree, i, leaf AS h FROM placed),{climb("g")}
            subroots AS (SELECT tree AS own, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM g{levels}),
            t0 AS (SELECT '*' AS tree, i, subroot AS h FROM subroots),{climb("t")}
            w0 AS (SELECT doc_id, leaf, NULL::VARCHAR AS subroot, tree, i, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS f, '' AS proof FROM placed),{walk("g", "w")}
            x0 AS (SELECT doc_id, leaf, s.subroot, '*' AS tree, s.i, f, proof FROM w{levels} w JOIN subroots s ON s.own = w.tree),{walk("t", "x")}
            done AS (SELECT x.*, t.h AS root FROM x{levels} x CROSS JOIN t{levels} t)
            SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM done"""
