"""The registered queries of the text operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kerbside.llm.bpe import encode_documents
from kerbside.llm.common import read_table
from kerbside.llm.decontaminate import decontaminate
from kerbside.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, block_words, needed_words, scan_licenses, template_words
from kerbside.llm.maxent import score_texts
from kerbside.llm.merkle import FIELDS, verify
from kerbside.llm.packing import pack
from kerbside.llm.quality import apply_rules, classify
from kerbside.llm.sharding import shard_by_bytes
from kerbside.llm.simhash import near_duplicates
from kerbside.llm.suffix_dedup import remove_repeats
from kerbside.llm.toxicity import score_toxicity
from kerbside.llm.whitening import whiten


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), with_kept=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents"), carry=True).drop("row")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=False)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_sharding": op4_sharding,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_packing": op8_token_packing,
    "op9_simhash": op9_simhash,
    "op10_license_scan": op10_license_scan,
    "op11_toxicity": op11_toxicity,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

#: ASCII capitals to small letters only, as the contract has it.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_PHRASE_WORDS = [(n, label, k, w, len(p.split())) for n, (p, label) in enumerate(PHRASES.items()) for k, w in enumerate(p.split())]
_TEMPLATE_WORDS = [
    (n, label, w, block_words(words), len(set(words)), needed_words(len(set(words)), THRESHOLD))
    for n, (label, words) in enumerate((label, template_words(text)) for label, text in TEMPLATES)
    for w in sorted(set(words))
]

#: crc32 of a text: a byte is mixed in, then eight shifts, which 256 stands for.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::UBIGINT, flatten(list_transform(range(1, length({0}) + 1),
        lambda i: [ord({0}[i])::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
    lambda c, x: CASE WHEN x < 256 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in FIELDS) + ")"
_TAMPERED = _LEAF.replace("n_chars", "(n_chars + 1)")


def _levels(leaves: str, name: str) -> str:
    """Nodes of every level of the trees of ``leaves`` (tree, pos, node), pos counted from 0."""
    return f"""{name}(tree, level, pos, node, n) AS (
        SELECT tree, 0, pos, node, count(*) OVER (PARTITION BY tree) FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
        FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n)"""


def _proofs(nodes: str, name: str) -> str:
    """The siblings of every leaf level by level: where each stands (1 left, 2 right, 0 none), and its digest."""
    return f"""{name} AS (
        SELECT leaf.tree, leaf.pos, list(struct_pack(side := CASE WHEN s.node IS NULL THEN 0 ELSE 2 - (up.pos & 1) END, node := s.node)
            ORDER BY up.level) AS steps
        FROM {nodes} AS leaf JOIN {nodes} AS up ON up.tree = leaf.tree AND up.pos = leaf.pos >> up.level AND up.n > 1
        LEFT JOIN {nodes} AS s ON s.tree = up.tree AND s.level = up.level AND s.pos = xor(up.pos, 1)
        WHERE leaf.level = 0 GROUP BY leaf.tree, leaf.pos)"""


ORACLES: dict[str, str] = {
    "op12_merkle_manifest": f"""
        WITH RECURSIVE doc AS (
            SELECT doc_id, lang, {_LEAF} AS leaf,
                   CASE WHEN {_CRC.format("(doc_id::VARCHAR)")} % 7 = 0 THEN {_TAMPERED} ELSE {_LEAF} END AS altered
            FROM documents),
        leaf AS (
            SELECT *, coalesce('1' || lang, '0') AS tree, leaf AS node,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM doc),
        {_levels("leaf", "nodes")},
        {_proofs("nodes", "proofs")},
        top AS (SELECT '' AS tree, tree AS name, node, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
        {_levels("top", "tops")},
        {_proofs("tops", "above")},
        proven AS (
            SELECT doc_id, leaf, altered, top.node AS subroot, (SELECT node FROM tops WHERE n = 1) AS root,
                   coalesce(proofs.steps, []) || coalesce(above.steps, []) AS steps
            FROM leaf JOIN top ON top.name = leaf.tree
            LEFT JOIN proofs ON proofs.tree = leaf.tree AND proofs.pos = leaf.pos LEFT JOIN above ON above.pos = top.pos),
        folded AS (
            SELECT *, row_number() OVER () AS r, list_reduce(
                list_prepend(struct_pack(side := 0, node := altered), steps),
                lambda a, s: struct_pack(side := 0, node := sha256(
                    CASE s.side WHEN 0 THEN a.node WHEN 1 THEN s.node || a.node ELSE a.node || s.node END))).node AS folded_root
            FROM proven)
        SELECT doc_id, leaf, subroot, root,
               sha256(coalesce(array_to_string(list_filter(list_transform(steps, lambda s: s.node), lambda d: d IS NOT NULL), ''), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded""",
    "op10_license_scan": f"""
        WITH phrase(phrase, label, k, word, size) AS (VALUES {_rows(_PHRASE_WORDS)}),
        template(template, label, word, block, size, needed) AS (VALUES {_rows(_TEMPLATE_WORDS)}),
        doc AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        word AS (SELECT r, i - 1 AS pos, w[i] AS word FROM doc, unnest(range(1, len(w) + 1)) AS u(i)),
        place AS (
            SELECT r, phrase, any_value(label) AS label, pos - k AS start
            FROM word JOIN phrase USING (word) GROUP BY r, phrase, pos - k
            HAVING count(*) = any_value(size)),
        base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM place GROUP BY r),
        seen AS (SELECT r, pos, word, template.* EXCLUDE (word) FROM word JOIN template USING (word)),
        block AS (
            SELECT a.r, a.template, a.pos, any_value(a.label) AS label, any_value(a.size) AS size,
                   any_value(a.needed) AS needed, count(DISTINCT b.word) AS common
            FROM seen AS a JOIN seen AS b ON a.r = b.r AND a.template = b.template AND b.pos >= a.pos AND b.pos < a.pos + a.block
            GROUP BY a.r, a.template, a.pos),
        hit AS (SELECT r, label, common / size AS share FROM block WHERE common >= needed),
        best AS (SELECT r, max(share) AS best FROM hit GROUP BY r),
        own AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT r, label FROM place) GROUP BY r),
        every AS (
            SELECT r, string_agg(label, ',' ORDER BY label) AS labels
            FROM (SELECT r, label FROM place UNION SELECT r, label FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
               CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(own.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
        FROM doc LEFT JOIN base USING (r) LEFT JOIN best USING (r) LEFT JOIN own USING (r) LEFT JOIN every USING (r)""",
    "op2_decontaminate": f"""
        WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        gram AS (
            SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS gram, least(len(w), 10) AS size
            FROM item, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(i) WHERE len(w) > 0),
        doc AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT size FROM gram),
        place AS (
            SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
            FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
        found AS (SELECT r, i, size, item_id FROM place JOIN gram USING (gram, size)),
        hit AS (
            SELECT r, count(DISTINCT i + k) AS n_hit
            FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(0, size)) AS u(k) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
}
