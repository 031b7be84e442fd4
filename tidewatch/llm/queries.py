"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, quality, repeats, tokenbin, toxicity
from .common import documents, table
from .decontam import ORACLE as OVERLAP_SQL
from .decontam import clean, overlaps
from .exact_dedup import distinct_documents, exact_groups
from .licenses import ORACLE as LICENSE_SQL
from .licenses import scan
from .near_dedup import ORACLE as NEAR_SQL
from .near_dedup import near_groups, one_of_each
from .packing import pack


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal(table(spark, sf_dir, "conversations"))


def op2_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer())


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_mixing_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(documents(spark, sf_dir), tokenizer())


def op6_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir))


def op8_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).drop("spans")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_snapshot_collapse": op1_snapshot_collapse,
    "op2_best_two_fit": op2_best_two_fit,
    "op3_spaced_seeds": op3_spaced_seeds,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_mixing_coder": op5_mixing_coder,
    "op6_merged_transforms": op6_merged_transforms,
    "op7_chosen_path": op7_chosen_path,
    "op8_toxicity_trees": op8_toxicity_trees,
    "op9_license_diagonals": op9_license_diagonals,
    "op10_exact_dedup": op10_exact_dedup,
}

ORACLES: dict[str, str] = {
    "op1_snapshot_collapse": chat.ORACLE,
    "op3_spaced_seeds": OVERLAP_SQL,
    "op7_chosen_path": NEAR_SQL,
    "op9_license_diagonals": LICENSE_SQL,
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY body)""",
}


def judged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return distinct_documents(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer())


#: The stages of the corpus pipeline: each works on all that the one before kept; the last packs.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", judged),
    ("exact_dedup", distinct),
    ("near_dedup", unlike),
    ("decontamination", unleaked),
    ("packing", packed),
]
