"""From raw documents to packed, mixed training windows, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.mixing import in_order, mix
from shelfcast.llm.near_texts import near_classes, one_per_class
from shelfcast.llm.packing import pack
from shelfcast.llm.quality_model import score, train
from shelfcast.llm.quality_rules import repetition
from shelfcast.llm.queries import TEMPERATURE
from shelfcast.llm.queues import fresh, in_written_order, stream_weights
from shelfcast.session import discard, materialise, tune, written_here


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Columns that the stages read; all others are moved aside, so that none is taken for a stage's own verdict.
READ = ("doc_id", "text", "source", "n_chars")


def apart(stage: Stage) -> Stage:
    """The stage, run with the columns that it does not read under other names."""

    @wraps(stage)
    def run_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in READ]
        moved = dict(zip(others, fresh(docs.columns, *(f"aside_{i}" for i in range(len(others)))), strict=True))
        out = stage(spark, docs.withColumnsRenamed(moved), sf_dir)
        return out.withColumnsRenamed({new: old for old, new in moved.items()})

    return run_apart


@apart
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not mostly repetition.

    Null, empty and short texts fail the base rules; a text of any length is read whole; ties and repeated rows are judged each by itself; an
    empty table stays empty; other columns pass through, whatever their names.
    """
    return repetition(docs).filter("kept").select(*docs.columns)


@apart
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels, does not reject.

    Null texts are scored as empty ones; a text of any length is read whole; repeated rows get the same score; an empty table stays empty;
    other columns pass through, whatever their names.
    """
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, machine).filter("predicted = 1").select(*docs.columns)


@apart
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id, ties by digest, one of repeated rows.

    Null texts and texts without words are in no class and stay; a text of any length is compared whole; an empty table stays empty;
    other columns pass through, whatever their names.
    """
    return one_per_class(near_classes(docs)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered by the mixture of their sources: file by file and row by row, which packing follows.

    Weights are rows of a source to the power ``TEMPERATURE``. Null and empty sources are one; null texts, very long texts, ties and repeated rows are rows
    like others, none is dropped or repeated; an empty table stays empty. Other columns pass through, whatever their names.
    """
    mixed, names = mix(docs, temperature=TEMPERATURE)
    return in_order(mixed, names).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1,024 tokens, in the order and to the weights of the stream that the mixing stage wrote.

    Order is that of the written files, however Spark splits them; weights are those at which the sources take turns in it. Null and empty texts
    are one closing id; null and empty sources are one queue; a text of any length is cut where windows end; repeated rows are packed each; an empty
    table gives no pieces. Columns other than doc_id, text and source are left out.
    """
    (position,) = fresh(docs.columns, "stream_position")
    stream = in_written_order(docs, position)
    pieces = pack(stream, stream_weights(stream, "source", position), position=position)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: The model and the sketches are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written before the next one reads them.

    What a stage has written on the way, and the rows of the stage before, are deleted as soon as its own rows are written. The
    intermediate tables of the last stage stay, since its result reads them.
    """
    docs, before = tune(spark).read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with written_here() as made:
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
        discard(spark, [*made[:-1], *before])  # the last path is that of the stage's rows
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
