"""A corpus from documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table
from roomgrid.llm.jaccard import without_near_copies
from roomgrid.llm.language import UNDETERMINED, fit, held_out, predict
from roomgrid.llm.lines import dedup_lines
from roomgrid.llm.mixing import OTHER, WEIGHTS, mix
from roomgrid.llm.packing import pack
from roomgrid.session import drop_paths, release_shuffles, shared_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document goes if no language has this share of its words; a third of them is below what
#: a text in two languages has.
MIN_SCORE = 1 / 3
#: Near copies share this percentage of their shingles of so many words. op3's own query keeps its 3 and 90.
NEAR_WORDS, NEAR_PERCENT = 5, 80


#: By application: step tables of stages that have returned.
_steps: dict[str, list[str]] = {}


def _frees_steps(stage: Stage) -> Stage:
    """The stage, which first removes the step tables of earlier ones, unless ``docs`` reads them."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_shuffles(spark)
        earlier = _steps.setdefault(spark.sparkContext.applicationId, [])
        if earlier:
            folders = {name.rsplit("/", 1)[0] for name in docs.inputFiles()}
            if not any(folder.endswith(path.split(":", 1)[-1]) for folder in folders for path in earlier):
                drop_paths(spark, earlier)
                earlier.clear()
        before = set(shared_paths(spark))
        result = stage(spark, docs, sf_dir)
        earlier += [path for path in shared_paths(spark) if path not in before]
        return result

    return run


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns c0, c1, ..., so that no name clashes with one that a stage adds, and their names."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


@_frees_steps
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that stands out, go.

    The field learns from those labelled documents that are not held out. A null text goes, as
    does every row if no row has a language. Each row is judged by itself, so repeated rows and
    rows without an id are, too. Texts are read whole; an empty table stays empty; columns of
    any name pass through.
    """
    field = fit(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("text", "lang"))
    plain, names = _plain(docs)
    labelled = stored(predict(plain, field, names["text"]), "labelled")
    kept = labelled.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return kept.select(*names.values()).toDF(*names)


@_frees_steps
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 50 words or more that stood earlier go; a document of which nothing is left goes.

    ``n_chars`` is counted anew, null for a null text, which stays. Rows with one id and text
    are one place, so copies of a row do not shorten each other; rows without an id come
    first. Texts are read whole; an empty table stays empty; columns of any name pass through.
    """
    plain, names = _plain(docs)
    cut = dedup_lines(plain, names["doc_id"], names["text"])
    text = F.col(names["text"])
    kept = cut.where((F.col("_deleted") == 0) | (text != ""))
    return kept.withColumn(names["n_chars"], F.length(text).cast("long")).select(*names.values()).toDF(*names)


@_frees_steps
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Near copies have a Jaccard similarity of ``NEAR_PERCENT`` in shingles of ``NEAR_WORDS`` words.
    Rows without an id stay only if no row of their group has one, and then one does; of
    different texts with one id one stays; repeated rows stay once. Documents without words
    are no copies. An empty table stays empty; columns of any name pass through.
    """
    return without_near_copies(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


@_frees_steps
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat so that sources have their target shares, in a random order.

    Rows without a source are one source; a row without an id or text counts as any other;
    an empty table stays empty; columns of any name pass through.
    """
    return mix(docs, WEIGHTS, OTHER).select(*docs.columns)


@_frees_steps
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens.

    A null or empty text is its end id alone; repeated rows are packed each by itself; long
    texts are cut into windows; other columns are ignored; an empty table gives no rows.
    """
    import public_tokenizers

    return pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learned field is nothing that SQL can state; tests/llm/test_pipeline.py holds each stage
#: against a plain version over the stage's own input.
ORACLE_SQL = None
