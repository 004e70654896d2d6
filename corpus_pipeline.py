"""A corpus made ready for training: toxic and poor documents, near-duplicates and repeated passages go, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import collected, prepared, release, vocabulary, written
from tidemart.llm.minhash import MinHash, keep_one
from tidemart.llm.packing import cut_documents, pack
from tidemart.llm.quality import keep_good
from tidemart.llm.suffix_dedup import remove_repeated_words
from tidemart.llm.toxicity import drop_toxic, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A passage of this many words that occurred before is cut out: those of over 50.
PASSAGE_WORDS = 51

#: SQL cannot express a learned lexicon or suffix order; tests hold the stages against brute force.
ORACLE_SQL = None


#: Tables that the stages made, by session and folder: the stage's place and their paths.
_MADE: dict[tuple[str, str], list[tuple[int, list[str]]]] = {}


def stage(place: int) -> Callable[[Stage], Stage]:
    """A stage that owns the tables it writes on its way. They are deleted when a later stage starts on the same folder: its
    ``docs`` are this one's written result, so nothing reads them again. Tables that ``docs`` does read stay."""

    def own(build: Stage) -> Stage:
        @wraps(build)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            made = _MADE.setdefault((prepared(spark).sparkContext.applicationId, sf_dir), [])
            spent = [path for before, paths in made if before < place for path in paths]
            if spent:
                read = {file.rpartition("/")[0].rpartition("/")[2] for file in docs.inputFiles()}
                spent = [path for path in spent if path.rpartition("/")[2] not in read]
                release(spark, spent)
                made[:] = [(before, [p for p in paths if p not in spent]) for before, paths in made]
            with collected() as paths:
                out = build(spark, docs, sf_dir)
            made.append((place, paths))
            return out

        return run_stage

    return own


@stage(1)
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. Learned from the labels of what is there.

    A null text is scored as an empty one, which stays unless the labels say that empty texts are toxic. Rows without an id
    and repeated rows are scored each by itself. Without labels, or without toxic ones among them, and on an empty table, nothing goes.
    """
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@stage(2)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go.

    A null or empty text has no words and goes. A null language has references of its own. Every row is judged by itself,
    repeated rows and rows without an id too; an empty table stays empty.
    """
    return keep_good(docs)


@stage(3)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id: shingles of five words, a similarity of 0.8 or more.

    Texts without words, nulls among them, are linked with nothing and stay. Of rows equal in id and text one stays; rows
    of one id with different texts are documents of their own; rows without an id all stay; an empty table stays empty.
    """
    return keep_one(docs, MinHash(width=5, percent=80))


@stage(4)
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occurred before are cut out of the texts; every document stays.

    Before means at a smaller id, or earlier in the text; null ids come first, and rows equal in id and text are one place. A
    null text stays null. ``n_chars``, where the table has it, follows the text. An empty table stays empty.
    """
    cut = remove_repeated_words(docs, PASSAGE_WORDS, keep_first=True)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@stage(5)
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences.

    A null or empty text is one piece, the end id. Repeated rows and rows without an id are packed each by itself; an empty
    table gives no pieces.
    """
    return pack(cut_documents(docs, vocabulary(public_tokenizers.path("word_bpe_49k.json"))))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, spent = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, build in STAGES[:-1]:
        result = build(spark, docs, sf_dir)
        with collected() as paths:
            docs = written(spark, result, name)
        release(spark, spent)
        spent = paths
    return STAGES[-1][1](spark, docs, sf_dir)
