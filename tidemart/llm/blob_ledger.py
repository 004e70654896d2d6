"""Secret scans with an incremental ledger of blobs, in DataFrame functions alone.

Every version of every path is named by the SHA-256 of its text, its blob. The ledger is a Parquet table with
a row for each blob and the rule versions that have been run on it, findings included. A scan looks up which
(blob, rule version) pairs are not there yet, reads the text of one row for each such blob, runs only the missing
rules and appends the result. Findings are then joined back to all paths.

Only hashes are grouped; texts move at most once, and only to meet the list of blobs to scan. A blob that
a third of all paths share is one row of that list, and its findings go to its paths over many salts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions import named
from tidemart.llm.common import SALT, lookup, salted, written
from tidemart.session import scratch


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern`` (Java syntax), less those whose ``group`` has fewer than
    ``at_least`` characters. A text without the literal ``needs`` has no match. A change of meaning takes a new
    ``version``, so that blobs are scanned again."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    at_least: int = 0
    needs: str | None = None

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


#: The rules that the query's contract fixes, in its order.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        at_least=8,
    ),
    SecretRule("access", "AKIA[A-Z0-9]+", at_least=16, needs="AKIA"),
    SecretRule("hex", "[0-9a-f]{32,}"),
)

#: Well-known public formats besides: PEM private keys, JSON web tokens, GitHub tokens.
MORE_RULES = (
    SecretRule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="eyJ"),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]{36,}", needs="gh"),
)

SPAN = "struct<rule:string,start:int,end:int>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All batches of a ledger; empty where nothing was scanned yet."""
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _found(rule: SecretRule, wanted: Column) -> Column:
    """The matches of a rule in ``text`` with the lengths of the texts before them, null if there are none."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    there = F.contains(text, F.lit(rule.needs)) if rule.needs else F.rlike(text, pattern)
    held = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    return F.when(
        wanted & there,
        F.struct(
            F.lit(rule.id).alias("rule"),
            F.lit(rule.at_least).alias("at_least"),
            F.arrays_zip(
                F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
                F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("size"),
                held.alias("held"),
            ).alias("matches"),
        ),
    )


def _spans(texts: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """Spans of the missing rules, a row per blob that has any. Places are running sums of the lengths of matches
    and of the texts between them."""
    tried = F.array(*[_found(rule, F.array_contains("missing", rule.id)) for rule in rules])
    hits = texts.select("blob", F.explode(tried).alias("hit")).filter("hit is not null and size(hit.matches) > 0")
    # repeated rows of the one path that stands for a blob are scanned alike
    hits = hits.select("blob", "hit.*").dropDuplicates(["blob", "rule"])
    each = hits.select("blob", "rule", "at_least", F.posexplode("matches").alias("at", "match"))
    before = Window.partitionBy("blob", "rule").orderBy("at")
    end = F.sum(F.expr("match.gap + match.size")).over(before).cast("int")
    # the last text comes after all matches, so it has no match and goes here
    placed = each.withColumn("end", end).filter("match.held >= at_least")
    span = F.struct("rule", F.expr("end - match.size").alias("start"), "end")
    return placed.groupBy("blob").agg(F.collect_list(span).alias("spans"))


def scan(
    versions: DataFrame,
    folder: str | None = None,
    rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES,
    id_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """Findings of every row: the columns ``id_cols``, ``blob``, and ``spans``, an array of (start, kind, name, end)
    in code points, end exclusive, sorted by start and then by the order of ``rules``.

    ``versions`` has a row per version of a path; ``id_cols`` name it and are only carried along. ``folder`` is the
    ledger, by default a new one under ``spark.checkpoint.dir``. What it holds is not scanned again; a batch is
    appended when it is whole, so a scan that was broken off leaves nothing behind, and two scans of the same blobs
    at once append equal findings, which count once.
    A null text is the empty text. Rows without any secret have an empty array; repeated rows, rows with null ids
    and one id with several texts each keep their row; an empty table gives none and appends nothing.
    Other columns, whatever their names, are not looked at. Whole texts are scanned.
    """
    spark = versions.sparkSession
    folder = folder or scratch(spark, "blob-ledger")
    ids = [named(c).alias(f"id_{i}") for i, c in enumerate(id_cols)]
    rows = versions.select(F.struct(*ids).alias("ids"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    paths = written(spark, salted(rows.select("ids", _blob(F.col("text")).alias("blob"))), "paths")

    known = read_ledger(spark, folder).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("rules"))
    firsts = paths.groupBy("blob", SALT).agg(F.min("ids").alias("ids")).groupBy("blob").agg(F.min("ids").alias("ids"))
    wanted = F.array(*[F.lit(rule.id) for rule in rules])
    missing = F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>")))
    unseen = firsts.join(known, "blob", "left").select("blob", "ids", missing.alias("missing")).filter("size(missing) > 0")
    unseen = written(spark, unseen, "unseen-blobs")

    mine = rows.withColumn("blob", _blob(F.col("text"))).alias("r")
    same = (F.col("r.blob") == F.col("u.blob")) & F.col("r.ids").eqNullSafe(F.col("u.ids"))
    texts = mine.join(unseen.alias("u"), same).select("u.blob", "u.missing", "r.text")
    batch = unseen.join(_spans(texts, rules), "blob", "left").select(
        "blob", F.col("missing").alias("rules"), F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")
    )
    batch.write.mode("append").parquet(folder)
    return findings(paths, read_ledger(spark, folder), rules).select(
        *[F.col(f"ids.id_{i}").alias(c) for i, c in enumerate(id_cols)], "blob", "spans"
    )


def findings(paths: DataFrame, ledger: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """The paths with the spans that the ledger has for their blobs and these rule versions."""
    names = {rule.id: rule.name for rule in rules}
    kind = F.array_position(F.array(*map(F.lit, names)), F.col("span.rule")).cast("int") - 1
    name = F.element_at(F.array(*map(F.lit, names.values())), kind + 1)
    each = ledger.filter("size(spans) > 0").select("blob", F.explode("spans").alias("span"))
    each = each.filter(F.col("span.rule").isin(list(names))).distinct()
    span = F.struct("span.start", kind.alias("kind"), name.alias("name"), "span.end")
    found = each.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,name:string,end:int>>")
    return lookup(paths, found, "blob").withColumn("spans", F.coalesce("spans", none))


def secret_digests(versions: DataFrame, folder: str | None = None) -> DataFrame:
    """Per document the counts of the base kinds, a digest of their spans, and all spans as text."""
    found = scan(versions, folder)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")

    def count(rule: SecretRule) -> Column:
        return F.size(F.filter("spans", lambda s: s["name"] == rule.name)).cast("long").alias(f"n_{rule.name}")

    return found.select(
        "doc_id", *map(count, BASE_RULES), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
