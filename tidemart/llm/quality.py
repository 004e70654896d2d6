"""Quality rules by distribution divergence (operator 3), in DataFrame functions alone.

Base rules count words, symbols, repeated lines and repeated 8-word windows. A document that passes them is
compared with the reference of its language: the Jensen-Shannon distance of its character classes, and of
its common words and all others, to the mean of all the language's documents. The references come from the
whole corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import unused, written

#: The white space between words and the characters counted as symbols.
SPACE = "[\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Character classes as (name, pattern), each counted in what the ones before it have left; the rest is one more class.
CLASSES = (
    ("lower", "\\p{Ll}+"),
    ("space", f"{SPACE}+"),
    ("upper", "\\p{Lu}+"),
    ("symbol", f"{SYMBOLS}+"),
    ("stop", "[.,;:!?]+"),
    ("digit", "\\p{Nd}+"),
)
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules. Distances have base 2 logarithms; class distances are in 0..1, and a word distance
    of 1 is that of a text without any common word."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: Documents with fewer characters in words are too short for the character classes to tell anything.
    min_chars: int = 200
    #: Where a text of its length would have fewer common words than this, the limit of the word distance is wider.
    min_common: int = 40
    #: A class distance may be class_floor + class_slack / sqrt(characters): chance alone moves short texts further.
    class_floor: float = 0.06
    class_slack: float = 3.4
    max_word_distance: float = 0.6
    #: Common words of a language: the most frequent ones, by documents, of at most so many letters.
    common_words: int = 24
    longest_common: int = 4


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _twice(hashes: str, gap: int) -> Column:
    """Hashes of windows twice as long: each joined with the one ``gap`` places on. The last ``gap`` are of no use."""
    return F.zip_with(F.col(hashes), F.slice(hashes, gap + 1, 2**30), lambda a, b: F.xxhash64(a, b))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: equal hashes meet when sorted with their places."""

    def repeated(ordered: Column) -> Column:
        after = F.slice(ordered, 2, F.size(ordered))
        same = F.zip_with(ordered, after, lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))

        def places(equal: Column) -> Column:
            # Equal to the one after it, or to the one before.
            both = F.zip_with(equal, F.concat(F.array(F.lit(False)), equal), lambda a, b: F.coalesce(a, F.lit(False)) | b)
            own = F.zip_with(ordered, both, lambda o, b: F.when(b, o["i"]))
            return F.sort_array(F.filter(own, lambda i: i.isNotNull()))

        return _let(same, places)

    def total(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(ordered, repeated), total)


def base_counts(df: DataFrame, text: str, of_words: dict[str, Column] | None = None) -> DataFrame:
    """Adds the counts of the character classes (``c_<class>``, ``c_other``), n_words, word_chars, n_symbols,
    n_dup_lines and n_repeat_words of the column ``text``, and what ``of_words`` says of the column ``words``.

    Each step that is used more than once is a column of its own, so that it is computed once, and the
    words themselves are dropped as soon as they are hashed.
    """
    keep = df.columns
    left = text
    for i, (name, pattern) in enumerate(CLASSES):
        df = df.withColumn(f"left_{i}", F.regexp_replace(left, pattern, ""))
        df = df.withColumn(f"c_{name}", F.length(left) - F.length(f"left_{i}"))
        left = f"left_{i}"
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = df.withColumns({"c_other": F.length(left), "words": F.array_remove(F.split(text, f"{SPACE}+"), ""), "lines": lines})
    out = out.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": (F.length(text) - F.col("c_space")).cast("long"),
            "n_symbols": F.col("c_symbol").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "h1": F.transform("words", lambda w: F.xxhash64(w)),
            **(of_words or {}),
        }
    )
    counted = [c for c in keep if c != text] + [*(f"c_{name}" for name, _ in CLASSES), "c_other", *(of_words or {})]
    out = out.select(*counted, "n_words", "word_chars", "n_symbols", "n_dup_lines", "h1")
    for width in (1, 2, 4):
        out = out.withColumn(f"h{2 * width}", _twice(f"h{width}", width)).drop(f"h{width}")
    out = out.withColumn("windows", F.slice("h8", 1, F.greatest(F.col("n_words").cast("int") - WINDOW + 1, F.lit(0))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return out.withColumn("n_repeat_words", F.when(repeats, _covered(F.col("windows"))).otherwise(0).cast("long"))


def _bare(words: Column, longest: int) -> Column:
    """Short words in small letters; marks stay, so a word before one is a word of its own."""
    return F.transform(F.filter(words, lambda w: F.length(w) <= longest), lambda w: F.lower(w))


def common_words(docs: DataFrame, lang: str, text: str, limits: Limits) -> DataFrame:
    """(lang, common): each language's most frequent short words, by documents, ties by the alphabet."""
    words = F.array_distinct(_bare(F.split(text, f"{SPACE}+"), limits.longest_common))
    counts = docs.select(lang, F.explode(words).alias("word")).filter(F.col("word").rlike("^\\p{L}+$")).groupBy(lang, "word").count()
    best = F.row_number().over(Window.partitionBy(lang).orderBy(F.desc("count"), "word"))
    top = counts.withColumn("place", best).filter(F.col("place") <= limits.common_words)
    return top.groupBy(lang).agg(F.sort_array(F.collect_list(F.struct("place", "word")))["word"].alias("common"))


def _distance(own: Column, reference: Column) -> Column:
    """The Jensen-Shannon distance of two distributions, as arrays of shares."""

    def term(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return sum((F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0) for x in (p, q)), F.lit(0.0))

    total = F.aggregate(F.zip_with(own, reference, term), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(own.isNotNull(), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def _distances(rated: DataFrame, sizes: dict[str, int], chosen: dict[str, Column]) -> DataFrame:
    """``<name>_distance`` of each document's ``<name>_shares`` to the mean of its language's ``chosen`` documents,
    and that mean as ``<name>_reference``.

    Null where the shares are null: too little text to tell.
    """
    means = {
        name: F.array(*(F.coalesce(F.avg(F.when(chosen[name], F.get(f"{name}_shares", F.lit(i)))), F.lit(0.0)) for i in range(size)))
        for name, size in sizes.items()
    }
    # A row a language, written so that its size is known when the join is planned.
    references = rated.groupBy("lang").agg(*(mean.alias(f"{name}_reference") for name, mean in means.items()))
    rated = rated.join(written(rated.sparkSession, references, "references"), "lang")
    far = {f"{name}_distance": _distance(F.col(f"{name}_shares"), F.col(f"{name}_reference")) for name in sizes}
    return rated.withColumns(far)


def judge_quality(
    df: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, class_distance, word_distance, kept.

    A document is kept unless the base rules fail it or a distance is above its limit. The class distance
    counts only for documents of at least ``min_chars``. The word distance counts at any length, in parts of
    that of a text without any common word; its limit grows as chance does where a text of that length would
    have fewer than ``min_common`` common words. It is null in a language without common words. A null or empty text has
    no words and fails the base rules. Documents of no language form a language of their own. Rows with
    equal ids are judged apart; a null id stays null; an empty table gives no rows.

    The text is read twice and never shuffled: once for the common words, once for the counts, which are
    written; the references are sums over those. The tables joined to the documents have a row a language.
    """
    spark = df.sparkSession
    docs = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
    )
    common = written(spark, common_words(docs, "lang", "text", limits), "common-words")
    # One letter for each common word of the text, by its place in the list, so that counting is a matter of lengths.
    letters = [chr(ord("A") + i) for i in range(limits.common_words)]
    place = F.transform(_bare(F.col("words"), limits.longest_common), lambda w: F.array_position("common", w))
    spelled = F.array_join(F.transform(F.filter(place, lambda i: i > 0), lambda i: F.substring(F.lit("".join(letters)), i.cast("int"), F.lit(1))), "")
    counted = base_counts(docs.join(common, "lang", "left"), "text", {"found": F.coalesce(spelled, F.lit(""))})
    hits = [F.length("found") - F.length(F.replace("found", F.lit(c), F.lit(""))) for c in letters]
    classes = [F.col(f"c_{name}") for name, _ in CLASSES] + [F.col("c_other")]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    totals = [sum(classes[1:], classes[0]).alias("n_chars")]
    others = F.col("n_words") - F.length("found")
    arrays = [F.array(*classes).alias("classes"), F.array(*hits, others).alias("words")]
    counts = written(spark, counted.select("doc_id", "lang", *base, *totals, *arrays), "quality-counts")

    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    shares = {
        "class_shares": F.when(F.col("word_chars") >= limits.min_chars, F.transform("classes", lambda n: n / F.col("n_chars"))),
        "word_shares": F.when(F.col("n_words") > 0, F.transform("words", lambda n: n / F.col("n_words"))),
    }
    rated = counts.withColumns({"base_failed": failed, **shares}).drop("classes", "words")
    sizes = {"class": len(classes), "word": len(hits) + 1}
    # The mean of all documents first, then that of the half of them nearest to it: poor documents move the
    # first and are not in the second.
    rated = _distances(rated, sizes, {k: ~F.col("base_failed") for k in sizes}).drop(*(f"{k}_reference" for k in sizes))
    middle = rated.groupBy("lang").agg(*(F.percentile_approx(F.when(~F.col("base_failed"), F.col(f"{k}_distance")), 0.5).alias(f"{k}_middle") for k in sizes))
    rated = written(spark, rated.join(written(spark, middle, "middles"), "lang"), "quality-rated")
    rated = _distances(rated, sizes, {k: ~F.col("base_failed") & (F.col(f"{k}_distance") <= F.col(f"{k}_middle")) for k in sizes})
    without = _distance(F.array(*[F.lit(0.0)] * len(hits), F.lit(1.0)), F.col("word_reference"))
    rated = rated.withColumn("word_distance", F.when(without > 0, F.col("word_distance") / without))
    most = limits.class_floor + limits.class_slack / F.sqrt("n_chars")
    expected = F.col("n_words") * (1 - F.element_at("word_reference", -1))
    most_words = limits.max_word_distance * F.sqrt(F.greatest(F.lit(1.0), limits.min_common / expected))
    near = [F.coalesce(F.col(f"{k}_distance") <= v, F.lit(True)) for k, v in (("class", most), ("word", most_words))]
    rated = rated.withColumn("kept", ~F.col("base_failed") & near[0] & near[1])
    return rated.select("doc_id", *base, "base_failed", "kept", "class_distance", "word_distance")


def keep_good(df: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns. Rows meet their verdicts by a hash of (id, text, lang)."""
    key = unused(df, "quality_key")
    own = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{lang_col}`"))
    keyed = df.withColumn(key, own)
    verdicts = judge_quality(keyed, limits, key, text_col, lang_col)
    return keyed.join(verdicts.filter("kept").select(F.col("doc_id").alias(key)).distinct(), key, "left_semi").drop(key)
