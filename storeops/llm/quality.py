"""Quality rules: repetition counts, and divergence of a document's histograms from its language's.

The character classes and the common words of a document are counted and compared, by Jensen-Shannon distance, with the
pooled histograms of all documents of its language.  Everything is one pass of built-in functions; only narrow rows (no
text) are stored between counting and judging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.llm.common import store, whole, words

# Frequent function words of each language that has a reference of its own.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une"],
}
WINDOW = 5
MIN_WORDS = 10  # below this the base rule rejects
MAX_REPEAT = 20  # percent of words in repeated windows
GUARD_CHARS = 400  # shorter texts are not judged by their characters ...
GUARD_WORDS = 50  # ... or by their words
MAX_CHAR_DISTANCE = 0.35
MAX_WORD_DISTANCE = 0.60


def repeated_words(tokens: Column, n: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in the text, first occurrences included."""
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))


def repeated_places(rows: DataFrame) -> DataFrame:
    """Adds ``places``: the sorted starts of repeated windows, null where none repeats.

    Each step is a column of its own: an array computed inside a lambda would be computed anew for every element.
    """
    ranked = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    near = lambda k: F.get("ranked", k)["h"]
    again = F.filter("ranked", lambda x, k: F.coalesce(near(k - 1) == x["h"], F.lit(False)) | F.coalesce(near(k + 1) == x["h"], F.lit(False)))
    return (
        rows.withColumn("ranked", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), ranked))
        .withColumn("again", again)
        .withColumn("places", F.array_sort(F.transform("again", lambda x: x["i"])))
    )


def covered() -> Column:
    """Words covered by the windows at ``places``: each covers its words up to the next one."""
    steps = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0))


def language(lang: Column) -> Column:
    """One of the languages with a word list, else one common class."""
    return F.when(lang.isin(*COMMON), lang).otherwise("other")


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, language, base counts and histograms of every document; no text."""
    lists = F.create_map(*[x for k, v in COMMON.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    tokens, text = F.col("tokens"), F.col("body")
    rows = repeated_places(
        docs.select("doc_id", language(F.col("lang")).alias("lang"), whole("text").alias("body"))
        .withColumn("tokens", words(text))
        .withColumn("n_words", F.size(tokens))
        .withColumn("word_chars", F.length(F.array_join(tokens, "")))
        .withColumn("lines", F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("hashes", repeated_words(tokens, F.col("n_words")))
        .withColumn("common", lists[F.col("lang")])
        .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")))
        .withColumn("digits", F.regexp_count(text, F.lit("[0-9]")))
        .withColumn("capitals", F.regexp_count(text, F.lit("[A-Z]")))
        .withColumn("marks", F.regexp_count(text, F.lit(r"[.,;:!?()\"'\-]")))
        .withColumn("spaces", F.length(text) - F.col("word_chars"))
        .withColumn("foreign", F.octet_length(text) - F.length(text))
    )
    seen = [F.col("n_words") - F.size(F.array_remove(tokens, F.get("common", F.lit(i)))) for i in range(10)]
    classes = [F.col(c) for c in ("n_symbols", "digits", "capitals", "marks", "spaces", "foreign")]
    rest = F.greatest(F.length("body") - sum(classes, F.lit(0)), F.lit(0))
    found = F.transform(F.array(*seen), lambda x: F.coalesce(F.greatest(x, F.lit(0)), F.lit(0)).cast("long"))
    return rows.select(
        "doc_id", "lang", F.length("body").alias("chars"), F.col("n_words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered().cast("long").alias("n_repeat_words"),
        F.transform(F.array(*classes, rest), lambda x: x.cast("long")).alias("char_counts"),
        F.when(F.col("common").isNull(), F.array_repeat(F.lit(0).cast("long"), 10)).otherwise(found).alias("common_counts"),
    ).withColumn(
        "word_counts",
        F.concat("common_counts", F.array(F.col("n_words") - F.aggregate("common_counts", F.lit(0).cast("long"), lambda a, x: a + x))),
    ).drop("common_counts")


def references(counted: DataFrame) -> DataFrame:
    """One pooled histogram pair per language class: at most one row per listed language plus one."""
    total = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i))) for i in range(n)])
    return counted.groupBy("lang").agg(total("char_counts", 7).alias("ref_chars"), total("word_counts", 11).alias("ref_words"))


def distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two count arrays; 0 when either is empty."""
    sum_of = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    na, nb = sum_of(a), sum_of(b)

    def term(x, y):
        p, q = x / na, y / nb
        half = lambda u, v: F.when(u > 0, u * F.log2(2 * u / (u + v))).otherwise(0.0)
        return (half(p, q) + half(q, p)) / 2

    js = F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, x: s + x)
    return F.when((na > 0) & (nb > 0), F.sqrt(F.greatest(js, F.lit(0.0)))).otherwise(0.0)


def judge(docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Counts, distances and verdict per row of ``docs`` (doc_id, text, lang).

    A null or empty text has no words, fails the base rule and has distance 0.  A null or unlisted language is judged
    against the pool of all such documents.  Each row is judged alone, so ties and repeated rows get equal results.
    """
    counted = store(counts(docs), "quality_counts")
    judged = counted.join(F.broadcast(references(counted)), "lang")  # five rows at most
    return (
        judged.withColumn("char_distance", F.when(F.col("chars") >= GUARD_CHARS, distance(F.col("char_counts"), F.col("ref_chars"))).otherwise(0.0))
        .withColumn("word_distance", F.when(F.col("n_words") >= GUARD_WORDS, distance(F.col("word_counts"), F.col("ref_words"))).otherwise(0.0))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("char_distance") <= max_char) & (F.col("word_distance") <= max_word))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")
    )
