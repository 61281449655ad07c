"""Operator 3: quality rules with a distribution divergence, in DataFrame functions only.

Each text becomes two histograms: its characters by class and its common words. Both are
compared with those of the reference languages by the Jensen-Shannon distance (base 2, from 0
to 1); a text of a listed language that is close to no reference in both is not kept. References
are fixed shares, so the verdict on a text depends on nothing but the text and its language: it
is the same alone, in a small table and among billions. Texts of languages without a reference
are held to the base rule alone, and texts below the minimum lengths are not judged by
divergence, as their histograms are mostly noise.

The histograms are also summed over all documents of each listed language, however few, and every
text is compared with the sums of its own language: two distances beside the verdict.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.llm.common import write_shared

# The languages, their common words, and rounded shares in general prose: of the
# characters by class (below) and, in percent of all words, of the common words.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "ein", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
}
WORD_SHARES = {
    "en": [6.0, 3.0, 2.7, 2.6, 2.0, 1.1, 1.1, 1.0, 0.95, 0.9, 0.7, 0.7],
    "de": [3.3, 3.3, 2.5, 1.8, 1.3, 1.1, 1.1, 1.1, 1.0, 1.0, 0.9, 0.8],
    "fr": [4.8, 2.7, 2.7, 2.3, 2.1, 2.0, 1.6, 1.5, 1.2, 1.1, 0.9, 0.8],
    "es": [6.4, 4.1, 3.0, 2.8, 2.7, 2.5, 1.7, 1.1, 1.0, 0.9, 1.0, 0.9],
}
CLASS_SHARES = {  # space, upper, digit, stop, symbol, wide; plain letters are the rest
    "en": [17.0, 2.5, 0.5, 2.5, 0.05, 0.1],
    "de": [15.0, 5.5, 0.5, 2.5, 0.05, 1.8],
    "fr": [16.5, 2.0, 0.5, 3.0, 0.05, 3.5],
    "es": [16.5, 2.0, 0.5, 2.5, 0.05, 2.2],
}
CLASSES = ["space", "upper", "digit", "stop", "symbol", "wide", "plain"]
PATTERNS = {
    "upper": "[A-Z]+", "digit": "[0-9]+", "stop": "[.,;:!?]+", "symbol": "[#*$%&|<>]+",
    "wide": "[^\\x00-\\x7F]+",
}
BLANK = "[\\x20\\x09-\\x0D]+"
MIN_WORDS = 50           # the base rule
MIN_COMMON = 150         # words, the least for judging by common words
MIN_CHARS = 200          # characters, the least for judging by character classes
MAX_REPEATED = 50        # percent of the words in repeated windows
CLASS_LIMIT = 0.30
WORD_LIMIT = 0.28
DIGITS = 6               # of distances from the corpus


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def taken_out(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array.

    If all windows differ, nothing else is computed. Otherwise windows are sorted with their
    places, equal neighbours mark the places, and the words they cover are counted once.
    """
    windows = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )).otherwise(F.array().cast("array<string>"))
    return windows


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_m`` of all counts per text; nothing is shuffled."""
    body = F.coalesce(F.col(text), F.lit(""))
    first = docs.withColumn("_t", body).withColumn("_w", F.array_remove(F.split("_t", BLANK), ""))
    words = F.col("_w")
    second = first.withColumn("_win", repeated_words(words)).withColumn(
        "_lines", F.filter(F.split("_t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    ).withColumn(
        # common words only, each between two spaces
        "_common", F.concat(F.lit(" "), F.lower(F.array_join(F.filter(
            words, lambda w: F.lower(w).isin(vocabulary())), "  ")), F.lit(" "))
    ).withColumn("_chars", F.length(F.array_join("_w", "")))
    third = second.withColumn("_sorted", F.when(
        F.size("_win") > F.size(F.array_distinct("_win")),
        F.sort_array(F.transform("_win", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    place = F.transform(
        F.filter(
            F.transform("_sorted", lambda s, k: F.struct(
                s["i"].alias("i"),
                ((F.get("_sorted", k - 1)["w"] == s["w"]) | F.coalesce(
                    F.get("_sorted", k + 1)["w"] == s["w"], F.lit(False))).alias("twice"))),
            lambda s: s["twice"]),
        lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))
    fourth = third.withColumn("_repeats", F.coalesce(
        F.when(F.col("_sorted").isNotNull(), F.size(F.array_distinct(F.flatten(place)))), F.lit(0)))
    counts = {k: taken_out(F.col("_t"), p) for k, p in PATTERNS.items()}
    fifth = fourth.select(*docs.columns, "_t", "_w", "_lines", "_common", "_chars", "_repeats",
                          *[c.alias(f"_{k}") for k, c in counts.items()])
    space = F.length("_t") - F.col("_chars")
    known = reduce(lambda a, b: a + b, [F.col(f"_{k}") for k in PATTERNS])
    common = [
        (F.length("_common") - F.length(F.replace("_common", F.lit(f" {w} ")))) / (len(w) + 2)
        for w in vocabulary()]
    return fifth.select(*docs.columns, F.struct(
        F.size("_w").cast("long").alias("n_words"), F.col("_chars").cast("long").alias("word_chars"),
        F.col("_symbol").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").cast("long").alias("n_repeat_words"),
        F.array(*[c.cast("long") for c in [
            space, *[F.col(f"_{k}") for k in PATTERNS], F.length("_t") - space - known]]).alias("classes"),
        F.array(*[c.cast("long") for c in common]).alias("common"),
    ).alias("_m"))


def references() -> dict[str, tuple[list[float], list[float]]]:
    """Per language the shares of the character classes, and of its common words and all others."""
    out = {}
    for lang in COMMON_WORDS:
        classes, words = ([x / 100 for x in table[lang]] for table in (CLASS_SHARES, WORD_SHARES))
        out[lang] = ([*classes, 1 - sum(classes)], [*words, 1 - sum(words)])
    return out


def js_distance(counts: Column, shares: Iterable[float]) -> Column:
    """Jensen-Shannon distance between an array of counts and a reference's shares."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c), F.lit(1))

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    terms = F.zip_with(
        F.transform(counts, lambda c: c / total), F.array(*[F.lit(float(q)) for q in shares]), term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2, F.lit(0.0)))


def base_failed(m: str = "_m") -> Column:
    n = F.col(f"{m}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEATED * n)


def near(m: str = "_m") -> dict[str, Column]:
    """Per reference whether measured texts are close to it in both histograms."""
    at = {w: i for i, w in enumerate(vocabulary())}
    n, classes_of = F.col(f"{m}.n_words"), F.col(f"{m}.classes")
    chars = F.aggregate(classes_of, F.lit(0).cast("long"), lambda a, c: a + c)
    out = {}
    for lang, (classes, words) in references().items():
        own = [F.col(f"{m}.common")[at[w]] for w in COMMON_WORDS[lang]]
        own.append(n - reduce(lambda a, b: a + b, own))
        out[lang] = (
            ((chars < MIN_CHARS) | (js_distance(classes_of, classes) <= CLASS_LIMIT))
            & ((n < MIN_COMMON) | (js_distance(F.array(*own), words) <= WORD_LIMIT)))
    return out


def kept(lang: str = "lang", m: str = "_m") -> Column:
    """The verdict on measured texts: the base rule and, where the language of the row is a listed
    one, closeness to a reference. The reference of another language will do, as labels err."""
    listed = F.coalesce(F.col(lang).isin(*COMMON_WORDS), F.lit(False))
    return ~base_failed(m) & (~listed | reduce(lambda a, b: a | b, near(m).values()))


def held(docs: DataFrame) -> DataFrame:
    """``measured``, behind a generator. It keeps later filters and columns above the measures:
    merged with them, they would repeat their expressions once for every use."""
    return measured(docs).select(*docs.columns, F.explode(F.array("_m")).alias("_m"))


def corpus_shares(measures: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """As ``references``, but of all measured texts of each listed language that occurs. At most one
    row per listed language is collected."""
    known = vocabulary()
    sums = [F.sum(F.col("_m.classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("_m.common")[i]).alias(f"w{i}") for i in range(len(known))]
    rows = measures.where(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang").agg(
        F.sum("_m.n_words").alias("n"), *sums).collect()
    out = {}
    for r in rows:
        classes = [r[f"c{i}"] for i in range(len(CLASSES))]
        words = [r[f"w{known.index(w)}"] for w in COMMON_WORDS[r["lang"]]]
        words.append(r["n"] - sum(words))
        out[r["lang"]] = tuple([x / max(sum(table), 1) for x in table] for table in (classes, words))
    return out


def corpus_distances(shares: dict[str, tuple[list[float], list[float]]]) -> dict[str, Column]:
    """Distances of measured texts from the sums of their language; NULL for unlisted languages."""
    known, by_class, by_word = vocabulary(), F.lit(None).cast("double"), F.lit(None).cast("double")
    for lang, (classes, words) in shares.items():
        own = [F.col("_m.common")[known.index(w)] for w in COMMON_WORDS[lang]]
        own.append(F.col("_m.n_words") - reduce(lambda a, b: a + b, own))
        here = F.col("lang") == lang
        by_class = F.when(here, js_distance(F.col("_m.classes"), classes)).otherwise(by_class)
        by_word = F.when(here, js_distance(F.array(*own), words)).otherwise(by_word)
    return {"class_distance": F.round(by_class, DIGITS), "word_distance": F.round(by_word, DIGITS)}


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance.

    One row per row of ``docs``. Null texts have no words and fail the base rule; rows of a null or
    unlisted language are held to the base rule alone and have no distances. Other columns play no part.
    """
    measures = write_shared(held(docs.select("doc_id", "text", "lang")).select("doc_id", "lang", "_m"), "measures")
    distances = corpus_distances(corpus_shares(measures))
    return measures.select(
        "doc_id", *[f"_m.{k}" for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"), kept().alias("kept"), *[c.alias(k) for k, c in distances.items()])


def keep_sound(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with their columns unchanged, whatever their names.
    Every text is measured once."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text"), F.col("lang"))
    return held(rows).where(kept()).select("row.*")
