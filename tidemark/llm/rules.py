"""Quality rules: repetition and symbol counts, and divergence from language references.

A document's character-class histogram, that of its marks alone (which letters would
swamp: a table's bars are few among its letters, but most of its marks) and its histogram
of common words (with one bin for all other words) are held against fixed histograms of its
language by Jensen-Shannon distance, so that a verdict depends on the document alone, not on the table it is in.
Documents of other or no language are held against one pooled reference, for which all
letters are one class.  Short documents, whose histograms say little, are not judged by
distance.  All of it is SQL expressions on the row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent words of English, German, French and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "with", "as", "on",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "des", "ist",
    "de", "la", "le", "et", "les", "un", "du", "que", "est", "pour",
    "el", "y", "a", "los", "del", "se", "las", "por",
)
# Classes of characters; the last bin of the histogram is for all others, letters beyond ASCII mostly.
CHARACTER_CLASSES = ("[a-z]", "[A-Z]", "[0-9]", r"[ \t\n\x0B\f\r]", "[.,;:!?'\"()-]", r"[#*$%&|<>@^_=+~/\\\[\]{}`]")
SPACE = r"[ \t\n\x0B\f\r]"
WINDOW = 8
#: Distances above these reject a document of at least MIN_WORDS words or MIN_CHARS characters.
MAX_CHARACTER_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.45
MIN_CHARS, MIN_WORDS = 200, 50
#: The like for documents of at least MIN_MARKS marks; reached where three of ten marks are not those of sentences.
MAX_MARK_DISTANCE, MIN_MARKS = 0.40, 20
# Classes of marks within the last two of CHARACTER_CLASSES: those of sentences, bars, symbols; all others are the last bin.
BAR, SYMBOLS = "|", "[#*$%&<>]"
# Mean histograms of the documents of sf0.1 labelled as good, of MIN_WORDS words at least and an even crc32 of the id.
# The shares of the character classes and of the common words; what they leave is that of all others.
REFERENCE_CHARACTERS = {
    "de": (0.7721, 0.0125, 0.0006, 0.1545, 0.0219, 0.0000),
    "en": (0.7937, 0.0145, 0.0009, 0.1665, 0.0243, 0.0000),
    "es": (0.7218, 0.0132, 0.0009, 0.1617, 0.0244, 0.0000),
    "fr": (0.7065, 0.0109, 0.0021, 0.1662, 0.0244, 0.0001),
}
#: Marks of sentences, bars and symbols, of documents with MIN_MARKS marks at least.
REFERENCE_MARKS = {"de": (0.9993, 0.0, 0.0), "en": (0.9993, 0.0, 0.0), "es": (0.9993, 0.0, 0.0), "fr": (0.9980, 0.0, 0.0)}
REFERENCE_WORDS = {
    "de": {"the": 0.0001, "in": 0.0177, "der": 0.0546, "die": 0.0290, "und": 0.0225, "den": 0.0144, "von": 0.0113, "zu": 0.0096, "das": 0.0094, "mit": 0.0078, "des": 0.0068, "ist": 0.0053, "de": 0.0001},
    "en": {"the": 0.0558, "of": 0.0288, "and": 0.0234, "to": 0.0171, "in": 0.0121, "is": 0.0104, "that": 0.0090, "it": 0.0083, "was": 0.0071, "with": 0.0056, "as": 0.0054, "on": 0.0066, "a": 0.0137},
    "es": {"the": 0.0004, "of": 0.0001, "to": 0.0001, "that": 0.0001, "it": 0.0001, "as": 0.0031, "der": 0.0001, "und": 0.0001, "mit": 0.0001, "de": 0.0547, "la": 0.0274, "un": 0.0070, "que": 0.0232, "el": 0.0160, "y": 0.0108, "los": 0.0104, "del": 0.0074, "se": 0.0080, "las": 0.0094, "por": 0.0067},
    "fr": {"the": 0.0003, "of": 0.0001, "and": 0.0001, "in": 0.0001, "it": 0.0001, "on": 0.0023, "des": 0.0124, "de": 0.0543, "la": 0.0291, "le": 0.0226, "et": 0.0164, "les": 0.0137, "un": 0.0098, "du": 0.0086, "que": 0.0064, "est": 0.0065, "pour": 0.0063, "a": 0.0001},
}


def bound(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with value computed once a row: a lambda's variable is never computed again inside it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def words_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit("[^ \\t\\x0B\\f\\r]")))
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def window_hashes(words: Column, window: int = WINDOW) -> Column:
    """A hash of each window of so many words (a power of two): hashes of words, then of pairs of neighbouring hashes, pairs of those, and so on."""
    hashes, span = F.transform(words, lambda w: F.xxhash64(w)), 1
    while span < window:
        # The windows of twice the span; none if there are no two of the span so far apart.
        n = lambda h, k=span: F.greatest(F.lit(0), F.size(h) - k)
        hashes = bound(hashes, lambda h, k=span, n=n: F.zip_with(F.slice(h, F.lit(1), n(h)), F.slice(h, F.lit(1 + k), n(h)), lambda a, b: F.xxhash64(a, b)))
        span *= 2
    return hashes


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words within windows of so many words that occur twice or more, by sorting the windows' hashes."""

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        same = lambda s, e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False))
        places = bound(pairs, lambda s: F.transform(F.filter(s, lambda e, i: same(s, e, i)), lambda e: e["at"]))
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(F.array_sort(places), start, lambda acc, p: F.struct(p.alias("last"), (acc["sum"] + F.least(F.lit(window), p - acc["last"])).alias("sum")))["sum"]

    return bound(window_hashes(words, window), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures of a text, of which words holds the words."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(words),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def _shares(counts: Column, total: Column) -> Column:
    """Shares of the total of an array of counts, with one more bin for what is left of it; null if the total is 0."""
    rest = lambda c: F.greatest(F.lit(0.0), total - F.aggregate(c, F.lit(0.0), lambda a, x: a + x))
    return F.when(total > 0, bound(counts, lambda c: F.transform(F.concat(c, F.array(rest(c))), lambda x: x / total)))


def character_counts(text: Column) -> Column:
    """How many characters there are of each class, then bars and symbols.  The first class, that of most characters, goes first, so that the others have little to look through."""
    first, *others = CHARACTER_CLASSES
    bars = lambda rest: F.length(rest) - F.length(F.replace(rest, F.lit(BAR), F.lit("")))
    found = lambda rest: [*[F.regexp_count(rest, F.lit(c)) for c in others], bars(rest), F.regexp_count(rest, F.lit(SYMBOLS))]
    counts = lambda rest, size: F.array((size - F.length(rest)).cast("double"), *[c.cast("double") for c in found(rest)])
    return bound(F.regexp_replace(text, F.lit(f"{first}+"), F.lit("")), lambda rest: counts(rest, F.length(text)))


def common_word_counts(words: Column) -> Column:
    """How often each common word occurs: words become single letters, and letters are counted."""
    letters = [chr(0x100 + i) for i in range(len(COMMON_WORDS))]
    of = F.create_map(*[F.lit(x) for pair in zip(COMMON_WORDS, letters, strict=True) for x in pair])
    coded = F.array_join(F.transform(words, lambda w: F.element_at(of, F.lower(w))), "")
    return bound(coded, lambda s: F.array(*[(F.length(s) - F.length(F.replace(s, F.lit(x), F.lit("")))).cast("double") for x in letters]))


def histograms(text: Column, words: Column) -> dict[str, Column]:
    """`chars`, `marks` and `common`, null for a text without any; and the number of marks."""
    text = F.coalesce(text, F.lit(""))
    n = len(CHARACTER_CLASSES)
    chars = lambda c: _shares(F.slice(c, 1, n), F.length(text).cast("double"))
    marks = lambda c: c[n - 2] + c[n - 1]
    of_marks = lambda c: _shares(F.array(c[n - 2], c[n], c[n + 1]), marks(c))
    counted = bound(character_counts(text), lambda c: F.struct(chars(c).alias("chars"), of_marks(c).alias("marks"), marks(c).alias("n_marks")))
    return {"counted": counted, "common": _shares(common_word_counts(words), F.size(words).cast("double"))}


def distance(p: Column, q: Column) -> Column:
    """The Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares; null if one is."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x, lambda acc: F.sqrt(F.greatest(F.lit(0.0), acc)))


def _language(lang: Column) -> Column:
    """The language of a tag such as `en` or `EN-gb`, if it has a reference; else `` (also for null)."""
    name = F.lower(F.regexp_extract(F.trim(lang.cast("string")), "^[A-Za-z]+", 0))
    return F.coalesce(F.when(name.isin(*REFERENCE_CHARACTERS), name), F.lit(""))


def _folded(shares: list[float]) -> list[float]:
    """Shares of character classes with those of all letters, a-z and the last class, in the first."""
    return [shares[0] + shares[-1], *shares[1:-1], 0.0]


def reference_histograms() -> dict[str, tuple[list[float], list[float], list[float]]]:
    """Shares of character classes, marks and common words by language; by `` the means of all languages, with all letters in the first class."""
    whole = lambda x: [*x, max(0.0, 1 - sum(x))]
    common = lambda lang: [REFERENCE_WORDS[lang].get(w, 0.0) for w in COMMON_WORDS]
    found = {lang: (whole(shares), whole(REFERENCE_MARKS[lang]), whole(common(lang))) for lang, shares in REFERENCE_CHARACTERS.items()}
    mean = [[sum(x) / len(found) for x in zip(*(of[i] for of in found.values()), strict=True)] for i in range(3)]
    return found | {"": (_folded(mean[0]), mean[1], mean[2])}


def _reference(language: Column, i: int) -> Column:
    rows = reference_histograms()
    return F.element_at(F.create_map(*[x for name, of in rows.items() for x in (F.lit(name), F.array(*map(F.lit, of[i])))]), language)


def far_from_reference(m: Column) -> Column:
    """Whether a long enough document lies too far from its language's reference."""
    far = (
        (m["char_distance"] > MAX_CHARACTER_DISTANCE) & (m["n_chars_seen"] >= MIN_CHARS),
        (m["mark_distance"] > MAX_MARK_DISTANCE) & (m["n_marks"] >= MIN_MARKS),
        (m["word_distance"] > MAX_WORD_DISTANCE) & (m["n_words"] >= MIN_WORDS),
    )
    return F.coalesce(far[0], F.lit(False)) | F.coalesce(far[1], F.lit(False)) | F.coalesce(far[2], F.lit(False))


def judged(text: Column, lang: Column, names: tuple[str, ...]) -> Column:
    """A struct of the measures of these names, n_chars_seen, n_marks, char_distance, mark_distance and word_distance; each is computed once a row."""
    language = _language(lang)
    letters = lambda h: F.concat(F.array(h[0] + F.element_at(h, -1)), F.slice(h, 2, len(CHARACTER_CLASSES) - 1), F.array(F.lit(0.0)))
    folded = lambda h: F.when(language == "", letters(h)).otherwise(h)

    def of(words: Column) -> Column:
        found, h = measures(text, words), histograms(text, words)
        by_chars = bound(h["counted"], lambda c: F.struct(c["n_marks"].alias("n"), distance(folded(c["chars"]), _reference(language, 0)).alias("chars"), distance(c["marks"], _reference(language, 1)).alias("marks")))
        by_words = bound(h["common"], lambda x: distance(x, _reference(language, 2)))
        base = [found[n].alias(n) for n in names]
        seen = F.coalesce(F.length(text), F.lit(0)).alias("n_chars_seen")
        return bound(by_chars, lambda d: F.struct(*base, seen, d["n"].alias("n_marks"), d["chars"].alias("char_distance"), d["marks"].alias("mark_distance"), by_words.alias("word_distance")))

    return bound(words_array(text), of)


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, mark_distance, word_distance.

    A null text has no words, and so fails the base rules.  Documents without a language or
    of one without a reference are held against the pooled one.  Repeated rows stay.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.select(F.col(id_column).alias("doc_id"), judged(F.col(text_column), F.col(lang_column), names).alias("_m"))
    m = F.col("_m")
    failed = base_failed(m["n_words"], m["n_repeat_words"])
    return rows.select("doc_id", *[m[n].alias(n) for n in names], failed.alias("base_failed"), (~failed & ~far_from_reference(m)).alias("kept"), *[m[n].alias(n) for n in ("char_distance", "mark_distance", "word_distance")])


def good_documents(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows of docs that quality_rules keeps, with their columns."""
    kept = bound(judged(F.col(text_column), F.col(lang_column), ("n_words", "n_repeat_words")), lambda m: ~base_failed(m["n_words"], m["n_repeat_words"]) & ~far_from_reference(m))
    return docs.where(kept)
