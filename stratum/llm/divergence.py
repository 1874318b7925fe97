"""Quality rules: how far a document's histograms are from those of its language.

Two histograms are compared by Jensen-Shannon distance (base 2, so from 0 to 1): the classes of its characters, and how
often each of the most common words of the language occurs, with one bin for all other words. The references come from
all documents of a language. A histogram of a short text says little, so each distance counts only from a least length on.

Everything is DataFrame expressions on one row per document. Words and lines are taken apart inside the row, so only the
words' counts by language are shuffled, after each task has added up its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.tables import stored

# ASCII white space, and the symbols that are counted.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Classes besides lower-case letters, as bodies of character classes; what none of them holds is a class of its own.
CLASSES = {"upper": "A-Z", "digits": "0-9", "spaces": r"\x20\x09-\x0D", "symbols": SYMBOLS,
           "marks": r".,;:!?'\x22()\x2D", "wide": r"^\x00-\x7F"}

#: Words of a window that counts as repeated if it is found twice.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent
#: Common words of each language.
COMMON = 32
#: Slots by hash, a power of two, in which common words are looked up before they are compared.
SLOTS = 512
#: Words that a language's documents must have together to be a reference.
MIN_REFERENCE = 1_000
MAX_LANGUAGES = 1_000
#: Least lengths from which the distances count, and the largest distances of a document that is kept.
MIN_CHARS, MIN_COMMON = 200, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.45


def _worked_out(rows: DataFrame, **columns: Column) -> DataFrame:
    """The rows with more columns, each worked out once, and not again in every expression that uses them."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


# --- counts inside a row --------------------------------------------------------------------------------------------


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _windows(hashes: Column) -> Column:
    """The hash of every ``WINDOW`` hashes in a row; none for fewer."""
    n = F.size(hashes) - WINDOW + 1
    five = F.transform(F.slice(hashes, 1, n), lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))
    return F.when(n > 0, five).otherwise(F.array().cast("array<long>"))


def _twice(windows: Column) -> Column:
    """Places of the windows that are found twice or more, in order."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def both(x, y):
        return F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>"))

    pairs = F.transform(F.array(placed), lambda s: F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), both))
    found = F.array_sort(F.array_distinct(F.flatten(F.element_at(pairs, 1))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.array().cast("array<int>"))


def _covered(places: Column) -> Column:
    """Words covered by the windows at these places, which are in order."""
    zero = F.struct(F.lit(0).alias("until"), F.lit(0).alias("n"))

    def step(a, p):
        return F.struct((p + WINDOW).alias("until"), (a["n"] + WINDOW - F.greatest(F.lit(0), a["until"] - p)).alias("n"))

    return F.aggregate(places, zero, step, lambda a: a["n"])


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1)


def _with_classes(rows: DataFrame) -> DataFrame:
    """The rows with the number of characters of each class of ``text``: ``lower``, those of ``CLASSES`` and ``others``."""
    rows = _worked_out(rows, upright=F.regexp_replace("text", "[a-z]+", ""))
    rows = _worked_out(rows, bare=F.regexp_replace("upright", f"[{CLASSES['spaces']}]+", ""))
    size = F.length("bare")
    counts = {name: size - F.length(F.regexp_replace("bare", f"[{body}]+", "")) for name, body in CLASSES.items() if name != "spaces"}
    rows = _worked_out(rows, lower=F.length("text") - F.length("upright"), spaces=F.length("upright") - size, left=size, **counts)
    others = F.col("left") - sum((F.col(name) for name in counts), F.lit(0))
    return rows.withColumn("others", others).drop("upright", "bare", "left")


BINS = ["lower", *CLASSES, "others"]


def counted(rows: DataFrame) -> DataFrame:
    """``hashes`` of the words, ``classes`` and the counts of the base rules, beside all columns but ``text``."""
    kept = [c for c in rows.columns if c != "text"]
    rows = _with_classes(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    rows = _worked_out(rows, n_dup_lines=_duplicate_lines(F.col("text")), hashes=_hashes(F.col("text")),
                       word_chars=F.length("text") - F.col("spaces")).drop("text")
    rows = _worked_out(rows, windows=_windows(F.col("hashes")))
    long = {"n_words": F.size("hashes"), "word_chars": F.col("word_chars"), "n_symbols": F.col("symbols"),
            "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": _covered(_twice(F.col("windows")))}
    return rows.select(*kept, "hashes", F.array(*BINS).cast("array<long>").alias("classes"), *[c.cast("long").alias(n) for n, c in long.items()])


# --- references and distances ---------------------------------------------------------------------------------------


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """``lang, reference`` of every language with enough words: hashes of its common words, and the shares of all bins.

    Common words are the ``common`` most frequent ones, without those as frequent as the first that is none of them.
    """
    own = docs.where(F.col("lang").isNotNull()).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    each = stored(own.select("lang", F.explode(_hashes(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    total = each.groupBy("lang").agg(F.sum("n").alias("all_words")).where(F.col("all_words") >= MIN_REFERENCE)
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= common + 1)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    beyond = F.when(F.size("top") > common, F.element_at("top", -1)["n"]).otherwise(0)
    top = _worked_out(top, beyond=beyond).select("lang", F.filter("top", lambda t: t["n"] > F.col("beyond")).alias("top"))
    sums = _with_classes(own).groupBy("lang").agg(*[F.sum(name).alias(name) for name in BINS])
    chars = sum((F.col(name) for name in BINS), F.lit(0))
    shares = F.transform("top", lambda t: t["n"] / F.col("all_words"))
    other = (F.col("all_words") - F.aggregate("top", F.lit(0).cast("long"), lambda a, t: a + t["n"])) / F.col("all_words")
    found = stored(total.join(top, "lang").join(sums, "lang").select("lang", F.struct(
        F.col("top.word").alias("words"), F.concat(shares, F.array(other)).alias("shares"),
        F.array(*[F.col(name) / chars for name in BINS]).alias("classes")).alias("reference")))
    if found.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return found


def distance(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts, not all 0, and one of shares."""

    def both(p, q):
        part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
        return (part(p) + part(q)) / 2

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)
    shared = F.transform(F.array(total), lambda n: F.aggregate(
        F.zip_with(counts, shares, lambda c, q: both(c / n, q)), F.lit(0.0), lambda a, x: a + x))
    return F.sqrt(F.greatest(F.lit(0.0), F.element_at(shared, 1)))


def _slot(word: Column) -> Column:
    return word.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def _taken(common: Column) -> Column:
    """For each slot, if a common word falls into it."""
    taken = F.transform(common, _slot)
    return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.array_contains(taken, i))


def _word_counts(own: Column, common: Column, taken: Column) -> Column:
    """How often each common word occurs, and all others together. Most others are told by their slot, and not compared."""
    hits = F.filter(own, lambda h: F.get(taken, _slot(h)) & F.array_contains(common, h))
    each = lambda h: F.transform(common, lambda w: (F.size(h) - F.size(F.array_remove(h, w))).cast("long"))
    counts = F.transform(F.array(hits), lambda h: F.concat(each(h), F.array((F.size(own) - F.size(h)).cast("long"))))
    return F.element_at(counts, 1)


def divergence(docs: DataFrame, reference: DataFrame | None = None, common: int = COMMON) -> DataFrame:
    """All columns of ``docs(text, lang, ...)`` as a struct ``row``, and what the rules say.

    ``n_words``; ``word_chars``, the characters in words; ``n_symbols``; ``n_dup_lines``, lines with a word that equal an
    earlier one; ``n_repeat_words``, words in windows of five that are found twice or more. ``base_failed``: fewer than 10
    words, or over 20 % of them repeated. ``class_distance`` and ``word_distance`` are those to the language's reference,
    null for texts of under 200 characters or 50 words. ``kept``: not failed, and no distance above its limit.

    A document of no language, or of one with under 1,000 words in all, is measured against every reference, and the
    nearest counts, for each distance; without any reference the distances are null. A missing or empty text has no words
    and fails. Repeated rows are judged each and count each for their language. An empty table gives an empty one. Other
    columns are not looked at. Words and windows are compared by 64-bit hashes. Over 1,000 languages with enough words are an error.
    """
    known = references(docs, common) if reference is None else reference
    known = known.withColumn("reference", F.col("reference").withField("taken", _taken(F.col("reference.words"))))
    every = known.agg(F.collect_list("reference").alias("every"), F.count_if(F.col("lang").isNull()).cast("int").alias("wanted"))
    known = known.select(F.col("lang").alias("known"), F.array("reference").alias("own"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    rows = counted(rows.withColumn("text", F.col(names["text"])))
    # At most MAX_LANGUAGES times the common words.
    rows = rows.join(F.broadcast(known), F.col(names["lang"]) == F.col("known"), "left")
    rows = rows.join(F.broadcast(every), F.when(F.col("own").isNull(), 0) == F.col("wanted"), "left")
    rows = _worked_out(rows, against=F.coalesce("own", "every"))
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, n: a + n)
    by_class = F.array_min(F.transform("against", lambda r: distance(F.col("classes"), r["classes"])))
    by_word = F.array_min(F.transform("against", lambda r: F.element_at(F.transform(
        F.array(_word_counts(F.col("hashes"), r["words"], r["taken"])), lambda c: distance(c, r["shares"])), 1)))
    rows = _worked_out(rows, class_distance=F.when(chars >= MIN_CHARS, by_class), word_distance=F.when(F.col("n_words") >= MIN_COMMON, by_word))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    row = F.struct(*[F.col(n).alias(c) for c, n in names.items()]).alias("row")
    return rows.select(
        row, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        "class_distance", "word_distance", (~failed & ~far).alias("kept"))
