"""Column expressions for text: tokenizing, stop words, shingles.

All are native Spark expressions (JVM side, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s: space, \t, \n, \x0B, \f, \r (ASCII only).
WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"

# Spark ML's default English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's
why's would
""".split()


def java_whitespace_split(text: Column) -> Column:
    """``text.split("\\\\s")`` as Java does it: split on each single
    whitespace character, keep inner and leading empty tokens, drop the
    trailing ones; an all-whitespace string gives an empty array."""
    stripped = F.rtrim(text, F.lit(" \t\n\x0B\f\r"))
    return F.when((stripped == "") & (text != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, WS_CLASS))


def tokenize(text: Column) -> Column:
    """ML Tokenizer semantics: lower-case, then split on single whitespace."""
    return java_whitespace_split(F.lower(text))


def remove_stop_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """StopWordsRemover semantics (case-insensitive, default English list).
    The membership test becomes a hash-set lookup (InSet) in the plan."""
    words = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    lits = [F.lit(w) for w in words]
    return F.filter(tokens, lambda x: ~F.lower(x).isin(*lits))


def words(text: Column) -> Column:
    """Lower-case words: split on runs of whitespace, empty tokens dropped."""
    return F.filter(F.split(F.lower(text), WS_CLASS + "+"), lambda x: x != "")


def shingles(word_array: Column, k: int = 3) -> Column:
    """Distinct k-word shingles (words joined by one space) of a word array.

    Built by zipping k shifted slices of the array, so the per-shingle
    lambda only touches its own element: even when the optimizer inlines
    the word expression (e.g. into a pushed-down filter) the work stays
    linear in the text length. Shorter arrays give an empty array.
    """
    n = F.size(word_array)
    m = F.greatest(n - k + 1, F.lit(1))
    zipped = F.arrays_zip(*[F.slice(word_array, j + 1, m) for j in range(k)])
    # for three words concat takes about half the time of concat_ws; no slice is shorter where n >= k, so none is null
    grams = F.transform(zipped, lambda z: F.concat(*[c for j in range(k) for c in (F.lit(" "), z[str(j)])][1:]))
    return F.when(n >= k, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(word_array: Column, k: int = 3) -> Column:
    """64-bit hashes of the distinct k-word shingles of a word array, made of
    the words as they are (no shingle is put together); see ``shingles``."""
    n = F.size(word_array)
    m = F.greatest(n - k + 1, F.lit(1))
    zipped = F.arrays_zip(*[F.slice(word_array, j + 1, m) for j in range(k)])
    grams = F.transform(zipped, lambda z: F.xxhash64(*[z[str(j)] for j in range(k)]))
    return F.when(n >= k, F.array_distinct(grams)).otherwise(F.array().cast("array<bigint>"))
