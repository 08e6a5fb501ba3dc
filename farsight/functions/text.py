"""Column functions over text: index tokens and query keywords.

Everything here is a composition of built-in Spark functions, so it runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop words a query keyword may not be.
STOP_WORDS = (
    "a about above after all also am an and any are as at be been before being below between "
    "both but by can could did do does down during each every few for from had has have he her "
    "him his how i if in into is it its just may me might more most must my no nor not of off on "
    "only or other our out over own same shall she should so some such than that the their them "
    "then these they this those through to too under up us very was we were what when where which "
    "while who whom why will with would yet you your"
).split()

# Limits of keyword extraction, of the text index and of the text given to a model.
MAX_KEYWORDS = 12
MIN_KEYWORD_LENGTH = 2
INDEX_TOKEN_LENGTH = (2, 40)
MAX_CHARS = 6000

UNICODE_WORD = r"[\p{L}\p{N}]+"
ASCII_WORD = r"[a-z0-9]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """All lower-cased runs of letters and digits, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(UNICODE_WORD), F.lit(0))


def index_tokens(text: Column) -> Column:
    """The distinct words of a text that the text index keeps (2 to 40 characters)."""
    return tokens_of_words(words(text))


def tokens_of_words(word_list: Column) -> Column:
    """`index_tokens` for a text already cut into words."""
    shortest, longest = INDEX_TOKEN_LENGTH
    kept = F.filter(word_list, lambda w: F.length(w).between(shortest, longest))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def text_for_embedding(text: Column, max_chars: int | None = MAX_CHARS) -> Column:
    """The first `max_chars` characters (None: all): what the model sees. The stored text stays whole."""
    return text if max_chars is None else F.substring(text, 1, max_chars)


def extract_keywords(text: Column, unicode: bool = False, most: int | None = MAX_KEYWORDS) -> Column:
    """The keywords of a query, in order of appearance, at most `most` (by default twelve; None: all).

    A word counts if it has two characters or more, is no stop word and is new. Two counted words
    standing side by side also give their concatenation. By default only ASCII letters and digits
    make words; `unicode=True` splits the way the text index does.
    """
    if unicode:
        tokens = words(text)
    else:
        # Not lower(): it would map some non-ASCII letters, such as the Kelvin sign, into ASCII.
        lowered = F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
        tokens = F.regexp_extract_all(lowered, F.lit(ASCII_WORD), F.lit(0))

    no_words = F.array().cast("array<string>")
    no_word = F.lit(None).cast("string")

    def state(found: Column, previous: Column) -> Column:
        return F.struct(found.alias("found"), previous.alias("previous"))

    def step(acc: Column, word: Column) -> Column:
        found, previous = acc["found"], acc["previous"]
        counts = (
            (F.length(word) >= MIN_KEYWORD_LENGTH)
            & (F.find_in_set(word, F.lit(",".join(STOP_WORDS))) == 0)
            & ~F.array_contains(found, word)
        )
        pair = F.concat(previous, word)
        adds_pair = previous.isNotNull() & ~F.array_contains(found, pair)
        grown = F.concat(found, F.when(adds_pair, F.array(word, pair)).otherwise(F.array(word)))
        grown = F.when(counts, state(grown, word)).otherwise(state(found, no_word))
        # Once all are found nothing later can change them, so long texts stay linear.
        return grown if most is None else F.when(F.size(found) >= most, acc).otherwise(grown)

    def finish(acc: Column) -> Column:
        return acc["found"] if most is None else F.slice(acc["found"], 1, most)

    return F.aggregate(
        F.coalesce(tokens, no_words), state(no_words, no_word), step, finish
    )
