"""Text expressions for item metadata. All built-in functions, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The ASCII punctuation characters removed before tokenising.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The placeholder stored where an item has no overview.
NO_OVERVIEW = "No overview found."

# Words of two or more letters, digits or underscores.
TOKEN = "[\\p{L}\\p{N}_]{2,}"

# A word, or a run of other signs, as a phrase extractor reads it.
WORD = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\p{Z}\\s]+"

# The English stopwords that end a key phrase. Contractions are
# left out because the apostrophe is gone before they could match.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn
""".split()


def strip_punctuation(x: Column) -> Column:
    return F.translate(x, PUNCTUATION, "")


def parse_names(x: Column) -> Column:
    """``array<string>`` of the ``name`` fields of a list-of-dict literal.

    The literals use single or double quotes and ``None``; the JSON reader takes
    both kinds of quotes, and ``None`` becomes ``null``.
    """
    as_json = F.regexp_replace(x, ": None([,}])", ": null$1")
    parsed = F.from_json(
        as_json,
        "array<struct<name:string>>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    return parsed["name"]


def clean_keywords(names: Column) -> Column:
    """Distinct lower-case words of all names, in order of appearance."""
    words = F.flatten(
        F.transform(names, lambda n: F.split(F.trim(F.lower(strip_punctuation(n))), "\\s+"))
    )
    return F.concat_ws(" ", F.array_distinct(F.filter(words, lambda w: w != "")))


def clean_elements(names: Column) -> Column:
    """One token per name: lower case, no punctuation, no blanks."""
    return F.concat_ws(
        " ", F.transform(names, lambda n: F.replace(F.lower(strip_punctuation(n)), F.lit(" "), F.lit("")))
    )


def drop_placeholder(x: Column, message: str = NO_OVERVIEW) -> Column:
    """Literal removal; the dot in the message is a dot."""
    return F.replace(x, F.lit(message), F.lit(""))


def combine(*cols: Column) -> Column:
    """Space-joined features; NULL adds nothing."""
    return F.trim(F.concat_ws(" ", *cols))


def unique_words(x: Column) -> Column:
    return F.concat_ws(" ", F.array_distinct(F.filter(F.split(x, " "), lambda w: w != "")))


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit(TOKEN), F.lit(0))


def phrase_words(x: Column) -> Column:
    """``array<struct<word,degree>>``: each word with the length of its phrase.

    Phrases are the runs of words between stopwords. One row in, one array out:
    the phrases of a text are found where the text already is, without a shuffle.
    """
    words = F.regexp_extract_all(F.lower(strip_punctuation(x)), F.lit(WORD), F.lit(0))
    line = F.concat(F.lit(" "), F.concat_ws(" ", words), F.lit(" "))
    stop = "(?<= )(?:" + "|".join(STOPWORDS) + ")(?= )"
    phrases = F.split(F.regexp_replace(line, stop, "\n"), "\n")
    split_phrases = F.transform(
        phrases, lambda p: F.filter(F.split(p, " "), lambda w: w != "")
    )
    return F.flatten(
        F.transform(
            split_phrases,
            lambda p: F.transform(
                p, lambda w: F.struct(w.alias("word"), F.size(p).cast("bigint").alias("degree"))
            ),
        )
    )
