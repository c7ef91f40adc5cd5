"""Text expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The canonical markers.
TAGS = ("noise", "laughter", "inaudible", "silence", "music", "breath")
TAG = r"\[(?:" + "|".join(TAGS) + r")\]"
#: Any text in brackets.
ANY_TAG = r"\[[^\[\]]+\]"


def words(text: Column) -> Column:
    """Words without letters or digits count too: runs of characters other than white space."""
    trimmed = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), "^ +| +$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def word_count(text: Column) -> Column:
    """The number of words outside markers."""
    return F.size(words(F.regexp_replace(text, TAG, " ")))


def spoken_word_count(text: Column) -> Column:
    """The number of words with a letter or digit outside brackets."""
    return F.size(F.filter(F.split(F.regexp_replace(text, ANY_TAG, " "), r"\s+"), lambda w: w.rlike(r"[\p{L}\p{N}]")))


def tokens(text: Column) -> Column:
    """Runs of letters, joined by hyphens, in their own case."""
    return F.regexp_extract_all(text, F.lit(r"(\p{L}+(?:-\p{L}+)*)"), 1)


def has_case(text: Column) -> Column:
    """Whether a text holds a capital letter."""
    return text.rlike(r"\p{Lu}")


def replaced(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The text after ordered regular-expression replacements."""
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def capitalised(text: Column) -> Column:
    """The first letter in upper case, the rest unchanged."""
    return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))


def uncapitalised(text: Column) -> Column:
    """The first letter in lower case, the rest unchanged."""
    return F.concat(F.lower(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))


def ngrams(items: Column, n: int) -> Column:
    """All runs of n neighbouring items, joined by a blank; none if there are fewer."""

    def of(own: Column) -> Column:
        last = F.size(own) - n + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(own, i, F.lit(n)), " "))

    return F.flatten(F.transform(F.array(items), of))  # bound once: a lambda's argument isn't computed again for each run


def duration_text(seconds: Column) -> Column:
    """Whole seconds as d/h/m/s."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%dd %02dh %02dm %02ds", F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60)


def clock(seconds: Column, mark: str = ".") -> Column:
    """hh:mm:ss and milliseconds."""
    ms = F.bround(seconds * 1000, 0).cast("long")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(ms / 3600000), F.floor(ms % 3600000 / 60000), F.floor(ms % 60000 / 1000), ms % 1000)


def short_number(n: Column) -> Column:
    """A count as 950, 1.2K or 3.4M."""
    return F.when(n >= 1e6, F.format_string("%.1fM", n / 1e6)).when(n >= 1e3, F.format_string("%.1fK", n / 1e3)).otherwise(n.cast("long").cast("string"))


def oxford(items: Column) -> Column:
    """a; a and b; a, b, and c."""
    n = F.size(items)
    head = F.array_join(F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(1))), ", ")
    return F.when(n == 0, "").when(n == 1, F.get(items, F.lit(0))).when(n == 2, F.concat(F.get(items, F.lit(0)), F.lit(" and "), F.get(items, F.lit(1)))).otherwise(
        F.concat(head, F.lit(", and "), F.element_at(items, -1))
    )


def jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words, in lower case; two texts without words are equal, one without is unlike."""
    x, y = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    both = F.size(F.array_union(x, y))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / both)
