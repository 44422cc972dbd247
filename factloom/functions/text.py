"""Text clean-up, tokens and shapes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean(text: Column) -> Column:
    """Line breaks and tabs become spaces."""
    return F.regexp_replace(text, r"[\r\n\t]", " ")


def scrub(text: Column) -> Column:
    """Angle brackets and control characters become spaces."""
    return F.regexp_replace(text, "[<>\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", " ")


def squeeze(text: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def trigger_key(text: Column) -> Column:
    """A trigger phrase as it is looked up in lists: squeezed and in lower case, without '#'."""
    return F.lower(squeeze(F.regexp_replace(text, "#", "")))


def strip_lines(text: Column) -> Column:
    """Each line trimmed, empty lines left out."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def tokens(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def camel_words(name: Column) -> Column:
    """Words of a CamelCase or snake_case name, in lower case."""
    spaced = F.regexp_replace(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1 $2"), "([A-Z]+)([A-Z][a-z])", "$1 $2")
    return F.filter(F.split(F.lower(F.regexp_replace(spaced, "[_ ]+", " ")), " "), lambda t: t != "")


def shape(token: Column) -> Column:
    """Character classes of a token: U, L, D, '.', ';', '-', '(' and ')'; other characters stay."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[A-Z]", "U"), "[a-z]", "L"), "[0-9]", "D")
    out = F.regexp_replace(F.regexp_replace(out, "[.,]", "."), "[;:?!]", ";")
    out = F.regexp_replace(out, r"[+*/=|_-]", "-")
    return F.regexp_replace(F.regexp_replace(out, r"[\[{<(]", "("), r"[\]}>)]", ")")


def short_shape(token: Column) -> Column:
    """The shape with repeats collapsed."""
    return F.regexp_replace(shape(token), r"(.)\1+", "$1")


def is_bad_example(text: Column, bad: list[str], share: float = 0.25) -> Column:
    """More than ``share`` of the words are on a list."""
    words = tokens(text)
    return F.size(F.filter(words, lambda t: t.isin(bad))) > share * F.size(words)


def is_short_worded(text: Column, length: int = 3, share: float = 0.75) -> Column:
    words = tokens(text)
    return F.size(F.filter(words, lambda t: F.length(t) <= length)) > share * F.size(words)


def genre_is_news(text: Column, pdf: Column, pages: Column, limit: int = 50_000) -> Column:
    """Null text: no; a PDF: no; under one page: yes; else a text below ``limit`` characters."""
    return F.when(text.isNull(), False).when(pdf, False).when(pages < 1, True).otherwise(F.length(text) < limit)


def token_class(token: Column) -> Column:
    """number, float, multiplier, modifier or other; a year (1000 to 2100) is no number."""
    t = F.lower(token)
    return (
        F.when(t.rlike("^[0-9]{4}$") & t.cast("int").between(1000, 2100), "other")
        .when(t.rlike("^[0-9]+$"), "number")
        .when(t.rlike("^[0-9]*[.][0-9]+$"), "float")
        .when(t.isin("hundred", "thousand", "million", "billion", "trillion", "dozen"), "multiplier")
        .when(t.isin("about", "around", "over", "under", "between", "least", "most", "nearly", "almost", "approximately", "more", "less"), "modifier")
        .otherwise("other")
    )
