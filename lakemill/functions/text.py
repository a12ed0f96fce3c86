"""Text scalars: folds, slugs, cleaning, ordered pattern rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and the letters without. Other scripts are left as they are.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def fold(text: Column) -> Column:
    """Lower case without marks on Latin letters."""
    return F.lower(F.translate(text, MARKED, PLAIN))


def slug(text: Column) -> Column:
    """Folded words joined by hyphens; null and texts without a letter or digit give what remains, '' at least."""
    return F.btrim(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), F.lit("-"))


def collapsed(text: Column) -> Column:
    """White space runs made one blank, ends trimmed; blank becomes null."""
    return F.nullif(F.btrim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def without_tags(text: Column) -> Column:
    """Markup removed, line breaks counting as blanks; blank becomes null."""
    return collapsed(F.regexp_replace(F.regexp_replace(text, r"(?i)<br\s*/?>", " "), "<[^>]+>", ""))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null and blank texts."""
    clean = collapsed(text)
    return F.when(clean.isNull(), 0).otherwise(F.size(F.split(clean, " "))).cast("long")


def name_key(text: Column) -> Column:
    """A name for matching: folded, its words in order of the alphabet, so that word order does not count."""
    words = F.filter(F.split(F.regexp_replace(fold(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """The label of the first rule (label, pattern) whose pattern is found in the text; their order matters."""
    out = F.lit(default)
    for label, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def first_theme(text: Column, themes: Mapping[str, Sequence[str]], default: str) -> Column:
    """The first theme one of whose keywords the folded text contains."""
    out, folded = F.lit(default), fold(F.coalesce(text, F.lit("")))
    for theme, keywords in reversed(list(themes.items())):
        found = F.lit(False)
        for word in keywords:
            found = found | F.contains(folded, F.lit(word))
        out = F.when(found, F.lit(theme)).otherwise(out)
    return out


def initials(name: Column) -> Column:
    """First letters of all words but the last, then the last word."""
    words = F.split(collapsed(name), " ")
    heads = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w: F.concat(F.substring(w, 1, 1), F.lit(".")))
    return F.array_join(F.concat(heads, F.slice(words, -1, 1)), " ")


def short_name(name: Column) -> Column:
    """The first letters of the first two words in capitals; a question mark for no name."""
    words = F.filter(F.split(F.coalesce(name, F.lit("")), r"\s+"), lambda w: w != "")
    letters = F.transform(F.slice(words, 1, 2), lambda w: F.upper(F.substring(w, 1, 1)))
    return F.when(F.size(words) > 0, F.array_join(letters, "")).otherwise("?")


def last_name(name: Column) -> Column:
    """The last word; a question mark for no name."""
    words = F.filter(F.split(F.coalesce(name, F.lit("")), r"\s+"), lambda w: w != "")
    return F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit("?"))


def percentage(share: Column) -> Column:
    """A share as whole per cent, halves up; N/D for what is missing or not finite."""
    number = share.cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, F.concat(F.floor(number * 100 + 0.5).cast("string"), F.lit(" %"))).otherwise("N/D")


def upper_head_as_surname(name: Column) -> Column:
    """'DOE SMITH Jane' becomes 'Jane Doe Smith': leading words in capitals are the surname."""
    head = F.regexp_extract(name, r"^((?:[\p{Lu}'-]{2,}\s+)+)", 1)
    return F.when(head == "", name).otherwise(F.concat_ws(" ", F.btrim(F.substring(name, F.length(head) + 1, F.length(name))), F.initcap(F.btrim(head))))


def stem(name: Column, suffix: str) -> Column:
    """A name without its suffix, if it has it."""
    return F.when(F.endswith(name, F.lit(suffix)), F.left(name, F.length(name) - len(suffix))).otherwise(name)


#: The signs of Roman numerals by value.
ROMAN = ((100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I"))


def roman(number: Column) -> Column:
    """A number from 1 to 399 in Roman numerals."""
    left, out = number.cast("int"), F.lit("")
    for value, sign in ROMAN:
        out = F.concat(out, F.repeat(F.lit(sign), F.floor(left / value).cast("int")))
        left = left % value
    return out


def place_label(town: Column, district: Column) -> Column:
    """Town (district), of what there is; null if there is neither."""
    return F.nullif(F.concat_ws(" ", town, F.concat(F.lit("("), district, F.lit(")"))), F.lit(""))


def uri_label(uri: Column) -> Column:
    """The last part of an address as a label: signs between words become blanks, words begin with a capital."""
    return F.initcap(F.regexp_replace(F.regexp_extract(uri, r"([^/#]+)[/#]?$", 1), "[_-]+", " "))
