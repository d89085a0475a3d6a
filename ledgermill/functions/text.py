"""Text cleaning as Spark column expressions.

Each function is one small step. Longer cleanings are lists of steps for `stepwise`, which gives every step its own
projection: a step may then use its input several times without that input being computed several times. A filter on a
cleaned text undoes this, because Spark moves it below the projections, unless `held` stands between them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import COUNTRY_CURRENCY, COUNTRY_SYNONYMS, NAME_PARTICLES

Step = Callable[[Column], Column]

_NOT_ASCII = "[^\\x00-\\x7F]"


def _char_class(chars: Iterable[str]) -> str:
    """Regular expression class of the characters; neighbours are joined to ranges, which match much faster."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


# Everything Unicode calls white space, plus the four ASCII separators.
_BLANK_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_BLANK_CLASS = _char_class(_BLANK_CHARS)

# Every ASCII sign that shows; digits come first, since they are looked for most.
_VISIBLE = "0123456789" + "".join(chr(c) for c in [*range(0x61, 0x7F), *range(0x21, 0x30), *range(0x3A, 0x61)])


def stepwise(df: DataFrame, column: str, steps: Iterable[Step], source: str | None = None) -> DataFrame:
    """Run `steps` one after another on `source`, leaving the result in `column`."""
    current = source or column
    for step in steps:
        df = df.withColumn(column, step(F.col(current)))
        current = column
    return df


def held(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with `columns` computed once, even if a filter on them follows.

    The planner moves filters below projections, with a copy of all that is computed there. It does not move them below
    a generator, and the outer form of one that makes a single row changes nothing else.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline_outer(F.array(F.struct(*columns)))).select(*df.columns)


def lookup(key: Column, table: dict) -> Column:
    """Value of `key` in a small constant table, null if it is not there."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANK_CHARS))


def strip_column(text: Column) -> Column:
    """As `strip_blanks`, for a column that holds its value already: the first and the last character tell that most
    texts have no blanks to strip. Texts compare by their bytes, so the whole text tells the first."""
    text = text.cast("string")
    ends = (text >= "!") & (text < "\x7f") & F.lit(_VISIBLE).contains(F.substring(text, -1, 1))
    return F.when(ends, text).otherwise(strip_blanks(text))


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"{_BLANK_CLASS}+", " ")


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def missing_to_null(text: Column, tokens: Iterable[str]) -> Column:
    return F.when(~text.isin(list(tokens)), text)


@lru_cache(maxsize=1)
def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks, for every character but Hangul syllables."""
    one_to_one, dropped, expanded = {}, [], {}
    for code in range(0x80, 0x110000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain == char:
            continue
        if len(plain) == 1:
            one_to_one[char] = plain
        elif not plain:
            dropped.append(char)
        else:
            expanded[char] = plain
    return "".join([*one_to_one, *dropped]), "".join(one_to_one.values()), expanded


def _fold_letters(text: Column) -> Column:
    source, target, _ = _folding_tables()
    return F.when(text.rlike(_NOT_ASCII), F.translate(text, source, target)).otherwise(text)


def _expand_ligatures(text: Column) -> Column:
    _, _, expanded = _folding_tables()
    # Tab and line feed never occur in the expansions, so they can separate the literal's entries.
    table = F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in expanded.items())), F.lit("\n"), F.lit("\t"))
    spelled = F.array_join(
        F.transform(F.regexp_extract_all(text, F.lit("(?s)(.)")), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""
    )
    # Texts that letters alone made plain are the rule, so the cheap test comes first.
    return F.when(text.rlike(_NOT_ASCII) & text.rlike(_char_class(expanded)), spelled).otherwise(text)


def _spell_hangul(text: Column) -> Column:
    """A syllable is a number: its leading, middle and trailing letters follow by division."""
    def letters(first: int, n: int) -> Column:
        return F.array(*[F.lit(chr(first + i)) for i in range(n)])

    leading, middle = letters(0x1100, 19), letters(0x1161, 21)
    trailing = F.array(F.lit(""), *[F.lit(chr(0x11A8 + i)) for i in range(27)])

    def spell(c: Column) -> Column:
        place = F.ascii(c) - 0xAC00
        return F.when(c.between("\uac00", "\ud7a3"), F.concat(
            F.get(leading, F.floor(place / 588).cast("int")), F.get(middle, F.floor(place % 588 / 28).cast("int")),
            F.get(trailing, place % 28))).otherwise(c)

    spelled = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)(.)")), spell), "")
    return F.when(text.rlike("[\uac00-\ud7a3]"), spelled).otherwise(text)


FOLD_ACCENTS: list[Step] = [_fold_letters, _expand_ligatures, _spell_hangul]


def _only_letters_and_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Z0-9]+", " ")


# Label of a category: upper case, no accents, no punctuation, single blanks.
CATEGORY_LABEL: list[Step] = [
    strip_blanks, *FOLD_ACCENTS, F.upper, _only_letters_and_digits, F.trim, empty_to_null,
]

# Key text: trimmed, empty is missing.
KEY_TEXT: list[Step] = [strip_blanks, empty_to_null]


def repair_encoding(text: Column) -> Column:
    """Undo UTF-8 that was once read as Latin-1; text that does not decode cleanly stays as it is.

    The guards are nested because the inner ones only hold for text that passed the outer ones.
    """
    suspicious = text.rlike("[ÂÃ�]")
    one_byte_chars = ~text.rlike("[^\\x00-\\xFF]")
    reread = F.encode(text, "ISO-8859-1").cast("string")
    repaired = F.when(F.is_valid_utf8(reread), reread).otherwise(text)
    return F.when(suspicious, F.when(one_byte_chars, repaired).otherwise(text)).otherwise(text)


def _capitalise_words(text: Column) -> Column:
    def word(w: Column) -> Column:
        return F.when(w.isin(NAME_PARTICLES), w).otherwise(
            F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))
        )

    return F.array_join(F.transform(F.split(F.lower(text), " "), word), " ")


PERSON_NAME: list[Step] = [strip_blanks, repair_encoding, collapse_blanks, empty_to_null, _capitalise_words]


def _canonical_country(key: Column) -> Column:
    return F.coalesce(lookup(key, COUNTRY_SYNONYMS), key)


COUNTRY_NAME: list[Step] = [
    strip_blanks, repair_encoding, collapse_blanks, empty_to_null, *FOLD_ACCENTS, F.upper, collapse_blanks,
    strip_blanks, _canonical_country,
]


def currency_of(country: Column) -> Column:
    return lookup(country, COUNTRY_CURRENCY)


def join_key(text: Column) -> Column:
    """Text as compared in key joins."""
    return strip_blanks(text)


def column_suffix(name: Column) -> Column:
    """Category name as part of a column name."""
    safe = F.regexp_replace(F.lower(name), "[^\\p{L}\\p{N}]+", "_")
    safe = F.btrim(safe, F.lit("_"))
    return F.coalesce(F.when(safe != "", safe), F.lit("sem_categoria"))
