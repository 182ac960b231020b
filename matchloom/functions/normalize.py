"""Normalization of names, addresses and countries as column expressions; everything stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ADDRESS, COUNTRIES, LEGAL, STOP_WORDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cache
def _unaccent_tables() -> tuple[str, str, dict[str, str]]:
    """Built from the Unicode database: characters that become one other, combining marks (dropped), and characters that
    become several. Hangul syllables are left whole."""
    one_from, one_to, marks, several = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        c = chr(code)
        if unicodedata.combining(c):
            marks.append(c)
            continue
        d = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if d == c:
            continue
        if len(d) == 1:
            one_from.append(c)
            one_to.append(d)
        else:
            several[c] = d
    return "".join(one_from + marks), "".join(one_to), several


def _table(words: dict[str, str]) -> Column:
    """A literal map, built from two literals that the optimizer folds."""
    keys, values = (F.split(F.lit("\x01".join(x)), "\x01") for x in (words.keys(), words.values()))
    return F.map_from_arrays(keys, values)


def unaccent(c: Column | str) -> Column:
    """Compatibility decomposition without combining marks.

    One-to-one characters are translated. Only texts that hold a character with a longer decomposition (ligatures,
    fractions, ...) take the slower way through a map, character by character.
    """
    c = _col(c)
    before, after, several = _unaccent_tables()
    plain = F.translate(c, before, after)
    table = _table(several)
    slow = F.translate(F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), ""), before, after)
    return F.when(c.rlike("[^\\x00-\\x7F]"), F.when(F.translate(c, "".join(several), "") != c, slow).otherwise(plain)).otherwise(c)


def clean_basic(c: Column | str) -> Column:
    """Lower case, unaccented, ``&`` spelled out, anything but a-z and 0-9 one space, trimmed; null gives ''."""
    c = unaccent(F.lower(F.coalesce(_col(c), F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def expand(c: Column | str, address: bool = False) -> Column:
    """Abbreviations spelled out, word by word, once; texts without any are left as they are."""
    c = _col(c)
    words = {**LEGAL, **(ADDRESS if address else {})}
    table = _table(words)
    spelled = F.array_join(F.transform(F.split(c, " "), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")
    return F.when(c.rlike(rf"\b({'|'.join(words)})\b"), spelled).otherwise(c)


def with_clean(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds clean_basic of columns (new name -> column) in steps, so that no step's expression is evaluated twice."""
    lowered = df.withColumns({f"_{o}": F.lower(F.coalesce(F.col(i), F.lit(""))) for o, i in columns.items()})
    plain = lowered.withColumns({f"_{o}": unaccent(f"_{o}") for o in columns})
    spelled = {o: F.trim(F.regexp_replace(F.replace(F.col(f"_{o}"), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")) for o in columns}
    return plain.withColumns(spelled).drop(*(f"_{o}" for o in columns))


def with_normalized(df: DataFrame, names: dict[str, str], addresses: dict[str, str]) -> DataFrame:
    """Adds normalized names and addresses (new name -> column) in steps."""
    clean = with_clean(df, {**names, **addresses})
    return clean.withColumns({**{o: expand(o) for o in names}, **{o: expand(o, True) for o in addresses}})


def normalize_name(c: Column | str) -> Column:
    return expand(clean_basic(c))


def sort_tokens(c: Column | str) -> Column:
    """Tokens in order, repeated ones kept."""
    return F.array_join(F.array_sort(F.split(_col(c), " ")), " ")


def normalize_address(c: Column | str) -> Column:
    return expand(clean_basic(c), address=True)


def numeric_tokens(c: Column | str) -> Column:
    """Tokens of digits alone, in order, repeated ones kept."""
    return F.filter(F.split(_col(c), " "), lambda t: t.rlike("^[0-9]+$"))


def normalize_country(c: Column | str) -> Column:
    """Upper case and trimmed, known spellings unified; blank or null is UNKNOWN."""
    up = F.upper(F.trim(F.coalesce(_col(c), F.lit(""))))
    out = F.when(up == "", "UNKNOWN")
    for name, spellings in COUNTRIES.items():
        out = out.when(up.isin(spellings), name)
    return out.otherwise(up)


def drop_fillers(c: Column | str) -> Column:
    """Without stop words (an option; the plans do not use it)."""
    return F.array_join(F.filter(F.split(_col(c), " "), lambda t: ~t.isin(STOP_WORDS)), " ")
