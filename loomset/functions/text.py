"""Column expressions over text and messages. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space: control characters, then all of category Z.
_SPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85" + " \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BRANCH = " → "


def strip(x: Column) -> Column:
    """Without Unicode white space at both ends. Only the ends are compared; a pattern would try each run of spaces within."""
    return F.btrim(x, F.lit(_SPACE))


def text_or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def prefix(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def split_part_rest(x: Column, sep: str, limit: int, index: int) -> Column:
    """Part `index` (from 0) of x split into at most `limit` parts, the last keeping the rest; null if there are fewer."""
    return F.get(F.split(x, sep, limit), F.lit(index))


def joined(items: Column, sep: str, default: str) -> Column:
    """Array items joined; default if there are none."""
    return F.coalesce(F.nullif(F.array_join(items, sep), F.lit("")), F.lit(default))


def contains_any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def occurrences(x: Column, part: Column) -> Column:
    """Times that part occurs without overlap."""
    return ((F.length(x) - F.length(F.replace(x, part, F.lit("")))) / F.length(part)).cast("long")


def sha256(x: Column) -> Column:
    return F.sha2(x, 256)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)


def seeded_key(seed: int, key: Column) -> Column:
    """A fixed pseudo-random order of keys."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), key.cast("string")), 256)


def degenerate(x: Column) -> Column:
    """Whether one of the 200-character windows at multiples of 200 starts with 40 characters that occur three times in it.

    Windows below 123 characters are not tested, nor are those that start at 5000 or later. The windows are cut in one pass, as
    each substring would count characters from the start of the text.
    """
    windows = F.regexp_extract_all(F.left(x, F.lit(5000)), F.lit("(?s).{1,200}"), F.lit(0))
    return F.exists(windows, lambda w: (F.length(w) >= 123) & (F.length(w) - F.length(F.replace(w, F.left(w, F.lit(40)), F.lit(""))) >= 120))


# Messages: array<struct<role, content>>


def of_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def first_content(messages: Column, role: str) -> Column:
    """Content of the first message of a role; null if there is none."""
    return F.get(of_role(messages, role), F.lit(0))["content"]


def last_content(messages: Column, role: str) -> Column:
    return F.try_element_at(of_role(messages, role), F.lit(-1))["content"]


def total_length(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda a, m: a + F.length(text_or_empty(m["content"])))


def roles(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.coalesce(m["role"], F.lit("?")))


def answer_fingerprint(messages: Column) -> Column:
    """SHA-256 of the first assistant content, lowered and stripped; of the empty text if there is none."""
    return sha256(strip(F.lower(text_or_empty(first_content(messages, "assistant")))))


def conversation_hash(messages: Column) -> Column:
    parts = F.transform(messages, lambda m: F.concat(text_or_empty(m["role"]), F.lit("\x1f"), text_or_empty(m["content"])))
    return sha256(F.array_join(parts, "\x1e"))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def first_match(x: Column, rules: dict[str, list[str]], default: str) -> Column:
    """Label of the first rule any of whose keywords x contains."""
    out = None
    for label, words in rules.items():
        hit = contains_any(x, words)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
