"""Text scalars."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that say nothing about what a text is about.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from", "get", "got", "had", "have", "i", "i'm", "if", "in", "is", "it", "its", "just",
    "like", "me", "my", "no", "not", "of", "oh", "on", "or", "our", "so", "that", "the", "their", "them", "there", "they", "this", "to", "uh", "um", "was", "we",
    "were", "what", "when", "with", "yeah", "you", "your",
]
TOKEN = r"[a-z0-9][a-z0-9'-]+"


def squeeze(x: Column) -> Column:
    """White space collapsed and trimmed; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(x, r"\s+", " ")), F.lit(""))


def nonblank(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def first_nonblank(*xs: Column) -> Column:
    return F.coalesce(*map(nonblank, xs))


def truthy(x: Column) -> Column:
    """The text unless it is empty, as ``a or b`` chains have it."""
    return F.nullif(x, F.lit(""))


def distinct_clean(xs: Column) -> Column:
    """Squeezed elements in order, blanks and repeats left out."""
    return F.array_distinct(F.filter(F.transform(xs, squeeze), lambda x: x.isNotNull()))


def join_parts(*parts: Column) -> Column:
    """The distinct non-blank parts, a line each; null if there are none."""
    return F.nullif(F.array_join(distinct_clean(F.array(*parts)), "\n"), F.lit(""))


def excerpt(x: Column, limit: int = 240, mark: str = "…") -> Column:
    """At most ``limit`` characters, the mark included."""
    return F.when(F.length(x) > limit, F.concat(F.rtrim(F.substring(x, 1, limit - len(mark))), F.lit(mark))).otherwise(x)


def strip_front_matter(markdown: Column) -> Column:
    """Markdown without a leading block between ``---`` lines; blank is null."""
    return nonblank(F.regexp_replace(markdown, r"(?s)\A---\r?\n.*?\n---[ \t]*(\r?\n|\z)\s*", ""))


def browser_host(url: Column) -> Column:
    """The authority of a URL, port included."""
    return F.nullif(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))


def tokens(x: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of three characters or more that aren't stop words."""
    stop = list(stop_words)
    words = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(stop))


def joined_facts(xs: Column, sep: str = "; ", limit: int | None = None) -> Column:
    """A list as one text."""
    some = F.slice(xs, 1, limit) if limit else xs
    return F.nullif(F.array_join(F.filter(F.transform(some, squeeze), lambda x: x.isNotNull()), sep), F.lit(""))


def canonical_json(x: Column) -> Column:
    """JSON with the keys of every object in order and no space between, so that equal values are equal text; other text as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(x)), x)


def leaves(document) -> Iterator[tuple[tuple, str]]:
    """The path and text of every leaf of a JSON value that says something; a path's steps are (place, key), the key None in lists."""
    waiting = [((), document)]
    while waiting:
        path, value = waiting.pop()
        if isinstance(value, (dict, list)):
            inside = value.items() if isinstance(value, dict) else ((None, v) for v in value)
            waiting += reversed([((*path, (place, key)), v) for place, (key, v) in enumerate(inside)])
        elif value is not None and (shown := " ".join(str(value).split())):
            yield path, shown


def spoken(document) -> str | None:
    """Any JSON value as one line: its leaves, each after the keys that it is the first to stand under."""
    parts, before = [], ()
    for path, shown in leaves(document):
        old = sum(1 for _ in takewhile(lambda two: two[0] == two[1], zip(path, before)))
        keys = [str(key) for _, key in path[old:] if key is not None]
        parts.append(": ".join([*keys, shown]))
        before = path
    return "; ".join(parts) or None


@F.pandas_udf(T.StringType())
def json_text(values: pd.Series) -> pd.Series:
    """A JSON text of any depth as one line; text that isn't JSON is taken as it is."""
    import json

    def one(x):
        if x is None:
            return None
        try:
            return spoken(json.loads(x))
        except ValueError:
            return spoken(x)

    return values.map(one, na_action="ignore").astype("object").where(values.notna(), None)
