"""Full-text search over chunks: an inverted index, a query language, BM25, snippets and the ways to fall back."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# BM25's parameters and the least weight of a term.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
WORD = r"[\p{L}\p{N}]+"
_MARKED = [c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) > 1]
_PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in _MARKED)


class QuerySyntaxError(ValueError):
    pass


def folded(x: Column) -> Column:
    """Lower case, Latin letters without their marks."""
    return F.lower(F.translate(x, "".join(_MARKED), _PLAIN))


def words(x: Column) -> Column:
    return F.regexp_extract_all(folded(F.coalesce(x, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def fold_word(x: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", x.lower()) if not unicodedata.combining(c))


PLACED = "array<struct<field:int,position:int,token:string>>"


@dataclass(frozen=True)
class Index:
    """An inverted index over documents as they are: doc, length, words.  A stored one (``inverted.Stored``) answers alike."""

    words: DataFrame
    fields: tuple[str, ...]

    def found(self, any_of: Callable[[Column], Column]) -> DataFrame:
        """doc, length and the places of the tokens for which ``any_of`` holds; others aren't exploded."""
        return self.words.select("doc", "length", F.filter("words", lambda w: any_of(w["token"])).alias("places")).where(F.size("places") > 0)

    def size(self) -> DataFrame:
        """One row: how many documents there are, and how long they are on average."""
        return self.words.agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_length"))


def index(docs: DataFrame, key: str, fields: list[str], *also: str) -> Index:
    """``also`` names columns to carry along."""
    per = docs.select(F.col(key).alias("doc"), *also, *[words(F.col(f)).alias(f"f{n}") for n, f in enumerate(fields)])

    def placed(n: int):
        return lambda w, i: F.struct(F.lit(n).alias("field"), i.alias("position"), w.alias("token"))

    every = F.concat(*[F.transform(f"f{n}", placed(n)) for n in range(len(fields))])
    length = sum((F.size(f"f{n}") for n in range(len(fields))), F.lit(0))
    return Index(per.select("doc", *also, length.alias("length"), every.cast(PLACED).alias("words")), tuple(fields))


#: Tokens between two phrases of NEAR, if the query doesn't say.
NEAR = 10


@dataclass(frozen=True)
class Match:
    """A word, a phrase or, if ``prefix``, one whose last word may go on; in some fields (none: in any)."""

    parts: tuple[str, ...]
    prefix: bool = False
    fields: frozenset[int] | None = None


@dataclass(frozen=True)
class Near:
    """Phrases of one field, each of which begins no later than some place and ends no more than ``gap`` tokens before it."""

    phrases: tuple[Match, ...]
    gap: int
    fields: frozenset[int] | None = None


Leaf = Match | Near


def within(tree, fields: frozenset[int]):
    """The same query with every leaf restricted to some fields."""
    if isinstance(tree, Leaf):
        both = fields if tree.fields is None else fields & tree.fields
        return replace(tree, fields=both)
    return (tree[0], within(tree[1], fields), within(tree[2], fields))


def parse(query: str, fields: tuple[str, ...] = ("title", "text")):
    """Words, "phrases", prefix*, NEAR(a "b c", 5), and what is behind ``field :``, ``{two fields} :`` or ``- field :``.

    They are joined by implicit or written AND, OR, NOT and parentheses.
    """
    found = re.findall(r'"[^"]*"\s*\*?|[(){}:,+]|-(?=\s*[\w{])|[^\s()"{}:,+]+|"', query)
    at = 0

    def peek(ahead: int = 0):
        return found[at + ahead] if at + ahead < len(found) else None

    def take(expected: str | None = None):
        nonlocal at
        if peek() is None or expected not in (None, peek()):
            raise QuerySyntaxError(query)
        at += 1
        return found[at - 1]

    def phrase() -> Match:
        token = take()
        if token in ("(", ")", "{", "}", ":", ",", "+", "-", '"', "AND", "OR", "NOT"):
            raise QuerySyntaxError(query)
        prefix = token.endswith("*")
        body = token.rstrip("*").strip().strip('"')
        if not token.startswith('"') and re.search(r"[^\w]", body):
            raise QuerySyntaxError(query)
        parts = [fold_word(w) for w in re.findall(r"[^\W_]+", body)]
        if not parts:
            raise QuerySyntaxError(query)
        return Match(tuple(parts), prefix)

    def near() -> Near:
        take("NEAR")
        take("(")
        phrases, gap = [], NEAR
        while peek() not in (")", ","):
            phrases.append(phrase())
        if peek() == ",":
            take()
            number = take()
            if not number.isdecimal():
                raise QuerySyntaxError(query)
            gap = int(number)
        take(")")
        if not phrases:
            raise QuerySyntaxError(query)
        return Near(tuple(phrases), gap)

    def columns() -> frozenset[int] | None:
        """The fields that a prefix ``field :`` names, if there is one here."""
        nonlocal at
        start, turned = at, peek() == "-"
        if turned:
            take()
        if peek() == "{":
            take()
            names = []
            while peek() != "}":
                names.append(take())
            take()
        elif peek() is not None and peek(1) == ":":
            names = [take()]
        else:
            names = []
        if peek() != ":" or not names:
            at = start
            return None
        take()
        known = {f.lower(): i for i, f in enumerate(fields)}
        if any(n.strip('"').lower() not in known for n in names):
            raise QuerySyntaxError(query)
        chosen = {known[n.strip('"').lower()] for n in names}
        return frozenset(set(known.values()) - chosen if turned else chosen)

    def leaf():
        where = columns()
        if peek() == "(":
            take()
            inner = either()
            take(")")
        elif peek() == "NEAR" and peek(1) == "(":
            inner = near()
        else:
            inner = phrase()
        return inner if where is None else within(inner, where)

    def without():
        out = leaf()
        while peek() == "NOT":
            take()
            out = ("not", out, leaf())
        return out

    def both():
        out = without()
        while peek() not in (None, ")", "OR"):
            if peek() == "AND":
                take()
            out = ("and", out, without())
        return out

    def either():
        out = both()
        while peek() == "OR":
            take()
            out = ("or", out, both())
        return out

    tree = either()
    if peek() is not None:
        raise QuerySyntaxError(query)
    return tree


def leaves(tree) -> list[Leaf]:
    """The leaves that make a document match."""
    return [tree] if isinstance(tree, Leaf) else leaves(tree[1]) + ([] if tree[0] == "not" else leaves(tree[2]))


def phrases_of(leaf: Leaf) -> tuple[Match, ...]:
    return (leaf,) if isinstance(leaf, Match) else leaf.phrases


def tests_of(leaf: Leaf) -> list[Callable[[Column], Column]]:
    """For each word of a leaf, what a token must be."""
    out = []
    for phrase in phrases_of(leaf):
        equal = [lambda t, p=p: t == p for p in phrase.parts]
        out += [*equal[:-1], lambda t, p=phrase.parts[-1]: t.startswith(p)] if phrase.prefix else equal
    return out


#: Places of different fields are this far apart.
FAR = 1 << 40


def begins(phrase: Match, fields: frozenset[int] | None) -> Column:
    """Where a phrase begins among a document's ``places``: position plus FAR times field."""

    def of_word(n: int, test) -> Column:
        fits = F.filter("places", lambda x: test(x["token"]) & (x["field"].isin(list(fields)) if fields is not None else F.lit(True)))
        return F.transform(fits, lambda x: x["field"].cast("long") * FAR + x["position"] - n)

    first, *rest = (of_word(n, test) for n, test in enumerate(tests_of(phrase)))
    for other in rest:
        first = F.array_intersect(first, other)
    return first


def frequency(leaf: Leaf) -> Column:
    """How often a leaf is among a document's ``places``; of NEAR the places where the last of a group of its phrases begins.

    NEAR goes once over the merged lists of its phrases, in order, and keeps
    where each began last.
    """
    if isinstance(leaf, Match):
        return F.size(begins(leaf, leaf.fields))
    if leaf.fields is not None and not leaf.fields:
        return F.lit(0)
    n = len(leaf.phrases)

    def marked(who: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(x.alias("at"), F.lit(who).alias("who"))

    every = F.concat(*[F.transform(begins(p, leaf.fields), marked(i)) for i, p in enumerate(leaf.phrases)])
    ends = F.array(*[F.lit(len(p.parts)).cast("long") for p in leaf.phrases])

    def go(state: Column, x: Column) -> Column:
        last = F.transform(state["last"], lambda y, i: F.when(i == x["who"], x["at"]).otherwise(y))
        near = F.forall(F.zip_with(last, ends, lambda y, length: x["at"] - y - length <= leaf.gap), lambda ok: ok)
        return F.struct(last.alias("last"), F.when(near, F.array_union(state["hits"], F.array(x["at"]))).otherwise(state["hits"]).alias("hits"))

    none = F.struct(F.array_repeat(F.lit(-FAR), n).alias("last"), F.array().cast("array<bigint>").alias("hits"))
    return F.size(F.aggregate(F.array_sort(every), none, go, lambda state: state["hits"]))


def holds(tree, tf: dict[Leaf, Column]) -> Column:
    """Whether a query holds for a document, from the frequencies of its leaves."""
    if isinstance(tree, Leaf):
        return tf[tree] > 0
    a, b = holds(tree[1], tf), holds(tree[2], tf)
    return a & b if tree[0] == "and" else a | b if tree[0] == "or" else a & ~b


def every_leaf(tree) -> list[Leaf]:
    return [tree] if isinstance(tree, Leaf) else every_leaf(tree[1]) + every_leaf(tree[2])


def any_word_of(asked: list[Leaf]) -> Callable[[Column], Column]:
    """Whether a token is one that some leaf looks for; equal ones as a list, which a stored index can look up."""
    equal = {p for leaf in asked for phrase in phrases_of(leaf) for p in (phrase.parts[:-1] if phrase.prefix else phrase.parts)}
    starts = {phrase.parts[-1] for leaf in asked for phrase in phrases_of(leaf) if phrase.prefix}

    def test(token: Column) -> Column:
        return reduce(Column.__or__, [*([token.isin(sorted(equal))] if equal else []), *[token.startswith(p) for p in sorted(starts)]])

    return test


def saturated(tf: Column, length: Column, avg_length: Column) -> Column:
    """What a word's frequency adds to a score before its rarity; more for more, less in longer documents."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg_length))


def rarity(n_docs: Column, n: Column) -> Column:
    return F.greatest(F.lit(LEAST_IDF), F.ln((n_docs - n + 0.5) / (n + 0.5)))


def frequencies(rows: DataFrame, asked: list[Leaf]) -> tuple[DataFrame, dict[Leaf, Column]]:
    """doc, length and the frequency of each leaf."""
    rows = rows.select("doc", "length", *[frequency(leaf).alias(f"tf{i}") for i, leaf in enumerate(asked)])
    return rows, {leaf: F.col(f"tf{i}") for i, leaf in enumerate(asked)}


def bm25(ix, query: str) -> DataFrame:
    """(doc, score) of the documents that match; higher is better.

    One pass gives the counts of each leaf, one the scores; nothing is
    exchanged but the counts, or the postings of the query's tokens if the
    index is stored.
    """
    tree = parse(query, ix.fields)
    asked = list(dict.fromkeys(every_leaf(tree)))
    rows, tf = frequencies(ix.found(any_word_of(asked)), asked)
    counts = rows.agg(*[F.count_if(tf[leaf] > 0).alias(f"n{i}") for i, leaf in enumerate(asked)])
    rows = rows.where(holds(tree, tf)).crossJoin(F.broadcast(ix.size())).crossJoin(F.broadcast(counts))  # one row each
    score = F.lit(0.0)
    for leaf in dict.fromkeys(leaves(tree)):
        score = score + rarity(F.col("n_docs"), F.col(f"n{asked.index(leaf)}")) * saturated(tf[leaf], F.col("length"), F.col("avg_length"))
    return rows.select("doc", score.alias("score"))


def snippet(body: Column, terms: list[tuple[str, bool]], size: int = 16, left: str = "[", right: str = "]", more: str = "...") -> Column:
    """The best ``size`` words, hits in brackets.

    ``terms`` are words and whether they may go on.  Of the windows that begin
    at a hit the best has most different terms, then most hits, then comes
    first; what it has is put in the middle.
    """
    plain = lambda w: F.regexp_replace(folded(w), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")

    def term(w: Column) -> Column:
        """The first term that a word is, null if none."""
        return F.coalesce(*[F.when(w.startswith(t) if prefix else w == t, F.lit(i)) for i, (t, prefix) in enumerate(terms)], F.lit(None).cast("int"))

    parts = F.split(F.trim(body), r"\s+")
    places = F.transform(parts, lambda w, i: F.struct(i.alias("at"), term(plain(w)).alias("who")))
    hits = F.filter(places, lambda x: x["who"].isNotNull())

    def window(x: Column, i: Column) -> Column:
        """A window's different terms, hits, where it begins (less is more) and where its last hit is."""
        inside = F.filter(F.slice(hits, i + 1, F.lit(size)), lambda y: y["at"] < x["at"] + size)
        return F.struct(F.size(F.array_distinct(F.transform(inside, lambda y: y["who"]))).alias("terms"), F.size(inside).alias("n"), (-x["at"]).alias("first"), F.element_at(inside, -1)["at"].alias("last"))

    best = F.array_max(F.transform(hits, window))
    first, last = -best["first"], best["last"]
    middle = first - F.floor((size - 1 - (last - first)) / 2).cast("int")
    start = F.when(best.isNull(), 1).otherwise(F.greatest(F.lit(1), F.least(middle + 1, F.size(parts) - size + 1)))
    shown = F.transform(F.slice(parts, start, size), lambda w: F.when(term(plain(w)).isNotNull(), F.concat(F.lit(left), w, F.lit(right))).otherwise(w))
    return F.concat(F.when(start > 1, more).otherwise(""), F.array_join(shown, " "), F.when(start + size <= F.size(parts), more).otherwise(""))


def terms_of(tree) -> list[tuple[str, bool]]:
    """The words that a snippet shows as hits."""
    found = [(w, phrase.prefix and i == len(phrase.parts) - 1) for leaf in leaves(tree) for phrase in phrases_of(leaf) for i, w in enumerate(phrase.parts)]
    return list(dict.fromkeys(found))


def tag_filter(chunks: DataFrame, chunk_tag: DataFrame, tags: list[str]) -> DataFrame:
    """Chunks that carry every one of the tags, as ``type:value`` or a value alone."""
    for tag in tags:
        kind, _, value = tag.rpartition(":")
        rows = chunk_tag.where((F.col("tag_value") == value) & (F.col("tag_type") == kind if kind else F.lit(True)))
        chunks = chunks.join(rows.select(F.col("chunk_id").alias("id")), "id", "left_semi")
    return chunks


def clamp_limit(limit: int | None, low: int = 1, high: int = 50) -> int:
    return max(low, min(high, int(limit or 10)))


def filtered(chunks: DataFrame, chunk_tag: DataFrame, day: str | None = None, day_from: str | None = None, day_to: str | None = None, chunk_types: list[str] | None = None, tags: list[str] | None = None) -> DataFrame:
    """Only the parameters that are set become predicates, so that they reach the scan."""
    tests = [F.col("day") == day] if day else []
    tests += [F.col("day") >= day_from] if day_from else []
    tests += [F.col("day") <= day_to] if day_to else []
    tests += [F.col("chunk_type").isin(chunk_types)] if chunk_types else []
    for test in tests:
        chunks = chunks.where(test)
    return tag_filter(chunks, chunk_tag, tags or [])


#: The searched columns of a chunk.
FIELDS = ("title", "text")


Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(df: DataFrame, name: str) -> DataFrame:
    return df


def search(chunks: DataFrame, chunk_tag: DataFrame, query: str | None, limit: int | None = 10, ix=None, keep: Keep = as_it_is, **filters) -> tuple[str, DataFrame]:
    """The strategy used (fts, like or latest) and the best chunks with score and snippet.

    ``ix`` is an index of the chunks, stored or not; without one the chunks are indexed as they are.
    Full-text search ranks keys alone; texts are read of the best chunks, which ``keep`` stores.
    """
    rows = filtered(chunks, chunk_tag, **filters)
    top = clamp_limit(limit)
    fallback = [F.col("salience").desc(), F.col("confidence").desc(), F.col("sort_key"), F.col("id")]
    head = F.substring("text", 1, 240)
    if not (query or "").strip():
        return "latest", rows.select("*", F.lit(None).cast("double").alias("score"), head.alias("snippet")).orderBy(*fallback).limit(top)
    try:
        tree = parse(query, ix.fields if ix else FIELDS)
    except QuerySyntaxError:
        found = rows.where(F.col("title").ilike(f"%{query.strip()}%") | F.col("text").ilike(f"%{query.strip()}%"))
        return "like", found.select("*", F.lit(None).cast("double").alias("score"), head.alias("snippet")).orderBy(*fallback).limit(top)
    order = [F.col("score").desc(), F.col("id")]
    scores = bm25(ix or index(chunks, "id", list(FIELDS)), query).withColumnRenamed("doc", "id")
    best = keep(rows.select("id").join(scores, "id").orderBy(*order).limit(top).distinct(), "best")
    # No more rows than the limit, 50 at most, reach every task.
    tagged = chunk_tag.join(F.broadcast(best.select(F.col("id").alias("chunk_id"))), "chunk_id", "left_semi")
    found = filtered(chunks.join(F.broadcast(best), "id"), tagged, **filters)
    return "fts", found.select(*rows.columns, "score", snippet(F.col("text"), terms_of(tree)).alias("snippet")).orderBy(*order).limit(top)
