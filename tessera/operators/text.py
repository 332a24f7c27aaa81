"""Text-mining operators: tokenising, n-gram rows and frequencies, regex
prefix filtering and wildcard context n-grams.

All are DataFrame-in, DataFrame-out.  Texts are processed whole.  n-gram rows
are built by JVM built-ins inside each row (no shuffle).  Counts are taken on
numbered words in Arrow batches (``grams``) and summed by a map-side-combined
aggregate, so a very frequent n-gram never concentrates raw rows on one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.functions.text import gram_at, ngrams, ngrams_starting_with
from tessera.operators.generators import explode_rows
from tessera.operators.grams import WORDS_AT_A_TIME, Bounds, Words, bounds, counted, distinct, gram_schema, handed, packed, slices
from tessera.operators.relational import top_k, top_k_per_group

# n-grams of that many words seldom repeat within a task; for the first few of
# them, up to MOST_BOUNDED a group, counts are bounded before they are taken.
LONG, MOST_BOUNDED = 3, 1000
# Fixed value: the word that stands for "any word" in a context prefix.
WILDCARD = "null"


def explode_ngrams(df: DataFrame, n: int, words_col: str = "words", out_col: str = "ngram",
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per n-gram occurrence (rows with fewer than n words emit none)."""
    return explode_rows(df, ngrams(words_col, n), out_col, keep=keep)


def ngram_counts(df: DataFrame, n: int, words_col: str = "words", out_col: str = "ngram",
                 group: Sequence[str] = (), count_col: str = "estfrequency") -> DataFrame:
    """Exact occurrence count of every n-gram (per ``group`` if given)."""
    return _ngram_counts(df, n, words_col, out_col, group, count_col, None)


def _ngram_counts(df: DataFrame, n: int, words_col: str, out_col: str, group: Sequence[str], count_col: str, bounds: Bounds | None) -> DataFrame:
    """``ngram_counts``; with ``bounds`` without the n-grams that cannot be among their group's first."""
    if n < 1:
        raise ValueError("n must be >= 1")
    sent = df.sparkSession.sparkContext.broadcast(bounds) if bounds is not None else None
    schema = gram_schema(df, group, StructField(out_col, StringType()), StructField(count_col, LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, WORDS_AT_A_TIME):
                row, grams, times, _ = counted(rows, n)
                if sent is not None:
                    kept = np.flatnonzero(sent.value.may_be_first(rows, row, grams))
                    row, grams, times = row[kept], grams.take(pa.array(kept)), times[kept]
                yield from handed([*[c.take(pa.array(row)) for c in rows.columns[:-1]], grams, pa.array(times, pa.int64())], schema.names)

    parts = df.select(*group, words_col).mapInArrow(run, schema)
    return parts.groupBy(*group, out_col).agg(F.sum(count_col).alias(count_col))


def ngram_frequency(df: DataFrame, n: int, k: int | None = 5, words_col: str = "words",
                    out_col: str = "ngram", group: Sequence[str] = (),
                    count_col: str = "estfrequency") -> DataFrame:
    """Most frequent n-grams: overall, or the top ``k`` of each group.  For a
    few long ones, a first pass bounds the counts, and n-grams that cannot be
    among them are not shuffled; counts are exact all the same."""
    few = n >= LONG and k is not None and 0 < k <= MOST_BOUNDED
    counts = _ngram_counts(df, n, words_col, out_col, group, count_col, bounds(df, n, k, words_col, group) if few else None)
    if k is None:
        return counts.orderBy(F.col(count_col).desc(), *group, out_col)
    order, ties = [F.col(count_col).desc()], [F.col(out_col)]
    if group:
        return top_k_per_group(counts, list(group), k, order, ties)
    return top_k(counts, k, order, ties)


# A pattern that is nothing but an anchor and plain words: its first word is
# followed by a space, so it is the n-gram's whole first token.
_PLAIN_WORDS = re.compile(r"\^([A-Za-z0-9]+)(?: [A-Za-z0-9]+)+ ?")


def ngram_regex_filter(df: DataFrame, n: int, pattern: str, words_col: str = "words",
                       out_col: str = "ngram") -> DataFrame:
    """n-gram occurrences matching a Java regex (unanchored find, as ``rlike``).

    For a pattern of plain words after ``^`` the n-gram strings are built only
    at positions whose token is its first word; every other pattern is tested
    on every n-gram."""
    plain = _PLAIN_WORDS.fullmatch(pattern)
    if plain and n > 1:
        rows = explode_rows(df, ngrams_starting_with(words_col, n, plain.group(1)), out_col)
    else:
        rows = explode_ngrams(df, n, words_col, out_col)
    return rows.filter(F.col(out_col).rlike(pattern))


@dataclass(frozen=True)
class Context:
    """The tokens that a context asks for, one a position; None is any token."""

    tokens: tuple[str | None, ...]

    @classmethod
    def of(cls, context: str | Iterable[str | None] | None) -> Context:
        """From text (split at blanks) or a list of tokens; the word ``null`` is any token."""
        parts = context.split() if isinstance(context, str) else tuple(context or ())
        if not parts:
            raise ValueError("a context needs at least one token")
        return cls(tuple(None if p == WILDCARD else p for p in parts))

    @property
    def first(self) -> str | None:
        """The token every matching n-gram starts with, when the context fixes it whole."""
        return self.tokens[0] if len(self.tokens) > 1 else None

    def regex(self) -> str:
        """A Java pattern for the n-gram's text, anchored at its start only:
        after the last token anything may follow."""
        quoted = ("\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E" if t is not None else ".*" for t in self.tokens)
        return "^" + " ".join(quoted)

    def fits(self, words: Column, start: Column) -> Column:
        """Whether the tokens from 1-based ``start`` are those asked for, each compared whole."""
        asked = [F.element_at(words, start + j) == t for j, t in enumerate(self.tokens) if t is not None]
        return reduce(lambda a, b: a & b, asked, F.lit(True))

    def grams(self, words: Column, exact: bool) -> Column:
        """The n-grams that can match: all that do if ``exact``, else those the regex has to test."""
        n = len(self.tokens)
        if exact:
            starts = F.filter(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: self.fits(words, i))
            found = F.transform(starts, lambda i: gram_at(words, i, n))
            return F.when(F.size(words) >= n, found)
        return ngrams(words, n) if self.first is None else ngrams_starting_with(words, n, self.first)


def context_ngram(df: DataFrame, context: str | Iterable[str | None], input_col: str = "words",
                  out_col: str = "ngram", count_col: str = "estfrequency", exact: bool = False) -> DataFrame:
    """Frequencies of the n-grams that fit a context such as
    ``'quality null null'``, most frequent first.

    By default the context's regex is searched in the n-gram, so the last
    literal token also matches as a prefix ('red one' finds 'red ones');
    ``exact`` compares whole tokens instead.  Either way n-grams are filtered
    before the shuffle and only matching ones are counted."""
    asked = Context.of(context)
    rows = explode_rows(df, asked.grams(F.col(input_col), exact), out_col)
    if not exact:
        rows = rows.filter(F.col(out_col).rlike(asked.regex()))
    return (rows.groupBy(out_col).agg(F.count(F.lit(1)).alias(count_col))
                .orderBy(F.col(count_col).desc(), F.col(out_col)))


# Contexts that one scan looks for; they are shipped to every task.
MAX_CONTEXTS = 100_000


def context_ngrams(df: DataFrame, contexts: Iterable[str | Sequence[str | None]], input_col: str = "words", context_col: str = "context",
                   out_col: str = "ngram", count_col: str = "estfrequency", exact: bool = False) -> DataFrame:
    """(context, ngram, estfrequency) of many contexts in one scan: for each
    what ``context_ngram`` gives for it alone, under its tokens joined by
    blanks.  Contexts that are equal count once.

    Contexts are looked up by all their literals at once: those that have them
    at the same places (a prefix at the end: of the same length) share one table."""
    asked = {c.tokens: c for c in map(Context.of, contexts)}
    if not asked or len(asked) > MAX_CONTEXTS:
        raise ValueError(f"between 1 and {MAX_CONTEXTS} contexts can be looked for in one scan")
    tables = [(shape, pa.array([" ".join(WILDCARD if t is None else t for t in c.tokens) for c in same]), pa.array([c.regex() for c in same]),
               [pa.array([c.tokens[j] for c in same]) for j in shape[1]]) for shape, same in _by_shape(asked.values(), exact).items()]
    sent = df.sparkSession.sparkContext.broadcast(tables)
    schema = StructType([StructField(c, StringType()) for c in ("context", "regex", out_col)] + [StructField(count_col, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, WORDS_AT_A_TIME):
                words = Words(rows.column(0))
                for (n, places, prefix), names, regexes, literals in sent.value:
                    at, which = _found(words, n, places, prefix, literals, len(names))
                    first, times = distinct(packed([(which, len(names)), *words.parts(at, n)]))
                    own = pa.array(which[first])
                    yield from handed([names.take(own), regexes.take(own), words.grams(at[first], n), pa.array(times, pa.int64())], schema.names)

    fits = df.select(input_col).mapInArrow(run, schema)
    if not exact:
        fits = fits.filter(F.rlike(F.col(out_col), F.col("regex")))
    return fits.groupBy(F.col("context").alias(context_col), out_col).agg(F.sum(count_col).alias(count_col))


def _by_shape(contexts: Iterable[Context], exact: bool) -> dict[tuple[int, tuple[int, ...], int], list[Context]]:
    """Contexts by (length, places of literals, length of the prefix that the last one is; -1: it is whole)."""
    out: dict[tuple[int, tuple[int, ...], int], list[Context]] = {}
    for c in contexts:
        last = c.tokens[-1]
        prefix = -1 if exact or last is None else len(last)
        out.setdefault((len(c.tokens), tuple(j for j, t in enumerate(c.tokens) if t is not None), prefix), []).append(c)
    return out


def _found(words: Words, n: int, places: Sequence[int], prefix: int, literals: Sequence[pa.Array], many: int) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams with some context's literals begin, and which context's (of ``many`` that ask for the same places)."""
    at, own, parts = words.places(n), np.arange(many), []
    for j, asked in zip(places, literals, strict=True):
        # the place's words (or their beginnings) in numbers, and the contexts' words in the same
        texts, number = words.texts, np.arange(len(words.texts))
        if j == n - 1 and prefix >= 0:
            begun = pc.utf8_slice_codeunits(texts, 0, prefix).dictionary_encode()
            texts = begun.dictionary
            number = begun.indices.fill_null(len(texts)).to_numpy(zero_copy_only=False).astype(np.int64)
        wanted = pc.index_in(asked, value_set=texts).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        used = np.zeros(len(texts) + 1, bool)
        used[wanted[wanted >= 0]] = True
        at = at[used[number[words.code[at + j]]]]
        own = own[wanted[own] >= 0]
        parts.append((j, number, wanted, len(texts) + 1))
    if not places:
        return at, np.zeros(len(at), np.int64)
    key = packed([(np.concatenate([wanted[own], number[words.code[at + j]]]), width) for j, number, wanted, width in parts])
    order = np.argsort(key[:len(own)])
    table, key = key[:len(own)][order], key[len(own):]
    if not len(own):
        return at[:0], own
    spot = np.minimum(np.searchsorted(table, key), len(table) - 1)
    fits = table[spot] == key
    return at[fits], own[order[spot[fits]]]
