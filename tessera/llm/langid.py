"""Language identification by Bayesian evidence fusion (operator 3).

Four pieces of evidence are combined, as sums of logarithms over the languages:

* the text: hashed character trigrams under a multinomial model of each
  language, learnt from every row that declares one; its weight saturates at
  TEXT_WEIGHT independent trigrams, since trigrams of one text are not;
* the declared language (``lang`` of the markup, or of the record): how often
  rows whose text speaks for a language declare this one;
* the suffix of the address, likewise;
* the host: a prior from the rows of the host, shrunk towards its registered
  domain's, and that towards all rows'.

The tables of the last three come from one grouped count of (host, suffix,
declared, language by text).  Languages are all declared primary tags, however
few rows declare them; there are no more of them than tags of two or three
letters.  The text model is all that is sent to tasks: a number for each bucket
that a language has met, so a rare one adds little.  It is smoothed by the trigrams
of all declared rows, so that a language of few rows draws only texts like its own.

A row is accepted if its text has letters and the best language's posterior
reaches ACCEPT (more likely than not).

Defined cases: a null or empty text, or one without letters, gets the language
of its other evidence and is rejected; a missing declaration or suffix is a
value of its own; a missing host has the prior of all rows; if no row declares
a language, every language is null and nothing is accepted; ties fall to the
first language in order; repeated rows are judged one by one; extra columns
are kept by ``judge`` and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import in_small_batches, persisted

BUCKETS = 8192
SMOOTH = BUCKETS / 2
TEXT_WEIGHT, STRENGTH, ACCEPT = 50.0, 20.0, 0.5
_MIX = np.uint32(2654435761)


def trigram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed byte trigrams of the lower-cased text; None without letters."""
    if not text or not any(map(str.isalpha, text[:256])) and not any(map(str.isalpha, text)):
        return None
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return np.bincount((code * _MIX) >> np.uint32(32 - 13), minlength=BUCKETS)


def _primary(tag: Column) -> Column:
    """'pt-BR' -> 'pt'; null if it isn't a language tag."""
    found = F.regexp_extract(F.lower(tag), r"^\s*([a-z]{2,3})(?![a-z])", 1)
    return F.when(found != "", found)


def document_evidence(docs: DataFrame) -> dict[str, Column]:
    """Records: ``lang`` declares, ``source`` is the host, there is no address."""
    return {"text": F.col("text"), "declared": F.col("lang"), "host": F.col("source"), "suffix": F.lit(None).cast("string")}


def page_evidence(pages: DataFrame) -> dict[str, Column]:
    """Web pages: the markup's ``lang`` declares, the address names host and suffix."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract("html", r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
    return {"text": body, "declared": F.when(declared != "", declared), "host": host,
            "suffix": F.regexp_extract(host, r"([^.]+)\.?$", 1)}


class TextModel:
    """log P(trigram | language), languages in order: that of a trigram that a
    language has not met, by bucket and by language, and what the others have
    above it, bucket by bucket."""

    def __init__(self, languages: list[str], language: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        every = np.bincount(bucket, n, BUCKETS) + 0.5
        share = SMOOTH * every / every.sum()
        order = np.lexsort((language, bucket))
        self.languages, self.language = languages, language[order].astype(np.int32)
        self.more = np.log1p(n[order] / share[bucket[order]])
        self.first = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        self.unmet = np.log(share)
        self.size = np.log(np.bincount(language, n, len(languages)) + SMOOTH)

    def evidence(self, text: str) -> np.ndarray | None:
        c = trigram_counts(text)
        if c is None:
            return None
        n, at = int(c.sum()), np.flatnonzero(c)
        begin, many = self.first[at], self.first[at + 1] - self.first[at]
        entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - begin, many)
        above = np.bincount(self.language[entry], self.more[entry] * np.repeat(c[at], many), len(self.languages))
        return ((c[at] @ self.unmet[at]) + above - n * self.size) / n * (n / (1 + n / TEXT_WEIGHT))


def learn_text(rows: DataFrame) -> TextModel | None:
    """From every row of (text, declared) that declares a language."""
    languages = sorted(r[0] for r in rows.filter("declared IS NOT NULL").select("declared").distinct().collect())
    if not languages:
        return None
    place = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}  # of the languages that this task meets
        for b in batches:
            for text, tag in zip(b["text"], b["declared"], strict=True):
                if tag in place and (c := trigram_counts(text)) is not None:
                    sums[place[tag]] = sums.get(place[tag], 0) + c
        for k, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"k": k, "bucket": at, "n": own[at]})

    parts = in_small_batches(rows.select("text", "declared")).mapInPandas(count, "k int, bucket int, n bigint")
    met = parts.groupBy("k", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows at most
    return TextModel(languages, *[met[c].to_numpy(np.int64) for c in ("k", "bucket", "n")])


def _with_text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """Column ``_text`` replaced by ``_ll`` (array<double>; null without
    letters).  Only the text goes to Python; other columns stay in the JVM."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.evidence(t) for t in texts], dtype=object)

    return in_small_batches(rows).withColumn("_ll", F.pandas_udf(run, "array<double>")("_text")).drop("_text")


def _shrunk(counts: DataFrame, key: str, size: int, parent: Column, of_language: bool, totals: list[int]) -> DataFrame:
    """(key, array over languages): P(key | language) shrunk to the key's
    share, or P(language | key) shrunk to ``parent``, as logarithms."""
    by = counts.groupBy(key, "k").agg(F.sum("n").alias("n"), F.first("parent").alias("parent") if "parent" in counts.columns
                                      else F.first(F.lit(None)).alias("parent"))
    rows = by.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"), F.sum("n").alias("all"),
                               F.first("parent").alias("parent"))
    each = F.sequence(F.lit(0), F.lit(size - 1))
    own = lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0))
    if of_language:
        n_l = F.array(*[F.lit(float(t)) for t in totals])
        share = F.col("all") / F.lit(float(max(1, sum(totals))))
        value = F.transform(each, lambda i: F.log((own(i) + STRENGTH * share) / (F.get(n_l, i) + STRENGTH)))
    else:
        value = F.transform(each, lambda i: F.log((own(i) + STRENGTH * F.exp(F.get(parent, i))) / (F.col("all") + STRENGTH)))
    return rows.select(key, value.alias(f"_p{key}"))


def judge(rows: DataFrame, evidence: dict[str, Column], *, accept: float = ACCEPT) -> DataFrame:
    """The given columns as struct ``doc``, and language, confidence, accepted."""
    host = evidence["host"]
    base = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("doc"), evidence["text"].alias("_text"),
                       F.coalesce(_primary(evidence["declared"]), F.lit("")).alias("_declared"),
                       F.coalesce(evidence["suffix"], F.lit("")).alias("_suffix"), F.coalesce(host, F.lit("")).alias("_host"))
    model = learn_text(base.select(F.col("_text").alias("text"), F.nullif("_declared", F.lit("")).alias("declared")))
    if model is None:
        return base.select("doc", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"),
                           F.lit(False).alias("accepted"))
    size = len(model.languages)
    domain = F.regexp_extract("_host", r"([^.]+\.[^.]+)\.?$", 1)
    best = F.array_position("_ll", F.array_max("_ll")) - 1
    counts = persisted(_with_text_evidence(base.select("_text", "_declared", "_suffix", "_host"), model)
                       .filter("_ll IS NOT NULL").withColumn("_domain", F.when(domain != "", domain).otherwise(F.col("_host")))
                       .groupBy("_host", "_domain", "_declared", "_suffix", best.cast("int").alias("k"))
                       .agg(F.count(F.lit(1)).alias("n")), "langid-counts")
    totals = [0] * size
    for k, n in counts.groupBy("k").agg(F.sum("n")).collect():
        totals[k] = n
    overall = np.log((np.array(totals) + 1.0) / (sum(totals) + size)).tolist()
    everyone = F.array(*[F.lit(x) for x in overall])
    by_declared = persisted(_shrunk(counts, "_declared", size, everyone, True, totals), "langid-declared")
    by_suffix = persisted(_shrunk(counts, "_suffix", size, everyone, True, totals), "langid-suffix")
    by_domain = _shrunk(counts, "_domain", size, everyone, False, totals).withColumnRenamed("_p_domain", "parent")
    by_host = persisted(_shrunk(counts.join(by_domain, "_domain"), "_host", size, F.col("parent"), False, totals), "langid-host")

    # unseen values (rows without letters only) say nothing; an unknown host has everyone's prior
    none = F.array_repeat(F.lit(0.0), size)
    scored = (_with_text_evidence(base, model).join(by_declared, "_declared", "left").join(by_suffix, "_suffix", "left")
              .join(by_host, "_host", "left"))
    parts = [F.coalesce("_ll", none), F.coalesce("_p_declared", none), F.coalesce("_p_suffix", none),
             F.when(F.col("_host") != "", F.coalesce("_p_host", everyone)).otherwise(everyone)]
    total = parts[0]
    for p in parts[1:]:
        total = F.zip_with(total, p, lambda a, b: a + b)
    out = scored.select("doc", F.col("_ll").isNotNull().alias("letters"), total.alias("total"))
    top = F.array_max("total")
    confidence = 1 / F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("total")))
    names = F.array(*[F.lit(x) for x in model.languages])
    out = out.select("doc", "letters", F.get(names, (F.array_position("total", top) - 1).cast("int")).alias("language"),
                     confidence.alias("confidence"))
    return out.select("doc", "language", "confidence", (F.col("letters") & (F.col("confidence") >= accept)).alias("accepted"))


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_id, declared, language, confidence, accepted of all
    documents (page_id null) and all pages (doc_id null), judged together."""
    null = F.lit(None).cast("bigint")
    both = (docs.select("doc_id", null.alias("page_id"), *[c.alias(n) for n, c in document_evidence(docs).items()])
            .unionByName(pages.select(null.alias("doc_id"), "page_id", *[c.alias(n) for n, c in page_evidence(pages).items()])))
    out = judge(both, {n: F.col(n) for n in ("text", "declared", "host", "suffix")})
    return out.select("doc.doc_id", "doc.page_id", "doc.declared", "language", "confidence", "accepted")


def accepted_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents, in their own columns, whose language is accepted."""
    return judge(docs, document_evidence(docs), **options).filter("accepted").select("doc.*")
