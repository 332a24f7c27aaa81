"""K5/K6 — product ratings and review-text mining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators.relational import top_k
from tessera.operators.text import ngram_frequency


def rated_products(ratings: DataFrame, min_count: int = 50) -> DataFrame:
    """(prod_id, avg_rating, num) for products with at least ``min_count``
    ratings (HAVING on the aggregate)."""
    return (ratings.groupBy("prod_id")
                   .agg(F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("num"))
                   .filter(F.col("num") >= min_count))


def rating_extremes(ratings: DataFrame, min_count: int = 50) -> DataFrame:
    """The best and the worst rated product among those with enough
    ratings, labelled ``extreme`` = 'best' / 'worst' (ties: lowest id)."""
    rated = rated_products(ratings, min_count)
    best = top_k(rated, 1, [F.col("avg_rating").desc()], ["prod_id"]).withColumn("extreme", F.lit("best"))
    worst = top_k(rated, 1, [F.col("avg_rating").asc()], ["prod_id"]).withColumn("extreme", F.lit("worst"))
    return best.unionByName(worst)


def review_words(ratings: DataFrame, message_col: str = "message", product: int | None = None) -> DataFrame:
    df = ratings if product is None else ratings.filter(F.col("prod_id") == product)
    return df.withColumn("words", tokenize(message_col))


def product_ngrams(ratings: DataFrame, n: int, k: int = 5, product: int | None = None,
                   per_product: bool = True) -> DataFrame:
    """Top ``k`` n-grams of the reviews of one product, or of every product."""
    words = review_words(ratings, product=product)
    group: Sequence[str] = ("prod_id",) if per_product else ()
    return ngram_frequency(words, n, k, out_col="ngram", group=group)


def comments_with_phrase(ratings: DataFrame, phrase: str, product: int | None = None) -> DataFrame:
    """Reviews containing ``phrase`` (case-sensitive substring)."""
    cond = F.col("message").contains(phrase)
    if product is not None:
        cond = (F.col("prod_id") == product) & cond
    return ratings.filter(cond)


def distinct_comments_with(ratings: DataFrame, word: str, product: int | None = None) -> DataFrame:
    return comments_with_phrase(ratings, word, product).select("message").distinct()


def product_record(products: DataFrame, prod_id: int) -> DataFrame:
    return products.filter(F.col("prod_id") == prod_id)


def products_named(products: DataFrame, name_phrase: str, brand: str) -> DataFrame:
    return products.filter(F.col("name").contains(name_phrase) & (F.col("brand") == brand))
