import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(words))
