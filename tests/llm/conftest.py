import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "sta", "Tor", "vä", "x") for b in ("n", "ri", "so", "tel", "u", "wen.", "z,")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, lang, source, n_chars, shard): prose, copies, near copies, a chain, junk, nulls, repeats and one long text."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(40)]
    texts += [None, "", " \t\n ", "one two", "ONE two", "a b c d e", "\n".join(["same line here"] * 6), "a  b\t\tc", "İ é <|endoftext|> don't 3.14"]
    base = sentence(rng, 100).split(" ")
    texts += [" ".join(base), " ".join(base).upper().lower(), " ".join(base)]
    for k in range(1, 9):  # each differs a little from the one before
        base = base[:]
        base[k * 11 % 100] = f"new{k}"
        texts.append(" ".join(base))
    texts += ["### | " + " *** ".join(sentence(rng, 1) for _ in range(80))]
    texts += ["Released under the MIT License. " + sentence(rng, 30), sentence(rng, 10) + " licensed under CC BY-NC 4.0 now", "mit license mit license apache license"]
    texts.append(sentence(rng, 20_000))
    out = [(i * 7 % 1009, t, ("en", "de", None)[i % 3], f"s{i % 2}", len(t or ""), i) for i, t in enumerate(texts)]
    out.append(out[0])  # a repeated row
    out.append((out[1][0], sentence(rng, 60), "en", "s", 1, 1))  # a repeated id with another text
    out.append((None, texts[3], "en", "s", 1, 1))
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
