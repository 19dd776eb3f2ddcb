import random

import pytest

SYLLABLES = "ka lo mi ne ru ta vo si den for gal hum ist jor kel".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = word(rng)
    return " ".join(words)


def make_texts(seed=1):
    """Texts with exact copies, near copies in chains, shared passages and lines, nulls, blanks and a very long one."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    line = "Common line of the whole corpus here."
    texts = [None, "", "", " \n\t ", "x", "x", "One two.", "one TWO.", None]
    for _ in range(12):
        texts.append("\n".join([line, sentence(rng, 30), sentence(rng, 8), sentence(rng, 14)]))
    base = sentence(rng, 90)
    chain = base
    for _ in range(10):
        texts += [base, edited(rng, base, 1), edited(rng, base, 3)]
        chain = edited(rng, chain, 1)
        texts.append(chain)
    for _ in range(8):
        texts.append(sentence(rng, 25) + " " + passage + " " + sentence(rng, 25))
    texts.append(sentence(rng, 6000) + "\n" + line + "\n" + passage)
    texts.append("ab " * 400)
    texts.append("Ünïcode ßtraße " + sentence(rng, 20) + " 漢字 \U0001f600   end")
    return texts


#: Names that operators use inside.
CLASHING = "doc text_hash line class n sigs places sig first place label row run digest shard slot score start length keys lines rank"


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, clash=True):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", f"s{n % 3}", len(t) if t is not None else None) for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"{c}!") for c in CLASHING.split()})
        return df.repartition(4) if rows else df

    return make


@pytest.fixture(scope="session")
def docs(make_docs, texts):
    """The texts, of which the last two rows repeat others, identifier and all, and two have no identifier."""
    return make_docs([*texts, texts[20], texts[10], "lone words here", None], [*range(len(texts)), 20, 10, None, None])


@pytest.fixture(scope="session")
def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]
