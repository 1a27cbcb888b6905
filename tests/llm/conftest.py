from __future__ import annotations

import random

import pytest

SYLLABLES = "an ber cho dun el fir gor hin isk jul kem lor mun nif oss pir qua rin sul tav ulm vek wor xim yel zan".split()


def prose(seed: int, n: int) -> str:
    """n invented words in sentences and lines."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        word = "".join(r.choices(SYLLABLES, k=r.randint(1, 3)))
        out.append(word + (".\n" if k % 23 == 22 else ". " if k % 9 == 8 else " "))
    return "".join(out).strip()


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """(doc_id, text): copies, near copies, a shared passage, nulls, repeats, a long text."""
    a, b = prose(1, 300), prose(2, 120)
    near = a.replace(a.split()[40], "changed", 1)
    passage = prose(3, 70).replace("\n", " ")
    pasted = prose(4, 60) + " tail " + passage + " more " + prose(5, 60)
    pasted2 = prose(6, 60) + " end " + passage + " next " + prose(7, 60)
    shout = "\n".join(["Same line again and again here."] * 12)
    mail = "write to jo.doe@mail.example.org or call +49 (30) 1234-5678 now, from 10.0.0.256 or 192.168.001.7, card 4111 1111 1111 1111."
    return [
        (1, a),
        (2, a),
        (3, near),
        (4, None),
        (5, ""),
        (None, b),
        (None, b),
        (6, pasted),
        (6, pasted),
        (7, pasted2),
        (8, prose(8, 6000)),
        (9, shout),
        (10, mail),
        (11, "été naïve 漢字 word"),
        (12, "..."),
        (13, "..."),
        (14, prose(9, 30) + "\n" + "\n".join(a.split("\n")[2:8])),
        (15, "one two"),
        (16, prose(8, 6000)[:9000] + " " + prose(10, 20)),
    ]


CLASHES = "key hash id kept task family side block shard band n_words n_hit row_id start root text_hash doc_key base_failed stratum quality lines windows gone mix_tokens mix_epoch tokens place source_".split()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with the columns of documents and many more whose names the operators use inside."""
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(odd_rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"x{c}") for c in CLASHES})


@pytest.fixture(scope="session")
def unique_rows(odd_rows) -> list[tuple]:
    """The rows with an id, each once, by id."""
    return sorted({i: t for i, t in odd_rows if i is not None}.items())


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
