import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, `key` string, body string, fp long, at long, n long, row int"


def messy_texts():
    """Texts with every case an operator must take: copies, near copies, nulls, empty, long, repeats."""
    rng = random.Random(5)
    syllables = "the on er an ti re ed th ing ou ble st en es and to é ñó ß".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() + rng.choice(["", "", ".", ","]) for _ in range(n))
    passage, line = prose(60), prose(12)
    texts = [None, "", " \t\n ", "one", "Two words", "three short words"]
    texts += [prose(rng.randint(40, 160)) for _ in range(12)]
    texts += [f"{prose(50)}\n{line if i % 2 else '  ' + line.title().upper().lower() + ' '}\n{prose(45)}" for i in range(8)]
    texts += [f"{prose(20)} {passage} {prose(20)}" for _ in range(4)]
    texts += [passage, f"{passage} {passage}"]
    base = prose(200)
    texts += [base] * 5
    near = base.split()
    for i in range(6):
        near[20 + 20 * i] = word()
        texts.append(" ".join(near))
    texts += ["again " * 300, "!! SHOUTED %%% " * 40, "x" * 5000, prose(5000), "Ünïcode​ Σίσυφος 日本 <|endoftext|> don't I'LL 3²"]
    return texts


@pytest.fixture(scope="session")
def texts():
    return messy_texts()


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """The texts as a table with null and repeated ids and columns named like those of the operators."""
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 2}", 0 if t is None else len(t), 1, "k", "b", 2, 3, 4, 5) for i, t in enumerate(texts)]
    rows.append((None, "a text without an id, quite short", "en", None, None, None, None, None, None, None, None, None))
    rows.append(rows[8])
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path, mode="overwrite")
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def plain(docs):
    """(doc_id, text) of every row."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("doc_id < -1")
