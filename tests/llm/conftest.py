import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators might use themselves.
CLASHING = "row long, digest string, _digest string, _again boolean, _best string, _key string, _text_key string, score double, `a.b` string"


@pytest.fixture(scope="session", autouse=True)
def shared_dir(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def words():
    r = random.Random(3)
    return ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(4000)]


@pytest.fixture
def documents(spark):
    def make(rows, clashing=False):
        full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        if not clashing:
            return spark.createDataFrame(full, DOCS)
        return spark.createDataFrame([(*f, 1, "d", "e", True, "f", "g", "h", 0.5, "i") for f in full], f"{DOCS}, {CLASHING}")

    return make


@pytest.fixture(scope="session")
def odd_rows(words):
    """Null and repeated ids, null, empty, blank and very long texts, ties, a large group of copies."""
    r = random.Random(4)
    long = " ".join(r.choice(words) for _ in range(60_000))
    plain = [" ".join(r.choice(words) for _ in range(r.randint(1, 300))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(plain)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, "a null id"), (None, "a null id"), (None, None), (103, long), (104, long), (105, "é中 \U0001f600 \\ \x00 end")]
    rows += [(200 + i, plain[0]) for i in range(80)] + [(300, plain[1]), (300, plain[1]), (301, plain[1] + " "), (302, plain[1].replace(" ", "  "))]
    return rows
